"""A whole close: feeds built with planted breaks, reconciled, and graded against the register."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgertie.functions.labels import batch_label, loan_label, period_end
from ledgertie.functions.variance import total
from ledgertie.operators import allocate, quality, report, whatif
from ledgertie.operators.ordered import mark_until
from ledgertie.sources.schemas import KEYS, REGISTER

ENTITIES = ["North", "South", "West", "East", "Centre"]
PRODUCTS = ["Home", "Car", "Card", "Cash", "Line", "Shop"]
QUARTERS = ["2025Q1", "2025Q2"]
LATE = [
    ("North", "Home", "2025Q1", 1),
    ("West", "Card", "2025Q2", 2),
    ("East", "Shop", "2025Q1", 3),
]
TWICE = [("Centre", "Cash", "2025Q1", 4), ("North", "Car", "2025Q2", 5)]
TIMING = [("South", "Home", "2025Q1", 6), ("East", "Car", "2025Q2", 7)]
MOVES = [("North", "2025Q1", "Line", "Cash", 8), ("West", "2025Q2", "Car", "Shop", 9)]


def run_date():
    return F.date_add(period_end(F.col("quarter")), 8)


@pytest.fixture(scope="module")
def close(spark):
    lists = spark.createDataFrame(
        [(ENTITIES[i % 5], PRODUCTS[i], QUARTERS[i % 2]) for i in range(6)], KEYS
    )
    gl = whatif.universe(lists, KEYS).select(
        *KEYS,
        (F.crc32(F.concat_ws("|", *KEYS).cast("binary")) % 900000 + 400000)
        .cast("decimal(18,2)")
        .alias("gl_balance"),
    )
    loans = gl.withColumn("position", F.explode(F.sequence(F.lit(0), F.lit(59)))).withColumn(
        "weight", F.pmod(F.xxhash64(*KEYS, "position"), F.lit(1000)) + 500
    )
    loans = allocate.apportion_exact(loans, KEYS, "gl_balance", "weight", "position", "loan_amount")
    loans = allocate.assign_batches(loans.drop("position"), KEYS, ["weight", "loan_amount"])
    loans = loans.select(
        loan_label(F.col("entity"), F.col("product"), F.col("quarter"), F.col("position")).alias(
            "loan_id"
        ),
        *KEYS,
        "loan_amount",
        batch_label(F.col("quarter"), F.col("batch")).alias("load_batch_id"),
        "position",
    )

    def planted(rows):
        scenario = spark.createDataFrame(rows, [*KEYS, "break_no"])
        share = total(F.round(F.col("gl_balance") * Decimal("0.03"), 2))
        return scenario.join(gl, KEYS).select(*KEYS, "break_no", share.alias("target"))

    parts, spoilt = [], loans
    for kind, rows, last in (("late_feed", LATE, True), ("duplicate_load", TWICE, False)):
        aimed = allocate.with_target(loans, planted(rows), KEYS)
        marked = mark_until(aimed, KEYS, ["position"], "loan_amount", "target", descending=last)
        parts.append(whatif.detail_register(kind, whatif.moved_loans(marked), gl))
        with_target = allocate.with_target(spoilt, planted(rows).drop("break_no"), KEYS)
        if last:
            spoilt = allocate.drop_tail_until(
                with_target, KEYS, ["position"], "loan_amount", "target"
            ).drop("target")
        else:
            spoilt = allocate.replay_head_until(
                with_target, KEYS, ["position"], "loan_amount", "target"
            ).drop("target")
    fraction = F.lit(Decimal("0.026")).alias("fraction")
    timing = spark.createDataFrame(TIMING, [*KEYS, "break_no"]).select("*", fraction)
    moves = spark.createDataFrame(
        MOVES, ["entity", "quarter", "source", "target", "break_no"]
    ).select("*", fraction)
    parts.append(whatif.timing_register(timing, gl, run_date()))
    parts.append(whatif.mapping_register(moves, gl))
    deltas = whatif.timing_deltas(gl, timing).select(*KEYS, "delta").unionByName(
        whatif.mapping_deltas(gl, moves).select(*KEYS, "delta")
    )
    filed = whatif.filed_from_gl(gl, deltas, F.lit("H.1"), run_date())
    key = whatif.assemble_register(*parts).cache()
    results = {name: df.cache() for name, df in report.run_all(gl, spoilt, filed).items()}
    return gl.cache(), loans.cache(), spoilt.cache(), filed.cache(), key, results


def side(key, name):
    return key.filter(F.col("detected_by") == name)


def test_universe_has_every_account(close):
    gl = close[0]
    assert gl.count() == 60 and quality.repeated_accounts(gl).isEmpty()
    assert quality.universe_gaps(gl).isEmpty()
    assert quality.universe_gaps(gl.filter("entity <> 'East' or product <> 'Car'")).count() == 2


def test_clean_detail_foots_exactly(close):
    gl, loans, spoilt, _, key, _ = close
    assert allocate.not_positive(loans, "loan_amount").isEmpty()
    assert quality.not_footing(gl, loans, key.limit(0)).isEmpty()
    assert quality.not_footing(gl, spoilt, key).isEmpty()
    assert quality.not_footing(gl, spoilt, key.limit(0)).count() == 5
    assert quality.not_footing(gl, loans, key).count() == 5


def test_register(close):
    key = close[4]
    assert key.columns == [field.name for field in REGISTER]
    rows = key.collect()
    assert len(rows) == 11
    assert [(r.quarter, r.entity, r["product"]) for r in rows] == sorted(
        (r.quarter, r.entity, r["product"]) for r in rows
    )
    by_id = {}
    for row in rows:
        by_id.setdefault(row.break_id, []).append(row)
    assert set(by_id) == {f"BRK-{n:03d}" for n in range(1, 10)}
    late, pair = by_id["BRK-001"][0], by_id["BRK-008"]
    assert (late.expected_direction, late.expected_root_cause) == ("under", "LATE_FEED")
    assert late.planted_variance < 0 and late.notes.endswith("never reached the sub-ledger")
    assert {r.expected_direction for r in pair} == {"under", "over"}
    assert sum(r.planted_variance for r in pair) == 0
    assert by_id["BRK-006"][0].notes == (
        "GL adjustment posted after the 2025-04-08 extract run; no offsetting entry elsewhere"
    )


def test_register_is_a_usable_key(close):
    key = close[4]
    assert quality.repeated_accounts(key).isEmpty()
    assert quality.missing_modes(key).isEmpty()
    assert quality.thin_margins(key).isEmpty()
    assert quality.unbalanced_pairs(key).isEmpty()
    one_kind = key.filter("break_type = 'late_feed'")
    assert {r.break_type for r in quality.missing_modes(one_kind).collect()} == {
        "duplicate_load", "timing_difference", "mapping_error",
    }
    assert quality.repeated_accounts(key.unionByName(key)).count() == 11
    assert quality.thin_margins(key, threshold=50).count() == 11
    half = key.filter("break_type <> 'mapping_error' or expected_direction = 'under'")
    assert quality.unbalanced_pairs(half).count() == 2


def test_every_planted_break_is_found_and_no_other(close):
    key, results = close[4], close[5]
    for result, name in (
        (results["gl_vs_subledger"], "gl_vs_subledger"),
        (results["gl_vs_regulatory_extract"], "gl_vs_regulatory_extract"),
    ):
        own = side(key, name)
        assert quality.grade_breaks(result, own).isEmpty()
        assert quality.missed_breaks(result, own).isEmpty()
        assert quality.spurious_breaks(result, own).isEmpty()
        assert quality.extra_break_rows(result, own).isEmpty()
        assert quality.clean_over_threshold(result, key).isEmpty()
        assert quality.clean_not_zero(result, key).isEmpty()
        assert quality.clean_accounts(result, key).count() == 49
        assert quality.cause_mismatches(result, own).isEmpty()
        planted = {(r.entity, r["product"], r.quarter): r for r in own.collect()}
        for row in report.breaks_only(result).collect():
            expected = planted[row.entity, row["product"], row.quarter]
            assert row.variance == expected.planted_variance
            assert row.variance_pct == expected.planted_variance_pct


def test_graders_tell_missed_from_spurious(close):
    key, results = close[4], close[5]
    first = results["gl_vs_subledger"]
    own = side(key, "gl_vs_subledger")
    other = own.filter("break_id <> 'BRK-001'").unionByName(side(key, "gl_vs_regulatory_extract"))
    graded = quality.grade_breaks(first, other).collect()
    verdicts = {(r.entity, r["product"]): r.verdict for r in graded}
    assert verdicts.pop(("North", "Home")) == "SPURIOUS"
    assert set(verdicts.values()) == {"MISSED"} and len(verdicts) == 6
    assert quality.spurious_breaks(first, other).count() == 1
    assert quality.missed_breaks(first, other).count() == 6
    row = quality.extra_break_rows(first, other).first()
    assert tuple(row) == (5, 10)
    assert quality.clean_not_zero(first, other).count() == 1
    assert quality.clean_over_threshold(first, other).count() == 1
    wrong = own.withColumn("expected_root_cause", F.lit("LATE_FEED"))
    assert quality.cause_mismatches(first, wrong).count() == 2
    flipped = first.withColumn("variance", -F.col("variance"))
    assert quality.cause_mismatches(flipped, own).count() == 5


def test_labels_are_corroborated(close):
    first, second = close[5]["gl_vs_subledger"], close[5]["gl_vs_regulatory_extract"]
    assert quality.uncorroborated_duplicates(first).isEmpty()
    assert quality.uncorroborated_duplicates(
        first.withColumn("duplicate_loan_ids", F.lit(0))
    ).count() == 2
    assert quality.asymmetric_pairs(second).isEmpty()
    assert quality.asymmetric_pairs(second.filter("product <> 'Cash'")).count() == 1
    assert quality.two_sided_timing(second).isEmpty()
    named = second.withColumn("offsetting_product", F.lit("X"))
    assert quality.two_sided_timing(named).count() == 2
    assert quality.asymmetric_pairs(named).count() == 4


def test_trend_covers_the_register(close):
    key, results = close[4], close[5]
    first, second, trend = results.values()
    assert quality.trend_mismatches(trend, first, second).isEmpty()
    assert quality.trend_coverage(trend, key).isEmpty()
    assert tuple(quality.trend_coverage(trend, key.limit(4)).first()) == (11, 4, 0)
    over = trend.withColumn("break_rate_pct", F.lit(120.0))
    assert quality.trend_coverage(over, key).first().periods_over_100 == 2


def test_adjust_and_reclass_keep_other_accounts(spark, close):
    gl = close[0]
    fraction = F.lit(Decimal("0.1")).alias("fraction")
    timing = spark.createDataFrame(TIMING[:1], [*KEYS, "break_no"]).select("*", fraction)
    adjusted = whatif.adjust_balance(gl, timing)
    changed = quality.multiset_diff(gl.select(KEYS), adjusted.select(KEYS))
    assert changed.isEmpty()
    after = adjusted.withColumnRenamed("gl_balance", "after")
    gap = gl.join(after, KEYS).filter("gl_balance <> after")
    row = gap.first()
    assert gap.count() == 1 and row.after == row.gl_balance * Decimal("0.9")
    moves = spark.createDataFrame(
        MOVES[:1], ["entity", "quarter", "source", "target", "break_no"]
    ).select("*", fraction)
    moved = whatif.reclass_balance(gl, moves)
    sums = [df.agg(F.sum("gl_balance")).first()[0] for df in (gl, moved)]
    assert sums[0] == sums[1]
    assert quality.multiset_diff(
        gl.select(*KEYS, total(F.col("gl_balance")).alias("b")),
        moved.select(*KEYS, F.col("gl_balance").alias("b")),
    ).count() == 4


def test_moves_keep_the_total_where_an_account_is_absent(spark):
    rows = [("North", "Home", "2025Q1", Decimal("100.00"))]
    gl = spark.createDataFrame(rows, "entity string, product string, quarter string, gl_balance decimal(18,2)")
    moves = spark.createDataFrame(
        [("North", "2025Q1", "Home", "Auto", 1), ("North", "2025Q1", "Cash", "Home", 2)],
        ["entity", "quarter", "source", "target", "break_no"],
    ).select("*", F.lit(Decimal("0.1")).alias("fraction"))
    moved = {r["product"]: r.gl_balance for r in whatif.reclass_balance(gl, moves).collect()}
    assert moved == {"Home": Decimal("90.00"), "Auto": Decimal("10.00")}
    left = whatif.unmatched_scenarios(gl, moves.withColumnRenamed("source", "product"))
    assert [r.break_no for r in left.collect()] == [2]
