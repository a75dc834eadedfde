from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from frames import by_product, detail, dollars, extract, ledger
from ledgertie.operators import offsets, tieouts
from ledgertie.sources.schemas import KEYS

E, Q = "East", "2025Q1"


def test_detail_tieout_cases(spark):
    gl = ledger(
        spark,
        (E, "at", Q, 1000),
        (E, "above", Q, 1000),
        (E, "zero", Q, 0),
        (E, "unbased", Q, 0),
        (E, "absent", Q, 100),
        (E, "late", Q, 100),
        (E, "twice", Q, 100),
    )
    loans = detail(
        spark,
        ("1", E, "at", Q, 1005),
        ("2", E, "above", Q, "1005.01"),
        ("3", E, "unbased", Q, 10),
        ("4", E, "late", Q, 90),
        ("5", E, "twice", Q, 100),
        ("5", E, "twice", Q, 100),
        ("6", E, "no ledger row", Q, 5),
    )
    result = tieouts.reconcile_detail(gl, loans)
    assert result.columns == [
        "entity", "product", "quarter", "gl_balance", "sub_ledger_balance", "loan_count",
        "duplicate_loan_ids", "variance", "variance_pct", "status", "root_cause",
        "suggested_action",
    ]
    rows = by_product(result)
    assert len(rows) == 7 and "no ledger row" not in rows
    assert {name: (r.status, r.root_cause) for name, r in rows.items()} == {
        "at": ("PASS", "NONE"),
        "above": ("BREAK", "DUPLICATE_LOAD"),
        "zero": ("PASS", "NONE"),
        "unbased": ("BREAK", "DUPLICATE_LOAD"),
        "absent": ("BREAK", "FEED_NOT_RECEIVED"),
        "late": ("BREAK", "LATE_FEED"),
        "twice": ("BREAK", "DUPLICATE_LOAD"),
    }
    assert rows["zero"].variance_pct is None and rows["unbased"].variance_pct is None
    assert (rows["absent"].loan_count, rows["absent"].variance_pct) == (0, -100.0)
    assert rows["twice"].duplicate_loan_ids == 1 and rows["above"].duplicate_loan_ids == 0
    ordered = [row["product"] for row in result.collect()]
    assert ordered == ["absent", "twice", "late", "above", "unbased", "at", "zero"]


def test_duplicate_ledger_rows_stay_apart_in_detail_and_fold_in_filed(spark):
    gl = ledger(spark, (E, "a", Q, 60), (E, "a", Q, 40))
    loans = detail(spark, ("1", E, "a", Q, 100))
    assert tieouts.reconcile_detail(gl, loans).count() == 2
    filed = tieouts.reconcile_filed(gl, extract(spark, (E, "a", Q, 100))).collect()
    assert [(row.gl_balance, row.status) for row in filed] == [(Decimal("100.00"), "PASS")]


def test_threshold_is_a_parameter(spark):
    gl, loans = ledger(spark, (E, "a", Q, 100)), detail(spark, ("1", E, "a", Q, 101))
    assert tieouts.reconcile_detail(gl, loans, threshold=1).first().status == "PASS"
    assert tieouts.reconcile_detail(gl, loans, threshold=0.99).first().status == "BREAK"


PAIRINGS = [tieouts.pair_by_stacking, tieouts.pair_by_full_join, tieouts.pair_by_union]
PARTNERS = [offsets.offset_partner, offsets.offset_partner_by_join]


@pytest.mark.parametrize("pairing", PAIRINGS)
@pytest.mark.parametrize("partners", PARTNERS)
def test_filed_tieout_cases(spark, pairing, partners):
    """One entity per case; every ledger account has 1000 unless stated."""
    q2 = "2025Q2"
    gl = ledger(
        spark,
        ("pair", "A", Q, 1000), ("pair", "B", Q, 1000),
        ("cent", "A", Q, 1000), ("cent", "B", Q, 1000),
        ("under", "A", Q, 1000), ("under", "B", Q, 1000000),
        ("three", "A", Q, 1000), ("three", "B", Q, 1000), ("three", "C", Q, 1000),
        ("period", "A", Q, 1000), ("period", "B", q2, 1000),
        ("cross", "A", Q, 100),
        ("empty", "A", Q, 0),
    )
    filed = extract(
        spark,
        ("pair", "A", Q, 950), ("pair", "B", Q, 1050),
        ("cent", "A", Q, 950), ("cent", "B", Q, "1050.01"),
        ("under", "A", Q, 950), ("under", "B", Q, 1000050),
        ("three", "A", Q, 950), ("three", "B", Q, 1050), ("three", "C", Q, 1050),
        ("period", "A", Q, 950), ("period", "B", q2, 1050),
        ("cross", "B", Q, 100),
    )
    result = tieouts.reconcile_filed(gl, filed, pairing=pairing, partners=partners)
    assert result.columns == [
        "entity", "product", "quarter", "gl_balance", "extract_balance", "variance",
        "variance_pct", "status", "root_cause", "offsetting_product", "suggested_action",
    ]
    found = {
        (r.entity, r["product"]): (r.root_cause, r.offsetting_product) for r in result.collect()
    }
    assert found == {
        ("pair", "A"): ("MAPPING_ERROR", "B"),
        ("pair", "B"): ("MAPPING_ERROR", "A"),
        ("cent", "A"): ("TIMING_DIFFERENCE", None),
        ("cent", "B"): ("UNEXPLAINED_OVERSTATEMENT", None),
        ("under", "A"): ("TIMING_DIFFERENCE", None),
        ("under", "B"): ("NONE", None),
        ("three", "A"): ("MAPPING_ERROR", "C"),
        ("three", "B"): ("MAPPING_ERROR", "A"),
        ("three", "C"): ("MAPPING_ERROR", "A"),
        ("period", "A"): ("TIMING_DIFFERENCE", None),
        ("period", "B"): ("UNEXPLAINED_OVERSTATEMENT", None),
        ("cross", "A"): ("MISSING_FROM_EXTRACT", "B"),
        ("cross", "B"): ("NOT_IN_GL", "A"),
        ("empty", "A"): ("MISSING_FROM_EXTRACT", None),
    }
    rows = {(r.entity, r["product"]): r for r in result.collect()}
    assert rows["cross", "B"].variance_pct is None and rows["cross", "B"].quarter == Q
    assert (rows["empty", "A"].status, rows["empty", "A"].variance) == ("BREAK", 0)


@pytest.mark.parametrize("partners", PARTNERS)
def test_partners_agree_with_comparing_every_pair(spark, partners):
    """Few amounts, so that many breaks share a variance; most of one entity is one amount."""
    rng = random.Random(7)
    rows = []
    for entity in ("E1", "E2"):
        for number in range(120):
            amount = rng.choice([-3, -2, -1, 0, 1, 2, 3]) if entity == "E1" else (
                -5 if number % 3 else 5
            )
            status = "PASS" if rng.random() < 0.2 else "BREAK"
            rows.append((entity, f"P{number:03d}", Q, dollars(amount), status))
    flagged = spark.createDataFrame(
        rows, "entity string, product string, quarter string, variance decimal(38,2), status string"
    )
    expected = {}
    for e, p, _, v, s in rows:
        matches = [
            op for oe, op, _, ov, os in rows
            if s == "BREAK" and os == "BREAK" and oe == e and op != p and ov != 0
            and abs(ov + v) < Decimal("0.01")
        ]
        if matches:
            expected[e, p] = max(matches)
    found = partners(flagged, KEYS, "product").collect()
    assert {(r.entity, r["product"]): r.offsetting_product for r in found} == expected
    assert len(found) == len(expected)


def test_keys_and_columns_can_have_other_names(spark):
    gl = ledger(spark, (E, "a", Q, 100)).toDF("firm", "line", "month", "booked")
    loans = detail(spark, ("1", E, "a", Q, 90)).toDF("ref", "firm", "line", "month", "amount")
    flagged = tieouts.flag_detail(gl, loans, ["firm", "line", "month"], "booked", "amount", "ref")
    assert flagged.select("firm", "variance", "status").first() == (E, Decimal("-10.00"), "BREAK")


def test_large_totals_do_not_overflow(spark):
    many = spark.range(40).select(
        F.col("id").cast("string").alias("loan_id"),
        F.lit(E).alias("entity"), F.lit("a").alias("product"), F.lit(Q).alias("quarter"),
        F.lit(Decimal("9999999999999999.99")).alias("loan_amount"),
    )
    gl = ledger(spark, (E, "a", Q, 100))
    row = tieouts.reconcile_detail(gl, many).first()
    assert row.sub_ledger_balance == 40 * Decimal("9999999999999999.99")
    assert row.root_cause == "DUPLICATE_LOAD"


def test_flags_without_ids_agree_and_null_ids_are_no_id(spark):
    gl = ledger(spark, (E, "a", Q, 100), (E, "b", Q, 100))
    loans = detail(
        spark, ("1", E, "a", Q, 60), ("1", E, "a", Q, 60), (None, E, "a", Q, 1), (None, E, "a", Q, 1)
    )
    full = tieouts.flag_detail(gl, loans)
    lean = tieouts.flag_detail(gl, loans, id_col=None)
    assert set(full.columns) - set(lean.columns) == {"loan_count", "duplicate_loan_ids"}
    assert full.select(lean.columns).collect() == lean.collect()
    row = full.filter("product = 'a'").first()
    assert (row.loan_count, row.duplicate_loan_ids) == (4, 3)
