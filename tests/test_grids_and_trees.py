"""Offsets within a tolerance, digest trees, gaps, split ledgers and figures of any scope."""

from __future__ import annotations

import itertools
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from frames import detail, dollars, ledger
from ledgertie.operators import kept, offsets, quality, report, rollups, whatif
from ledgertie.operators.digests import differing_buckets, tree_diff
from ledgertie.operators.tolerance import offset_partner_within
from ledgertie.sources import generations
from ledgertie.sources.schemas import KEYS

FLAGGED = "entity string, product string, quarter string, variance decimal(38,2), status string"


def breaks(spark, seed: int, spread: int, accounts: int = 60):
    draw = random.Random(seed)
    rows = []
    for entity, quarter in itertools.product(["East", "West", "Hot"], ["2025Q1", "2025Q2"]):
        for i in range(accounts * (4 if entity == "Hot" else 1)):
            cents = draw.randint(-spread, spread)
            status = "PASS" if draw.random() < 0.1 else "BREAK"
            rows.append((entity, f"P{i:03d}", quarter, Decimal(cents) / 100, status))
    return rows, spark.createDataFrame(rows, FLAGGED).repartition(3)


def partners_by_loop(rows, tolerance: Decimal) -> dict:
    found = {}
    for e, p, q, v, s in rows:
        fits = [
            p2 for e2, p2, q2, v2, s2 in rows
            if (e2, q2) == (e, q) and p2 != p and s == s2 == "BREAK" and v2 and abs(v + v2) < tolerance
        ]
        if fits:
            found[e, p, q] = max(fits)
    return found


@pytest.mark.parametrize(
    "spread, tolerance", [(30, "0.01"), (30, "0.37"), (2000, "0.02"), (2000, "1.00"), (2000, "12.50"), (30, "9.00")]
)
def test_partners_within_a_tolerance_are_those_of_all_pairs(spark, spread, tolerance):
    rows, flagged = breaks(spark, spread, spread)
    got = offset_partner_within(flagged, KEYS, "product", tolerance).collect()
    assert {tuple(r)[:3]: r.offsetting_product for r in got} == partners_by_loop(rows, Decimal(tolerance))
    assert len({tuple(r)[:3] for r in got}) == len(got)


def test_a_cent_is_equality_and_other_tolerances_are_refused(spark):
    _, flagged = breaks(spark, 5, 400)
    nonzero = flagged.filter("variance <> 0")
    exact = offsets.offset_partner(nonzero, KEYS, "product")
    assert quality.multiset_diff(offset_partner_within(nonzero, KEYS, "product"), exact).isEmpty()
    for wrong in ("0", "-1.00", "0.005"):
        with pytest.raises(ValueError):
            offset_partner_within(flagged, KEYS, "product", wrong)


@pytest.mark.parametrize("planted", [0, 1, 40])
def test_digest_trees_find_what_multisets_differ_in(spark, planted):
    draw = random.Random(planted)
    rows = [(i % 700, None if i % 5 else f"x{i % 11}", i % 3) for i in range(3000)]
    other = list(rows)
    for _ in range(planted):
        kind, at = draw.randrange(4), draw.randrange(len(other))
        if kind == 0:
            other.pop(at)
        elif kind == 1:
            other.append(other[at])
        elif kind == 2:
            other[at] = (None, f"{other[at][0]}", 5)
        else:
            other[at] = (other[at][0], None, None)
    schema = "a int, b string, c int"
    left, right = spark.createDataFrame(rows, schema), spark.createDataFrame(other, schema).repartition(4)
    want = sorted(map(tuple, quality.multiset_diff(left, right).collect()), key=str)
    assert sorted(map(tuple, tree_diff(left, right, 16, 8).collect()), key=str) == want
    assert bool(want) == bool(planted)


def test_swapped_nulls_are_told_apart(spark):
    left = spark.createDataFrame([("a", None), (None, "b")], "x string, y string")
    right = spark.createDataFrame([(None, "a"), ("b", None)], "x string, y string")
    assert tree_diff(left, right).count() == 4
    assert tree_diff(left, left).isEmpty()


def test_equal_tables_move_no_rows(spark):
    from ledgertie.operators import digests

    df = spark.range(5000).selectExpr("id AS a", "id % 7 AS b")
    rows = digests._signed(df, df.repartition(3), 32, 8)
    assert differing_buckets(rows, ["_wide"]).isEmpty()


@pytest.mark.parametrize("sizes", [(3, 4, 5), (1, 1, 1), (2, 30, 9)])
def test_gaps_are_the_universe_less_the_table(spark, sizes):
    draw = random.Random(sum(sizes))
    every = list(itertools.product(*([f"{d}{i}" for i in range(n)] for d, n in zip("abc", sizes, strict=True))))
    held = [row for row in every if draw.random() < 0.35] or every[:1]
    held += held[:2] + [("a0", None, "c0")]
    df = spark.createDataFrame(held, "a string, b string, c string")
    got = quality.universe_gaps(df, ["a", "b", "c"])
    values = [{row[i] for row in held if None not in row} for i in range(3)]
    want = set(itertools.product(*values)) - set(held)
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_gaps_over_several_blocks(spark):
    pairs = spark.range(10_000).selectExpr("'all' AS a", "id AS b")
    some = spark.range(10_000).filter("id % 4000 = 7").selectExpr("'some' AS a", "id AS b")
    got = quality.universe_gaps(pairs.unionByName(some), ["a", "b"])
    assert got.count() == 9997 and got.filter("a = 'some' AND b % 4000 <> 7").count() == 9997
    assert quality.universe_gaps(pairs.limit(0), ["a", "b"]).count() == 0


def split_ledger(spark):
    q = "2025Q1"
    rows = [("East", "a", q, 100), ("East", "a", q, 50), ("East", "b", q, 10), ("East", "b", q, 10)]
    return ledger(spark, *rows, ("West", "a", q, 7))


def balances(df) -> dict:
    found: dict = {}
    for row in df.collect():
        found.setdefault((row.entity, row["product"]), []).append(row.gl_balance)
    return {key: sorted(held) for key, held in found.items()}


def test_what_if_on_split_ledgers_keeps_totals(spark):
    gl = split_ledger(spark)
    fraction = F.lit(Decimal("0.10")).cast("decimal(12,8)").alias("fraction")
    timing = spark.createDataFrame([("East", "a", "2025Q1", 3)], [*KEYS, "break_no"]).select("*", fraction)
    adjusted = balances(whatif.adjust_balance(gl, timing))
    assert adjusted[("East", "a")] == [dollars(35), dollars(100)]  # 135 of 150: the least row bears it
    moves = spark.createDataFrame(
        [("East", "2025Q1", "a", "b", 4), ("East", "2025Q1", "a", "new", 5)],
        ["entity", "quarter", "source", "target", "break_no"],
    ).select("*", fraction)
    moved = balances(whatif.reclass_balance(gl, moves))
    assert moved == {
        ("East", "a"): [dollars(20), dollars(100)],
        ("East", "b"): [dollars(10), dollars(25)],
        ("East", "new"): [dollars(15)],
        ("West", "a"): [dollars(7)],
    }
    lines = whatif.mapping_register(moves, gl).collect()
    assert len(lines) == 4 and sum(line.planted_variance for line in lines) == 0
    shares = {(r.break_id, r["product"]): r.planted_variance_pct for r in lines}
    assert shares["BRK-004", "a"] == -10.0 and shares["BRK-004", "b"] == 75.0
    assert len(whatif.timing_register(timing, gl, F.lit("2025-04-08")).collect()) == 1


def test_figures_of_every_scope_equal_those_of_filtered_results(spark):
    rows, flagged = breaks(spark, 2, 500, 12)
    filed = flagged.filter("product <> 'P003'")
    cells = report.kpi_cells(flagged, filed).cache()
    scopes = [(None, None), (["2025Q1"], None), (None, ["East", "Hot"]), (["2025Q2"], ["West"]), (["x"], None)]
    for scope in scopes:
        own = report.kpis(report.scope(flagged, *scope), report.scope(filed, *scope)).collect()
        assert report.kpis_of_scope(cells, *scope).collect() == own, scope
    cube = {(r.entity, r.quarter): r for r in report.kpi_cube(cells).collect()}
    assert len(cube) == 12
    for (entity, quarter), row in cube.items():
        chosen = [None if quarter == "ALL" else [quarter], None if entity == "ALL" else [entity]]
        own = report.kpis(report.scope(flagged, *chosen), report.scope(filed, *chosen)).first()
        assert [row[name] for name in report.KPI_COLUMNS] == list(own)
    with pytest.raises(ValueError):
        report.kpi_cells(flagged, filed, ["status"])


def test_kept_rollups_follow_loads(spark, tmp_path):
    draw = random.Random(3)
    rows = [
        (draw.choice([f"L{i}" for i in range(80)] + [None]), "Hot" if draw.random() < 0.6 else "East",
         draw.choice(["a", "b", None]), "2025Q1", draw.randint(1, 9999) / 100)
        for _ in range(900)
    ]
    loads = [detail(spark, *rows[:400]), detail(spark, *rows[400:405]), detail(spark, *rows[405:])]
    state, columns = str(tmp_path / "state"), (KEYS, "loan_amount", "loan_id")
    whole = None
    for load in loads:
        whole = load if whole is None else whole.unionByName(load)
        full = rollups.rollup_to_grain(whole, *columns)
        changed = kept.fold_load(load, state, *columns, buckets=(4, 2))
        same = [F.col(f"c.{key}").eqNullSafe(F.col(f"f.{key}")) for key in KEYS]
        own = full.alias("f").join(load.select(*KEYS).distinct().alias("c"), same, "left_semi")
        assert quality.multiset_diff(changed, own.select(*changed.columns)).isEmpty()
        held = kept.rollup_of(spark, state, whole, KEYS, "loan_id")
        assert quality.multiset_diff(held, full.select(*held.columns)).isEmpty()
    before = generations.current(spark, state)
    broken = loads[1].withColumn("loan_amount", F.raise_error(F.lit("no")).cast("decimal(18,2)"))
    with pytest.raises(Exception, match="no"):
        kept.fold_load(broken, state, *columns, buckets=(4, 2))
    assert generations.current(spark, state) == before
