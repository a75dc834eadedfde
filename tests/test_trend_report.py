from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from frames import detail, extract, ledger
from ledgertie.operators import quality, report, tieouts, trend

E, Q, Q2, Q3 = "East", "2025Q1", "2025Q2", "2025Q3"


@pytest.fixture(scope="module")
def feeds(spark):
    gl = ledger(
        spark,
        (E, "both", Q, 100), (E, "detail", Q, 100), (E, "clean", Q, 100), ("West", "late", Q, 100),
        (E, "clean", Q2, 100),
        (E, "one", Q3, 100),
    )
    loans = detail(
        spark,
        ("1", E, "both", Q, 90), ("2", E, "detail", Q, 120), ("3", E, "clean", Q, 100),
        ("4", "West", "late", Q, 70),
        ("5", E, "clean", Q2, 100),
        ("6", E, "one", Q3, 100),
    )
    filed = extract(
        spark,
        (E, "both", Q, 105), (E, "detail", Q, 100), (E, "clean", Q, 100), ("West", "late", Q, 100),
        (E, "clean", Q2, 100),
        (E, "orphan", Q3, 7), (E, "orphan 2", Q3, 8), (E, "one", Q3, 100),
        (E, "nowhere", "2026Q1", 5),
    )
    return gl, loans, filed


@pytest.fixture(scope="module")
def results(feeds):
    return report.run_all(*feeds)


def test_trend(results):
    found = results["quarterly_break_trend"]
    assert found.columns == [
        "quarter", "total_accounts", "accounts_with_breaks", "break_rate_pct",
        "total_break_amount", "subledger_breaks", "extract_breaks", "subledger_break_amount",
        "extract_break_amount",
    ]
    D = Decimal
    assert [tuple(row) for row in found.collect()] == [
        (Q, 4, 3, 75.0, D("65.00"), 3, 1, D("60.00"), D("5.00")),
        (Q2, 1, 0, 0.0, D("0.00"), 0, 0, D("0.00"), D("0.00")),
        (Q3, 1, 2, 200.0, D("15.00"), 0, 2, D("0.00"), D("15.00")),
    ]


def test_trend_agrees_with_results(results):
    first, second, found = results.values()
    assert quality.trend_mismatches(found, first, second).count() == 1  # 2026Q1 has no ledger row
    inside = second.filter(F.col("quarter") != "2026Q1")
    assert quality.trend_mismatches(found, first, inside).isEmpty()


def test_kpis(spark, results):
    first, second, _ = results.values()
    row = report.kpis(first, second).first()
    assert tuple(row) == (6, 6, 100.0, Decimal("85.00"), Decimal("30.00"))
    nothing = report.kpis(first.limit(0), second.limit(0)).first()
    assert tuple(nothing) == (0, 0, 0.0, Decimal("0.00"), Decimal("0.00"))


def test_scope_and_breaks_only(results):
    first = results["gl_vs_subledger"]
    assert report.scope(first).count() == 6
    assert report.scope(first, quarters=[Q]).count() == 4
    assert report.scope(first, [Q, Q2], ["West"]).count() == 1
    assert report.scope(first, quarters=[]).count() == 0
    assert report.breaks_only(first).count() == 3
    assert report.breaks_only(first, on=False).count() == 6


def test_cause_counts_and_ranking(results):
    first, second, _ = results.values()
    counts = [tuple(row) for row in report.cause_counts(first).collect()]
    assert counts == [("LATE_FEED", 2), ("DUPLICATE_LOAD", 1)]
    ranked = report.rank_breaks(first, "variance_pct").collect()
    assert [row["product"] for row in ranked] == ["late", "both", "detail"]
    filed = report.rank_breaks(second, "variance").collect()
    assert [row.variance for row in filed] == sorted(row.variance for row in filed)
    assert "offsetting_product" in filed[0].asDict()


def test_long_trend(results):
    long = report.trend_long(results["quarterly_break_trend"])
    assert long.columns == ["quarter", "tie_out", "amount"]
    rows = {(row.quarter, row.tie_out): row.amount for row in long.collect()}
    assert len(rows) == 6
    assert rows[Q, "GL vs sub-ledger"] == Decimal("60.00")
    assert rows[Q, "GL vs extract"] == Decimal("5.00")


def test_filter_values_and_counts(feeds, results):
    values = report.distinct_values(feeds[0], "quarter").collect()
    assert [row.quarter for row in values] == [Q, Q2, Q3]
    rows = report.break_counts(results).collect()
    counts = {row.result: (row.result_rows, row.breaks) for row in rows}
    assert counts == {
        "gl_vs_subledger": (6, 3),
        "gl_vs_regulatory_extract": (9, 4),
        "quarterly_break_trend": (3, None),
        "all": (18, 7),
    }


def test_population_counts_ledger_rows(spark):
    twice = ledger(spark, (E, "a", Q, 1), (E, "a", Q, 2))
    assert trend.population(twice).first().total_accounts == 2


def test_broken_in_both_counts_once(feeds):
    gl, loans, filed = feeds
    breaks = trend.stack_breaks(tieouts.flag_detail(gl, loans), tieouts.flag_filed(gl, filed))
    both = breaks.filter(F.col("product") == "both").collect()
    assert {row.reconciliation for row in both} == {"gl_vs_subledger", "gl_vs_regulatory_extract"}
