"""Breaks of both tie-outs stacked, and their trend per period."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgertie.functions.variance import BREAK, total, total_or_zero
from ledgertie.sources.schemas import KEYS, PERIOD

# How each tie-out is named in results.
DETAIL_TIE_OUT = "gl_vs_subledger"
FILED_TIE_OUT = "gl_vs_regulatory_extract"


def stack_breaks(detail: DataFrame, filed: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """One row per break of either tie-out, with the tie-out's name and the absolute amount."""

    def tagged(result: DataFrame, name: str) -> DataFrame:
        return result.filter(F.col("status") == BREAK).select(
            *keys,
            F.lit(name).alias("reconciliation"),
            F.abs("variance").alias("break_amount"),
        )

    return tagged(detail, DETAIL_TIE_OUT).unionByName(tagged(filed, FILED_TIE_OUT))


def population(gl: DataFrame, period: str = PERIOD) -> DataFrame:
    """Ledger accounts per period."""
    return gl.groupBy(period).agg(F.count("*").alias("total_accounts"))


def break_trend(
    gl: DataFrame, breaks: DataFrame, period: str = PERIOD, account_cols: list[str] | None = None
) -> DataFrame:
    """Break rate and amounts per period.

    An account broken in both tie-outs counts once and its two amounts both count.
    Breaks are folded to one row per period before they meet the population, so the
    join has a handful of rows on each side however many breaks there are. Filed
    accounts without a ledger row are in the numerator only, so the rate can pass
    100; a period without any ledger row has no line.
    """
    accounts = account_cols or [key for key in KEYS if key != period]
    in_detail = F.col("reconciliation") == DETAIL_TIE_OUT
    in_filed = F.col("reconciliation") == FILED_TIE_OUT
    amount = F.col("break_amount")
    folded = breaks.groupBy(period).agg(
        F.count_distinct(*accounts).alias("accounts_with_breaks"),
        F.sum(amount).alias("total_break_amount"),
        F.count_if(in_detail).alias("subledger_breaks"),
        F.count_if(in_filed).alias("extract_breaks"),
        F.sum(F.when(in_detail, amount)).alias("subledger_break_amount"),
        F.sum(F.when(in_filed, amount)).alias("extract_break_amount"),
    )
    counts = ["accounts_with_breaks", "subledger_breaks", "extract_breaks"]
    amounts = ["total_break_amount", "subledger_break_amount", "extract_break_amount"]
    rate = F.lit(100.0) * F.col("accounts_with_breaks") / F.col("total_accounts")
    return (
        population(gl, period)
        .join(folded, period, "left")
        .fillna(0, subset=counts)
        .withColumns({name: total_or_zero(total(F.col(name))) for name in amounts})
        .select(
            period,
            "total_accounts",
            "accounts_with_breaks",
            F.round(rate, 2).alias("break_rate_pct"),
            "total_break_amount",
            "subledger_breaks",
            "extract_breaks",
            "subledger_break_amount",
            "extract_break_amount",
        )
        .orderBy(period)
    )
