"""Bringing every side of a tie-out to account grain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgertie.functions.variance import total


def rollup_to_grain(
    detail: DataFrame,
    keys: list[str],
    amt: str,
    id_col: str,
    balance: str = "sub_ledger_balance",
) -> DataFrame:
    """Balance, row count and distinct ids per account.

    Rows are grouped by account *and* id first, so one huge account spreads over all
    tasks and one id repeated many times is folded before it travels; what reaches
    the second grouping is one row per account and task. Spark plans a distinct count
    in the same two shuffles, but aggregates four times on the way instead of twice.
    """
    per_id = detail.groupBy(*keys, id_col).agg(
        F.sum(amt).alias("_amount"), F.count("*").alias("_rows")
    )
    return per_id.groupBy(*keys).agg(
        total(F.sum("_amount")).alias(balance),
        F.sum("_rows").alias("loan_count"),
        F.count(id_col).alias("distinct_loan_count"),
    )


def rollup_balance(df: DataFrame, keys: list[str], amt: str) -> DataFrame:
    """Balance per account."""
    return df.groupBy(*keys).agg(total(F.sum(amt)).alias(amt))


def duplicate_ids(rows: Column, distinct: Column) -> Column:
    """Rows beyond the first of each id: evidence that a batch was replayed."""
    return F.coalesce(rows, F.lit(0)) - F.coalesce(distinct, F.lit(0))
