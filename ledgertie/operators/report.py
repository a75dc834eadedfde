"""Report views over tie-out results: filters, headline figures, distributions, rankings."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgertie.functions.variance import BREAK, total_or_zero
from ledgertie.operators.tieouts import reconcile_detail, reconcile_filed
from ledgertie.operators.trend import break_trend, stack_breaks
from ledgertie.sources.schemas import KEYS, PERIOD
from ledgertie.sources.session import materialise

# Labels of the two tie-outs in the long form of the trend.
TREND_LABELS = {
    "subledger_break_amount": "GL vs sub-ledger",
    "extract_break_amount": "GL vs extract",
}

SCOPES = ["entity", "quarter"]  # what a report is filtered by
EVERY = "ALL"
KPI_COLUMNS = [
    "accounts_in_scope",
    "accounts_with_breaks",
    "break_rate_pct",
    "total_break_amount",
    "largest_break",
]


def scope(
    df: DataFrame, quarters: list[str] | None = None, entities: list[str] | None = None
) -> DataFrame:
    """Rows of the chosen quarters and entities; ``None`` means all."""
    for column, chosen in (("quarter", quarters), ("entity", entities)):
        if chosen is not None:
            df = df.filter(F.col(column).isin(*chosen))
    return df


def breaks_only(df: DataFrame, on: bool = True) -> DataFrame:
    return df.filter(F.col("status") == BREAK) if on else df


def kpis(detail: DataFrame, filed: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Accounts in scope, broken accounts, rate, amount in doubt and largest break: one row.

    Both results are read once: scope counts the detail tie-out's rows, an account
    broken in both counts once, and amounts are not netted.
    """

    def side(result: DataFrame, counted: int) -> DataFrame:
        return result.select(*keys, "status", "variance", F.lit(counted).alias("counted"))

    broken = F.col("status") == BREAK
    amount = F.when(broken, F.abs("variance"))
    size = F.nullif("accounts_in_scope", F.lit(0))
    rate = F.lit(100.0) * F.col("accounts_with_breaks") / size
    return (
        side(detail, 1)
        .unionByName(side(filed, 0))
        .agg(
            F.coalesce(F.sum("counted"), F.lit(0)).alias("accounts_in_scope"),
            F.count_distinct(*(F.when(broken, F.col(key)) for key in keys)).alias(
                "accounts_with_breaks"
            ),
            total_or_zero(F.sum(amount)).alias("total_break_amount"),
            total_or_zero(F.max(amount)).alias("largest_break"),
        )
        .select(
            "accounts_in_scope",
            "accounts_with_breaks",
            F.round(F.coalesce(rate, F.lit(0.0)), 1).alias("break_rate_pct"),
            "total_break_amount",
            "largest_break",
        )
    )


def kpi_cells(
    detail: DataFrame, filed: DataFrame, dims: list[str] = SCOPES, keys: list[str] = KEYS
) -> DataFrame:
    """Key figures of each cell of the reporting dimensions, from which those of any scope follow.

    The dimensions are part of the account key, so an account lies in one cell and its
    breaks are counted once: numbers of accounts add up over cells as amounts do, and a
    filter needs no results again, only the cells it names.
    """
    if not set(dims) <= set(keys):
        raise ValueError(f"{dims} must be part of the account key {keys}")

    def side(result: DataFrame, counted: int) -> DataFrame:
        return result.select(*keys, "status", "variance", F.lit(counted).alias("counted"))

    amount = F.when(F.col("status") == BREAK, F.abs("variance"))
    accounts = (
        side(detail, 1)
        .unionByName(side(filed, 0))
        .groupBy(*keys)
        .agg(
            F.sum("counted").alias("accounts_in_scope"),
            F.max((F.col("status") == BREAK).cast("int")).alias("accounts_with_breaks"),
            F.sum(amount).alias("total_break_amount"),
            F.max(amount).alias("largest_break"),
        )
    )
    return accounts.groupBy(*dims).agg(*_folded_figures())


def _folded_figures() -> list:
    sums = [F.sum(name).alias(name) for name in ("accounts_in_scope", "accounts_with_breaks")]
    return [
        *sums,
        total_or_zero(F.sum("total_break_amount")).alias("total_break_amount"),
        total_or_zero(F.max("largest_break")).alias("largest_break"),
    ]


def _with_rate(figures: DataFrame) -> DataFrame:
    size = F.nullif("accounts_in_scope", F.lit(0))
    rate = F.round(F.coalesce(F.lit(100.0) * F.col("accounts_with_breaks") / size, F.lit(0.0)), 1)
    counts = ["accounts_in_scope", "accounts_with_breaks"]
    zeros = {name: F.coalesce(name, F.lit(0).cast("long")) for name in counts}
    return figures.withColumns({**zeros, "break_rate_pct": rate})


def kpis_of_scope(
    cells: DataFrame, quarters: list[str] | None = None, entities: list[str] | None = None
) -> DataFrame:
    """Key figures of a report's scope from :func:`kpi_cells`: one row, as :func:`kpis` gives it."""
    figures = scope(cells, quarters, entities).agg(*_folded_figures())
    return _with_rate(figures).select(*KPI_COLUMNS)


def kpi_cube(cells: DataFrame, dims: list[str] = SCOPES) -> DataFrame:
    """Key figures of every scope of one or all values of each dimension; ``ALL`` is all of them."""
    figures = cells.cube(*dims).agg(*_folded_figures(), *(F.grouping(d).alias(f"_{d}") for d in dims))
    named = {d: F.when(F.col(f"_{d}") == 1, EVERY).otherwise(F.col(d)) for d in dims}
    return _with_rate(figures.withColumns(named)).select(*dims, *KPI_COLUMNS)


def cause_cube(result: DataFrame, dims: list[str] = SCOPES) -> DataFrame:
    """Breaks per root cause in every such scope."""
    counted = breaks_only(result).groupBy(*dims, "root_cause").agg(F.count("*").alias("breaks"))
    sets = [[*chosen, "root_cause"] for n in range(len(dims) + 1) for chosen in combinations(dims, n)]
    columns = [F.col(name) for name in [*dims, "root_cause"]]
    rolled = counted.groupingSets([[F.col(c) for c in held] for held in sets], *columns).agg(
        F.sum("breaks").alias("breaks"), *(F.grouping(d).alias(f"_{d}") for d in dims)
    )
    named = {d: F.when(F.col(f"_{d}") == 1, EVERY).otherwise(F.col(d)) for d in dims}
    return rolled.withColumns(named).select(*dims, "root_cause", "breaks")


def cause_counts(result: DataFrame) -> DataFrame:
    """Breaks per root cause, most frequent first."""
    return (
        breaks_only(result)
        .groupBy("root_cause")
        .agg(F.count("*").alias("breaks"))
        .orderBy(F.desc("breaks"), "root_cause")
    )


def trend_long(trend: DataFrame, period: str = PERIOD) -> DataFrame:
    """The trend's two amount columns as rows: period, tie-out, amount."""
    names = F.create_map(*(F.lit(word) for pair in TREND_LABELS.items() for word in pair))
    return trend.unpivot(period, list(TREND_LABELS), "source", "amount").select(
        period, names[F.col("source")].alias("tie_out"), "amount"
    )


def rank_breaks(result: DataFrame, by: str, keys: list[str] = KEYS) -> DataFrame:
    """Breaks by signed measure, lowest first; rows without the measure come last."""
    shown = [by, "root_cause", *(c for c in ("variance", "variance_pct") if c != by)]
    if "offsetting_product" in result.columns:
        shown.append("offsetting_product")
    return breaks_only(result).select(*keys, *shown).orderBy(F.asc_nulls_last(by), *keys)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted choices for a filter."""
    return df.select(column).distinct().orderBy(column)


def break_counts(results: dict[str, DataFrame]) -> DataFrame:
    """Rows and breaks per result and in all; breaks is NULL for a result without a status."""

    def counted(name: str, df: DataFrame) -> DataFrame:
        has_status = "status" in df.columns
        breaks = F.count_if(F.col("status") == BREAK) if has_status else F.lit(None)
        return df.agg(
            F.count("*").alias("result_rows"), breaks.cast("bigint").alias("breaks")
        ).withColumn("result", F.lit(name))

    stacked = reduce(DataFrame.unionByName, (counted(n, df) for n, df in results.items()))
    return (
        stacked.rollup("result")
        .agg(F.sum("result_rows").alias("result_rows"), F.sum("breaks").alias("breaks"))
        .select(F.coalesce("result", F.lit("all")).alias("result"), "result_rows", "breaks")
    )


def run_all(
    gl: DataFrame, sub_ledger: DataFrame, extract: DataFrame, **options
) -> dict[str, DataFrame]:
    """The three results in the order of the close; ``options`` go to both tie-outs.

    Each tie-out is computed once and written, a row per account; the trend and
    whatever the caller derives read the written rows, not the feeds again.
    """
    detail = materialise(reconcile_detail(gl, sub_ledger, **options))
    filed = materialise(reconcile_filed(gl, extract, **options))
    return {
        "gl_vs_subledger": detail,
        "gl_vs_regulatory_extract": filed,
        "quarterly_break_trend": break_trend(gl, stack_breaks(detail, filed)),
    }
