"""Grading results against a register of expected breaks, and data-quality checks.

Every check returns the offending rows; an empty result is a pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgertie.functions.variance import BREAK, DEFAULT_THRESHOLD, PASS, total, total_or_zero
from ledgertie.operators import gaps
from ledgertie.operators.rollups import rollup_balance
from ledgertie.operators.tieouts import filed_branches
from ledgertie.operators.trend import DETAIL_TIE_OUT, FILED_TIE_OUT, stack_breaks
from ledgertie.operators.whatif import FAILURE_MODES
from ledgertie.sources.schemas import KEYS, PERIOD, PRODUCT


def account_difference(left: DataFrame, right: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Accounts on one side only, with the side's name; empty if the sets are equal.

    One grouping of both stacked sides in place of a set difference each way.
    """
    stacked = left.select(*keys, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(*keys, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    return (
        stacked.groupBy(*keys)
        .agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
        .filter(F.col("_l") != F.col("_r"))
        .select(*keys, F.when(F.col("_l") == 1, "left").otherwise("right").alias("side"))
    )


# --- grading against the register -------------------------------------------------


def grade_breaks(result: DataFrame, key: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Expected accounts that were missed, and flagged ones that nobody expected."""
    flagged = result.filter(F.col("status") == BREAK)
    verdict = F.when(F.col("side") == "left", "SPURIOUS").otherwise("MISSED")
    return account_difference(flagged, key, keys).select(*keys, verdict.alias("verdict"))


def missed_breaks(result: DataFrame, key: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Expected accounts that the result does not flag."""
    flagged = result.filter(F.col("status") == BREAK)
    return key.select(*keys).distinct().join(flagged, keys, "left_anti")


def spurious_breaks(result: DataFrame, key: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Flagged accounts that nobody expected."""
    flagged = result.filter(F.col("status") == BREAK)
    return flagged.select(*keys).distinct().join(key, keys, "left_anti")


def extra_break_rows(result: DataFrame, key: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """The two row counts if the result has other than one break row per expected account."""
    rows = result.agg(F.count_if(F.col("status") == BREAK).alias("break_rows"))
    expected = key.agg(F.count_distinct(*keys).alias("expected_accounts"))
    return (
        rows.unionByName(expected, allowMissingColumns=True)
        .agg(
            F.max("break_rows").alias("break_rows"),
            F.max("expected_accounts").alias("expected_accounts"),
        )
        .filter(F.col("break_rows") != F.col("expected_accounts"))
    )


def clean_accounts(result: DataFrame, key: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Result rows of accounts on which nothing was planted, in either tie-out."""
    return result.join(key, keys, "left_anti")


def clean_over_threshold(
    result: DataFrame,
    key: DataFrame,
    keys: list[str] = KEYS,
    threshold: float = DEFAULT_THRESHOLD,
) -> DataFrame:
    """Clean accounts that drifted past the threshold or are not PASS."""
    drifted = F.coalesce(F.abs("variance_pct"), F.lit(0.0)) > threshold
    return clean_accounts(result, key, keys).filter(drifted | (F.col("status") != PASS))


def clean_not_zero(result: DataFrame, key: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Clean accounts that do not tie out to exactly zero."""
    moved = (F.col("variance") != 0) | (F.coalesce("variance_pct", F.lit(0.0)) != 0)
    return clean_accounts(result, key, keys).filter(moved)


def cause_mismatches(result: DataFrame, key: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Expected breaks whose label is not the expected one or contradicts their sign."""
    under = ["LATE_FEED", "TIMING_DIFFERENCE"]
    contradicts = (F.col("root_cause").isin(*under) & (F.col("variance") >= 0)) | (
        (F.col("root_cause") == "DUPLICATE_LOAD") & (F.col("variance") <= 0)
    )
    return (
        result.filter(F.col("status") == BREAK)
        .select(*keys, "variance", "root_cause")
        .join(key.select(*keys, "expected_root_cause"), keys)
        .filter((F.col("root_cause") != F.col("expected_root_cause")) | contradicts)
    )


def uncorroborated_duplicates(result: DataFrame) -> DataFrame:
    """Rows on which the DUPLICATE_LOAD label and repeated loan ids disagree."""
    labelled = F.col("root_cause") == "DUPLICATE_LOAD"
    return result.filter(labelled != (F.col("duplicate_loan_ids") > 0))


def asymmetric_pairs(
    result: DataFrame, keys: list[str] = KEYS, product: str = PRODUCT
) -> DataFrame:
    """Mapping errors whose partner is absent, points elsewhere or does not net to zero."""
    others = [key for key in keys if key != product]
    mapping = result.filter(F.col("root_cause") == "MAPPING_ERROR").select(
        *keys, "variance", "offsetting_product"
    )
    partner = mapping.select(
        *others,
        F.col(product).alias("offsetting_product"),
        F.col("offsetting_product").alias("partner_names"),
        F.col("variance").alias("partner_variance"),
    )
    agrees = (F.col("partner_names") == F.col(product)) & (
        F.col("variance") + F.col("partner_variance") == 0
    )
    return mapping.join(partner, [*others, "offsetting_product"], "left").filter(
        ~F.coalesce(agrees, F.lit(False))
    )


def two_sided_timing(result: DataFrame) -> DataFrame:
    """Timing differences that have a partner or are not under the ledger."""
    return result.filter(F.col("root_cause") == "TIMING_DIFFERENCE").filter(
        F.col("offsetting_product").isNotNull() | (F.col("variance") >= 0)
    )


def not_footing(
    gl: DataFrame,
    detail: DataFrame,
    expected: DataFrame,
    keys: list[str] = KEYS,
    gl_amt: str = "gl_balance",
    detail_amt: str = "loan_amount",
) -> DataFrame:
    """Ledger accounts off zero without a planted detail break, or at zero with one."""
    planted = (
        expected.filter(F.col("detected_by") == DETAIL_TIE_OUT)
        .select(*keys)
        .distinct()
        .withColumn("planted", F.lit(True))
    )
    footed = gl.select(*keys, gl_amt).join(rollup_balance(detail, keys, detail_amt), keys, "left")
    gap = total(total_or_zero(F.col(detail_amt)) - total(F.col(gl_amt)))
    return (
        footed.join(planted, keys, "left")
        .select(*keys, gap.alias("variance"), F.coalesce("planted", F.lit(False)).alias("planted"))
        .filter((F.col("variance") != 0) != F.col("planted"))
    )


# --- agreement of the trend -------------------------------------------------------


def period_breaks(
    detail: DataFrame, filed: DataFrame, keys: list[str] = KEYS, period: str = PERIOD
) -> DataFrame:
    """Per period, the breaks of the two results: accounts, numbers and absolute amount."""
    accounts = [key for key in keys if key != period]
    return (
        stack_breaks(detail, filed, keys)
        .groupBy(period)
        .agg(
            F.count_distinct(*accounts).alias("own_accounts"),
            F.count_if(F.col("reconciliation") == DETAIL_TIE_OUT).alias("own_subledger"),
            F.count_if(F.col("reconciliation") == FILED_TIE_OUT).alias("own_extract"),
            total(F.sum("break_amount")).alias("own_amount"),
        )
    )


def trend_mismatches(
    trend: DataFrame,
    detail: DataFrame,
    filed: DataFrame,
    keys: list[str] = KEYS,
    period: str = PERIOD,
    tolerance: float = 0.02,
) -> DataFrame:
    """Periods whose trend line differs from the breaks of the two results."""
    own = period_breaks(detail, filed, keys, period)
    pairs = {
        "accounts_with_breaks": "own_accounts",
        "subledger_breaks": "own_subledger",
        "extract_breaks": "own_extract",
    }
    differs = [F.coalesce(a, F.lit(0)) != F.coalesce(b, F.lit(0)) for a, b in pairs.items()]
    gap = total_or_zero(F.col("total_break_amount")) - total_or_zero(F.col("own_amount"))
    off = reduce(lambda a, b: a | b, differs, F.abs(gap).cast("double") > tolerance)
    return trend.join(own, period, "full").filter(off)


def trend_coverage(trend: DataFrame, key: DataFrame) -> DataFrame:
    """One row if the trend's breaks are not the register's rows, or a rate passes 100."""
    counted = trend.agg(
        F.coalesce(F.sum(F.col("subledger_breaks") + F.col("extract_breaks")), F.lit(0)).alias(
            "trend_breaks"
        ),
        F.count_if(F.col("break_rate_pct") > 100).alias("periods_over_100"),
    )
    planted = key.agg(F.count("*").alias("expected_breaks"))
    names = ["trend_breaks", "expected_breaks", "periods_over_100"]
    return (
        counted.unionByName(planted, allowMissingColumns=True)
        .agg(*(F.max(name).alias(name) for name in names))
        .filter(
            (F.col("trend_breaks") != F.col("expected_breaks")) | (F.col("periods_over_100") > 0)
        )
    )


# --- validity of the register ------------------------------------------------------


def repeated_accounts(df: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Accounts with more than one row."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)


def missing_modes(key: DataFrame) -> DataFrame:
    """Kinds of break that the register does not contain."""
    kinds = [(kind,) for kind in sorted(FAILURE_MODES)]
    known = key.sparkSession.createDataFrame(kinds, "break_type string")
    return known.join(key.select("break_type").distinct(), "break_type", "left_anti")


def thin_margins(
    key: DataFrame, threshold: float = DEFAULT_THRESHOLD, factor: float = 2.0
) -> DataFrame:
    """Expected breaks too close to the threshold to grade detection by, or without a percentage."""
    pct = F.col("planted_variance_pct")
    return key.filter(pct.isNull() | (F.abs(pct) <= factor * threshold))


def unbalanced_pairs(key: DataFrame) -> DataFrame:
    """Mapping errors of the register that are not two opposite sides netting to zero."""
    return (
        key.filter(F.col("break_type") == "mapping_error")
        .groupBy("break_id")
        .agg(
            F.count("*").alias("sides"),
            F.count_if(F.col("expected_direction") == "under").alias("under"),
            F.count_if(F.col("expected_direction") == "over").alias("over"),
            total(F.sum("planted_variance")).alias("net"),
        )
        .filter(~((F.col("under") == 1) & (F.col("over") == 1) & (F.col("net") == 0)))
    )


# --- loads and populations ---------------------------------------------------------


def overlapping_branches(
    gl: DataFrame,
    extract: DataFrame,
    keys: list[str] = KEYS,
    gl_amt: str = "gl_balance",
    extract_amt: str = "extract_balance",
) -> DataFrame:
    """Accounts in both halves of the union form of a full outer join."""
    covered, unsupported = filed_branches(gl, extract, keys, gl_amt, extract_amt)
    return covered.select(*keys).intersect(unsupported.select(*keys))


def load_checks(tables: dict[str, tuple[DataFrame, DataFrame, str]]) -> DataFrame:
    """Row counts, money totals and NULLs of each (source, target, amount), one row a table.

    Each table is read once.
    """

    def measured(amt: str, side: str) -> list:
        return [F.count("*").alias(f"{side}_rows"), total(F.sum(amt)).alias(f"{side}_total")]

    def checked(name: str, source: DataFrame, target: DataFrame, amt: str) -> DataFrame:
        holes = reduce(
            lambda a, b: a + b, (F.count_if(F.col(column).isNull()) for column in target.columns)
        )
        sent = source.agg(*measured(amt, "source"))
        loaded = target.agg(*measured(amt, "target"), holes.alias("nulls"))
        names = [*sent.columns, *loaded.columns]
        return (
            sent.unionByName(loaded, allowMissingColumns=True)
            .agg(*(F.max(column).alias(column) for column in names))
            .withColumn("table_name", F.lit(name))
        )

    rows = reduce(DataFrame.unionByName, (checked(n, *parts) for n, parts in tables.items()))
    same = (F.col("source_rows") == F.col("target_rows")) & F.equal_null(
        "source_total", "target_total"
    )
    return rows.withColumn("passed", same & (F.col("nulls") == 0))


def multiset_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that the two sides hold a different number of times, with both numbers.

    One grouping of the stacked sides, combined before the shuffle, so a value
    that makes up much of the data travels once per task.
    """
    columns = left.columns
    sides = left.select(*columns, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(*columns, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    return (
        sides.groupBy(*columns)
        .agg(F.sum("_l").alias("left_rows"), F.sum("_r").alias("right_rows"))
        .filter(F.col("left_rows") != F.col("right_rows"))
    )


def frame_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows in which two formulations of a result differ; raises if their schemas do."""

    def shape(df: DataFrame) -> list[tuple[str, str]]:
        return [(field.name, field.dataType.simpleString()) for field in df.schema]

    if shape(left) != shape(right):
        raise ValueError(f"schemas differ: {shape(left)} and {shape(right)}")
    return multiset_diff(left, right)


def universe_gaps(df: DataFrame, dims: list[str] = KEYS) -> DataFrame:
    """Accounts that the reporting dimensions allow but the table does not hold."""
    return gaps.universe_gaps(df, dims)


def content_digest(df: DataFrame) -> DataFrame:
    """Row count and an order-free digest: the sum of 60 bits of every row's SHA-256.

    Values are written with their length, so no two different rows read alike.
    """

    def written(name: str):
        text = F.col(name).cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    row = F.sha2(F.concat(*(written(name) for name in sorted(df.columns))), 256)
    bits = F.conv(F.substring(row, 1, 15), 16, 10).cast("decimal(20,0)")
    return df.agg(
        F.count("*").alias("row_count"),
        F.coalesce(F.sum(bits), F.lit(0)).cast("decimal(38,0)").alias("digest"),
    )
