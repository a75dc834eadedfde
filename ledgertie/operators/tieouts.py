"""The two tie-outs: detail against the ledger, and filed balances against the ledger."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgertie.functions import causes
from ledgertie.functions.variance import (
    BREAK,
    DEFAULT_THRESHOLD,
    presence,
    status_detail,
    status_filed,
    total,
    total_or_zero,
    variance,
    variance_pct,
)
from ledgertie.operators.offsets import PARTNER, offset_partner
from ledgertie.operators.rollups import duplicate_ids, rollup_balance, rollup_to_grain
from ledgertie.sources.schemas import KEYS, PERIOD, PRODUCT
from ledgertie.sources.session import materialise


def report_order(result: DataFrame, keys: list[str], period: str = PERIOD) -> DataFrame:
    """Breaks first, largest percentage first, then by period and account.

    A break on a zero ledger balance has no percentage and comes last of the breaks.
    """
    first = [period] if period in keys else []
    rest = [key for key in keys if key not in first]
    return result.orderBy(
        F.when(F.col("status") == BREAK, 0).otherwise(1),
        F.abs(F.coalesce("variance_pct", F.lit(0.0))).desc(),
        *first,
        *rest,
    )


def flag_detail(
    gl: DataFrame,
    detail: DataFrame,
    keys: list[str] = KEYS,
    gl_amt: str = "gl_balance",
    detail_amt: str = "loan_amount",
    id_col: str | None = "loan_id",
    threshold: float = DEFAULT_THRESHOLD,
) -> DataFrame:
    """Ledger rows against rolled-up detail, up to the status.

    The join starts from the ledger: an account whose detail is wholly absent must
    stay, and detail without an account has no row. Ledger rows are not rolled up.
    Without ``id_col`` loans are not counted and only balances are shuffled, which is
    all that the trend, the key figures and the grading of accounts need.
    """
    if id_col is None:
        rolled = rollup_balance(detail, keys, detail_amt).withColumnRenamed(
            detail_amt, "sub_ledger_balance"
        )
        evidence = []
    else:
        rolled = rollup_to_grain(detail, keys, detail_amt, id_col)
        repeated = duplicate_ids(F.col("loan_count"), F.col("distinct_loan_count"))
        evidence = [
            F.coalesce("loan_count", F.lit(0)).alias("loan_count"),
            repeated.alias("duplicate_loan_ids"),
        ]
    gl_balance, diff = total(F.col(gl_amt)), F.col("variance")
    return (
        gl.select(*keys, gl_amt)
        .join(rolled, keys, "left")
        .select(
            *keys,
            gl_balance.alias("gl_balance"),
            total_or_zero(F.col("sub_ledger_balance")).alias("sub_ledger_balance"),
            *evidence,
            variance(F.col("sub_ledger_balance"), gl_balance).alias("variance"),
        )
        .withColumn("variance_pct", variance_pct(diff, F.col("gl_balance")))
        .withColumn("status", status_detail(diff, F.col("gl_balance"), threshold))
    )


def reconcile_detail(
    gl: DataFrame,
    detail: DataFrame,
    keys: list[str] = KEYS,
    gl_amt: str = "gl_balance",
    detail_amt: str = "loan_amount",
    id_col: str = "loan_id",
    threshold: float = DEFAULT_THRESHOLD,
) -> DataFrame:
    """Does the detail foot to the ledger? One row per ledger row, with cause and action."""
    flagged = flag_detail(gl, detail, keys, gl_amt, detail_amt, id_col, threshold)
    cause = causes.cause_detail(F.col("status"), F.col("loan_count"), F.col("variance"))
    result = flagged.withColumn("root_cause", cause).withColumn(
        "suggested_action", causes.action(F.col("root_cause"), causes.DETAIL_ACTIONS)
    )
    return report_order(result, keys)


def pair_by_stacking(
    gl: DataFrame, extract: DataFrame, keys: list[str], gl_amt: str, extract_amt: str
) -> DataFrame:
    """Both balances per account from one grouping of the stacked feeds.

    Stands for a full outer join of two roll-ups with one shuffle in place of two
    aggregations and a join. A side without rows sums to NULL, as in the join.
    """
    stacked = gl.select(*keys, gl_amt).unionByName(
        extract.select(*keys, extract_amt), allowMissingColumns=True
    )
    return stacked.groupBy(*keys).agg(
        total(F.sum(gl_amt)).alias(gl_amt), total(F.sum(extract_amt)).alias(extract_amt)
    )


def pair_by_full_join(
    gl: DataFrame, extract: DataFrame, keys: list[str], gl_amt: str, extract_amt: str
) -> DataFrame:
    """Both balances per account by a full outer join of the two roll-ups."""
    return rollup_balance(gl, keys, gl_amt).join(
        rollup_balance(extract, keys, extract_amt), keys, "full"
    )


def filed_branches(
    gl: DataFrame, extract: DataFrame, keys: list[str], gl_amt: str, extract_amt: str
) -> tuple[DataFrame, DataFrame]:
    """The two halves of a full outer join: ledger accounts, and extract-only accounts."""
    ledger = rollup_balance(gl, keys, gl_amt)
    filed = rollup_balance(extract, keys, extract_amt)
    covered = ledger.join(filed, keys, "left")
    unsupported = filed.join(ledger, keys, "left_anti").select(
        *keys, F.lit(None).cast(ledger.schema[gl_amt].dataType).alias(gl_amt), extract_amt
    )
    return covered, unsupported


def pair_by_union(
    gl: DataFrame, extract: DataFrame, keys: list[str], gl_amt: str, extract_amt: str
) -> DataFrame:
    """Both balances per account as a left join plus an anti join.

    The anti join keeps the halves disjoint, so they are stacked without a distinct.
    """
    covered, unsupported = filed_branches(gl, extract, keys, gl_amt, extract_amt)
    return covered.unionByName(unsupported)


def flag_filed(
    gl: DataFrame,
    extract: DataFrame,
    keys: list[str] = KEYS,
    gl_amt: str = "gl_balance",
    extract_amt: str = "extract_balance",
    threshold: float = DEFAULT_THRESHOLD,
    pairing: Callable[..., DataFrame] = pair_by_stacking,
) -> DataFrame:
    """Accounts of either side up to the status, with presence taken before zero-filling."""
    gl_balance, filed, diff = F.col("gl_balance"), F.col("extract_balance"), F.col("variance")
    missing_gl, missing_extract = F.col("missing_from_gl"), F.col("missing_from_extract")
    return (
        pairing(gl, extract, keys, gl_amt, extract_amt)
        .select(
            *keys,
            presence(F.col(gl_amt)).alias("missing_from_gl"),
            presence(F.col(extract_amt)).alias("missing_from_extract"),
            total_or_zero(F.col(gl_amt)).alias("gl_balance"),
            total_or_zero(F.col(extract_amt)).alias("extract_balance"),
        )
        .withColumn("variance", variance(filed, gl_balance))
        .withColumn("variance_pct", variance_pct(diff, gl_balance))
        .withColumn(
            "status", status_filed(diff, gl_balance, missing_gl, missing_extract, threshold)
        )
    )


def reconcile_filed(
    gl: DataFrame,
    extract: DataFrame,
    keys: list[str] = KEYS,
    product: str = PRODUCT,
    gl_amt: str = "gl_balance",
    extract_amt: str = "extract_balance",
    threshold: float = DEFAULT_THRESHOLD,
    pairing: Callable[..., DataFrame] = pair_by_stacking,
    partners: Callable[..., DataFrame] = offset_partner,
) -> DataFrame:
    """Does the filed number match the ledger? One row per account on either side.

    The flagged accounts are written once, because the search for partners reads them
    again twice and Spark would otherwise pair both feeds for each reading. Accounts
    with a partner are written too, so that Spark joins them by their size.
    """
    flagged = materialise(flag_filed(gl, extract, keys, gl_amt, extract_amt, threshold, pairing))
    cause = causes.cause_filed(
        F.col("status"),
        F.col("missing_from_gl"),
        F.col("missing_from_extract"),
        F.col(PARTNER),
        F.col("variance"),
    )
    paired = materialise(partners(flagged, keys, product))
    result = (
        flagged.join(paired, keys, "left")
        .withColumn("root_cause", cause)
        .select(
            *keys,
            "gl_balance",
            "extract_balance",
            "variance",
            "variance_pct",
            "status",
            "root_cause",
            PARTNER,
            causes.action(F.col("root_cause"), causes.FILED_ACTIONS).alias("suggested_action"),
        )
    )
    return report_order(result, keys)
