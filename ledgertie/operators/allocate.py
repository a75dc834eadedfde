"""Allocating a total to rows, and simulating missing and replayed batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgertie.functions.labels import REPLAY_SUFFIX, cents, from_cents
from ledgertie.operators.ordered import mark_until, positions
from ledgertie.sources.session import materialise


def _with_units(df: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """``df`` with its weights as whole numbers ``_w``, in proportion within an account.

    Whole numbers and decimals of up to 18 digits keep their own scale; other weights
    count relative to the account's greatest, at 15 digits.
    """
    kind = df.schema[weight].dataType
    if isinstance(kind, T.IntegralType):
        return df.withColumn("_w", F.col(weight).cast("decimal(19,0)"))
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        scaled = F.col(weight).cast("decimal(18,%d)" % kind.scale) * F.lit(10**kind.scale)
        return df.withColumn("_w", scaled.cast("decimal(19,0)"))
    most = df.groupBy(*keys).agg(F.max(F.col(weight).cast("double")).alias("_most"))
    share = F.when(F.col("_most") > 0, F.col(weight).cast("double") / F.col("_most")).otherwise(0.0)
    units = F.rint(share * 1e15).cast("bigint").cast("decimal(19,0)")
    return df.join(most, keys).withColumn("_w", units).drop("_most")


def apportion_exact(
    df: DataFrame,
    keys: list[str],
    total: str,
    weight: str,
    id_col: str,
    part: str = "part",
) -> DataFrame:
    """Split each account's ``total`` over its rows by ``weight``; the parts sum exactly.

    Every row gets its share rounded down to the cent, also below zero, and the cents
    left over go one each to the largest remainders, ties by ``id_col``. ``total`` is
    the same on all rows of an account; weights are not negative. Where they are all
    zero the parts are NULL and ``not_positive`` names the rows. The rows are written
    once with their shares, which are costly and read four times.
    """
    weighed = _with_units(df, keys, weight).withColumn(
        "_cents", cents(F.col(total)).cast("decimal(19,0)")
    )
    sums = weighed.groupBy(*keys).agg(F.sum("_w").alias("_sum"))
    sums = materialise(sums.withColumn("_sum", F.when(F.col("_sum") > 0, F.col("_sum"))))
    shared = materialise(
        weighed.join(sums, keys)
        .withColumn("_product", F.col("_cents") * F.col("_w"))
        .withColumn("_rest", F.pmod("_product", "_sum"))
        .withColumn("_share", F.expr("(_product - _rest) div _sum"))
        .withColumn("_order", -F.col("_rest"))
        .drop("_product", "_rest", "_w", "_sum")
    )
    left_over = materialise(
        shared.groupBy(*keys).agg(
            (F.max("_cents") - F.sum("_share")).cast("bigint").alias("_left")
        )
    )
    counted = shared.join(left_over, keys).withColumn("_one", F.lit(1))
    marked = mark_until(counted, keys, ["_order", id_col], "_one", "_left", mark="_extra")
    amount = from_cents(F.col("_share") + F.col("_extra").cast("bigint"))
    return marked.withColumn(part, amount).drop(
        "_cents", "_share", "_order", "_left", "_one", "_extra"
    )


def not_positive(df: DataFrame, part: str = "part") -> DataFrame:
    """Rows whose part is absent or not above zero; every loan has to carry a balance."""
    return df.filter(F.col(part).isNull() | (F.col(part) <= 0))


def with_target(detail: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    """Detail with its account's target; accounts without one keep NULL and are left alone.

    ``targets`` has a row per account; Spark joins it by its size.
    """
    return detail.join(targets, keys, "left")


def drop_tail_until(
    df: DataFrame, keys: list[str], order: list[str], amt: str, target: str
) -> DataFrame:
    """Detail without its last rows: rows go, from the end, while less than ``target`` is gone."""
    marked = mark_until(df, keys, order, amt, target, descending=True)
    return marked.filter(~F.col("taken")).drop("taken")


def replay_head_until(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    amt: str,
    target: str,
    tag: str = "load_batch_id",
) -> DataFrame:
    """Detail with its first rows a second time, until ``target`` is doubled.

    The copies carry the batch id with a replay suffix. Each row is scanned once
    and emitted once or twice.
    """
    marked = mark_until(df, keys, order, amt, target)
    copies = F.when(F.col("taken"), F.array(F.lit(False), F.lit(True))).otherwise(
        F.array(F.lit(False))
    )
    replayed = F.concat(F.col(tag), F.lit(REPLAY_SUFFIX))
    return (
        marked.withColumn("_copy", F.explode(copies))
        .withColumn(tag, F.when(F.col("_copy"), replayed).otherwise(F.col(tag)))
        .drop("taken", "_copy")
    )


def assign_batches(
    df: DataFrame, keys: list[str], order: list[str], size: int = 25
) -> DataFrame:
    """Rows numbered from 0 in their account, and from 1 in batches of ``size``."""
    numbered = positions(df, keys, order)
    return numbered.withColumn("batch", F.expr(f"position div {int(size)} + 1"))
