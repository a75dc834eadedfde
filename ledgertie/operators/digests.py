"""Comparing large tables by digests in two levels; rows move only where they differ.

Rows are dealt into buckets by a hash of their content, and each side's buckets are told
by a count and two sums of hashes, combined before they travel. Buckets that agree are
done. The others are looked at in finer buckets, and the rows of those that still differ
are compared as multisets. Equal tables exchange digests alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgertie.operators.quality import multiset_diff
from ledgertie.sources.session import materialise

WIDE, FINE = 1024, 64  # buckets, and finer buckets in each


def _hash(columns: list[str], seed: int) -> Column:
    """A hash of a row in which a NULL is unlike any value and unlike its absence elsewhere."""
    parts = [part for name in columns for part in (F.col(name).isNull(), F.col(name))]
    return F.xxhash64(F.lit(seed), *parts)


def _signed(left: DataFrame, right: DataFrame, wide: int, fine: int) -> DataFrame:
    """The rows of both sides with hashes and buckets; those of the right count as minus one."""
    columns = left.columns
    stacked = left.select(*columns, F.lit(1).alias("_sign")).unionByName(
        right.select(*columns, F.lit(-1).alias("_sign"))
    )
    hashed = stacked.withColumns({"_a": _hash(columns, 1), "_b": _hash(columns, 2)})
    return hashed.withColumns(
        {
            "_wide": F.pmod("_a", F.lit(wide)).cast("int"),
            "_fine": F.pmod("_b", F.lit(fine)).cast("int"),
        }
    )


def differing_buckets(rows: DataFrame, buckets: list[str]) -> DataFrame:
    """Buckets whose count or sums of hashes are not the same on both sides."""

    def net(name: str) -> Column:
        return F.sum(F.col("_sign") * F.col(name).cast("decimal(20,0)"))

    sums = rows.groupBy(*buckets).agg(
        F.sum("_sign").alias("_rows"), net("_a").alias("_net_a"), net("_b").alias("_net_b")
    )
    differs = (F.col("_rows") != 0) | (F.col("_net_a") != 0) | (F.col("_net_b") != 0)
    return materialise(sums.filter(differs).select(*buckets), "differing")


def tree_diff(left: DataFrame, right: DataFrame, wide: int = WIDE, fine: int = FINE) -> DataFrame:
    """Rows that the two sides hold a different number of times, as :func:`multiset_diff`.

    Both sides have the same columns. The digests are sums of 64-bit hashes; tables that
    differ with all of them equal are not told apart.
    """
    rows = _signed(left, right, wide, fine)
    coarse = differing_buckets(rows, ["_wide"])
    narrowed = rows.join(coarse, "_wide", "left_semi")
    finer = differing_buckets(narrowed, ["_wide", "_fine"])
    suspect = materialise(
        narrowed.join(finer, ["_wide", "_fine"], "left_semi").select(*left.columns, "_sign"), "suspect"
    )
    sides = (suspect.filter(F.col("_sign") == sign).select(*left.columns) for sign in (1, -1))
    return multiset_diff(*sides)
