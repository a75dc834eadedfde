"""Accounts that the reporting dimensions allow but a table does not hold, without their product.

The values of each dimension are numbered. Under every held prefix of an account the
numbers of the next dimension that it has are gathered in blocks of bounded length, and
their complement is what it lacks. A prefix that is lacking lacks all that could follow
it. So what is made is the gaps, and a few entries per held prefix, never the universe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgertie.operators.ordered import positions
from ledgertie.sources.session import materialise

BLOCK = 4096


def _numbers(df: DataFrame, dim: str) -> tuple[DataFrame, int]:
    """Distinct values of a dimension numbered from 0 (value, number), and how many there are."""
    values = df.select(F.col(dim).alias("_value")).filter(F.col(dim).isNotNull()).distinct()
    numbered = positions(values, [], ["_value"], "_number")
    numbered = materialise(numbered.select("_value", "_number"), "values")
    return numbered, numbered.count()


def _missing(held: DataFrame, prefix: list[str], size: int) -> DataFrame:
    """Numbers below ``size`` that a prefix does not have (prefix, _number)."""
    blocks = -(-size // BLOCK)
    places = F.col("_number") % BLOCK
    block = F.floor(F.col("_number") / BLOCK).cast("int")
    filled = held.groupBy(*prefix, block.alias("_block")).agg(
        F.collect_set(places.cast("int")).alias("_held")
    )
    filled = materialise(filled, "blocks")

    def lacking(block: Column, held: Column) -> Column:
        width = F.least(F.lit(BLOCK), F.lit(size) - block * BLOCK)
        return F.array_except(F.sequence(F.lit(0), width - 1), held)

    within = filled.select(*prefix, "_block", F.explode(lacking(F.col("_block"), F.col("_held"))).alias("_at"))
    empty = filled.groupBy(*prefix).agg(F.collect_set("_block").alias("_held"))
    untouched = F.array_except(F.sequence(F.lit(0), F.lit(blocks - 1)), F.col("_held"))
    none = F.array().cast("array<int>")
    whole = empty.select(*prefix, F.explode(untouched).alias("_block"))
    whole = whole.select(*prefix, "_block", F.explode(lacking(F.col("_block"), none)).alias("_at"))
    number = F.col("_block").cast("long") * BLOCK + F.col("_at")
    return within.unionByName(whole).select(*prefix, number.alias("_number"))


def universe_gaps(df: DataFrame, dims: list[str]) -> DataFrame:
    """Combinations of the values of ``dims`` that no row of ``df`` has.

    A row with a NULL in one of them is no account: it fills no gap and gives no values.
    """
    held = df.select(*dims)
    for dim in dims:
        held = held.filter(F.col(dim).isNotNull())
    held = materialise(held.distinct(), "held")
    gaps, first = None, dims[0]
    for place, dim in enumerate(dims[1:], start=1):
        prefix = dims[:place]
        numbers, size = _numbers(held, dim)
        numbered = held.select(*prefix, F.col(dim).alias("_value")).distinct().join(numbers, "_value")
        found = _missing(numbered, prefix, size)
        found = found.join(numbers, "_number").select(*prefix, F.col("_value").alias(dim))
        if gaps is not None and size:
            every = F.sequence(F.lit(0).cast("long"), F.lit(size - 1).cast("long"))
            followed = gaps.withColumn("_number", F.explode(every)).join(numbers, "_number")
            found = found.unionByName(followed.select(*prefix, F.col("_value").alias(dim)))
        gaps = materialise(found, "gaps")
    return gaps if gaps is not None else held.select(first).limit(0)
