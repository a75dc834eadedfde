"""Offset partners within a tolerance, by a grid instead of a theta join.

Two breaks offset each other if they belong to different products of one entity and
period and their variances add up to less than the tolerance. On a grid of cells as wide
as the tolerance, the amount that a break needs and the one it finds lie in one cell or
in neighbouring ones. In the own cell every amount fits; in the next one those below a
bound, in the one before those above a bound. So what is asked is the last product among
the first or last amounts of a cell, which a running maximum tells: no pair is compared.

Breaks of equal amount are folded first, to their last two products, so a cell has at
most as many rows as the tolerance has cents, and the second product answers for
the break whose own product is the last.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgertie.functions.labels import cents
from ledgertie.operators.offsets import PARTNER
from ledgertie.functions.variance import BREAK
from ledgertie.sources.session import materialise

OWN, ABOVE, BELOW = 0, 1, -1  # the cell asked, from the cell of the needed amount


def _folded(breaks: DataFrame, by: list[str], product: str) -> DataFrame:
    """Amounts with the last two products that have them (``_first``, ``_second``)."""
    first = materialise(breaks.groupBy(*by).agg(F.max(product).alias("_first")), "partners")
    others = breaks.join(first, by).filter(F.col(product) < F.col("_first"))
    second = others.groupBy(*by).agg(F.max(product).alias("_second"))
    return first.join(second, by, "left")


def _so_far(cell: list[str], order: list[Column]) -> tuple[Column, Column]:
    """The last two products of the amounts before a row of its cell, in this order.

    A product has one amount, so the second of them is the greatest of each amount's second
    and of the lesser of its first and the last product before it.
    """
    window = Window.partitionBy(*cell).orderBy(*order)
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.max("_first").over(before)
    lesser = F.when(ahead.isNotNull() & F.col("_first").isNotNull(), F.least(ahead, "_first"))
    return ahead, F.greatest("_second", lesser)


def _answers(rows: DataFrame, cell: list[str], order: list[Column]) -> DataFrame:
    first, lesser = _so_far(cell, order)
    before = Window.partitionBy(*cell).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumns({"_last": first, "_lesser": lesser})
        .withColumn("_next", F.max("_lesser").over(before))
        .filter(F.col("_side").isNotNull())
    )


def offset_partner_within(
    flagged: DataFrame, keys: list[str], product: str, tolerance: Decimal | str = "0.01"
) -> DataFrame:
    """Accounts with a partner whose variance adds to theirs to less than ``tolerance``.

    ``flagged`` has one row per account. The partner is a break of another product with a
    variance other than zero; of several the last product is named. ``tolerance`` is any
    amount of whole cents; at one cent the result is that of equal and opposite amounts.
    """
    width = int(Decimal(str(tolerance)) * 100)
    if width < 1 or width != Decimal(str(tolerance)) * 100:
        raise ValueError(f"tolerance must be whole cents above zero, got {tolerance}")
    group = [key for key in keys if key != product]
    breaks = flagged.filter(F.col("status") == BREAK).select(
        *keys, cents(F.col("variance")).alias("_cents")
    )
    breaks = materialise(breaks, "breaks")

    def cell(amount: Column) -> Column:
        return F.floor(amount / F.lit(width)).cast("decimal(38,0)")

    folded = materialise(
        _folded(breaks.filter("_cents <> 0"), [*group, "_cents"], product), "folded"
    )
    none = F.lit(None)
    homes = folded.select(
        *group,
        cell(F.col("_cents")).alias("_cell"),
        F.col("_cents").alias("_at"),
        "_first",
        "_second",
        none.cast("int").alias("_side"),
        none.cast("decimal(38,0)").alias("_asked"),
    )
    needed = -F.col("_cents")
    sides = F.array(
        *(
            F.struct(
                F.lit(side).alias("_side"),
                (cell(needed) + side).cast("decimal(38,0)").alias("_cell"),
                (needed + side * width).cast("decimal(38,0)").alias("_at"),
            )
            for side in (OWN, ABOVE, BELOW)
        )
    )
    probes = breaks.select(*group, "_cents").distinct().select(
        *group, F.col("_cents").alias("_asked"), F.inline(sides)
    )
    rows = homes.unionByName(probes, allowMissingColumns=True)
    asking = F.col("_side").isNotNull()
    # the own cell is asked behind its last amount; a bound is asked before amounts equal to it
    rising = [F.coalesce(F.col("_side") == OWN, F.lit(False)), F.col("_at"), ~asking]
    falling = [F.col("_at").desc(), ~asking]
    in_cell = [*group, "_cell"]
    up = _answers(rows.filter(~asking | (F.col("_side") >= OWN)), in_cell, rising)
    down = _answers(rows.filter(~asking | (F.col("_side") == BELOW)), in_cell, falling)
    told = up.unionByName(down).select(*group, "_asked", F.explode(F.array("_last", "_next")).alias("_p"))
    by = [*group, "_asked"]
    last = told.groupBy(*by).agg(F.sort_array(F.collect_set("_p"), asc=False).alias("_best"))
    best = last.filter(F.size("_best") > 0).withColumnRenamed("_asked", "_cents")
    own_is_last = F.get("_best", F.lit(0)) == F.col(product)
    partner = F.when(own_is_last, F.get("_best", F.lit(1))).otherwise(F.get("_best", F.lit(0)))
    found = breaks.join(best, [*group, "_cents"]).select(*keys, partner.alias(PARTNER))
    return found.filter(F.col(PARTNER).isNotNull())
