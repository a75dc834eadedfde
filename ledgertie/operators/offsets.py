"""Finding the break that offsets another: same entity and period, opposite variance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgertie.functions.variance import BREAK

PARTNER = "offsetting_product"


def _candidates(flagged: DataFrame, keys: list[str]) -> DataFrame:
    return flagged.filter((F.col("status") == BREAK) & (F.col("variance") != 0)).select(
        *keys, "variance"
    )


def offset_partner(flagged: DataFrame, keys: list[str], product: str) -> DataFrame:
    """Accounts that have a partner, with the partner's product.

    ``flagged`` has one row per account. Breaks are folded per entity, period and
    absolute variance to the last product on each side of zero, combined before
    the shuffle; what is left is at most one row per pair of amounts. A window
    over that group would hold all of its breaks in one task, and clean accounts
    would all meet in the group of variance zero.
    """
    group = [key for key in keys if key != product]
    breaks = _candidates(flagged, keys).withColumn("gap", F.abs("variance"))
    over = F.when(F.col("variance") > 0, F.col(product))
    under = F.when(F.col("variance") < 0, F.col(product))
    pairs = (
        breaks.groupBy(*group, "gap")
        .agg(F.max(over).alias("over"), F.max(under).alias("under"))
        .filter(F.col("over").isNotNull() & F.col("under").isNotNull())
    )
    partner = F.when(F.col("variance") > 0, F.col("under")).otherwise(F.col("over"))
    return breaks.join(pairs, [*group, "gap"]).select(*keys, partner.alias(PARTNER))


def offset_partner_by_join(flagged: DataFrame, keys: list[str], product: str) -> DataFrame:
    """The same accounts by a self join on the negated variance.

    Amounts are exact to the cent, so "nets to zero within a cent" is equality and
    the join needs no residual condition. Breaks of equal variance are folded
    first, so a row meets one partner row and never every row of its group. Two
    accounts of opposite variance are different accounts, which leaves the product
    as what tells them apart.
    """
    group = [key for key in keys if key != product]
    breaks = _candidates(flagged, keys).withColumn("needed", -F.col("variance"))
    offered = (
        breaks.groupBy(*group, F.col("variance").alias("needed"))
        .agg(F.max(product).alias(PARTNER))
    )
    return breaks.join(offered, [*group, "needed"]).select(*keys, PARTNER)
