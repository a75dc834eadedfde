"""Selecting rows in order up to a target, and positions, in groups of any size.

A window partitioned by account would sort a whole account in one task, and a global
sort would move all rows to find one cut per account. Cuts are found by counting
instead: the rows of a large account are cut into bins at approximate quantiles of their
order, amounts and rows are summed per account and bin before they travel, and only the
bin in which the account crosses its target is looked at again, until it is small. A
window then sees that bin alone. Every round leaves about one row in sixty of the large
accounts; which quantiles a round happens to take changes nothing in the result.

Positions need all rows in order, so account *and* order, but no other column, are
range-partitioned: a large account spreads over many consecutive partitions ("chunks"),
totals per chunk give each chunk's starting point, and rows are joined to their number.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgertie.sources.session import materialise

CHUNK = "_chunk"
SORTED_ROWS = 100_000  # an account's rows that a window may sort in one task
BINS = 64
STRING_BYTES, STRING_STEPS = 6, 6  # a string is told apart by so many bytes at a time, so often


def _directions(order: list[str], descending: bool) -> list:
    return [F.desc(name) if descending else F.asc(name) for name in order]


def _before(keys: list[str], col: str, order: list):
    """Sum of ``col`` over the preceding rows of the account."""
    preceding = (
        Window.partitionBy(*keys)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return F.coalesce(F.sum(col).over(preceding), F.lit(0))


def _codes(df: DataFrame, order: list[str], descending: bool) -> list[Column]:
    """Numbers that never decrease along the order, the later ones for ties of the earlier."""
    codes: list[Column] = []
    for name in order:
        kind, column = df.schema[name].dataType, F.col(name)
        if isinstance(kind, T.StringType):
            for step in range(STRING_STEPS):
                part = F.substring(column.cast("binary"), step * STRING_BYTES + 1, STRING_BYTES)
                digits = F.rpad(F.hex(part), 2 * STRING_BYTES, "0")
                codes.append(F.conv(digits, 16, 10).cast("double"))
        elif isinstance(kind, T.DateType):
            codes.append(F.unix_date(column).cast("double"))
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            codes.append(F.unix_micros(column.cast("timestamp")).cast("double"))
        else:
            codes.append(column.cast("double"))
    codes = [F.coalesce(code, F.lit(float("-inf"))) for code in codes]
    return [-code for code in codes] if descending else codes


def _narrowed(rows: DataFrame, keys: list[str], code: Column) -> DataFrame:
    """Each account's rows in the one bin of ``code`` in which it crosses its target.

    ``_start`` and ``_ahead`` are the amount and the rows before the bin, ``_rows`` the
    rows in it, and ``_tied`` says that they all have one code.
    """
    coded = rows.withColumn("_code", code)
    shares = F.array(*(F.lit((i + 1) / BINS) for i in range(BINS - 1)))
    cuts = F.array_distinct(F.percentile_approx("_code", shares, 1000))
    cuts = materialise(coded.groupBy(*keys).agg(cuts.alias("_cuts")), "quantiles")
    # a code that is a cut has a bin of its own, so a frequent one is soon alone
    below = F.size(F.filter("_cuts", lambda cut: cut < F.col("_code")))
    up_to = F.size(F.filter("_cuts", lambda cut: cut <= F.col("_code")))
    binned = coded.join(cuts, keys).withColumn("_bin", below + up_to).drop("_cuts")
    sums = binned.groupBy(*keys, "_bin").agg(
        F.sum("_size").alias("_sum"),
        F.count("*").alias("_n"),
        (F.min("_code") == F.max("_code")).alias("_single"),
        F.max("_goal").alias("_goal"),
        F.max("_start").alias("_from"),
        F.max("_ahead").alias("_past"),
    )
    order = [F.col("_bin")]
    sums = materialise(sums, "bins").withColumns(
        {
            "_from": F.col("_from") + _before(keys, "_sum", order),
            "_past": F.col("_past") + _before(keys, "_n", order),
        }
    )
    crossing = (F.col("_from") < F.col("_goal")) & (F.col("_from") + F.col("_sum") >= F.col("_goal"))
    crossed = sums.filter(crossing).select(*keys, "_bin", "_n", "_single", "_from", "_past")
    kept = binned.drop("_start", "_ahead", "_rows", "_tied").join(crossed, [*keys, "_bin"])
    names = {"_n": "_rows", "_single": "_tied", "_from": "_start", "_past": "_ahead"}
    return materialise(kept.drop("_bin", "_code").withColumnsRenamed(names), "crossing")


def _last_rows(rows: DataFrame, keys: list[str], codes: list[Column], most: int) -> DataFrame:
    """Rows of large accounts, narrowed until an account has ``most`` at most.

    Rows that no code tells apart stay together however many they are.
    """
    small, pending = [], rows
    for code in codes:
        tied = []
        while pending is not None:
            narrowed = _narrowed(pending, keys, code)
            many = F.col("_rows") > most
            small.append(narrowed.filter(~many))
            tied.append(narrowed.filter(many & F.col("_tied")))
            pending = narrowed.filter(many & ~F.col("_tied"))
            if pending.isEmpty():
                pending = None
        pending = reduce(DataFrame.unionByName, tied)
        if pending.isEmpty():
            pending = None
            break
    if pending is not None:
        small.append(pending)
    return reduce(DataFrame.unionByName, small)


def cut_points(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    measure: str,
    target: str,
    descending: bool = False,
    sorted_rows: int = SORTED_ROWS,
) -> DataFrame:
    """Per account, the last row taken when rows are taken in order up to a target.

    A row is taken while the total of the rows before it is below ``target``, so
    the row that crosses it is included. ``order`` must tell the rows of an account
    apart and ``measure`` must not be negative. Returns ``keys``; ``_cut``, a struct of
    ``order`` that is NULL where the whole account is taken; and the amount and the
    number of the rows taken (``moved_amount``, ``moved_loans``). Accounts of which
    nothing is taken have no row.
    """
    aimed = df.filter(F.col(target) > 0).select(
        *keys, *order, F.col(measure).alias("_size"), F.col(target).alias("_goal")
    )
    sizes = materialise(
        aimed.groupBy(*keys).agg(
            F.sum("_size").alias("_total"),
            F.count("*").alias("_rows"),
            F.max("_goal").alias("_most"),
        ),
        "sizes",
    )
    reached = F.col("_total") >= F.col("_most")
    large = F.col("_rows") > sorted_rows
    row = F.struct(*order)
    whole = sizes.filter(~reached).select(
        *keys, F.col("_total").alias("moved_amount"), F.col("_rows").alias("moved_loans")
    )
    none = F.lit(0).cast("long")
    started = {"_start": F.lit(0).cast(sizes.schema["_total"].dataType), "_ahead": none}

    def of(accounts: Column) -> DataFrame:
        chosen = sizes.filter(reached & accounts).select(*keys)
        return aimed.join(chosen, keys).withColumns(started)

    rows = of(~large)
    if not sizes.filter(reached & large).isEmpty():
        narrowed = _last_rows(of(large), keys, _codes(df, order, descending), sorted_rows)
        rows = rows.unionByName(narrowed.select(*rows.columns))
    edge = F.min(row) if descending else F.max(row)
    before = F.col("_start") + _before(keys, "_size", _directions(order, descending))
    cut = (
        rows.withColumn("_before", before)
        .filter(F.col("_before") < F.col("_goal"))
        .groupBy(*keys)
        .agg(
            edge.alias("_cut"),
            (F.max("_start") + F.sum("_size")).alias("moved_amount"),
            (F.max("_ahead") + F.count("*")).alias("moved_loans"),
        )
    )
    return cut.unionByName(whole, allowMissingColumns=True)


def mark_until(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    measure: str,
    target: str,
    descending: bool = False,
    mark: str = "taken",
    sorted_rows: int = SORTED_ROWS,
) -> DataFrame:
    """All rows of ``df`` with a boolean: is the row taken (see :func:`cut_points`)?"""
    cuts = cut_points(df, keys, order, measure, target, descending, sorted_rows)
    cuts = materialise(cuts.select(*keys, "_cut", F.lit(True).alias("_any")), "cuts")
    here = F.struct(*order)
    inside = here >= F.col("_cut") if descending else here <= F.col("_cut")
    taken = F.col("_any").isNotNull() & (F.col("_cut").isNull() | inside)
    return (
        df.join(cuts, keys, "left")
        .withColumn(mark, F.coalesce(taken, F.lit(False)))
        .drop("_cut", "_any")
    )


def positions(
    df: DataFrame, keys: list[str], order: list[str], name: str = "position"
) -> DataFrame:
    """All rows of ``df`` numbered from 0 within their account.

    Only ``keys`` and ``order`` are sorted and written; whole rows move once, to meet their
    numbers. NULL in a key or an order column is a value like any other, and comes first.
    Rows that ``order`` doesn't tell apart have consecutive numbers, in any order.
    """
    line, within = F.struct(*keys, *order), F.struct(*keys, CHUNK)
    chunked = materialise(
        df.select(*keys, *order)
        .orderBy(*keys, *order)
        .withColumn(CHUNK, F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id()),
        "order",
    )
    starts = chunked.groupBy(*keys, CHUNK).agg(
        F.min("_at").alias("_first"), F.count("*").alias("_rows")
    )
    earlier = _before(keys, "_rows", [F.col(CHUNK)]) - F.col("_first")
    starts = materialise(starts.select(within.alias("_within"), earlier.alias("_ahead")), "starts")
    # structs are equal where both hold NULL, so rows without an account find theirs as well
    placed = chunked.withColumn("_within", within).join(starts, "_within")
    numbers = placed.groupBy(line.alias("_line")).agg(
        F.min(F.col("_at") + F.col("_ahead")).alias("_place")
    )
    tied = F.row_number().over(Window.partitionBy("_line").orderBy("_place"))
    return (
        df.withColumn("_line", line)
        .join(numbers, "_line")
        .withColumn(name, F.col("_place") + tied - 1)
        .drop("_line", "_place")
    )
