"""Inputs of the operators and ranges of ids that tasks can share out alike."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgertie.sources.session import materialise

__all__ = [
    "documents",
    "free_name",
    "id_and_text",
    "materialise",
    "numbered",
    "range_parts",
    "read",
]


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "documents")


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns that an operator reads, under its own names."""
    return df.select(
        df[id_col].cast("long").alias("doc_id"), df[text_col].cast("string").alias("text")
    )


def constants(values: Sequence[int], kind: str) -> Column:
    """An array of many constants, which Spark folds once and which keeps the plan short."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


@dataclass(frozen=True)
class Steps:
    """Equal steps of ids from ``low``, and the range of each; a negative one is cut further.

    Step number ``-1 - i`` among the ranges stands for the ``i``-th of the finer steps.
    """

    low: int
    step: int
    parts: tuple[int, ...]

    def column(self, name: str, parts: Column) -> Column:
        cell = F.expr(f"(`{name}` - {self.low}L) div {self.step}L").cast("int")
        return F.element_at(parts, F.greatest(cell, F.lit(0)) + 1)


@dataclass(frozen=True)
class RangeParts:
    """Consecutive ranges of ids, from equal steps and finer ones where they hold too many."""

    steps: Steps
    finer: tuple[Steps, ...] = ()

    @property
    def count(self) -> int:
        last = self.steps.parts[-1]
        return (last if last >= 0 else self.finer[-1].parts[-1]) + 1

    def column(self, name: str) -> Column:
        """The number of the range a row lies in; nulls lie in the first."""
        held = self.steps.column(name, constants(self.steps.parts, "int"))
        if self.finer:
            # the finer steps lie behind each other in one array, each from its own offset
            offsets, joined = [], []
            for finer in self.finer:
                offsets.append(len(joined))
                joined += finer.parts

            def of(values: Sequence[int]) -> Column:
                return F.get(constants(values, "long"), -1 - held)

            lows, widths = ([getattr(f, k) for f in self.finer] for k in ("low", "step"))
            inside = of(offsets) + F.call_function("div", F.col(name) - of(lows), of(widths))
            finest = F.get(constants(joined, "int"), inside.cast("int"))
            held = F.when(held >= 0, held).otherwise(finest)
        return F.when(F.col(name).isNull(), F.lit(0)).otherwise(held)


def _cells(ids: DataFrame, low: int, high: int, cells: int) -> tuple[int, dict[int, tuple]]:
    """Equal steps between two ids: their width, and count, least and greatest id of each."""
    step = (high - low) // cells + 1
    cell = F.expr(f"(id - {low}L) div {step}L").cast("int")
    counted = ids.groupBy(cell.alias("cell")).agg(
        F.count("*").alias("n"), F.min("id").alias("low"), F.max("id").alias("high")
    )
    return step, {row["cell"]: (row["n"], row["low"], row["high"]) for row in counted.toLocalIterator()}


def range_parts(ids: DataFrame, column: str, rows: int, cells: int = 65_536) -> RangeParts:
    """Ranges of ids that hold about ``rows`` rows each, as far as steps tell.

    The ids are counted in at most ``cells`` equal steps between the least and the
    greatest, and steps with more than ``rows`` rows once more between their own least and
    greatest, so one far id does not leave all others in one range. The driver gets
    tables of bounded size, and the ranges depend on the ids alone: not on the partitions
    of the input or on their order. Rows with one id stay in one range.
    """
    held = ids.select(F.col(column).alias("id")).filter(F.col("id").isNotNull())
    low, high = held.agg(F.min("id"), F.max("id")).first()
    if low is None:
        return RangeParts(Steps(0, 1, (0,)))
    step, counts = _cells(held, low, high, cells)
    full = {cell for cell, (n, least, most) in counts.items() if n > rows and most > least}
    part = filled = 0

    def next_part(n: int) -> int:
        nonlocal part, filled
        if filled and filled + n > rows:
            part, filled = part + 1, 0
        filled += n
        return part

    within = {}
    if full:
        each = max(2, cells // len(full))
        bounds = {cell: counts[cell][1:] for cell in full}
        within = _finer(held, low, step, bounds, each)
    parts, finer = [], []
    for cell in range((high - low) // step + 1):
        if cell in full:
            least, most = bounds[cell]
            width = (most - least) // each + 1
            inner = (within.get((cell, at), 0) for at in range((most - least) // width + 1))
            finer.append(Steps(least, width, tuple(next_part(n) for n in inner)))
            parts.append(-len(finer))
        else:
            parts.append(next_part(counts[cell][0] if cell in counts else 0))
    return RangeParts(Steps(low, step, tuple(parts)), tuple(finer))


def _finer(
    ids: DataFrame, low: int, step: int, bounds: dict[int, tuple[int, int]], each: int
) -> dict[tuple[int, int], int]:
    """Rows in each of ``each`` equal steps between the bounds of some cells."""
    names = sorted(bounds)
    place = {cell: i for i, cell in enumerate(names)}
    lows = [bounds[cell][0] for cell in names]
    widths = [(bounds[cell][1] - bounds[cell][0]) // each + 1 for cell in names]
    which = F.element_at(
        F.map_from_arrays(constants(names, "int"), constants([place[c] + 1 for c in names], "int")),
        F.expr(f"(id - {low}L) div {step}L").cast("int"),
    )
    rows = ids.withColumn("which", which).filter(F.col("which").isNotNull())
    start = F.element_at(constants(lows, "long"), F.col("which"))
    width = F.element_at(constants(widths, "long"), F.col("which"))
    at = F.call_function("div", F.col("id") - start, width).cast("int")
    counted = rows.groupBy("which", at.alias("at")).count()
    return {(names[r["which"] - 1], r["at"]): r["count"] for r in counted.toLocalIterator()}


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores after it as it takes to be new to ``df``."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


FILE_ROWS = 1 << 40  # more than a file has


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a number for each row in the new column ``name``, the same in every use.

    Rows of files are numbered by their file and their place in it, so nothing is
    written and a lost executor changes no number. The files are numbered in a table with a
    row for each, which Spark joins by its size. Any other table is written once.
    """
    path, place = free_name(df, "_file"), free_name(df, "_place")
    try:
        files = df.select(F.col("_metadata.file_path").alias(path)).distinct()
        placed = df.select(
            "*", F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(place)
        )
    except AnalysisException:
        return materialise(df.withColumn(name, F.monotonically_increasing_id()), "numbered", True)
    number = F.row_number().over(Window.orderBy(path)).cast("long") - 1
    files = materialise(files.withColumn(name, number), "files", True)
    held = placed.join(files, path)
    row = F.col(name) * FILE_ROWS + F.col(place)
    return held.withColumn(name, row).select(*(F.col(f"`{c}`") for c in df.columns), name)
