"""Reading, loading and exporting feeds, with checks at every boundary."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgertie.sources.fetching import fetch_rows
from ledgertie.sources.generations import current, publish, read_current
from ledgertie.sources.schemas import FEEDS


def _path(spark: SparkSession, location: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def require_paths(spark: SparkSession, paths: dict[str, str]) -> None:
    """Raise one error that names every feed whose source is absent."""

    def absent(location: str) -> bool:
        path, files = _path(spark, location)
        return not files.exists(path)

    missing = [f"{name}: {location}" for name, location in paths.items() if absent(location)]
    if missing:
        raise FileNotFoundError("feeds not found: " + "; ".join(missing))


def read_feed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Headed CSV with an explicit schema; a bad value or header fails the read."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A loaded feed, at the columns and types of its schema.

    Of a table in generations it is the one in force when this is called.
    """
    published = current(spark, path) is not None
    stored = lower_names(read_current(spark, path) if published else spark.read.parquet(path))
    return stored.select(*(F.col(field.name).cast(field.dataType) for field in schema))


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*(name.lower() for name in df.columns))


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row with the number of NULLs of each column, from a single pass."""
    names = columns or df.columns
    return df.agg(*(F.count_if(F.col(name).isNull()).alias(name) for name in names))


def require_not_null(df: DataFrame, columns: list[str] | None = None) -> None:
    """Raise if any of the columns holds a NULL; Spark does not enforce NOT NULL itself."""
    _refuse_nulls(null_counts(df, columns).first().asDict())


def _refuse_nulls(counts: dict[str, int]) -> None:
    found = {name: n for name, n in counts.items() if n}
    if found:
        raise ValueError(f"NULL in columns that must not be: {found}")


def check_row_count(source: DataFrame, target: DataFrame, name: str = "table") -> int:
    """Raise if the load dropped or doubled rows; return the rows loaded."""
    return _same_count(source.count(), target.count(), name)


def _same_count(expected: int, loaded: int, name: str) -> int:
    if expected != loaded:
        raise RuntimeError(
            f"{name}: the written copy holds {loaded:,} rows where {expected:,} were read"
        )
    return loaded


def append(df: DataFrame, target: str) -> None:
    df.write.mode("append").parquet(target)


def refresh(df: DataFrame, target: str, partition_by: list[str] | None = None) -> None:
    """Replace the whole target; running it twice leaves the same rows."""
    df.write.mode("overwrite").partitionBy(*(partition_by or [])).parquet(target)


def replace_checked(df: DataFrame, target: str, name: str = "table") -> int:
    """Replace ``target`` only after the new copy is complete, counted and free of NULLs.

    The source is read once, counted as it is written, and the copy once for all checks.
    It is written beside the target and then renamed over it, so a failed write or
    check leaves the previous table as it was. This is for plain folders that others read as
    they are; between its two renames they can see no table, which :func:`publish_checked` avoids.
    """
    spark = df.sparkSession
    tag = uuid.uuid4().hex
    target_path, files = _path(spark, target)
    staged_path, _ = _path(spark, f"{target}.staged-{tag}")
    previous_path, _ = _path(spark, f"{target}.previous-{tag}")
    try:
        sent = Observation()
        observed = df.observe(sent, F.count(F.lit(1)).alias("rows"))
        observed.write.mode("error").parquet(staged_path.toString())
        staged = spark.read.parquet(staged_path.toString())
        holes = [F.count_if(F.col(column).isNull()) for column in staged.columns]
        rows, *nulls = staged.agg(F.count("*"), *holes).first()
        loaded = _same_count(sent.get["rows"], rows, name)
        _refuse_nulls(dict(zip(staged.columns, nulls, strict=True)))
    except Exception:
        files.delete(staged_path, True)
        raise
    had_previous = files.exists(target_path)
    if had_previous and not files.rename(target_path, previous_path):
        raise OSError(f"could not set {target} aside")
    if not files.rename(staged_path, target_path):
        if had_previous:
            files.rename(previous_path, target_path)
        raise OSError(f"could not publish {target}")
    if had_previous:
        files.delete(previous_path, True)
    return loaded


def publish_checked(df: DataFrame, target: str, name: str = "table") -> int:
    """Replace ``target``, a table in generations, after the same checks.

    The source is read once, counted as it is written, and the copy once for all checks.
    The copy comes into force by one rename (see :mod:`ledgertie.sources.generations`):
    a reader sees the old table or the new one whole, and a failed write or check leaves
    the old one in force. Read it with :func:`read_table` or ``read_current``.
    """
    sent = Observation()
    observed = df.observe(sent, F.count(F.lit(1)).alias("rows"))
    loaded = 0

    def check(staged: DataFrame) -> None:
        nonlocal loaded
        holes = [F.count_if(F.col(column).isNull()) for column in staged.columns]
        rows, *nulls = staged.agg(F.count("*"), *holes).first()
        loaded = _same_count(sent.get["rows"], rows, name)
        _refuse_nulls(dict(zip(staged.columns, nulls, strict=True)))

    publish(observed, target, check)
    return loaded


def load_feeds(spark: SparkSession, sources: dict[str, str], folder: str) -> dict[str, int]:
    """Load the CSV feeds into published tables under ``folder``; rows loaded by name.

    Read them with :func:`read_table`.
    """
    require_paths(spark, sources)
    return {
        name: publish_checked(read_feed(spark, source, FEEDS[name]), f"{folder}/{name}", name)
        for name, source in sources.items()
    }


def save_bucketed(df: DataFrame, table: str, columns: list[str], buckets: int) -> None:
    """Store a feed bucketed on ``columns``.

    A sub-ledger bucketed on account and loan id is rolled up without shuffling
    its rows: the distinct count finds every loan's copies in one bucket.
    """
    df.write.mode("overwrite").bucketBy(buckets, *columns).sortBy(*columns).saveAsTable(table)


def export(df: DataFrame, path: str) -> None:
    """One folder of headed CSV files per result."""
    df.write.mode("overwrite").option("header", True).csv(path)


def fetch(df: DataFrame) -> Iterator[Row]:
    """All rows of a result (see :mod:`ledgertie.sources.fetching` for Arrow batches)."""
    return fetch_rows(df)


def profile(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per column of each table: position, type and the table's row count."""

    def described(name: str, df: DataFrame) -> DataFrame:
        fields = F.array(
            *(
                F.struct(
                    F.lit(place).alias("position"),
                    F.lit(field.name).alias("column_name"),
                    F.lit(field.dataType.simpleString()).alias("data_type"),
                )
                for place, field in enumerate(df.schema, start=1)
            )
        )
        counted = df.agg(F.count("*").alias("row_count"))
        return counted.select(F.lit(name).alias("table_name"), "row_count", F.inline(fields))

    return reduce(DataFrame.unionByName, (described(n, df) for n, df in tables.items()))


def sample_rows(df: DataFrame, n: int = 3, order: list[str] | None = None) -> DataFrame:
    """``n`` rows for looking at a table: the first by ``order``, or any."""
    return (df.orderBy(*order) if order else df).limit(n)
