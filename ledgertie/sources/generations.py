"""Tables that are replaced and extended as a whole: immutable parts and one pointer.

A table is a folder of parts, written once and never changed, and a small file
``CURRENT`` that names those in force. A commit writes its parts first and then renames a
new pointer over the old one, which file systems do in one step. A reader takes the pointer
once and sees one whole generation, whatever is committed meanwhile; a commit that stops
on the way leaves the old one in force. Parts out of force go a generation later, so
that readers of the one before can finish.

Each commit also stores the batch ids it brought. They are in force with its rows, by the
same pointer, so a load that is tried again finds its batches there and adds nothing.
One writer at a time is assumed; a commit whose pointer has moved on meanwhile is refused.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POINTER = "CURRENT"
BATCH = "load_batch_id"


@dataclass(frozen=True)
class Generation:
    """What a pointer names: the number of commits, parts, and parts just out of force."""

    number: int
    parts: tuple[str, ...] = ()
    previous: tuple[str, ...] = ()


def _files(spark: SparkSession, location: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def current(spark: SparkSession, target: str) -> Generation | None:
    """The generation in force, or None if nothing was committed."""
    path, files = _files(spark, f"{target}/{POINTER}")
    if not files.exists(path):
        return None
    stream = files.open(path)
    try:
        held = json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()
    return Generation(held["number"], tuple(held["parts"]), tuple(held["previous"]))


def _swap(spark: SparkSession, target: str, generation: Generation) -> None:
    """Put ``generation`` in force by one rename."""
    place = f"{target}/{POINTER}"
    staged, files = _files(spark, f"{place}.{uuid.uuid4().hex}")
    stream = files.create(staged, False)
    try:
        stream.write(json.dumps(vars(generation)).encode())
    finally:
        stream.close()
    fs = spark._jvm.org.apache.hadoop.fs
    rename = getattr(fs, "Options$Rename")
    options = spark._sc._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    path, _ = _files(spark, place)
    context = fs.FileContext.getFileContext(path.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(files.makeQualified(staged), files.makeQualified(path), options)


def commit(
    spark: SparkSession, target: str, seen: Generation | None, parts: tuple[str, ...]
) -> Generation:
    """Put ``parts`` in force after ``seen``, the generation that they were made from."""
    seen = seen or Generation(0)
    now = current(spark, target) or Generation(0)
    if now.number != seen.number:
        raise RuntimeError(f"{target}: another commit came first")
    gone = tuple(part for part in seen.parts if part not in parts)
    generation = Generation(seen.number + 1, parts, gone)
    _swap(spark, target, generation)
    for part in seen.previous:
        path, files = _files(spark, f"{target}/{part}")
        files.delete(path, True)
    return generation


def _written(df: DataFrame, target: str, batch_col: str | None) -> str:
    """A new part with the rows and the distinct batch ids of ``df``, not yet in force."""
    part = f"part-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(f"{target}/{part}/rows")
    if batch_col is not None and batch_col in df.columns:
        rows = df.sparkSession.read.schema(df.schema).parquet(f"{target}/{part}/rows")
        ids = rows.select(F.col(batch_col).cast("string").alias(BATCH)).distinct()
        ids.write.mode("error").parquet(f"{target}/{part}/batches")
    return part


def _discard(spark: SparkSession, target: str, part: str) -> None:
    path, files = _files(spark, f"{target}/{part}")
    files.delete(path, True)


def publish(
    df: DataFrame,
    target: str,
    check: Callable[[DataFrame], None] | None = None,
    batch_col: str | None = BATCH,
) -> Generation:
    """Replace the whole table by ``df``, after ``check`` has seen the written copy.

    If the write or the check fails, the part goes and the table stays as it was.
    """
    spark = df.sparkSession
    seen = current(spark, target)
    part = _written(df, target, batch_col)
    try:
        if check is not None:
            check(spark.read.schema(df.schema).parquet(f"{target}/{part}/rows"))
        return commit(spark, target, seen, (part,))
    except Exception:
        _discard(spark, target, part)
        raise


def read_current(spark: SparkSession, target: str) -> DataFrame:
    """The rows of the generation in force when this is called."""
    held = current(spark, target)
    if held is None or not held.parts:
        raise FileNotFoundError(f"{target}: nothing was committed")
    return spark.read.parquet(*(f"{target}/{part}/rows" for part in held.parts))


def loaded_batches(spark: SparkSession, target: str) -> DataFrame:
    """Ids of the batches in force (load_batch_id)."""
    held, paths = current(spark, target), []
    for part in held.parts if held else ():
        path, files = _files(spark, f"{target}/{part}/batches")
        if files.exists(path):
            paths.append(path.toString())
    schema = f"{BATCH} string"
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def append_batches(df: DataFrame, target: str, batch_col: str = BATCH) -> int:
    """Add the rows of those batches that the table does not have yet; the rows added.

    All of them come into force at once. A batch in force is left out whole, however
    often its load is tried again; rows without a batch id are refused.
    """
    spark = df.sparkSession
    seen = current(spark, target)
    known = loaded_batches(spark, target).distinct().withColumnRenamed(BATCH, "_loaded")
    new = df.join(known, F.col(batch_col).cast("string") == F.col("_loaded"), "left_anti")
    part = _written(new.select(*df.columns), target, batch_col)
    try:
        rows = spark.read.schema(df.schema).parquet(f"{target}/{part}/rows")
        added, nameless = rows.agg(F.count("*"), F.count_if(F.col(batch_col).isNull())).first()
        if nameless:
            raise ValueError(f"{nameless} rows have no batch id")
        if not added:
            _discard(spark, target, part)
            return 0
        commit(spark, target, seen, (*(seen.parts if seen else ()), part))
        return added
    except Exception:
        _discard(spark, target, part)
        raise
