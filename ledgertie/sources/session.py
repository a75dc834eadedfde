"""Tables written in the shared folder, to cut lineage and to give Spark true sizes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_passing: ContextVar[tuple[list[str], ...]] = ContextVar("passing", default=())


def shared_folder(spark: SparkSession) -> str:
    """This run's own folder inside the one the cluster names in ``spark.checkpoint.dir``.

    A local session without that setting uses its warehouse folder; any other session
    without it is refused. The folder goes when the session's JVM ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{base.rstrip('/')}/ledgertie-{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def delete(spark: SparkSession, path: str) -> None:
    """Delete a written table or file, if it is there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[None]:
    """Tables written inside the block go when it ends, but for those written to last.

    A table that is written to last goes with the block around this one, or with the session.
    """
    paths: list[str] = []
    token = _passing.set((*_passing.get(), paths))
    try:
        yield
    finally:
        _passing.reset(token)
        for path in paths:
            delete(spark, path)


def scratch_path(spark: SparkSession, name: str, lasting: bool = False) -> str:
    """A new path for a written table in this run's folder."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    blocks = _passing.get()[: -1 if lasting else None]
    if blocks:
        blocks[-1].append(path)
    return path


def materialise(df: DataFrame, name: str = "table", lasting: bool = False) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and continue from the files.

    Used where two branches must see the very same rows and where rows are read more
    than once. The files keep column statistics and sizes, so Spark itself can choose
    between a broadcast and a shuffle when the table is joined. A ``lasting`` table
    outlives the block of :func:`passing_tables` that it is written in.
    """
    path = scratch_path(df.sparkSession, name, lasting)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
