"""Results brought to the driver as Arrow batches, or as rows where that is not possible.

A result of any size is staged as Parquet in the shared folder, in files of bounded
length, and read back file by file and batch by batch, so the driver holds one file on its
disk and one batch in memory. Without Arrow, or for types that Arrow does not read back as
they are, rows come partition by partition.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T

from ledgertie.sources.session import delete, scratch_path

BATCH_ROWS, FILE_ROWS = 10_000, 1_000_000
PLAIN = (
    T.StringType, T.BooleanType, T.NumericType, T.DateType, T.TimestampNTZType, T.BinaryType,
)


def can_use_arrow(df: DataFrame) -> bool:
    """Whether Arrow is there and reads all columns back as they are."""
    try:
        import pyarrow.parquet  # noqa: F401
    except ImportError:
        return False
    return all(isinstance(field.dataType, PLAIN) for field in df.schema)


def fetch_batches(df: DataFrame, batch_rows: int = BATCH_ROWS, file_rows: int = FILE_ROWS) -> Iterator:
    """All rows of a result as ``pyarrow.RecordBatch`` objects of ``batch_rows`` at most.

    The order of the rows is that of the result.
    """
    import pyarrow.parquet as pq

    spark = df.sparkSession
    staged = scratch_path(spark, "fetched")
    df.write.option("maxRecordsPerFile", file_rows).parquet(staged)
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(staged)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        names = sorted(
            held.getPath().toString()
            for held in files.listStatus(path)
            if held.getPath().getName().startswith("part-")
        )
        with tempfile.TemporaryDirectory() as folder:
            for name in names:
                local = os.path.join(folder, "file.parquet")
                source = spark._jvm.org.apache.hadoop.fs.Path(name)
                place = spark._jvm.org.apache.hadoop.fs.Path(f"file://{local}")
                files.copyToLocalFile(False, source, place, True)
                with pq.ParquetFile(local) as held:
                    yield from held.iter_batches(batch_size=batch_rows)
                os.remove(local)
    finally:
        delete(spark, staged)


def fetch_rows(df: DataFrame) -> Iterator[Row]:
    """All rows of a result; the driver holds a partition at a time, and the one after it."""
    return df.toLocalIterator(prefetchPartitions=True)


def fetched(df: DataFrame, arrow: bool | None = None) -> Iterator[dict]:
    """All rows of a result as dictionaries, through Arrow if that is possible.

    ``arrow`` forces one way; both give the same values.
    """
    if can_use_arrow(df) if arrow is None else arrow:
        for batch in fetch_batches(df):
            yield from batch.to_pylist()
    else:
        for row in fetch_rows(df):
            yield row.asDict()
