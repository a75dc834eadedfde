"""Commits that are seen whole, loads that may be retried, and results fetched either way."""

from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgertie.sources import feeds, fetching, generations


def batches(spark, *rows):
    return spark.createDataFrame(list(rows), "loan_id string, load_batch_id string")


def test_readers_see_one_whole_generation(spark, tmp_path):
    target = str(tmp_path / "t")
    assert generations.current(spark, target) is None
    with pytest.raises(FileNotFoundError):
        generations.read_current(spark, target)
    feeds.publish_checked(spark.range(3), target)
    old = generations.read_current(spark, target)
    assert feeds.publish_checked(spark.range(10, 15), target) == 5
    assert sorted(r.id for r in old.collect()) == [0, 1, 2]  # a reader that began before
    assert generations.read_current(spark, target).count() == 5
    feeds.publish_checked(spark.range(1), target)
    folders = {path.name for path in (tmp_path / "t").iterdir() if path.is_dir()}
    held = generations.current(spark, target)
    assert folders == {*held.parts, *held.previous} and held.number == 3


def test_a_commit_that_stops_leaves_the_table(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "t")
    feeds.publish_checked(spark.range(3), target)
    broken = spark.range(3).select(F.raise_error(F.lit("no")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="no"):
        feeds.publish_checked(broken, target)
    holed = spark.range(3).select(F.nullif("id", F.lit(1)).alias("id"))
    with pytest.raises(ValueError, match="id"):
        feeds.publish_checked(holed, target)

    def stop(*_):
        assert generations.read_current(spark, target).count() == 3  # parts are there, not in force
        raise OSError("stopped before the pointer")

    with monkeypatch.context() as patched:
        patched.setattr(generations, "_swap", stop)
        with pytest.raises(OSError):
            feeds.publish_checked(spark.range(7), target)
    assert generations.read_current(spark, target).count() == 3
    assert feeds.publish_checked(spark.range(7), target) == 7


def test_a_commit_from_an_old_generation_is_refused(spark, tmp_path):
    target = str(tmp_path / "t")
    feeds.publish_checked(spark.range(3), target)
    seen = generations.current(spark, target)
    feeds.publish_checked(spark.range(4), target)
    with pytest.raises(RuntimeError, match="another commit"):
        generations.commit(spark, target, seen, ("part-x",))
    assert generations.read_current(spark, target).count() == 4


def test_batches_come_once_however_often_they_are_loaded(spark, tmp_path):
    target = str(tmp_path / "t")
    first = batches(spark, ("1", "B1"), ("1", "B1"), ("2", "B2"))
    assert generations.append_batches(first, target) == 3  # a replay within one load stays
    assert generations.append_batches(first, target) == 0
    more = first.unionByName(batches(spark, ("3", "B3")))
    assert generations.append_batches(more, target) == 1
    held = generations.read_current(spark, target)
    assert sorted(map(tuple, held.collect())) == [("1", "B1"), ("1", "B1"), ("2", "B2"), ("3", "B3")]
    with pytest.raises(ValueError, match="no batch id"):
        generations.append_batches(batches(spark, ("4", None)), target)
    assert generations.read_current(spark, target).count() == 4
    names = {r.load_batch_id for r in generations.loaded_batches(spark, target).collect()}
    assert names == {"B1", "B2", "B3"}
    feeds.publish_checked(batches(spark, ("9", "B9")), target)  # a new table forgets its batches
    assert generations.append_batches(first, target) == 3


def test_a_load_that_stops_can_be_tried_again(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "t")
    load = batches(spark, ("1", "B1"), ("2", "B2"))
    with monkeypatch.context() as patched:
        patched.setattr(generations, "_swap", lambda *_: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            generations.append_batches(load, target)
    assert generations.current(spark, target) is None
    assert generations.append_batches(load, target) == 2


def test_arrow_and_rows_fetch_the_same(spark):
    rows = [
        (i, f"é{i}" if i % 3 else None, Decimal(i) / 100, datetime.date(2025, 1, 1 + i % 28), i / 7, i % 2 == 0)
        for i in range(2500)
    ]
    schema = "n long, name string, amount decimal(18,2), day date, share double, even boolean"
    df = spark.createDataFrame(rows, schema).repartition(3).orderBy("n")
    assert fetching.can_use_arrow(df)
    sizes = [batch.num_rows for batch in fetching.fetch_batches(df, batch_rows=400, file_rows=900)]
    assert sum(sizes) == 2500 and max(sizes) <= 400
    arrow, plain = list(fetching.fetched(df, True)), list(fetching.fetched(df, False))
    assert arrow == plain and [row["n"] for row in arrow] == list(range(2500))
    assert list(fetching.fetched(df.limit(0), True)) == []


def test_rows_are_the_way_out(spark, monkeypatch):
    nested = spark.createDataFrame([(1, [1, 2])], "n long, held array<int>")
    assert not fetching.can_use_arrow(nested)
    assert list(fetching.fetched(nested)) == [{"n": 1, "held": [1, 2]}]
    import sys

    monkeypatch.setitem(sys.modules, "pyarrow.parquet", None)
    assert not fetching.can_use_arrow(spark.range(2))
    assert [row["id"] for row in fetching.fetched(spark.range(2))] == [0, 1]
