from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from frames import detail, extract, ledger
from ledgertie.operators import quality, rollups, tieouts
from ledgertie.sources import feeds, schemas

GL = (
    "entity,product,quarter,gl_balance,gl_account,as_of_date\n"
    "East,Home,2025Q1,100.50,GL-1,2025-03-31\n"
    "East,Car,2025Q1,7,GL-2,2025-03-31\n"
)
SUB = (
    "loan_id,entity,product,quarter,loan_amount,load_batch_id\n"
    "1,East,Home,2025Q1,100.50,B1\n1,East,Home,2025Q1,100.50,B1-REPLAY\n2,East,Car,2025Q1,7.00,B1\n"
)
EXT = (
    "entity,product,quarter,extract_balance,schedule_code,extract_run_date\n"
    "East,Home,2025Q1,100.50,H.1,2025-04-08\n"
)


@pytest.fixture
def sources(tmp_path):
    texts = {"general_ledger": GL, "sub_ledger": SUB, "regulatory_extract": EXT}
    paths = {}
    for name, text in texts.items():
        path = tmp_path / f"{name}.csv"
        path.write_text(text)
        paths[name] = str(path)
    return paths


def test_load_is_typed_counted_and_repeatable(spark, sources, tmp_path):
    out = str(tmp_path / "tables")
    expected = {"general_ledger": 2, "sub_ledger": 3, "regulatory_extract": 1}
    assert feeds.load_feeds(spark, sources, out) == expected
    assert feeds.load_feeds(spark, sources, out) == expected
    gl = feeds.read_table(spark, f"{out}/general_ledger", schemas.GENERAL_LEDGER)
    assert [f.dataType for f in gl.schema] == [f.dataType for f in schemas.GENERAL_LEDGER]
    first = gl.filter("product = 'Home'").first()
    assert first.gl_balance == Decimal("100.50")
    assert first.as_of_date == datetime.date(2025, 3, 31)
    sub = feeds.read_table(spark, f"{out}/sub_ledger", schemas.SUB_LEDGER)
    row = tieouts.reconcile_detail(gl, sub).first()
    assert (row.root_cause, row.duplicate_loan_ids) == ("DUPLICATE_LOAD", 1)
    assert not [p for p in (tmp_path / "tables").iterdir() if "." in p.name]


def test_missing_sources_are_named_together(spark, sources):
    wrong = {**sources, "sub_ledger": "/nowhere/sub.csv", "regulatory_extract": "/nowhere/ext.csv"}
    with pytest.raises(FileNotFoundError) as error:
        feeds.load_feeds(spark, wrong, "/nowhere")
    assert "/nowhere/sub.csv" in str(error.value) and "/nowhere/ext.csv" in str(error.value)
    assert "general_ledger" not in str(error.value)


@pytest.mark.parametrize(
    "text", [GL.replace("100.50", "many"), GL.replace("gl_balance", "balance")]
)
def test_bad_values_and_headers_fail_the_read(spark, tmp_path, text):
    path = tmp_path / "gl.csv"
    path.write_text(text)
    with pytest.raises(Exception):  # noqa: B017 - Spark raises its own classes
        feeds.read_feed(spark, str(path), schemas.GENERAL_LEDGER).collect()


def test_nulls_are_reported_by_column(spark, tmp_path):
    path = tmp_path / "gl.csv"
    path.write_text(GL.replace("East,Car", ",Car"))
    feed = feeds.read_feed(spark, str(path), schemas.GENERAL_LEDGER)
    with pytest.raises(ValueError, match="entity"):
        feeds.require_not_null(feed)
    feeds.require_not_null(feed, ["product", "quarter"])


def test_row_count_check(spark):
    assert feeds.check_row_count(spark.range(3), spark.range(3)) == 3
    with pytest.raises(RuntimeError, match="holds 2 rows where 3 were read"):
        feeds.check_row_count(spark.range(3), spark.range(2))


def test_failed_replacement_keeps_the_table(spark, tmp_path):
    target = str(tmp_path / "t")
    feeds.replace_checked(spark.range(3), target)
    broken = spark.range(3).select(F.raise_error(F.lit("no")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="no"):
        feeds.replace_checked(broken, target)
    holed = spark.range(3).select(F.nullif("id", F.lit(1)).alias("id"))
    with pytest.raises(ValueError, match="id"):
        feeds.replace_checked(holed, target)
    assert spark.read.parquet(target).count() == 3
    assert feeds.replace_checked(spark.range(5), target) == 5
    assert spark.read.parquet(target).count() == 5
    assert [path.name for path in tmp_path.iterdir()] == ["t"]


def test_refresh_append_export(spark, tmp_path):
    target = str(tmp_path / "t")
    frame = ledger(spark, ("East", "Home", "2025Q1", 1), ("East", "Home", "2025Q2", 2))
    feeds.refresh(frame, target, ["quarter"])
    feeds.refresh(frame, target, ["quarter"])
    assert spark.read.parquet(target).count() == 2
    feeds.append(frame, str(tmp_path / "a"))
    feeds.append(frame, str(tmp_path / "a"))
    assert spark.read.parquet(str(tmp_path / "a")).count() == 4
    feeds.export(frame, str(tmp_path / "csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert back.columns == frame.columns and back.count() == 2


def test_fetch_gives_all_rows(spark):
    rows = feeds.fetch(spark.range(150_000))
    assert next(rows).id == 0 and sum(1 for _ in rows) == 149_999


def test_names_profile_and_sample(spark):
    frame = ledger(spark, ("East", "Home", "2025Q1", 1)).toDF("ENTITY", "Product", "QUARTER", "gl")
    lowered = feeds.lower_names(frame)
    assert lowered.columns == ["entity", "product", "quarter", "gl"]
    rows = feeds.profile({"gl": lowered, "none": lowered.limit(0)}).collect()
    assert [(r.table_name, r.position, r.column_name, r.row_count) for r in rows][3:5] == [
        ("gl", 4, "gl", 1), ("none", 1, "entity", 0),
    ]
    assert rows[3].data_type == "decimal(18,2)"
    assert feeds.sample_rows(spark.range(9)).count() == 3


def test_bucketed_detail_is_rolled_up_without_moving_rows(spark):
    rows = [(str(i % 50), "East", f"P{i % 3}", "2025Q1", i) for i in range(300)]
    loans = detail(spark, *rows)
    columns = ["entity", "product", "quarter", "loan_id"]
    feeds.save_bucketed(loans, "bucketed_loans", columns, 4)
    try:
        rolled = rollups.rollup_to_grain(
            spark.table("bucketed_loans"), schemas.KEYS, "loan_amount", "loan_id"
        )
        plan = rolled._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(") == 1  # of the partial roll-ups
        assert "loan_id" not in plan[plan.index("Exchange") :].split("\n")[0]
        plain = rollups.rollup_to_grain(loans, schemas.KEYS, "loan_amount", "loan_id")
        assert quality.frame_diff(rolled, plain).isEmpty()
    finally:
        spark.sql("DROP TABLE bucketed_loans")


def test_load_checks(spark):
    sent = detail(spark, ("1", "East", "a", "2025Q1", 5), ("2", "East", "a", "2025Q1", 7))
    swapped = detail(spark, ("1", "East", "a", "2025Q1", 5), ("1", "East", "a", "2025Q1", 5))
    holed = detail(spark, ("1", "East", None, "2025Q1", 5), ("2", "East", "a", "2025Q1", 7))
    checks = quality.load_checks(
        {
            "same": (sent, sent, "loan_amount"),
            "swapped": (sent, swapped, "loan_amount"),
            "short": (sent, sent.limit(1), "loan_amount"),
            "holed": (sent, holed, "loan_amount"),
            "empty": (sent.limit(0), sent.limit(0), "loan_amount"),
        }
    )
    found = {row.table_name: row for row in checks.collect()}
    assert {name for name, row in found.items() if row.passed} == {"same", "empty"}
    assert found["holed"].nulls == 1


def test_multisets_and_frames(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "id string")
    right = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "id string")
    assert {tuple(r) for r in quality.multiset_diff(left, right).collect()} == {
        ("a", 2, 1), ("b", 1, 2),
    }
    assert quality.frame_diff(left, left).isEmpty()
    with pytest.raises(ValueError):
        quality.frame_diff(left, left.toDF("other"))
    with pytest.raises(ValueError):
        quality.frame_diff(left, left.withColumn("id", F.lit(1)))


def test_account_difference_and_branches(spark):
    gl = ledger(spark, ("East", "a", "2025Q1", 1), ("East", "b", "2025Q1", 1))
    filed = extract(spark, ("East", "b", "2025Q1", 1), ("East", "c", "2025Q1", 1))
    sides = {r["product"]: r.side for r in quality.account_difference(gl, filed).collect()}
    assert sides == {"a": "left", "c": "right"}
    assert quality.overlapping_branches(gl, filed).isEmpty()
    assert quality.account_difference(gl, gl.unionByName(gl)).isEmpty()


def test_digest_depends_on_content_not_on_order(spark):
    rows = [("a", None, 1), (None, "a", 1), ("b", "c", 2)]
    schema = "x string, y string, n int"
    digest = [
        tuple(quality.content_digest(df).first())
        for df in (
            spark.createDataFrame(rows, schema),
            spark.createDataFrame(rows[::-1], schema).repartition(3),
            spark.createDataFrame([("a", None, 1), ("a", None, 1), ("b", "c", 2)], schema),
            spark.createDataFrame([], schema),
        )
    ]
    assert digest[0] == digest[1] != digest[2]
    assert digest[3] == (0, Decimal(0))
