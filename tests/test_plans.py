"""Shapes of the physical plans that have to hold at any size."""

from __future__ import annotations

import re

import pytest

from pyspark.sql import functions as F

from frames import detail, extract, ledger
from ledgertie.operators import allocate, offsets, ordered, quality, tieouts, trend, whatif
from ledgertie.operators.tolerance import offset_partner_within
from ledgertie.plans.queries import orders_feeds
from ledgertie.sources.schemas import KEYS

NEVER = ["CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "InArrow"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def hash_keys(text: str) -> list[list[str]]:
    """Columns of every hash exchange, from the top down."""
    found = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    return [[part.split("#")[0].strip() for part in keys.split(",")[:-1]] for keys in found]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Feeds with more columns than the tie-outs need, read back from Parquet."""
    folder = str(tmp_path_factory.mktemp("feeds"))
    q = "2025Q1"
    frames = {
        "gl": ledger(spark, ("East", "a", q, 100), ("East", "b", q, 100)),
        "sub": detail(spark, ("1", "East", "a", q, 100), ("2", "East", "b", q, 90)),
        "ext": extract(spark, ("East", "a", q, 100), ("East", "b", q, 100)),
    }
    for name, df in frames.items():
        df.selectExpr("*", "'x' AS surplus").write.parquet(f"{folder}/{name}")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield {name: spark.read.parquet(f"{folder}/{name}") for name in frames}
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_detail_spreads_on_account_and_loan(stored):
    text = plan(tieouts.reconcile_detail(stored["gl"], stored["sub"]))
    assert not any(word in text for word in NEVER) and "Window" not in text
    exchanges = hash_keys(text)
    assert [*KEYS, "loan_id"] in exchanges
    assert sorted(exchanges) == sorted([KEYS, KEYS, [*KEYS, "loan_id"]])
    # rows are combined before they travel
    assert re.search(r"loan_id#\d+, 4\).*\n.*HashAggregate\(.*partial_sum", text)
    assert "surplus" not in text


def test_trend_reads_neither_ids_nor_causes(stored):
    gl, sub, ext = stored.values()
    flagged = tieouts.flag_detail(gl, sub, id_col=None)
    breaks = trend.stack_breaks(flagged, tieouts.flag_filed(gl, ext))
    text = plan(trend.break_trend(gl, breaks))
    assert not any(word in text for word in NEVER)
    assert "loan_id" not in text and "surplus" not in text
    assert text.count("/sub]") == 1


def test_filed_pairing_moves_the_feeds_once(stored):
    text = plan(tieouts.flag_filed(stored["gl"], stored["ext"]))
    assert hash_keys(text) == [KEYS] and "Join" not in text
    assert text.count("/gl]") == 1 and text.count("/ext]") == 1


def test_written_accounts_are_not_moved_again(stored):
    text = plan(tieouts.reconcile_filed(stored["gl"], stored["ext"]))
    assert not any(word in text for word in NEVER)
    assert "/gl]" not in text and "/ext]" not in text and "Window" not in text
    assert [KEYS] * len(hash_keys(text)) == hash_keys(text)


@pytest.mark.parametrize("partners", [offsets.offset_partner, offsets.offset_partner_by_join])
def test_partner_search_never_compares_pairs(stored, partners):
    flagged = tieouts.flag_filed(stored["gl"], stored["ext"])
    text = plan(partners(flagged, KEYS, "product"))
    assert not any(word in text for word in NEVER) and "Window" not in text
    assert "partial_max" in text


def test_universe_multiplies_distinct_values_only(stored):
    text = plan(whatif.universe(stored["gl"]))
    assert text.count("CartesianProduct") == 2
    assert all([key] in hash_keys(text) for key in KEYS)
    assert not any(word in text for word in NEVER if word != "CartesianProduct")


def test_gaps_multiply_nothing(stored):
    assert not any(word in plan(quality.universe_gaps(stored["gl"])) for word in NEVER)


def test_rows_are_selected_without_a_global_sort(stored):
    aimed = stored["sub"].withColumn("target", F.lit(50).cast("decimal(18,2)"))
    for df in (
        ordered.cut_points(aimed, KEYS, ["loan_id"], "loan_amount", "target"),
        allocate.drop_tail_until(aimed, KEYS, ["loan_id"], "loan_amount", "target"),
        allocate.apportion_exact(aimed, KEYS, "target", "loan_amount", "loan_id"),
    ):
        assert "rangepartitioning" not in plan(df)


def test_whole_rows_are_numbered_without_being_sorted_or_written(stored):
    shown = plan(allocate.assign_batches(stored["sub"], KEYS, ["loan_id"]))
    assert "rangepartitioning" not in shown
    # rows are read from the feed itself, beside the written numbers
    assert shown.count("surplus") and shown.count("SinglePartition") == 0


def test_partners_within_a_tolerance_compare_no_pairs(stored):
    flagged = tieouts.flag_filed(stored["gl"], stored["ext"])
    found = offset_partner_within(flagged, KEYS, "product", "5.00")
    text = plan(found)
    assert not any(word in text for word in NEVER)
    assert not re.search(r"SortMergeJoin .*, Inner, .*(abs|<)", text)


def test_feeds_are_made_on_first_use(spark):
    bound = orders_feeds(spark, "/root/testdata/sf0.001")
    assert bound.sub_ledger.columns and set(vars(bound)) == {"base", "sub_ledger"}
    assert bound.gl.columns and "accounts" in vars(bound)
