"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local threads. Every query runs once
to warm up and then BENCH_REPEATS times; the median counts. Results are written to
Spark's no-op sink, so every row and column is computed and nothing is collected.
``loaded_*`` times the operators over feeds stored as tables; all others start from
the raw tables, so they include deriving the feeds from them.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable
from functools import partial
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ledgertie.operators import report, tieouts, trend  # noqa: E402
from ledgertie.plans.queries import lineitem_feeds, registry  # noqa: E402
from ledgertie.sources.session import scratch_path  # noqa: E402

HEADLINE = [
    "tieout_detail_lineitem",
    "tieout_filed_lineitem",
    "break_trend_lineitem",
    "kpi_summary_lineitem",
    "grade_verdicts_lineitem",
    "multiset_diff_lineitem",
    "duplicate_ids",
    "tieout_detail",
    "tieout_filed",
    "break_trend",
    "apportion",
    "assign_batches",
    "drop_tail",
    "replay_head",
    "expected_breaks",
    "content_digest",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ledgertie-bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(build: Callable[[], DataFrame]) -> float:
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def loaded_feeds(spark: SparkSession, folder: str) -> dict[str, Callable[[], DataFrame]]:
    """The operators alone, over line-item feeds that have been loaded into tables."""
    bound = lineitem_feeds(spark, folder)
    path = scratch_path(spark, "bench-feeds")
    for name in ("gl", "sub_ledger", "extract"):
        getattr(bound, name).write.parquet(f"{path}/{name}")
    gl, loans, filed = (spark.read.parquet(f"{path}/{n}") for n in ("gl", "sub_ledger", "extract"))

    def flags() -> tuple[DataFrame, DataFrame]:
        return tieouts.flag_detail(gl, loans, id_col=None), tieouts.flag_filed(gl, filed)

    return {
        "loaded_tieout_detail": lambda: tieouts.reconcile_detail(gl, loans),
        "loaded_tieout_filed": lambda: tieouts.reconcile_filed(gl, filed),
        "loaded_break_trend": lambda: trend.break_trend(gl, trend.stack_breaks(*flags())),
        "loaded_kpi_summary": lambda: report.kpis(*flags()),
    }


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = session(cpus)
    seconds = {}
    builds = {name: partial(registry()[name], spark, folder) for name in names}
    if not sys.argv[1:]:
        builds = {**loaded_feeds(spark, folder), **builds}
    for name, build in builds.items():
        timed(build)
        seconds[name] = round(statistics.median(timed(build) for _ in range(repeats)), 3)
    print(
        json.dumps(
            {
                "metric": "median seconds of the headline queries, summed",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
                "cpus": cpus,
                "repeats": repeats,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
