"""Exact roll-ups kept current: a load touches its own buckets only.

The state holds a row per account and loan id, with the loan's amount and number of rows,
which is what an exact count of distinct ids needs. It lies in buckets by account, each cut
again by loan id, so that one large account spreads. A load is folded to the same grain,
joined with the buckets it falls into, and those are written anew; one pointer brings all
of them into force at once. Balances of the accounts that changed follow from their buckets.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgertie.functions.variance import total
from ledgertie.sources import generations
from ledgertie.sources.session import materialise

BUCKETS = (64, 4)  # by account, and by loan id in each; the same in every call over one state


def _bucket(keys: list[str], id_col: str, buckets: tuple[int, int]) -> Column:
    account = F.pmod(F.xxhash64(*keys), F.lit(buckets[0]))
    part = F.pmod(F.xxhash64(F.col(id_col), F.lit("part")), F.lit(buckets[1]))
    return (account * buckets[1] + part).cast("int")


def _number(part: str) -> int:
    return int(part.rpartition("=")[2])


def _read(spark: SparkSession, state: str, parts: list[str], schema: str) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(f"{state}/{part}" for part in parts))


def _schema(df: DataFrame, keys: list[str], id_col: str) -> str:
    kinds = {field.name: field.dataType.simpleString() for field in df.schema}
    held = ", ".join(f"`{name}` {kinds[name]}" for name in [*keys, id_col])
    return f"{held}, _amount decimal(38,2), _rows bigint"


def _rolled(rows: DataFrame, keys: list[str], id_col: str, balance: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        total(F.sum("_amount")).alias(balance),
        F.sum("_rows").alias("loan_count"),
        F.count(id_col).alias("distinct_loan_count"),
    )


def fold_load(
    load: DataFrame,
    state: str,
    keys: list[str],
    amt: str,
    id_col: str,
    balance: str = "sub_ledger_balance",
    buckets: tuple[int, int] = BUCKETS,
) -> DataFrame:
    """Fold ``load`` into the state and return the new roll-up of the accounts that changed.

    Columns are those of ``rollup_to_grain``. If the write stops on the way, the state stays
    as it was.
    """
    spark, by = load.sparkSession, [*keys, id_col]
    schema = _schema(load, keys, id_col)
    delta = load.groupBy(*by).agg(
        total(F.sum(amt)).alias("_amount"), F.count("*").alias("_rows")
    )
    delta = materialise(delta.withColumn("_bucket", _bucket(keys, id_col, buckets)), "load")
    touched = {row[0] for row in delta.select("_bucket").distinct().collect()}  # few by design
    seen = generations.current(spark, state)
    parts = list(seen.parts) if seen else []
    old = _read(spark, state, [part for part in parts if _number(part) in touched], schema)
    both = old.unionByName(delta.select(*old.columns)).groupBy(*by)
    new = both.agg(total(F.sum("_amount")).alias("_amount"), F.sum("_rows").alias("_rows"))
    folder = f"load-{uuid.uuid4().hex}"
    written = new.withColumn("_bucket", _bucket(keys, id_col, buckets))
    written.write.mode("error").partitionBy("_bucket").parquet(f"{state}/{folder}")
    in_force = [part for part in parts if _number(part) not in touched]
    in_force += [f"{folder}/_bucket={bucket}" for bucket in sorted(touched)]
    generations.commit(spark, state, seen, tuple(in_force))
    changed = materialise(delta.select(*keys).distinct(), "changed")
    accounts = {bucket // buckets[1] for bucket in touched}
    near = [part for part in in_force if _number(part) // buckets[1] in accounts]
    rows = _read(spark, state, near, schema)
    same = [rows[key].eqNullSafe(changed[key]) for key in keys]
    return _rolled(rows.join(changed, same, "left_semi"), keys, id_col, balance)


def rollup_of(
    spark: SparkSession, state: str, like: DataFrame, keys: list[str], id_col: str,
    balance: str = "sub_ledger_balance",
) -> DataFrame:
    """The roll-up of all loads in force; ``like`` has the types of keys and ids."""
    held = generations.current(spark, state)
    rows = _read(spark, state, list(held.parts) if held else [], _schema(like, keys, id_col))
    return _rolled(rows, keys, id_col, balance)
