"""Small feeds written out by hand."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

KEY = "entity string, product string, quarter string"


def dollars(value) -> Decimal | None:
    return None if value is None else Decimal(str(value)).quantize(Decimal("0.01"))


def ledger(spark: SparkSession, *rows) -> DataFrame:
    """Rows of (entity, product, quarter, balance)."""
    data = [(*row[:3], dollars(row[3])) for row in rows]
    return spark.createDataFrame(data, f"{KEY}, gl_balance decimal(18,2)")


def extract(spark: SparkSession, *rows) -> DataFrame:
    data = [(*row[:3], dollars(row[3])) for row in rows]
    return spark.createDataFrame(data, f"{KEY}, extract_balance decimal(18,2)")


def detail(spark: SparkSession, *rows) -> DataFrame:
    """Rows of (loan_id, entity, product, quarter, amount)."""
    data = [(*row[:4], dollars(row[4])) for row in rows]
    return spark.createDataFrame(data, f"loan_id string, {KEY}, loan_amount decimal(18,2)")


def by_product(df: DataFrame) -> dict:
    return {row["product"]: row for row in df.collect()}
