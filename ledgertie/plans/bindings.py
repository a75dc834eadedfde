"""The test tables as the three feeds, with planted breaks.

A *base* is a table of loans: id, account key and amount, and the small numbers
(``rk``, ``pn``, ``qn``, ``k``) from which the breaks are planted. Orders and line
items each give one. The feeds are then derived from the base by fixed rules, all
of them plain expressions, so that other SQL can restate them.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgertie.functions.labels import (
    REPLAY_SUFFIX,
    account_label,
    batch_label,
    period_end,
    quarter_label,
)
from ledgertie.functions.variance import total
from ledgertie.operators.trend import DETAIL_TIE_OUT, FILED_TIE_OUT
from ledgertie.sources.schemas import KEYS, MONEY
from ledgertie.sources.session import materialise

# Product types in alphabetical order, ranked from 1.
PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]

# Share of a planted account's loans that miss the feed or come twice: k % 10 < 3.
PLANTED_TENTHS = 3


def _code() -> Column:
    """What is planted on an account, by number from 0 to 22."""
    return (F.col("qn") * 7 + F.col("rk") * 5 + F.col("pn") * 3) % 23


def _mapped() -> Column:
    """Whether an entity and period has its first product filed under the second."""
    return (F.col("qn") * 5 + F.col("rk")) % 6 == 0


@dataclass(frozen=True)
class Feeds:
    """What is derived from a base of loans; each part is made when it is first asked for."""

    base: DataFrame

    @cached_property
    def accounts(self) -> DataFrame:
        """Account totals as a written table.

        Without it every use of ledger or extract would scan all loans again: their
        filters are on the account key, so they sink below the grouping and no two
        groupings are alike.
        """
        return materialise(_account_table(self.base), "accounts")

    @cached_property
    def gl(self) -> DataFrame:
        return _ledger(self.accounts)

    @cached_property
    def sub_ledger(self) -> DataFrame:
        return _detail(self.base)

    @cached_property
    def extract(self) -> DataFrame:
        return _filed(self.accounts)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _geography(spark: SparkSession, folder: str) -> DataFrame:
    """Region of each nation: a few dozen rows, which Spark broadcasts by their size.

    Bases join it last: joined to another table first, its size estimate multiplies
    and Spark would take the large table for the smaller side.
    """
    nation, region = _table(spark, folder, "nation"), _table(spark, folder, "region")
    named = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return named.select(
        "n_nationkey", F.col("r_name").alias("entity"), F.col("r_regionkey").alias("rk")
    )


def _quarter_number(day: Column) -> Column:
    return F.year(day) * 4 + F.quarter(day)


def _money(amount: str) -> Column:
    """A double of two decimals as money, through whole cents.

    A direct cast takes the way over the double's text, about ten times as long.
    """
    cents = F.rint(F.col(amount) * 100).cast("bigint").cast("decimal(15,0)")
    return (cents * F.lit(Decimal("0.01"))).cast(MONEY)


def _loan(loan_id: Column, k: str, product: str, pn: Column, day: str, amount: str) -> list[Column]:
    return [
        loan_id.alias("loan_id"),
        F.col(k).alias("k"),
        F.col("entity"),
        F.col("rk"),
        F.col(product).alias("product"),
        pn.alias("pn"),
        quarter_label(F.col(day)).alias("quarter"),
        _quarter_number(F.col(day)).alias("qn"),
        _money(amount).alias("loan_amount"),
    ]


def orders_base(spark: SparkSession, folder: str) -> DataFrame:
    """One loan per order: the customer's region, the order's priority."""
    geography = _geography(spark, folder)
    loan_id = F.concat(F.lit("L"), F.col("o_orderkey").cast("string"))
    rank = F.substring("o_orderpriority", 1, 1).cast("int")
    return (
        _table(spark, folder, "orders")
        .join(_table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(geography, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            *_loan(loan_id, "o_orderkey", "o_orderpriority", rank, "o_orderdate", "o_totalprice")
        )
    )


def lineitem_base(spark: SparkSession, folder: str) -> DataFrame:
    """One loan per order line: the supplier's region, the part's type."""
    geography = _geography(spark, folder)
    ids = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    rank = F.array_position(F.array(*map(F.lit, PART_TYPES)), F.col("p_type")).cast("int")
    return (
        _table(spark, folder, "lineitem")
        .join(_table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(_table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(geography, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            *_loan(
                F.concat_ws("-", *ids), "l_orderkey", "p_type", rank, "l_shipdate",
                "l_extendedprice",
            )
        )
    )


def _planted() -> Column:
    return F.col("k") % 10 < PLANTED_TENTHS


def _account_table(base: DataFrame) -> DataFrame:
    """Account totals; the quarter's label is made per account, not per loan."""
    year = F.expr("(qn - 1) div 4").cast("string")
    quarter = F.concat(year, F.lit("Q"), ((F.col("qn") - 1) % 4 + 1).cast("string"))
    return (
        base.groupBy("entity", "product", "rk", "pn", "qn")
        .agg(
            total(F.sum("loan_amount")).alias("bal"),
            total(F.sum(F.when(_planted(), F.col("loan_amount")))).alias("planted_amount"),
            F.count_if(_planted()).alias("planted_loans"),
        )
        .withColumn("quarter", quarter)
        .withColumn("c", _code())
        .withColumn("mapped", _mapped())
    )


def _ledger(accounts: DataFrame) -> DataFrame:
    return accounts.filter(F.col("c") != 6).select(
        *KEYS,
        total(F.when(F.col("c") == 7, F.lit(0)).otherwise(F.col("bal"))).alias("gl_balance"),
        account_label(F.col("product"), F.col("entity"), F.col("product")).alias("gl_account"),
        period_end(F.col("quarter")).alias("as_of_date"),
    )


def _detail(base: DataFrame) -> DataFrame:
    """All loans, some absent and some twice, from a single scan of the base."""
    copies = (
        F.when((_code() == 3) | ((_code() == 1) & _planted()), F.array().cast("array<string>"))
        .when((_code() == 2) & _planted(), F.array(F.lit(""), F.lit(REPLAY_SUFFIX)))
        .otherwise(F.array(F.lit("")))
    )
    return base.select(
        "loan_id",
        *KEYS,
        "loan_amount",
        "k",
        F.explode(copies).alias("copy"),
    ).select(
        "loan_id",
        *KEYS,
        "loan_amount",
        F.concat(batch_label(F.col("quarter"), F.col("k") % 20 + 1), "copy").alias(
            "load_batch_id"
        ),
    )


def _moved() -> Column:
    """Balance that a mapped entity and period moves out of its first product.

    The window holds the products of one entity and period, six at most.
    """
    siblings = Window.partitionBy("entity", "quarter")
    source = F.max(F.when(F.col("pn") == 1, F.col("bal"))).over(siblings)
    return F.coalesce(F.round(source * F.lit(3) / F.lit(100), 2), F.lit(0))


def _filed_balance() -> Column:
    shares = {8: "0.978", 10: "1.02", 11: "1.003"}
    moved = F.when(F.col("pn") == 1, -F.col("moved")).when(F.col("pn") == 2, F.col("moved"))
    mapped = F.col("bal") + F.coalesce(moved, F.lit(0))
    unmapped = F.col("bal")
    for code, share in shares.items():
        scaled = F.round(F.col("bal").cast("decimal(30,2)") * F.lit(share).cast("decimal(4,3)"), 2)
        unmapped = F.when(F.col("c") == code, scaled).otherwise(unmapped)
    return total(F.when(F.col("mapped"), mapped).otherwise(unmapped))


def _filed(accounts: DataFrame) -> DataFrame:
    return (
        accounts.withColumn("moved", _moved())
        .filter(F.col("mapped") | (F.col("c") != 9))
        .select(
            *KEYS,
            _filed_balance().alias("extract_balance"),
            F.concat(F.lit("H."), F.col("pn").cast("string")).alias("schedule_code"),
            F.date_add(period_end(F.col("quarter")), 8).alias("extract_run_date"),
        )
    )


def detail_key(bound: Feeds) -> DataFrame:
    """Accounts on which the detail feed was spoilt, by the rules above."""
    some = F.col("planted_loans") > 0
    cause = (
        F.when(F.col("c") == 3, "FEED_NOT_RECEIVED")
        .when((F.col("c") == 1) & some, "LATE_FEED")
        .when((F.col("c") == 2) & some, "DUPLICATE_LOAD")
    )
    amount = (
        F.when(F.col("c") == 3, -F.col("bal"))
        .when(F.col("c") == 1, -F.col("planted_amount"))
        .otherwise(F.col("planted_amount"))
    )
    return _key(bound.accounts, cause, amount, DETAIL_TIE_OUT)


def filed_key(bound: Feeds) -> DataFrame:
    """Accounts on which the extract was spoilt, by the rules above."""
    in_mapping = F.col("mapped") & F.col("pn").isin(1, 2) & (F.col("moved") != 0)
    single = (
        F.when(F.col("c") == 8, "TIMING_DIFFERENCE")
        .when(F.col("c") == 9, "MISSING_FROM_EXTRACT")
        .when(F.col("c") == 10, "UNEXPLAINED_OVERSTATEMENT")
    )
    cause = F.when(in_mapping, "MAPPING_ERROR").when(~F.col("mapped"), single)
    unfiled = ~F.col("mapped") & (F.col("c") == 9)
    amount = F.when(unfiled, -F.col("bal")).otherwise(_filed_balance() - F.col("bal"))
    return _key(bound.accounts.withColumn("moved", _moved()), cause, amount, FILED_TIE_OUT)


def _key(accounts: DataFrame, cause: Column, amount: Column, detected_by: str) -> DataFrame:
    return accounts.select(
        *KEYS,
        F.lit(detected_by).alias("detected_by"),
        cause.alias("expected_root_cause"),
        total(amount).alias("planted_variance"),
    ).filter(F.col("expected_root_cause").isNotNull())


# Scenarios for the what-if operators, one row per account or move.


def timing_scenarios(bound: Feeds) -> DataFrame:
    return bound.accounts.filter(F.col("c") == 8).select(
        *KEYS, F.lit("0.022").cast("decimal(12,8)").alias("fraction"), _break_no(F.col("pn"))
    )


def mapping_moves(bound: Feeds) -> DataFrame:
    """Moves out of product 1 into product 2 of the mapped entities and periods."""
    sides = (
        bound.accounts.filter(F.col("mapped"))
        .groupBy("entity", "quarter", "rk", "qn")
        .agg(
            F.max(F.when(F.col("pn") == 1, F.col("product"))).alias("source"),
            F.max(F.when(F.col("pn") == 2, F.col("product"))).alias("target"),
        )
    )
    return sides.filter(F.col("source").isNotNull() & F.col("target").isNotNull()).select(
        "entity",
        "quarter",
        "source",
        "target",
        F.lit("0.026").cast("decimal(12,8)").alias("fraction"),
        _break_no(F.lit(0)),
    )


def loan_targets(bound: Feeds, code: int | None = None) -> DataFrame:
    """Per account the amount of loans to drop or replay: ``c`` percent of its balance.

    With ``code``, only the accounts of that code, and 3 percent.
    """
    chosen = bound.accounts if code is None else bound.accounts.filter(F.col("c") == code)
    share = F.col("c") if code is None else F.lit(3)
    return chosen.select(
        *KEYS, total(F.round(F.col("bal") * share / 100, 2)).alias("target"), _break_no(F.col("pn"))
    )


def _break_no(pn: Column) -> Column:
    return (F.col("qn") * 100 + F.col("rk") * 10 + pn).alias("break_no")
