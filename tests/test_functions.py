from __future__ import annotations

import datetime
import zlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from frames import dollars
from ledgertie.functions import causes, labels
from ledgertie.functions.variance import (
    exceeds,
    presence,
    status_detail,
    status_filed,
    total,
    variance,
    variance_pct,
)


def one(spark, schema, values, column):
    return spark.createDataFrame([values], schema).select(column.alias("x")).first()["x"]


AMOUNTS = "other decimal(18,2), base decimal(18,2)"


@pytest.mark.parametrize(
    ("other", "base", "diff", "pct"),
    [
        ("1005", "1000", "5", 0.5),
        (None, "100", "-100", -100.0),
        ("10", None, "10", None),
        ("10", "0", "10", None),
        (None, None, "0", None),
        ("2", "3", "-1", -33.3333),
    ],
)
def test_variance_and_percentage(spark, other, base, diff, pct):
    values = (dollars(other), dollars(base))
    found = variance(F.col("other"), F.col("base"))
    assert one(spark, AMOUNTS, values, found) == Decimal(diff)
    assert one(spark, AMOUNTS, values, variance_pct(found, total(F.col("base")))) == pct


@pytest.mark.parametrize(
    ("diff", "base", "threshold", "status"),
    [
        ("5.00", "1000", 0.5, "PASS"),
        ("5.01", "1000", 0.5, "BREAK"),
        ("-5.01", "1000", 0.5, "BREAK"),
        ("0", "0", 0.5, "PASS"),
        ("0.01", "0", 0.5, "BREAK"),
        ("5.01", "-1000", 0.5, "BREAK"),
        ("1.25", "1000", 0.125, "PASS"),
        ("1.26", "1000", 0.125, "BREAK"),
        ("0.01", "1000", 0, "BREAK"),
    ],
)
def test_threshold_is_strict_and_exact(spark, diff, base, threshold, status):
    values = (dollars(diff), dollars(base))
    found = status_detail(total(F.col("other")), total(F.col("base")), threshold)
    assert one(spark, AMOUNTS, values, found) == status


def test_threshold_needs_at_most_four_decimals(spark):
    with pytest.raises(ValueError):
        exceeds(F.col("a"), F.col("b"), 0.00001)


def test_one_sided_accounts_break_at_any_amount(spark):
    zero = total(F.lit(0))
    for missing in ((1, 0), (0, 1)):
        found = status_filed(zero, zero, F.lit(missing[0]), F.lit(missing[1]))
        assert one(spark, "i int", (1,), found) == "BREAK"
    assert one(spark, "i int", (1,), status_filed(zero, zero, F.lit(0), F.lit(0))) == "PASS"
    assert one(spark, AMOUNTS, (None, dollars(0)), presence(F.col("other"))) == 1
    assert one(spark, AMOUNTS, (None, dollars(0)), presence(F.col("base"))) == 0


@pytest.mark.parametrize(
    ("status", "loans", "diff", "cause"),
    [
        ("PASS", 0, "-1", "NONE"),
        ("BREAK", 0, "-1", "FEED_NOT_RECEIVED"),
        ("BREAK", 3, "-1", "LATE_FEED"),
        ("BREAK", 3, "1", "DUPLICATE_LOAD"),
        ("BREAK", 3, "0", "UNCLASSIFIED"),
    ],
)
def test_detail_causes(spark, status, loans, diff, cause):
    found = causes.cause_detail(F.col("s"), F.col("n"), F.col("v"))
    schema = "s string, n int, v decimal(18,2)"
    assert one(spark, schema, (status, loans, dollars(diff)), found) == cause
    text = causes.action(found, causes.DETAIL_ACTIONS)
    assert one(spark, schema, (status, loans, dollars(diff)), text) == causes.DETAIL_ACTIONS[cause]


@pytest.mark.parametrize(
    ("status", "no_gl", "no_extract", "partner", "diff", "cause"),
    [
        ("PASS", 0, 0, "B", "-1", "NONE"),
        ("BREAK", 0, 1, "B", "-1", "MISSING_FROM_EXTRACT"),
        ("BREAK", 1, 0, "B", "1", "NOT_IN_GL"),
        ("BREAK", 0, 0, "B", "-1", "MAPPING_ERROR"),
        ("BREAK", 0, 0, None, "-1", "TIMING_DIFFERENCE"),
        ("BREAK", 0, 0, None, "1", "UNEXPLAINED_OVERSTATEMENT"),
    ],
)
def test_filed_causes(spark, status, no_gl, no_extract, partner, diff, cause):
    found = causes.cause_filed(*(F.col(name) for name in "sglpv"))
    schema = "s string, g int, l int, p string, v decimal(18,2)"
    values = (status, no_gl, no_extract, partner, dollars(diff))
    assert one(spark, schema, values, found) == cause
    assert one(spark, schema, values, causes.action(found, causes.FILED_ACTIONS)) == (
        causes.FILED_ACTIONS[cause]
    )


@pytest.mark.parametrize(
    ("amount", "label"),
    [
        (0.0, "$0.00"),
        (999.999, "$1,000.00"),
        (1000.0, "$1.00K"),
        (-1234.5, "$-1.23K"),
        (1.2e6, "$1.20M"),
        (999_999_999.0, "$1,000.00M"),
        (2.5e9, "$2.50B"),
        (1.5e13, "$15,000.00B"),
    ],
)
def test_money_labels(spark, amount, label):
    assert one(spark, "a double", (amount,), labels.money_label(F.col("a"))) == label


def test_account_label_uses_crc32(spark):
    column = labels.account_label(F.col("s"), F.col("e"), F.col("p"))
    for entity, product in (("US Retail Bank", "Mortgage"), ("Ost & West", "Kredit")):
        number = zlib.crc32(f"{entity}|{product}".encode()) % 9000 + 1000
        found = one(spark, "s string, e string, p string", ("H.1", entity, product), column)
        assert found == f"GL-H1-{number}"


def test_identifiers(spark):
    values = ("US Small Bank", "heloc", "2025Q1", 7)
    schema = "e string, p string, q string, i bigint"
    loan = labels.loan_label(F.col("e"), F.col("p"), F.col("q"), F.col("i"))
    assert one(spark, schema, values, loan) == "USB-HEL-2025Q1-0007"
    assert one(spark, schema, values, labels.batch_label(F.col("q"), F.col("i"))) == "B2025Q1-07"
    assert one(spark, schema, values, labels.break_label(F.col("i"))) == "BRK-007"
    assert one(spark, "i int", (12345,), labels.break_label(F.col("i"))) == "BRK-12345"
    assert one(spark, schema, values, labels.period_end(F.col("q"))) == datetime.date(2025, 3, 31)
    day = datetime.date(2024, 12, 31)
    assert one(spark, "d date", (day,), labels.quarter_label(F.col("d"))) == "2024Q4"


def test_fractions_round_halves_to_even_cents(spark):
    schema = "a decimal(18,2), f decimal(12,8)"
    column = labels.fraction_of(F.col("a"), F.col("f"))
    for amount, fraction, part in (("0.05", "0.5", "0.02"), ("0.15", "0.5", "0.08")):
        assert one(spark, schema, (Decimal(amount), Decimal(fraction)), column) == Decimal(part)


def test_cents_there_and_back(spark):
    cents = labels.cents(F.col("a"))
    assert one(spark, "a decimal(18,2)", (Decimal("12.34"),), cents) == 1234
    back = labels.from_cents(F.lit(1234))
    assert one(spark, "i int", (1,), back) == Decimal("12.34")
