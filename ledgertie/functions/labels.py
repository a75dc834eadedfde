"""Identifiers, period labels and display formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

REPLAY_SUFFIX = "-REPLAY"


def money_label(amount: Column) -> Column:
    """Compact currency: ``$1.20M``, in B, M or K from 1e9, 1e6 and 1e3 upwards."""
    value = amount.cast("double")
    size = F.abs(value)

    def scaled(divisor: float, suffix: str) -> Column:
        return F.concat(F.lit("$"), F.format_number(value / divisor, 2), F.lit(suffix))

    return (
        F.when(size >= 1e9, scaled(1e9, "B"))
        .when(size >= 1e6, scaled(1e6, "M"))
        .when(size >= 1e3, scaled(1e3, "K"))
        .otherwise(scaled(1.0, ""))
    )


def cents(amount: Column) -> Column:
    """A decimal amount as whole cents."""
    return (amount.cast("decimal(38,2)") * 100).cast("decimal(38,0)")


def from_cents(amount: Column) -> Column:
    return (amount.cast("decimal(38,0)") / 100).cast("decimal(38,2)")


def fraction_of(amount: Column, fraction: Column) -> Column:
    """``amount * fraction`` to the cent, halves to even."""
    share = amount.cast("decimal(24,2)") * fraction.cast("decimal(12,8)")
    return F.bround(share, 2).cast("decimal(38,2)")


def quarter_label(day: Column) -> Column:
    """``2025Q1`` for any day of that quarter."""
    return F.concat(F.year(day).cast("string"), F.lit("Q"), F.quarter(day).cast("string"))


def period_end(label: Column) -> Column:
    """Last day of a ``2025Q1`` label."""
    month = F.substring(label, 6, 1).cast("int") * 3
    return F.last_day(F.make_date(F.substring(label, 1, 4).cast("int"), month, F.lit(1)))


def zero_padded(number: Column, width: int) -> Column:
    """Digits with leading zeros up to ``width``; a longer number stays whole."""
    digits = number.cast("string")
    return F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0"))


def initials(name: Column) -> Column:
    """First letters of a name's words."""
    return F.array_join(F.transform(F.split(name, " +"), lambda w: F.substring(w, 1, 1)), "")


def loan_label(entity: Column, product: Column, period: Column, number: Column) -> Column:
    """``URB-MOR-2025Q1-0007``: initials, product prefix, period, number in the account."""
    return F.concat_ws(
        "-",
        initials(entity),
        F.upper(F.substring(product, 1, 3)),
        period,
        zero_padded(number, 4),
    )


def batch_label(period: Column, number: Column) -> Column:
    """``B2025Q1-03``."""
    return F.concat(F.lit("B"), period, F.lit("-"), zero_padded(number, 2))


def account_label(schedule: Column, entity: Column, product: Column) -> Column:
    """``GL-H1-7069``: schedule without dots and a stable number from entity and product."""
    number = F.crc32(F.concat_ws("|", entity, product).cast("binary")) % 9000 + 1000
    return F.concat(
        F.lit("GL-"), F.replace(schedule, F.lit("."), F.lit("")), F.lit("-"), number.cast("string")
    )


def break_label(number: Column) -> Column:
    """``BRK-007``."""
    return F.concat(F.lit("BRK-"), zero_padded(number, 3))
