"""Adjusting a feed by scenario, and the register of the breaks that must follow."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgertie.functions.labels import break_label, fraction_of
from ledgertie.functions.variance import total, variance_pct
from ledgertie.operators.ordered import cut_points
from ledgertie.operators.rollups import rollup_balance
from ledgertie.operators.trend import DETAIL_TIE_OUT, FILED_TIE_OUT
from ledgertie.sources.schemas import KEYS, PERIOD, PRODUCT, REGISTER

# Kinds of break, the tie-out that finds each, its direction and its
# root cause. The target side of a mapping error is over.
FAILURE_MODES = {
    "late_feed": (DETAIL_TIE_OUT, "under", "LATE_FEED"),
    "duplicate_load": (DETAIL_TIE_OUT, "over", "DUPLICATE_LOAD"),
    "timing_difference": (FILED_TIE_OUT, "under", "TIMING_DIFFERENCE"),
    "mapping_error": (FILED_TIE_OUT, "under", "MAPPING_ERROR"),
}

# Wording of the register's notes.
LATE_FEED_NOTE = "%d loans missed the load cutoff and never reached the sub-ledger"
DUPLICATE_LOAD_NOTE = "batch replayed: %d loans double-counted"
TIMING_NOTE = "GL adjustment posted after the %s extract run; no offsetting entry elsewhere"
MAPPING_SOURCE_NOTE = "loans mis-tagged out of %s into %s (source side of the pair)"
MAPPING_TARGET_NOTE = "loans mis-tagged into %s out of %s (target side of the pair)"


def apply_deltas(
    df: DataFrame, deltas: DataFrame, keys: list[str], amt: str, delta: str = "delta"
) -> DataFrame:
    """Balances plus the sum of their deltas; an account without one keeps its balance.

    An account of several rows has its delta on one of them, the least by all columns,
    and of equal rows on one: rows are counted, and the least comes once more often with
    the delta than without. A delta for an account without a row opens that account, with
    NULL in the other columns, so what was taken from one account always arrives at another.
    """
    summed = deltas.groupBy(*keys).agg(total(F.sum(delta)).alias("_delta"))
    others = [name for name in df.columns if name not in keys]
    alike = df.groupBy(*df.columns).agg(F.count("*").alias("_rows"))
    least = alike.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_least"))
    moved = least.join(summed, keys, "full").select(*keys, "_least", "_delta")
    placed = alike.join(moved, keys, "full")
    here = F.col("_delta").isNotNull() & (F.struct(*others).eqNullSafe(F.col("_least")))
    opened = F.col("_rows").isNull()
    rest = F.when(opened, 0).otherwise(F.col("_rows") - here.cast("int"))
    copies = F.array_repeat(F.lit(False), rest.cast("int"))
    copies = F.when(here | opened, F.array_append(copies, F.lit(True))).otherwise(copies)
    held, change = total(F.col(amt)), F.col("_delta")
    after = F.when(F.col("_moved"), total(F.coalesce(held + change, held, change))).otherwise(held)
    return (
        placed.withColumn("_moved", F.explode(copies))
        .withColumn(amt, total(after))
        .select(*keys, *others)
        .select(*df.columns)
    )


def unmatched_scenarios(
    df: DataFrame, scenarios: DataFrame, keys: list[str] = KEYS
) -> DataFrame:
    """Scenarios whose account has no balance to take from; they change nothing."""
    return scenarios.join(df.select(*keys), keys, "left_anti")


def timing_deltas(
    df: DataFrame, scenarios: DataFrame, keys: list[str] = KEYS, amt: str = "gl_balance"
) -> DataFrame:
    """The amounts by which one-sided adjustments reduce accounts (keys and ``fraction``).

    The fraction is of the account's whole balance, in however many rows it lies.
    """
    return scenarios.join(rollup_balance(df, keys, amt), keys).withColumn(
        "delta", -fraction_of(F.col(amt), F.col("fraction"))
    )


def adjust_balance(
    df: DataFrame, scenarios: DataFrame, keys: list[str] = KEYS, amt: str = "gl_balance"
) -> DataFrame:
    """Balances after one-sided reductions by a fraction of the balance."""
    return apply_deltas(df, timing_deltas(df, scenarios, keys, amt), keys, amt)


def mapping_deltas(
    df: DataFrame,
    moves: DataFrame,
    keys: list[str] = KEYS,
    amt: str = "gl_balance",
    product: str = PRODUCT,
) -> DataFrame:
    """Two rows per move, out of ``source`` and into ``target``, that net to zero.

    ``moves`` has the other keys, the two products and the fraction of the source's
    balance that moves. Each row also carries its own account's balance.
    """
    balances = rollup_balance(df, keys, amt)
    others = [key for key in keys if key != product]
    moved = moves.join(
        balances.withColumnRenamed(product, "source"), [*others, "source"]
    ).withColumn("moved", fraction_of(F.col(amt), F.col("fraction")))
    sides = F.inline(
        F.array(
            F.struct(F.col("source").alias(product), (-F.col("moved")).alias("delta")),
            F.struct(F.col("target").alias(product), F.col("moved").alias("delta")),
        )
    )
    return moved.drop(amt).select("*", sides).drop("moved").join(balances, keys, "left")


def reclass_balance(
    df: DataFrame, moves: DataFrame, keys: list[str] = KEYS, amt: str = "gl_balance"
) -> DataFrame:
    """Balances after amounts were moved between two products of an entity and period."""
    return apply_deltas(df, mapping_deltas(df, moves, keys, amt), keys, amt)


def filed_from_gl(
    gl: DataFrame,
    deltas: DataFrame,
    schedules: Column,
    run_dates: Column,
    keys: list[str] = KEYS,
    gl_amt: str = "gl_balance",
) -> DataFrame:
    """Extract rows: ledger balance plus deltas, with schedule code and run date."""
    return apply_deltas(gl.select(*keys, gl_amt), deltas, keys, gl_amt).select(
        *keys,
        F.col(gl_amt).alias("extract_balance"),
        schedules.alias("schedule_code"),
        run_dates.alias("extract_run_date"),
    )


def _register(
    planted: DataFrame,
    kind: str,
    amount: Column,
    base: Column,
    notes: Column,
    keys: list[str],
    over: Column | None = None,
) -> DataFrame:
    detected_by, direction, cause = FAILURE_MODES[kind]
    if over is None:
        over = F.lit(False)
    values = {
        "break_id": break_label(F.col("break_no")),
        **{key: F.col(key) for key in keys},
        "break_type": F.lit(kind),
        "detected_by": F.lit(detected_by),
        "expected_direction": F.when(over, "over").otherwise(direction),
        "expected_root_cause": F.lit(cause),
        "planted_variance": amount,
        "planted_variance_pct": variance_pct(amount, base),
        "notes": notes,
    }
    return planted.select(*(values[field.name].alias(field.name) for field in REGISTER))


def moved_loans(
    marked: DataFrame, keys: list[str] = KEYS, amt: str = "loan_amount", mark: str = "taken"
) -> DataFrame:
    """Amount and number of the loans taken per account, with the account's break number."""
    return (
        marked.filter(F.col(mark))
        .groupBy(*keys, "break_no")
        .agg(F.sum(amt).alias("moved_amount"), F.count("*").alias("moved_loans"))
    )


def moved_until(
    detail: DataFrame,
    scenarios: DataFrame,
    keys: list[str] = KEYS,
    order: str = "position",
    amt: str = "loan_amount",
) -> DataFrame:
    """The same for all scenarios at once, from the cuts alone: no loan is marked.

    ``scenarios`` has a row per account: ``break_type``, ``break_no`` and ``target``. Late
    feeds take loans from the end, so their order (a number) counts backwards.
    """
    aimed = detail.join(scenarios, keys)
    late = F.col("break_type") == "late_feed"
    placed = aimed.withColumn("_place", F.when(late, -F.col(order)).otherwise(F.col(order)))
    cuts = cut_points(placed, keys, ["_place"], amt, "target").drop("_cut")
    return cuts.join(scenarios.select(*keys, "break_type", "break_no"), keys)


def detail_register(
    kind: str, moved: DataFrame, gl: DataFrame, keys: list[str] = KEYS, gl_amt: str = "gl_balance"
) -> DataFrame:
    """Expected breaks of late feeds or duplicate loads.

    ``moved`` has one row per scenario account: ``break_no``, and the amount and
    number of the loans that were dropped or doubled (``moved_amount``,
    ``moved_loans``) - what happened, not what was aimed at.
    """
    late = kind == "late_feed"
    amount = total(F.col("moved_amount"))
    amount = -amount if late else amount
    notes = F.format_string(LATE_FEED_NOTE if late else DUPLICATE_LOAD_NOTE, "moved_loans")
    planted = moved.join(rollup_balance(gl, keys, gl_amt), keys)
    return _register(planted, kind, amount, F.col(gl_amt), notes, keys)


def timing_register(
    scenarios: DataFrame,
    gl: DataFrame,
    run_dates: Column,
    keys: list[str] = KEYS,
    gl_amt: str = "gl_balance",
) -> DataFrame:
    """Expected breaks of late ledger adjustments."""
    notes = F.format_string(TIMING_NOTE, run_dates.cast("string"))
    planted = timing_deltas(gl, scenarios, keys, gl_amt)
    return _register(
        planted, "timing_difference", total(F.col("delta")), F.col(gl_amt), notes, keys
    )


def mapping_register(
    moves: DataFrame,
    gl: DataFrame,
    keys: list[str] = KEYS,
    gl_amt: str = "gl_balance",
    product: str = PRODUCT,
) -> DataFrame:
    """Expected breaks of mapping errors: both sides of each move under one break id."""
    into = F.col(product) == F.col("target")
    notes = F.when(
        ~into,
        F.format_string(MAPPING_SOURCE_NOTE, "source", "target"),
    ).otherwise(F.format_string(MAPPING_TARGET_NOTE, "target", "source"))
    planted = mapping_deltas(gl, moves, keys, gl_amt, product)
    return _register(
        planted, "mapping_error", total(F.col("delta")), F.col(gl_amt), notes, keys, over=into
    )


def assemble_register(*parts: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """The whole register, by period and account."""
    ordered = sorted(keys, key=lambda key: key != PERIOD)
    return reduce(DataFrame.unionByName, parts).orderBy(*ordered)


def universe(df: DataFrame, dims: list[str] = KEYS) -> DataFrame:
    """Every account the reporting dimensions allow: each value of one with each of the others.

    The product is what this operator is for, so it is an open cross join. Its sides are
    the distinct values of one dimension each, never rows of the feed.
    """
    return reduce(DataFrame.crossJoin, (df.select(dim).distinct() for dim in dims))
