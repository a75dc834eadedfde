"""Named queries: every operator over the whole of the bound test tables."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgertie.functions.labels import (
    account_label,
    batch_label,
    loan_label,
    money_label,
    period_end,
)
from ledgertie.functions.variance import total
from ledgertie.operators import (
    allocate,
    kept,
    offsets,
    quality,
    report,
    rollups,
    tieouts,
    trend,
    whatif,
)
from ledgertie.operators.digests import tree_diff
from ledgertie.operators.tolerance import offset_partner_within
from ledgertie.plans import bindings
from ledgertie.plans.bindings import Feeds
from ledgertie.sources.feeds import (
    append,
    export,
    load_feeds,
    profile,
    publish_checked,
    read_table,
    refresh,
    sample_rows,
)
from ledgertie.sources.fetching import fetched
from ledgertie.sources.generations import append_batches, read_current
from ledgertie.sources.schemas import FEEDS, KEYS
from ledgertie.sources.session import materialise, scratch_path

Query = Callable[[SparkSession, str], DataFrame]
SCOPE = (["1996Q1", "1997Q2", "1998Q3"], ["ASIA", "EUROPE"])  # what a report is filtered to


def orders_feeds(spark: SparkSession, folder: str) -> Feeds:
    return Feeds(bindings.orders_base(spark, folder))


def lineitem_feeds(spark: SparkSession, folder: str) -> Feeds:
    return Feeds(bindings.lineitem_base(spark, folder))


def _detail(f: Feeds) -> DataFrame:
    return tieouts.reconcile_detail(f.gl, f.sub_ledger)


def _filed(f: Feeds, **forms) -> DataFrame:
    return tieouts.reconcile_filed(f.gl, f.extract, **forms)


def _in_two(df: DataFrame, amt: str, entity: str) -> DataFrame:
    """``df`` with every balance of one entity in two rows: a hundred, and the rest."""
    hundred, whole = F.lit(Decimal("100.00")), F.col(amt)
    parts = F.when(
        F.col("entity") == entity, F.array(total(whole - hundred), total(hundred))
    ).otherwise(F.array(total(whole)))
    return df.withColumn(amt, F.explode(parts))


def _detail_split(f: Feeds) -> DataFrame:
    """Two ledger rows an account in ASIA: a line for each."""
    return tieouts.reconcile_detail(_in_two(f.gl, "gl_balance", "ASIA"), f.sub_ledger)


def _filed_split(f: Feeds) -> DataFrame:
    """Two ledger rows an account in ASIA, two extract rows in EUROPE: folded."""
    return tieouts.reconcile_filed(
        _in_two(f.gl, "gl_balance", "ASIA"), _in_two(f.extract, "extract_balance", "EUROPE")
    )


def _flags(f: Feeds) -> tuple[DataFrame, DataFrame]:
    """Both tie-outs up to the status, on balances alone."""
    detail = tieouts.flag_detail(f.gl, f.sub_ledger, id_col=None)
    return detail, tieouts.flag_filed(f.gl, f.extract)


def _written_flags(f: Feeds) -> tuple[DataFrame, DataFrame]:
    """The flags as written rows, one per account, for queries that read them twice."""
    detail, filed = _flags(f)
    return materialise(detail), materialise(filed)


def _breaks(f: Feeds) -> DataFrame:
    return trend.stack_breaks(*_flags(f))


def _trend(f: Feeds) -> DataFrame:
    return trend.break_trend(f.gl, _breaks(f))


def _both(detail: DataFrame, filed: DataFrame) -> DataFrame:
    """Two results under each other, told apart by the tie-out's name."""
    tagged = F.lit(trend.DETAIL_TIE_OUT), F.lit(trend.FILED_TIE_OUT)
    return detail.withColumn("reconciliation", tagged[0]).unionByName(
        filed.withColumn("reconciliation", tagged[1])
    )


def _keys(f: Feeds) -> DataFrame:
    return bindings.detail_key(f).unionByName(bindings.filed_key(f))


def _presence(f: Feeds) -> DataFrame:
    return (
        tieouts.flag_filed(f.gl, f.extract)
        .groupBy("missing_from_gl", "missing_from_extract", "status")
        .agg(F.count("*").alias("accounts"))
    )


def _filtered(f: Feeds) -> DataFrame:
    return report.breaks_only(report.scope(_detail(f), *SCOPE))


def _cause_counts(f: Feeds) -> DataFrame:
    return _both(report.cause_counts(_detail(f)), report.cause_counts(_filed(f)))


def _kpi_labels(f: Feeds) -> DataFrame:
    return _breaks(f).select(
        *KEYS, "reconciliation", money_label(F.col("break_amount")).alias("label")
    )


def _scaled_labels(f: Feeds) -> DataFrame:
    """Labels of signed period totals: sizes from hundreds to billions."""
    signed = tieouts.flag_filed(f.gl, f.extract).groupBy("quarter").agg(
        F.sum("variance").alias("net"), F.sum("gl_balance").alias("ledger")
    )
    amounts = {"net": F.col("net"), "ledger": F.col("ledger"), "tenth": F.col("ledger") / 10}
    return signed.select(
        "quarter", *(money_label(amount).alias(f"{name}_label") for name, amount in amounts.items())
    )


def _duplicate_ids(spark: SparkSession, folder: str) -> DataFrame:
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select(
        "l_returnflag",
        "l_linestatus",
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_id"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
    )
    rolled = rollups.rollup_to_grain(
        lines, ["l_returnflag", "l_linestatus"], "amount", "line_id", "balance"
    )
    duplicates = rollups.duplicate_ids(F.col("loan_count"), F.col("distinct_loan_count"))
    return rolled.withColumn("duplicate_ids", duplicates)


def _apportion(f: Feeds) -> DataFrame:
    accounts = f.accounts.select(*KEYS, F.col("bal").alias("target"))
    loans = allocate.with_target(f.base, accounts, KEYS).withColumn("weight", F.col("k") % 97 + 1)
    parts = allocate.apportion_exact(loans, KEYS, "target", "weight", "loan_id")
    return parts.select("loan_id", *KEYS, "part")


def _apportion_signed(f: Feeds) -> DataFrame:
    """Totals of either sign over fractional weights, which are all zero on code 5."""
    signed = total(F.col("bal") * F.when(F.col("pn") % 2 == 1, -1).otherwise(1))
    accounts = f.accounts.select(*KEYS, signed.alias("target"), "c")
    thousandths = F.when(F.col("c") == 5, 0).otherwise(F.col("k") % 97 + 1)
    weight = (thousandths * F.lit(Decimal("0.001"))).cast("decimal(10,3)")
    loans = allocate.with_target(f.base, accounts, KEYS).withColumn("weight", weight)
    parts = allocate.apportion_exact(loans, KEYS, "target", "weight", "loan_id")
    return parts.select("loan_id", *KEYS, "part")


def _batches(f: Feeds) -> DataFrame:
    numbered = allocate.assign_batches(f.base, KEYS, ["k"])
    return numbered.select(
        "loan_id",
        *KEYS,
        "position",
        batch_label(F.col("quarter"), F.col("batch")).alias("load_batch_id"),
        loan_label(
            F.col("entity"), F.col("product"), F.col("quarter"), F.col("position")
        ).alias("loan_label"),
    )


def _loans(f: Feeds) -> DataFrame:
    return f.base.withColumn("load_batch_id", batch_label(F.col("quarter"), F.col("k") % 20 + 1))


def _drop_tail(f: Feeds) -> DataFrame:
    loans = allocate.with_target(f.base, bindings.loan_targets(f), KEYS)
    kept = allocate.drop_tail_until(loans, KEYS, ["k"], "loan_amount", "target")
    return kept.select("loan_id", *KEYS, "loan_amount")


def _replay_head(f: Feeds) -> DataFrame:
    loans = allocate.with_target(_loans(f), bindings.loan_targets(f), KEYS)
    replayed = allocate.replay_head_until(loans, KEYS, ["k"], "loan_amount", "target")
    return replayed.select("loan_id", *KEYS, "loan_amount", "load_batch_id")


def _adjust(f: Feeds) -> DataFrame:
    adjusted = whatif.adjust_balance(f.gl, bindings.timing_scenarios(f))
    return adjusted.select(*KEYS, "gl_balance")


def _reclass(f: Feeds) -> DataFrame:
    moved = whatif.reclass_balance(f.gl, bindings.mapping_moves(f))
    return moved.select(*KEYS, "gl_balance")


def _reclass_totals(f: Feeds) -> DataFrame:
    """Totals per entity and quarter before and after the moves, which net to zero."""
    by = ["entity", "quarter"]
    moved = whatif.reclass_balance(f.gl, bindings.mapping_moves(f))
    before, after = (
        df.groupBy(*by).agg(total(F.sum("gl_balance")).alias(name))
        for df, name in ((f.gl, "total_before"), (moved, "total_after"))
    )
    return before.join(after, by, "full")


def _unmatched_scenarios(f: Feeds) -> DataFrame:
    """Adjustments and moves out of accounts that the ledger does not have."""
    moves = bindings.mapping_moves(f).withColumnRenamed("source", "product")
    kinds = {"timing_difference": bindings.timing_scenarios(f), "mapping_error": moves}
    timing, mapping = (
        whatif.unmatched_scenarios(f.gl, scenarios).select(*KEYS, F.lit(kind).alias("kind"))
        for kind, scenarios in kinds.items()
    )
    return timing.unionByName(mapping)


def _run_date():
    return F.date_add(period_end(F.col("quarter")), 8)


def _register_of(f: Feeds, gl: DataFrame) -> DataFrame:
    """Late feeds on code 1, replays on code 2, timing on code 8, and the mapping moves."""
    kinds = {"late_feed": 1, "duplicate_load": 2}
    planned = (
        bindings.loan_targets(f, code).withColumn("break_type", F.lit(kind))
        for kind, code in kinds.items()
    )
    scenarios = materialise(reduce(DataFrame.unionByName, planned), "scenarios")
    moved = materialise(whatif.moved_until(f.base, scenarios, order="k"), "moved")
    parts = [
        whatif.detail_register(kind, moved.filter(F.col("break_type") == kind), gl)
        for kind in kinds
    ]
    parts.append(whatif.timing_register(bindings.timing_scenarios(f), gl, _run_date()))
    parts.append(whatif.mapping_register(bindings.mapping_moves(f), gl))
    return whatif.assemble_register(*parts)


def _register(f: Feeds) -> DataFrame:
    return _register_of(f, f.gl)


def _split_gl(f: Feeds) -> DataFrame:
    """The ledger with two rows an account in ASIA."""
    return _in_two(f.gl, "gl_balance", "ASIA")


def _split_what_if(f: Feeds) -> DataFrame:
    """Balances of the split ledger, row by row, after all adjustments and moves."""
    gl = _split_gl(f)
    deltas = whatif.timing_deltas(gl, bindings.timing_scenarios(f)).select(*KEYS, "delta")
    moved = whatif.mapping_deltas(gl, bindings.mapping_moves(f)).select(*KEYS, "delta")
    return whatif.apply_deltas(
        gl.select(*KEYS, "gl_balance"), deltas.unionByName(moved), KEYS, "gl_balance"
    )


def _split_totals(f: Feeds) -> DataFrame:
    """Totals of the split ledger per entity and quarter before and after the moves."""
    by, gl = ["entity", "quarter"], _split_gl(f)
    moved = whatif.reclass_balance(gl, bindings.mapping_moves(f))
    before, after = (
        df.groupBy(*by).agg(total(F.sum("gl_balance")).alias(name))
        for df, name in ((gl, "total_before"), (moved, "total_after"))
    )
    return before.join(after, by, "full")


def _filed_from_gl(f: Feeds) -> DataFrame:
    deltas = whatif.timing_deltas(f.gl, bindings.timing_scenarios(f)).select(*KEYS, "delta")
    moved = whatif.mapping_deltas(f.gl, bindings.mapping_moves(f)).select(*KEYS, "delta")
    schedule = F.concat(F.lit("H."), F.substring("product", 1, 1))
    return whatif.filed_from_gl(f.gl, deltas.unionByName(moved), schedule, _run_date())


def _account_labels(f: Feeds) -> DataFrame:
    schedule = F.concat(F.lit("H."), F.substring("product", 1, 1))
    return f.gl.select(
        *KEYS,
        account_label(schedule, F.col("entity"), F.col("product")).alias("gl_account"),
        "as_of_date",
    )


def _grade_missed(f: Feeds) -> DataFrame:
    """Tie-outs without AFRICA, whose expected breaks are then missed."""
    detail, filed = (flagged.filter(F.col("entity") != "AFRICA") for flagged in _flags(f))
    return _both(
        quality.missed_breaks(detail, bindings.detail_key(f)),
        quality.missed_breaks(filed, bindings.filed_key(f)),
    )


def _grade_spurious(f: Feeds) -> DataFrame:
    detail, filed = _flags(f)
    return _both(
        quality.spurious_breaks(detail, bindings.detail_key(f)),
        quality.spurious_breaks(filed, bindings.filed_key(f)),
    )


def _grade_verdicts(f: Feeds) -> DataFrame:
    detail, filed = _flags(f)
    graded = _both(
        quality.grade_breaks(detail, bindings.detail_key(f)),
        quality.grade_breaks(filed, bindings.filed_key(f)),
    )
    return graded.groupBy("reconciliation", "verdict").agg(F.count("*").alias("accounts"))


def _extra_rows(f: Feeds) -> DataFrame:
    detail, filed = _flags(f)
    return _both(
        quality.extra_break_rows(detail, bindings.detail_key(f)),
        quality.extra_break_rows(filed, bindings.filed_key(f)),
    )


def _clean_over(f: Feeds) -> DataFrame:
    detail, filed = _flags(f)
    columns = [*KEYS, "variance", "status"]
    return _both(
        quality.clean_over_threshold(detail, _keys(f)).select(*columns),
        quality.clean_over_threshold(filed, _keys(f)).select(*columns),
    )


def _clean_not_zero(f: Feeds) -> DataFrame:
    detail, filed = _flags(f)
    columns = [*KEYS, "variance", "variance_pct"]
    return _both(
        quality.clean_not_zero(detail, _keys(f)).select(*columns),
        quality.clean_not_zero(filed, _keys(f)).select(*columns),
    )


def _cause_mismatches(f: Feeds) -> DataFrame:
    return _both(
        quality.cause_mismatches(_detail(f), bindings.detail_key(f)),
        quality.cause_mismatches(_filed(f), bindings.filed_key(f)),
    )


def _uncorroborated(f: Feeds) -> DataFrame:
    return quality.uncorroborated_duplicates(_detail(f)).select(
        *KEYS, "root_cause", "duplicate_loan_ids"
    )


def _pair_symmetry(f: Feeds) -> DataFrame:
    """Named partners counted, and how many of them do not point back."""
    filed = _filed(f)
    bad = quality.asymmetric_pairs(filed).agg(F.count("*").alias("asymmetric"))
    named = filed.filter(F.col("root_cause") == "MAPPING_ERROR").agg(F.count("*").alias("named"))
    return named.unionByName(bad, allowMissingColumns=True).agg(
        F.max("named").alias("named"), F.max("asymmetric").alias("asymmetric")
    )


def _two_sided(f: Feeds) -> DataFrame:
    """The filed tie-out with the signs of ASIA turned, which no timing difference bears."""
    variance = F.col("variance")
    turned = total(F.when(F.col("entity") == "ASIA", -variance).otherwise(variance))
    filed = _filed(f).withColumn("variance", turned)
    return quality.two_sided_timing(filed).select(*KEYS, "variance", "offsetting_product")


def _not_footing(f: Feeds) -> DataFrame:
    return quality.not_footing(f.gl, f.sub_ledger, bindings.detail_key(f))


def _trend_mismatches(f: Feeds) -> DataFrame:
    """The orders trend against one that leaves the filed tie-out's breaks of AFRICA out."""
    detail, filed = _written_flags(f)
    partial = trend.stack_breaks(detail, filed.filter(F.col("entity") != "AFRICA"))
    narrowed = trend.break_trend(f.gl, partial)
    return quality.trend_mismatches(narrowed, detail, filed).select(
        "quarter", "extract_breaks", "own_extract", "total_break_amount", "own_amount"
    )


def _trend_agreement(f: Feeds) -> DataFrame:
    """The trend, made of balances alone, beside the breaks of both tie-outs in full."""
    own = quality.period_breaks(_detail(f), _filed(f))
    names = ["accounts_with_breaks", "subledger_breaks", "extract_breaks", "total_break_amount"]
    return _trend(f).select("quarter", *names).join(own, "quarter", "full")


def _trend_coverage(f: Feeds) -> DataFrame:
    return quality.trend_coverage(_trend(f), _keys(f))


def _multiset_diff(f: Feeds) -> DataFrame:
    """Loan ids that the sub-ledger lost or holds twice."""
    return quality.multiset_diff(f.base.select("loan_id"), f.sub_ledger.select("loan_id"))


def _no_partner(*args, **kwargs) -> DataFrame:
    return offsets.offset_partner(*args, **kwargs).filter(F.lit(False))


def _form_differences(f: Feeds) -> DataFrame:
    """Rows in which the forms of the filed tie-out differ from the default one.

    The one without partners has to differ in every line that names one.
    """
    stacked = _filed(f)
    forms = {
        "full_join": _filed(f, pairing=tieouts.pair_by_full_join),
        "theta": _filed(f, partners=offsets.offset_partner_by_join),
        "unpaired": _filed(f, partners=_no_partner),
    }
    counts = [
        quality.frame_diff(stacked, form)
        .agg(F.count("*").alias("differing_rows"))
        .withColumn("form", F.lit(name))
        for name, form in forms.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _account_difference(f: Feeds) -> DataFrame:
    return quality.account_difference(f.gl, f.extract)


def _load_checks(f: Feeds) -> DataFrame:
    """The loans as sent against the sub-ledger as spoilt, a ledger that lost names, and a copy."""
    kept = F.when(F.col("entity") != "AFRICA", F.col("gl_account"))
    return quality.load_checks(
        {
            "sub_ledger": (f.base.select("loan_amount"), f.sub_ledger, "loan_amount"),
            "general_ledger": (f.gl, f.gl.withColumn("gl_account", kept), "gl_balance"),
            "regulatory_extract": (f.extract, materialise(f.extract), "extract_balance"),
        }
    )


def _branch_overlap(f: Feeds) -> DataFrame:
    """Feeds without EUROPE's products: a NULL key finds no partner and is in both halves."""
    known = F.when(F.col("entity") != "EUROPE", F.col("product"))
    gl, extract = (df.withColumn("product", known) for df in (f.gl, f.extract))
    return quality.overlapping_branches(gl, extract)


def _written_twice(write: Callable[[DataFrame, str], None]) -> Callable[[Feeds], DataFrame]:
    """Rows per account after the ledger went twice into one table."""

    def body(f: Feeds) -> DataFrame:
        spark = f.gl.sparkSession
        path = scratch_path(spark, "ledger")
        for _ in range(2):
            write(f.gl, path)
        return spark.read.parquet(path).groupBy(*KEYS).agg(F.count("*").alias("rows"))

    return body


def _published(f: Feeds) -> DataFrame:
    """The ledger published whole and then without ASIA, each as its readers saw it."""
    spark = f.gl.sparkSession
    path = scratch_path(spark, "ledger")
    seen = []
    for feed in (f.gl, f.gl.filter(F.col("entity") != "ASIA")):
        publish_checked(feed, path, "general_ledger")
        seen.append(read_current(spark, path))
    counted = (
        rows.groupBy("quarter").agg(
            F.count("*").alias("accounts"), total(F.sum("gl_balance")).alias("balance")
        )
        for rows in seen
    )
    first, second = counted
    return first.withColumn("generation", F.lit(1)).unionByName(
        second.withColumn("generation", F.lit(2))
    )


def _batches_retried(f: Feeds) -> DataFrame:
    """Rows per batch after some batches were loaded, then all, and then all once more."""
    spark = f.gl.sparkSession
    path = scratch_path(spark, "loans")
    early = F.crc32(F.col("load_batch_id").cast("binary")) % 2 == 0
    for load in (f.sub_ledger.filter(early), f.sub_ledger, f.sub_ledger):
        append_batches(load, path)
    return read_current(spark, path).groupBy("load_batch_id").agg(
        F.count("*").alias("rows"), total(F.sum("loan_amount")).alias("amount")
    )


def _kept_rollup(f: Feeds) -> DataFrame:
    """The detail rolled up from a state that three loads were folded into."""
    spark = f.gl.sparkSession
    path = scratch_path(spark, "state")
    third = F.crc32(F.col("loan_id").cast("binary")) % 3
    for number in range(3):
        load = f.sub_ledger.filter(third == number)
        kept.fold_load(load, path, KEYS, "loan_amount", "loan_id", buckets=(8, 2))
    return kept.rollup_of(spark, path, f.sub_ledger, KEYS, "loan_id")


def _fetched_trend(f: Feeds) -> DataFrame:
    """The trend as fetched in Arrow batches, and as fetched row by row."""
    shown = materialise(_trend(f), "trend")
    spark = shown.sparkSession
    ways = (
        spark.createDataFrame(list(fetched(shown, arrow)), shown.schema).withColumn("way", F.lit(way))
        for way, arrow in (("arrow", True), ("rows", False))
    )
    return reduce(DataFrame.unionByName, ways)


def _within(tolerance: str) -> Callable[[Feeds], DataFrame]:
    return lambda f: offset_partner_within(
        tieouts.flag_filed(f.gl, f.extract), KEYS, "product", tolerance
    )


def _tree_diff(f: Feeds) -> DataFrame:
    return tree_diff(f.base.select("loan_id"), f.sub_ledger.select("loan_id"))


def _cells(f: Feeds) -> DataFrame:
    return report.kpi_cells(*_flags(f))


def _cause_cubes(f: Feeds) -> DataFrame:
    return _both(report.cause_cube(_detail(f)), report.cause_cube(_filed(f)))


def _loaded_tieout(f: Feeds) -> DataFrame:
    """The detail tie-out of feeds that went out as CSV and were loaded with all checks."""
    spark = f.gl.sparkSession
    folder = scratch_path(spark, "feeds")
    sent = {"general_ledger": f.gl, "sub_ledger": f.sub_ledger, "regulatory_extract": f.extract}
    sources = {name: f"{folder}/csv/{name}" for name in sent}
    for name, feed in sent.items():
        export(feed.select(FEEDS[name].names), sources[name])
    load_feeds(spark, sources, f"{folder}/tables")
    gl, loans = (
        read_table(spark, f"{folder}/tables/{name}", FEEDS[name])
        for name in ("general_ledger", "sub_ledger")
    )
    return tieouts.reconcile_detail(gl, loans)


def _profile(f: Feeds) -> DataFrame:
    return profile({"general_ledger": f.gl, "sub_ledger": f.sub_ledger, "extract": f.extract})


def _repeated_ids(spark: SparkSession, folder: str) -> DataFrame:
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    return quality.repeated_accounts(lines, ["l_orderkey", "l_linenumber"])


def _planted_checks(check: Callable[[DataFrame], DataFrame]) -> Callable[[Feeds], DataFrame]:
    return lambda f: check(_register(f))


def _status_counts(f: Feeds) -> DataFrame:
    results = report.run_all(f.gl, f.sub_ledger, f.extract)
    return report.break_counts(results)


def _on(build: Callable[[SparkSession, str], Feeds], body: Callable[[Feeds], DataFrame]) -> Query:
    return lambda spark, folder: body(build(spark, folder))


def registry() -> dict[str, Query]:
    orders: dict[str, Callable[[Feeds], DataFrame]] = {
        # tie-outs and their forms
        "tieout_detail": _detail,
        "tieout_filed": _filed,
        "tieout_filed_full_join": lambda f: _filed(f, pairing=tieouts.pair_by_full_join),
        "tieout_filed_union_anti": lambda f: _filed(f, pairing=tieouts.pair_by_union),
        "tieout_filed_theta": lambda f: _filed(f, partners=offsets.offset_partner_by_join),
        "tieout_detail_split": _detail_split,
        "tieout_filed_split": _filed_split,
        "break_trend": _trend,
        "all_breaks": _breaks,
        # building blocks
        "detail_rollup": lambda f: rollups.rollup_to_grain(
            f.sub_ledger, KEYS, "loan_amount", "loan_id"
        ),
        "balance_rollup": lambda f: rollups.rollup_balance(f.extract, KEYS, "extract_balance"),
        "offset_pairs": lambda f: offsets.offset_partner(
            tieouts.flag_filed(f.gl, f.extract), KEYS, "product"
        ),
        "offset_pairs_dollar": _within("1.00"),
        "offset_pairs_wide": _within("25000.00"),
        "tieout_filed_within": lambda f: _filed(f, partners=offset_partner_within),
        "presence_flags": _presence,
        "population": lambda f: trend.population(f.gl),
        # report views
        "kpi_summary": lambda f: report.kpis(*_flags(f)),
        "filtered_breaks": _filtered,
        "cause_counts": _cause_counts,
        "trend_long": lambda f: report.trend_long(_trend(f)),
        "break_ranking": lambda f: report.rank_breaks(_detail(f), "variance_pct"),
        "break_ranking_filed": lambda f: report.rank_breaks(_filed(f), "variance"),
        "filter_values": lambda f: report.distinct_values(f.gl, "quarter"),
        "filter_entities": lambda f: report.distinct_values(f.gl, "entity"),
        "kpi_summary_scoped": lambda f: report.kpis(
            *(report.scope(flagged, *SCOPE) for flagged in _flags(f))
        ),
        "kpi_cube": lambda f: report.kpi_cube(_cells(f)),
        "kpi_scope_from_cells": lambda f: report.kpis_of_scope(_cells(f), *SCOPE),
        "cause_cube": _cause_cubes,
        "break_counts": _status_counts,
        "money_labels": _kpi_labels,
        "money_labels_totals": _scaled_labels,
        # allocation and what-if
        "apportion": _apportion,
        "apportion_signed": _apportion_signed,
        "not_apportioned": lambda f: allocate.not_positive(_apportion_signed(f)),
        "assign_batches": _batches,
        "drop_tail": _drop_tail,
        "replay_head": _replay_head,
        "adjust_balance": _adjust,
        "reclass_balance": _reclass,
        "reclass_totals": _reclass_totals,
        "unmatched_scenarios": _unmatched_scenarios,
        "expected_breaks": _register,
        "expected_breaks_split": lambda f: _register_of(f, _split_gl(f)),
        "what_if_split": _split_what_if,
        "reclass_totals_split": _split_totals,
        "filed_from_gl": _filed_from_gl,
        "account_labels": _account_labels,
        # grading
        "grade_missed": _grade_missed,
        "grade_spurious": _grade_spurious,
        "grade_verdicts": _grade_verdicts,
        "extra_break_rows": _extra_rows,
        "clean_over_threshold": _clean_over,
        "clean_not_zero": _clean_not_zero,
        "cause_mismatches": _cause_mismatches,
        "uncorroborated_duplicates": _uncorroborated,
        "pair_symmetry": _pair_symmetry,
        "two_sided_timing": _two_sided,
        "footing_check": _not_footing,
        "trend_agreement": _trend_agreement,
        "trend_mismatches": _trend_mismatches,
        "trend_coverage": _trend_coverage,
        "register_repeated": _planted_checks(quality.repeated_accounts),
        "register_missing_modes": _planted_checks(
            lambda key: quality.missing_modes(key.filter("break_type <> 'mapping_error'"))
        ),
        "register_thin_margins": _planted_checks(
            lambda key: quality.thin_margins(key).select("break_id", *KEYS, "planted_variance_pct")
        ),
        "register_unbalanced": _planted_checks(
            lambda key: quality.unbalanced_pairs(
                key.filter("expected_direction = 'under' OR entity <> 'EUROPE'")
            )
        ),
        # loads and populations
        "branch_overlap": _branch_overlap,
        "form_differences": _form_differences,
        "multiset_diff": _multiset_diff,
        "multiset_diff_tree": _tree_diff,
        "account_difference": _account_difference,
        "universe_gaps": lambda f: quality.universe_gaps(f.gl),
        "load_checks": _load_checks,
        "append_twice": _written_twice(append),
        "refresh_twice": _written_twice(refresh),
        "published_generations": _published,
        "batches_retried": _batches_retried,
        "rollup_kept_current": _kept_rollup,
        "fetched_trend": _fetched_trend,
        "loaded_tieout": _loaded_tieout,
        "table_profile": _profile,
        "table_sample": lambda f: sample_rows(f.sub_ledger, 3, ["loan_id", "load_batch_id"]),
        "content_digest": lambda f: quality.content_digest(f.sub_ledger),
    }
    lineitem: dict[str, Callable[[Feeds], DataFrame]] = {
        "tieout_detail_lineitem": _detail,
        "tieout_filed_lineitem": _filed,
        "break_trend_lineitem": _trend,
        "kpi_summary_lineitem": lambda f: report.kpis(*_flags(f)),
        "grade_verdicts_lineitem": _grade_verdicts,
        "multiset_diff_lineitem": _multiset_diff,
        "multiset_diff_tree_lineitem": _tree_diff,
    }
    return {
        **{name: _on(orders_feeds, body) for name, body in orders.items()},
        **{name: _on(lineitem_feeds, body) for name, body in lineitem.items()},
        "duplicate_ids": _duplicate_ids,
        "repeated_ids": _repeated_ids,
    }
