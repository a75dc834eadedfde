from __future__ import annotations

import random
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from frames import dollars
from ledgertie.operators import allocate, ordered

LOANS = "account string, n bigint, amount decimal(18,2), target decimal(18,2), load_batch_id string"


def loans(spark, sizes, seed=3, fractions=(0, 0.03, 0.5, 0.97, 1.5)):
    """Accounts of the given sizes with random amounts; targets are shares of the balance."""
    rng = random.Random(seed)
    rows = []
    for account, size in sizes.items():
        numbers = rng.sample(range(size * 3), size)
        amounts = [dollars(rng.randint(1, 10**6) / 100) for _ in numbers]
        target = dollars(float(sum(amounts)) * rng.choice(fractions))
        rows += [
            (account, n, amount, target, "B1") for n, amount in zip(numbers, amounts, strict=True)
        ]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, LOANS).repartition(5)


def taken_by_loop(rows, descending):
    """The rows taken when they are gone through one by one."""
    accounts = defaultdict(list)
    for row in rows:
        accounts[row[0]].append(row)
    taken = set()
    for account in accounts.values():
        done = Decimal(0)
        for row in sorted(account, key=lambda r: r[1], reverse=descending):
            if done >= row[3]:
                break
            taken.add((row[0], row[1]))
            done += row[2]
    return taken


SIZES = {"hot": 4000, "big": 900, "mid": 60, "two": 2, "one": 1, **{f"s{i}": 7 for i in range(40)}}


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_marks_agree_with_a_loop_when_accounts_span_chunks(spark, many_chunks, descending, seed):
    rows, df = loans(spark, SIZES, seed)
    marked = ordered.mark_until(df, ["account"], ["n"], "amount", "target", descending)
    assert marked.count() == len(rows)
    found = {(r.account, r.n) for r in marked.filter("taken").collect()}
    assert found == taken_by_loop(rows, descending)


def test_hot_account_is_spread_over_chunks(spark, many_chunks):
    rows, df = loans(spark, {"hot": 6000, "a": 100, "b": 100})
    spread = df.orderBy("account", "n").groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) >= 3 and max(row["count"] for row in spread) < 4000


def test_accounts_without_a_target_are_left_alone(spark):
    _, df = loans(spark, {"a": 5, "b": 5})
    untouched = df.withColumn("target", F.lit(None).cast("decimal(18,2)"))
    marked = ordered.mark_until(untouched, ["account"], ["n"], "amount", "target")
    assert marked.filter("taken").isEmpty() and marked.count() == 10


def test_positions_count_from_zero(spark, many_chunks):
    rows, df = loans(spark, SIZES)
    numbered = ordered.positions(df, ["account"], ["n"]).collect()
    assert len(numbered) == len(rows)
    accounts = defaultdict(list)
    for row in numbered:
        accounts[row.account].append((row.n, row.position))
    for pairs in accounts.values():
        assert [position for _, position in sorted(pairs)] == list(range(len(pairs)))


def test_positions_of_nulls_ties_and_other_columns(spark, many_chunks):
    rows = [(a, n, f"{a}{n}{i}") for a in ("x", None) for n in (3, None, 1, 1) for i in range(20)]
    df = spark.createDataFrame(rows, "account string, n int, _note string").repartition(7)
    got = ordered.positions(df, ["account"], ["n"])
    assert got.columns == ["account", "n", "_note", "position"]
    found = defaultdict(dict)
    for row in got.collect():
        found[row.account][row.position] = row.n
        assert row._note.startswith(f"{row.account}{row.n}")
    wanted = [None] * 20 + [1] * 40 + [3] * 20
    assert set(found) == {"x", None}
    assert all([numbers[i] for i in range(80)] == wanted for numbers in found.values())
    assert ordered.positions(df.limit(0), ["account"], ["n"]).count() == 0


def test_batches(spark):
    _, df = loans(spark, {"a": 60})
    batches = allocate.assign_batches(df, ["account"], ["n"]).collect()
    assert Counter(row.batch for row in batches) == {1: 25, 2: 25, 3: 10}


def test_drop_tail_case(spark):
    rows = [("a", n, dollars(x), dollars(50), "B") for n, x in enumerate((30, 30, 40))]
    df = spark.createDataFrame(rows, LOANS)
    kept = allocate.drop_tail_until(df, ["account"], ["n"], "amount", "target").collect()
    assert [row.n for row in kept] == [0]


def test_replay_case(spark):
    rows = [("a", n, dollars(x), dollars(50), "B1") for n, x in enumerate((30, 30, 40))]
    df = spark.createDataFrame(rows, LOANS)
    out = allocate.replay_head_until(df, ["account"], ["n"], "amount", "target").collect()
    assert sorted((row.n, row.load_batch_id) for row in out) == [
        (0, "B1"), (0, "B1-REPLAY"), (1, "B1"), (1, "B1-REPLAY"), (2, "B1"),
    ]


def test_apportion_case(spark):
    rows = [("a", i, dollars(1), dollars(1), "B") for i in (3, 1, 2)]
    df = spark.createDataFrame(rows, LOANS)
    parts = allocate.apportion_exact(df, ["account"], "target", "amount", "n").collect()
    assert {row.n: row.part for row in parts} == {
        1: Decimal("0.34"), 2: Decimal("0.33"), 3: Decimal("0.33"),
    }


@pytest.mark.parametrize("equal", [False, True])
def test_apportion_sums_exactly_and_favours_large_remainders(spark, many_chunks, equal):
    rows, df = loans(spark, SIZES, fractions=(0.37, 1.01, 3.3))
    if equal:
        df = df.withColumn("amount", F.lit(1).cast("decimal(18,2)"))
        rows = [(a, n, Decimal("1.00"), t, b) for a, n, _, t, b in rows]
    parts = allocate.apportion_exact(df, ["account"], "target", "amount", "n").collect()
    found = {(row.account, row.n): row.part for row in parts}
    assert len(found) == len(rows)
    accounts = defaultdict(list)
    for account, n, weight, target, _ in rows:
        accounts[account].append((n, int(weight * 100), int(target * 100)))
    for account, members in accounts.items():
        weights, cents = sum(w for _, w, _ in members), members[0][2]
        shares = {n: divmod(cents * w, weights) for n, w, _ in members}
        left = cents - sum(floor for floor, _ in shares.values())
        lucky = sorted(shares, key=lambda n: (-shares[n][1], n))[:left]
        for n, (floor, _) in shares.items():
            assert found[account, n] == Decimal(floor + (n in lucky)) / 100
        assert sum(found[account, n] for n in shares) == Decimal(cents) / 100


def test_parts_have_to_be_positive(spark):
    rows = [("a", i, dollars(1), dollars("0.02"), "B") for i in range(3)]
    df = spark.createDataFrame(rows, LOANS)
    parts = allocate.apportion_exact(df, ["account"], "target", "amount", "n")
    assert allocate.not_positive(parts).count() == 1


def test_apportioned_parts_sum_for_any_sign_and_scale(spark):
    rows = [("down", i, Decimal("-1.00"), Decimal("1.000")) for i in range(3)]
    rows += [("fine", i, Decimal("10.00"), Decimal(f"0.00{w}")) for i, w in enumerate("13")]
    rows += [("none", i, Decimal("5.00"), Decimal("0.000")) for i in range(2)]
    schema = "account string, n bigint, target decimal(18,2), weight decimal(10,3)"
    df = spark.createDataFrame(rows, schema)
    for weight in ("decimal(10,3)", "double"):
        weighed = df.withColumn("weight", F.col("weight").cast(weight))
        parts = allocate.apportion_exact(weighed, ["account"], "target", "weight", "n")
        found = defaultdict(list)
        for r in parts.orderBy("account", "n").collect():
            found[r.account].append(r.part)
        assert found["down"] == [Decimal("-0.33"), Decimal("-0.33"), Decimal("-0.34")]
        assert found["fine"] == [Decimal("2.50"), Decimal("7.50")]
        assert found["none"] == [None, None]
        assert allocate.not_positive(parts).count() == 5


@pytest.mark.parametrize(
    "order, descending", [("number", False), ("number", True), ("text", True), ("tied", False)]
)
def test_large_accounts_are_narrowed_to_the_crossing_bin(spark, descending, order):
    """Accounts far over the rows that may be sorted, one of them with almost all rows."""
    rng = random.Random(7)
    sizes = {"hot": 2500, "big": 400, "mid": 60, "one": 1, "whole": 300}
    rows = []
    for account, size in sizes.items():
        numbers = rng.sample(range(size * 50), size)
        if account == "hot":  # a far outlier, and a dense stretch
            numbers[:2] = [2**40, 2**41]
        total = 0
        for n in numbers:
            amount = dollars(rng.choice([0, 1, 5, 10**4]) / 100)
            total += amount
            rows.append([account, n, amount, None, "B"])
        for row in rows[-size:]:
            row[3] = total * 2 if account == "whole" else dollars(float(total) * 0.61)
    df = spark.createDataFrame(rows, LOANS).repartition(4)
    names = {"number": ["n"], "text": ["name"], "tied": ["half", "n"]}[order]
    # strings that agree in their first bytes, and a first column with very few values
    df = df.withColumn("name", F.format_string("loan-number-%020d", "n")).withColumn(
        "half", (F.col("n") % 2).cast("int")
    )
    marked = ordered.mark_until(
        df, ["account"], names, "amount", "target", descending, sorted_rows=100
    )
    places = [[r[0], (r[1] % 2, r[1]) if order == "tied" else r[1], *r[2:]] for r in rows]
    want = taken_by_loop(places, descending)
    taken = marked.filter("taken").select("account", "n").collect()
    got = {(r.account, (r.n % 2, r.n) if order == "tied" else r.n) for r in taken}
    assert got == want
    cuts = ordered.cut_points(df, ["account"], names, "amount", "target", descending, 100).collect()
    for cut in cuts:
        mine = [r for r in places if r[0] == cut.account and (r[0], r[1]) in want]
        assert (cut.moved_loans, cut.moved_amount) == (len(mine), sum(r[2] for r in mine))
    assert {cut.account for cut in cuts if cut._cut is None} == {"whole"}


def test_equal_orders_of_a_large_account_end(spark):
    """Rows that nothing tells apart stop the narrowing instead of going on for ever."""
    rows = [("a", 7, dollars(1), dollars(30), "B")] * 200
    df = spark.createDataFrame(rows, LOANS)
    (cut,) = ordered.cut_points(df, ["account"], ["n"], "amount", "target", False, 20).collect()
    assert (cut.moved_loans, cut._cut.n) == (30, 7)
