"""Jobs that operators have to do whole: small tables on which a cut shows."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

import corpus_pipeline
from ledgertie.llm import line_dedup, mixing, pii, tables, toxicity
from ledgertie.llm.text import PLAIN_WORDS, as_bytes, words_of


def toxicity_chunk(texts: list[str], toxic: list[int], drawn: list[int]) -> toxicity.Chunk:
    words = words_of(*as_bytes(pa.array(texts)), PLAIN_WORDS)
    marks = (np.array(x, np.int8) for x in (toxic, drawn))
    parts = [(pa.array(range(len(texts))), *marks, words.counts, words.hashes)]
    return toxicity.Chunk.of(toxicity._chunk(0, parts))


def test_toxicity_tells_all_words_and_bigrams_apart():
    n = 600_000
    held = toxicity_chunk([" ".join(f"a{i}" for i in range(n))], [1], [0])
    assert len(held.words) == n + 1 and len(held.keys) == n  # with the start of the text


def test_toxicity_counts_every_labelled_row():
    held = toxicity_chunk(["a b a", "a c", "a d"], [1, 0, -1], [1, 0, 0])
    ordinary, toxic = held.by_class(held.word, len(held.words))
    assert (ordinary.sum(), toxic.sum()) == (2, 3)


def test_toxicity_contexts_come_from_all_documents(spark):
    rows = [(0, "a b", -1, False), (1, "c b", -1, False), (2, "c b", 1, False)]
    docs = spark.createDataFrame(rows, "row long, text string, toxic int, drawn boolean")
    stored = toxicity.materialise(toxicity._chunked(docs.coalesce(1)), "chunks")
    pairs = toxicity._ask_pairs(stored, 3, 0)
    for turn in range(1, toxicity.ROUNDS):
        pairs = pairs.unionByName(toxicity._ask_pairs(stored, 3, turn))
    pairs = pairs.groupBy("part").applyInArrow(toxicity._merge_pairs, toxicity.ANSWER)
    words = toxicity._ask_words(stored, pairs.filter("chunk >= 0"), 3)
    words = words.groupBy("part").applyInArrow(toxicity._merge_words, toxicity.ANSWER)
    contexts, vocabulary = toxicity._sums(words)[8:]
    assert (contexts, vocabulary) == (4, 3)  # a, c after the start; b after a and after c


def test_toxicity_uses_bigrams_that_are_rare():
    assert 0 < toxicity.discount(60, 20) < 1
    model = toxicity.Model([0.6, 0.6], [0.6, 0.6], [1000, 1000], [300, 300], 500, 300)
    one, two, none = np.array([1]), np.array([2]), np.array([0])
    seen = model.differences([none, one], [two, two], [two, two], [two, two], two)
    unseen = model.differences([none, none], [two, two], [two, two], [two, two], two)
    assert seen[0] > unseen[0] + 1  # seen once, after a word seen twice in each class


def told(kept) -> list[tuple]:
    return sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)


def test_pipeline_stages_judge_rows_and_not_ids(spark, tmp_path):
    draw = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    a, b, c, d = (" ".join(draw.choices(words, k=40)) for _ in range(4))
    schema = "doc_id long, text string"
    rows = [(None, a), (None, a), (5, b), (5, b), (5, c), (9, d), (3, d), (None, d), (None, "x y")]
    docs = spark.createDataFrame(rows, schema)
    kept = corpus_pipeline.near_duplicate_stage(spark, docs, "")
    assert told(kept) == sorted([(None, a), (5, b), (5, c), (3, d), (None, "x y")], key=str)

    items = spark.createDataFrame([(1, " ".join(a.split()[5:25]))], "item_id long, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(None, a), (None, b), (5, a), (5, b), (6, c)], schema)
    kept = corpus_pipeline.decontamination_stage(spark, docs, str(tmp_path))
    assert told(kept) == sorted([(None, b), (5, b), (6, c)], key=str)

    rows, marks = [], []
    for i in range(600):
        text = draw.choices(words, k=60)
        for place in (10, 30, 50) if i % 4 == 0 else ():
            text[place] = draw.choice(["vile", "nasty"])
        rows.append((i, " ".join(text)))
        marks.append((i, int(i % 4 == 0)))
    spark.createDataFrame(marks, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    clean, bad = (" ".join([*draw.choices(words, k=60), *x]) for x in ([], ["vile", "w1", "nasty"] * 2))
    odd = [(None, clean), (None, bad), (7000, clean), (7000, bad)]
    docs = spark.createDataFrame([*rows, *odd], schema)
    kept = told(corpus_pipeline.toxicity_stage(spark, docs, str(tmp_path)))
    assert [row for row in odd if row in kept] == [(None, clean), (7000, clean)]
    assert sum(row in kept for row in rows) > 400


def test_pipeline_removes_short_lines_that_are_equal(spark):
    long = "a line of more than twenty characters"
    rows = [(1, f"short\n\n{long}\nshort"), (2, f"shory\n short\t\n\n{long}s\nnew")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.line_stage(spark, docs, "")
    assert told(kept) == [(1, f"short\n\n{long}"), (2, "shory\n\nnew")]


def test_personal_data_segments_hold_a_card_digit_by_digit():
    for digits in ("4111111111111111", "4000000000000000006"):
        stretch = " ".join(digits)
        arcs = pii.Lattice(stretch).arcs
        assert (0, 2 * len(digits) - 1, pii.TYPES.index("card")) in [arc[:3] for arc in arcs]


def test_line_dedup_judges_rows_and_not_ids(spark):
    unique = "a line that no other row has at all"
    common = "a line of more than twenty characters"
    rows = [(None, f"{common}\n{common}"), (None, f"x\n{unique}"), (5, f"{common}\ny"), (5, f"z\n{unique}s")]
    rows += [(7, "same\nrow"), (7, "same\nrow"), (8, None), (8, "")]
    schema = "doc_id long, text string, _gone int, _lines int, _row int, n_lines int"
    docs = spark.createDataFrame([(*row, 1, 2, 3, 4) for row in rows], schema)
    got = line_dedup.dedup_lines(docs)
    assert got.columns[:6] == docs.columns and got.filter("_gone + _lines + _row + n_lines <> 10").count() == 0
    want = [(None, common), (None, f"x\n{unique}"), (5, "y"), (5, "z"), (7, "same\nrow"), (7, ""), (8, None), (8, "")]
    assert told(got) == sorted(want, key=str)


def test_line_dedup_of_long_words(spark):
    draw = random.Random(6)
    long = "".join(draw.choices("abcé中", k=200_000))
    cut = long[:70_000] + long[70_001:]
    two = long[:50] + long[60:]
    edge = ["".join(draw.choices("abcé", k=n)) for n in (32, 33, 34)]
    rows = [(1, f"on {long} end"), (2, f"on {cut} end"), (3, f"on {two} end"), (4, f"on{long} end")]
    rows += [(5, long[:40] + " " + long[40:80]), (6, long[:80])]
    rows += [(10 + i, f"edge of {word} here") for i, word in enumerate(edge)]
    rows += [(20 + i, f"edge of {word[:9] + word[10:]} here") for i, word in enumerate(edge)]
    rows += [(30 + i, f"edge of {word[:9]}#{word[10:]} here") for i, word in enumerate(edge)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    gone = {r.doc_id for r in line_dedup.dedup_lines(docs).filter("n_removed > 0").collect()}
    assert gone == {2, 4, 6, *range(20, 23), *range(30, 33)}


def test_mixing_draws_for_each_row(spark):
    rows = [(None, "a") for _ in range(3000)] + [(7, "b") for _ in range(1000)]
    schema = "doc_id long, source string, _of int, _steps int, _place int, _times int, _order int, _row int"
    docs = spark.createDataFrame([(*row, 1, 2, 3, 4, 5, 6) for row in rows], schema).repartition(4)
    weights = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "source string, weight double")
    mixed = mixing.mix(docs, weights)
    assert mixed.columns == [*docs.columns, "copy"]
    assert mixed.filter("_of * 100000 + _steps * 10000 + _place * 1000 + _times * 100 + _order * 10 + _row <> 123456").count() == 0
    counts = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert abs(counts["a"] - 1000) < 100 and abs(counts["b"] - 3000) < 170
    spread = [r["count"] for r in mixed.groupBy(F.spark_partition_id()).count().collect()]
    assert len(spread) > 1 or sum(spread) < 5000  # one partition only if Spark joined small ones


def test_mixing_at_a_high_rate(spark):
    docs = spark.createDataFrame([(1, "rare"), *((i, "big") for i in range(2, 4002))], "doc_id long, source string")
    weights = spark.createDataFrame([("rare", 1.0), ("big", 1.0)], "source string, weight double")
    mixed = {r.source: r["count"] for r in mixing.mix(docs, weights, epochs=5.0).groupBy("source").count().collect()}
    assert abs(mixed["rare"] - 10_000) < 600 and abs(mixed["big"] - 10_000) < 600


@pytest.mark.parametrize("far", [[], [2**61], [-(2**60), 2**61], [10**6, 2**50 + 5, 2**50 + 6]])
def test_ranges_stay_even_beside_far_ids(spark, far):
    ids = [*range(20_000), *far, *[7] * 50]
    df = spark.createDataFrame([(i,) for i in [*ids, None, None]], "doc_id long").repartition(3)
    parts = tables.range_parts(df, "doc_id", 500, cells=4096)
    placed = df.withColumn("part", parts.column("doc_id")).collect()
    held: dict[int, list] = {}
    for row in placed:
        held.setdefault(row.part, []).append(row.doc_id)
    assert set(held) <= set(range(parts.count)) and all(None not in held[p] for p in held if p)
    bounds = [sorted(i for i in held[p] if i is not None) for p in sorted(held)]
    assert all(a[-1] < b[0] for a, b in itertools.pairwise(bounds))
    assert max(map(len, held.values())) <= 600 and len(held) >= 38
