"""The corpus operators on odd tables, against brute force and against SQL."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from compare import connect, differences
from ledgertie.llm import (
    decontaminate,
    fingerprints,
    jaccard,
    line_dedup,
    mixing,
    oracle,
    pii,
    queries,
    substrings,
    token_counts,
    toxicity,
    warc,
)

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, copy int, h long"
WORDS = [f"w{i}" for i in range(400)]


def prose(seed: int, n: int) -> str:
    return " ".join(random.Random(seed).choices(WORDS, k=n))


PASSAGE = prose(1, 80)
NEAR = prose(2, 120)
ODD = [
    (1, PASSAGE + "\n" + prose(3, 30)),
    (2, prose(4, 20) + "\n" + PASSAGE),
    (3, NEAR),
    (4, NEAR.replace(NEAR.split()[60], "changed", 1)),
    (5, None),
    (6, ""),
    (7, "é 中文 🎉"),
    (None, "without an id " + PASSAGE),
    (9, "a@b.org +1 (337) 555-7349"),
    (9, "a@b.org +1 (337) 555-7349"),
    (10, prose(5, 30_000)),
    (11, "x" * 50_000),
    (12, "!!!"),
    (13, "!!!"),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, None if i == 5 else "en", None if i == 6 else "s", 0, 7, 8) for i, t in ODD]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, " ".join(PASSAGE.split()[5:40])), (2, "never seen here"), (3, None), (4, "中文")]
    return spark.createDataFrame([*rows, (None, "")], "item_id long, text string")


@pytest.mark.parametrize("name", sorted(oracle.statements()))
def test_query_agrees_with_sql(spark, name):
    result = queries.registry()[name](spark, FOLDER)
    assert differences(result, connect(FOLDER), oracle.statements()[name]) == ""


def test_sql_on_odd_rows(spark, odd, items, tmp_path):
    odd.drop("copy", "h").coalesce(1).write.parquet(f"{tmp_path}/d")
    items.coalesce(1).write.parquet(f"{tmp_path}/b")
    con = connect(str(tmp_path))
    con.execute(f"CREATE VIEW documents AS FROM read_parquet('{tmp_path}/d/*.parquet')")
    con.execute(f"CREATE VIEW benchmark AS FROM read_parquet('{tmp_path}/b/*.parquet')")
    docs = odd.drop("copy", "h")
    results = {
        "op1_benchmark_contamination": decontaminate.report(
            decontaminate.contamination(docs, items, segment_words=100)
        ),
        "op10_ngram_jaccard_join": jaccard.near_duplicates(docs, block=1),
        "op9_source_mixing": mixing.mix(docs),
    }
    for name, result in results.items():
        assert differences(result, con, oracle.statements()[name]) == "", name


def test_empty_tables(spark, empty, items):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    path = f"{spark.conf.get('spark.checkpoint.dir')}/empty-archive"
    assert warc.write_archive(pages, path).count() == 0
    results = [
        decontaminate.contamination(empty, items),
        decontaminate.contamination(empty, items.limit(0)),
        token_counts.count_tokens(empty, queries.tokenizer()),
        pii.find_personal_data(empty),
        toxicity.score_toxicity(empty, labels),
        fingerprints.fingerprints(empty),
        line_dedup.dedup_lines(empty),
        substrings.remove_repeats(empty),
        mixing.mix(empty),
        jaccard.near_duplicates(empty),
    ]
    assert [result.count() for result in results] == [0] * len(results)


def test_near_matches_in_any_order(spark):
    docs = spark.createDataFrame(
        [(1, "x c b z a y"), (2, "a x x x x x b c"), (3, "a b c")], "doc_id long, text string"
    )
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    found = decontaminate.contamination(docs, items, slop=1)
    assert {r.doc_id: r.n_items for r in found.collect()} == {1: 1, 2: 0, 3: 1}


def test_token_counts_equal_the_library(odd):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer())
    got = token_counts.count_tokens(odd, queries.tokenizer()).collect()
    known = {(i, len((t or "").encode()), len(model.encode(t or ""))) for i, t in ODD}
    assert {(r.doc_id, r.n_bytes, r.n_tokens) for r in got} == known and len(got) == len(ODD)
    assert all(r.over_limit == (r.n_tokens > 4096) for r in got)


def test_token_counts_of_random_texts():
    import pyarrow as pa
    import sentencepiece

    from ledgertie.llm.text import as_bytes

    model = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer())
    draw = random.Random(7)
    texts = ["".join(draw.choices("the in\n\t  ▁é中🎉.\0", k=draw.randint(0, 40))) for _ in range(2000)]
    got = token_counts.counts_of(*as_bytes(pa.array(texts)), queries.tokenizer())
    assert got.tolist() == [len(tokens) for tokens in model.encode(texts)]


def test_personal_data_base_and_added(spark):
    texts = [f"x 4111 1111 1111 1111 y +1 (337) 555-73{i} z, 4111 1111 1111 11{i}" for i in range(12, 40)]
    weights = pii.fit(texts)
    text = "no 77 4111 1111 1111 1111, mail a.b@c.org or +49 30 1234567, at 10.0.0.255"
    base = pii.base_spans(text)
    assert [kind for kind, _, _ in base] == ["email", "ip", "phone"]
    added = pii.added_spans(text, base, weights)
    assert [(kind, text[a:b]) for kind, a, b in added] == [("card", "4111 1111 1111 1111")]
    assert pii.added_spans("in 1999 2000 2001 2002 2003 it was", [], weights) == []


def test_personal_data_rows(odd):
    rows = pii.find_personal_data(odd).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        text = "a@b.org +1 (337) 555-7349" if r.doc_id == 9 else ""
        spans = "email:0:7,phone:8:25" if text else ""
        assert r.base_sha256 == hashlib.sha256(spans.encode()).hexdigest()


def test_toxicity_on_unseen_documents(spark):
    draw = random.Random(11)
    rows, marks = [(None, "w1 w2"), (9001, None), (9002, "")], []
    for i in range(1200):
        toxic = i % 5 == 0
        words = draw.choices(WORDS, k=60)
        for place in (10, 30, 50) if toxic else ():
            words[place] = draw.choice(["vile", "nasty"])
        rows.append((i, " ".join(words)))
        marks.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([*marks, (None, 1), (5, None)], "doc_id long, toxic int")
    scored = toxicity.score_toxicity(docs, labels).collect()
    assert len(scored) == len(rows) and all(0 <= r.score <= 1 for r in scored)
    unseen = [r for r in scored if r.held_out and r.doc_id < 9000]
    right = sum(r.predicted == (r.doc_id % 5 == 0) for r in unseen)
    assert len(unseen) > 200 and right >= 0.97 * len(unseen)


def test_fingerprints_by_brute_force(odd):
    rows = {
        (r.doc_id, r.n_chars, r.edited_sha256): r
        for r in fingerprints.fingerprints(odd, part_rows=2).collect()
    }
    order = sorted(ODD, key=lambda row: (row[0] is not None, row[0] or 0, row[1] or ""))
    for (doc_id, text), (_, after) in zip(order, [*order[1:], order[0]], strict=True):
        text, after = text or "", after or ""
        half = len(text) // 2
        edited = (text[: len(text) - half] + after[:half]).encode()
        r = rows[doc_id, len(text), hashlib.sha256(edited).hexdigest()]
        a, b, c = (slow_digest(x) for x in (text.encode(), edited, after.encode()))
        assert (r.fingerprint, r.edited_fingerprint) == (a, b)
        assert (r.near_edited == 1) >= (a == b) and (r.near_next == 1) >= (a == c)
        assert 0 <= r.near_edited <= 1


def slow_digest(text: bytes) -> str:
    counts = [0] * 128
    for places, multiplier in fingerprints.TRIPLETS:
        for i in range(len(text) - places[2]):
            a, b, c = (text[i + p] for p in places)
            value = ((a << 16 | b << 8 | c) + 1) * multiplier % 2**32
            value = (value ^ value >> 15) * 0x2C1B3C6D % 2**32
            counts[value >> 25] += 1
    q1, q2, q3 = (sorted(counts)[k] for k in (31, 63, 95))
    codes = [(n > q1) + (n > q2) + (n > q3) for n in counts]
    body = bytes(
        codes[i] << 6 | codes[i + 1] << 4 | codes[i + 2] << 2 | codes[i + 3]
        for i in range(0, 128, 4)
    )
    length = int(np.floor(np.log(len(text) + 1.0) / np.log(1.3)))
    top = max(q3, 1)
    return f"{length:02x}{q1 * 100 // top % 16:x}{q2 * 100 // top % 16:x}{body.hex()}"


def test_line_dedup_by_brute_force(spark):
    draw = random.Random(5)
    base = [" ".join(draw.choices(WORDS, k=8)) for _ in range(12)]
    rows = []
    for i in range(40):
        lines = []
        for _ in range(6):
            line = draw.choice(base)
            place = draw.randrange(len(line))
            kind = draw.randrange(5)
            if kind == 1:
                line = line[:place] + line[place + 1 :]
            elif kind == 2:
                line = line[:place] + draw.choice("z é") + line[place:]
            elif kind == 3:
                line = line[:place] + "Q" + line[place + 1 :]
            lines.append(draw.choice(["", " ", "\t"]) + line)
        rows.append((i, "\n".join([*lines, "short", ""])))
    rows += [(100, None), (101, ""), (None, base[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
    seen: list[str] = []
    for doc_id, text in sorted(rows, key=lambda row: (row[0] is not None, row[0] or 0)):
        kept = []
        for line in (text or "").split("\n"):
            bare = line.strip(" \t\r")
            if len(bare) < line_dedup.MIN_CHARS:
                gone = bool(bare) and bare in seen
            else:
                gone = any(within_one(bare, x) for x in seen)
            if not gone:
                kept.append(line)
            seen.append(bare)
        assert got[doc_id].text == (None if text is None else "\n".join(kept)), doc_id
    assert got[100].n_lines == 0 and got[101].n_lines == 1


def within_one(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def test_warc_round_trip(spark):
    rows = [
        (5, "http://a/\r\nx: y", "same"),
        (3, None, "same"),
        (None, "http://n/", "same"),
        (8, "http://e/", ""),
        (9, "http://f/", None),
        (4, "http://g/", "é" * 5000),
        (3, None, "same"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    folder = spark.conf.get("spark.checkpoint.dir")
    names = []
    for name in ("one", "two"):
        manifest = warc.write_archive(pages, f"{folder}/{name}", part_rows=2, roll_bytes=300)
        names.append(sorted((r.name, r.sha256) for r in manifest.collect()))
    assert names[0] == names[1] and len(names[0]) > 2  # the same files, byte by byte
    got = warc.read_archive(spark, f"{folder}/one").collect()
    kinds = sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to) for r in got)
    assert kinds == [
        (0, 4, "response", None),
        (3, 4, "response", None),
        (3, 4, "revisit", 3),
        (4, 10000, "response", None),
        (5, 4, "revisit", 3),
        (8, 0, "response", None),
        (9, 0, "revisit", 8),
    ]


@pytest.mark.parametrize("window", [6, 50])
def test_substrings_by_brute_force(odd, window):
    got = {}
    for r in substrings.remove_repeats(odd, window, chunk_words=100).collect():
        got.setdefault(r.doc_id, []).append((r.n_words, r.n_removed, r.kept_sha256))
    first: dict[tuple, int] = {}
    for doc_id, text in ODD:
        words = (text or "").split()
        for i in range(len(words) - window + 1):
            if doc_id is not None:
                key = tuple(words[i : i + window])
                first[key] = min(first.get(key, doc_id), doc_id)
    for doc_id, text in ODD:
        words = (text or "").split()
        gone = set()
        for i in range(len(words) - window + 1):
            if doc_id is not None and first[tuple(words[i : i + window])] < doc_id:
                gone.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        digest = hashlib.sha256(kept.encode()).hexdigest()
        assert (len(words), len(gone), digest) in got[doc_id], doc_id


def test_mixing_reaches_the_weights(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") < 3000, "big").otherwise(None).alias("source")
    )
    weights = spark.createDataFrame([("big", 1.0), (None, 3.0)], "source string, weight double")
    mixed = {r.source: r["count"] for r in mixing.mix(docs, weights).groupBy("source").count().collect()}
    assert abs(mixed["big"] - 1000) < 150 and abs(mixed[None] - 3000) < 250


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r.node: r.root for r in jaccard.components(edges, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100}


def test_pruning_keeps_what_may_reach_the_threshold():
    least = jaccard.least_matches(0.8, 1e-6)
    assert least == sorted(least) and least[128] < 0.8 * 128 and least[64] > 20


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, docs, FOLDER)
        assert kept.columns == (columns if name != "mixing" else [*columns, "copy"])
        if name == "near_duplicates":
            again = jaccard.near_duplicates(kept)
            assert again.filter("doc_id <> class_id").count() == 0
        if name == "decontamination":
            bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
            assert decontaminate.contamination(kept, bench).filter("n_hit > 0").count() == 0
        docs = spark.createDataFrame(kept.collect(), kept.schema)
