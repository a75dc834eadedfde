"""Benchmark passages in training text, by a positional inverted index.

The index is stored as segments of whole documents, each of about a million words: a
row per segment and term with the documents and positions of the term, and a row with
the segment's document ids and lengths. A phrase can only occur inside a segment, so
a lookup needs no posting list as a whole: the lists of the benchmark's terms meet
segment by segment, where each phrase starts from its rarest term's list and drops
positions, list by list, that the other terms do not follow at their offsets.

Words are runs of ASCII letters and digits and of everything beyond ASCII, with A-Z
lower-cased. Defined results: a null or empty text has no words; rows with equal or
null ids are documents of their own, one result each; an item of fewer words than a
window is one window, an item without words none; items with equal ids count once, a
null item id counts as the empty string. Texts may be of any length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgertie.llm.tables import id_and_text, materialise
from ledgertie.llm.text import (
    PLAIN_WORDS,
    binary_column,
    chunks,
    list_column,
    sorted_bounds,
    words_of,
)

WINDOW = 10
SEGMENT_WORDS = 1_000_000
INDEX = "segment string, term long, n long, ids array<long>, docs binary, positions binary"
FOUND = (
    "doc_id long, n_words long, n_hit long, n_items long, items array<string>, "
    "spans array<struct<start: long, end: long>>"
)


def _segment(name: str, parts: list) -> pa.RecordBatch:
    """Rows of a segment: its documents, then each term's postings by document and place."""
    ids = pa.concat_arrays([part[0] for part in parts])
    lengths = np.concatenate([part[1] for part in parts]).astype(np.int32)
    terms = np.concatenate([part[2] for part in parts]).view(np.int64)
    bases = np.cumsum([0] + [len(part[0]) for part in parts[:-1]])
    pairs = zip(bases, parts, strict=True)
    docs = np.concatenate([base + part[3] for base, part in pairs]).astype(np.int32)
    places = np.concatenate([part[4] for part in parts]).astype(np.int32)
    order = np.argsort(terms, kind="stable")
    terms = terms[order]
    bounds = sorted_bounds(terms)
    listed = [0, len(ids)]
    numbers = np.arange(len(ids), dtype=np.int32)
    rows = len(bounds)
    term = pa.concat_arrays([pa.nulls(1, pa.int64()), pa.array(terms[bounds[:-1]])])
    first = pa.ListArray.from_arrays(pa.array(listed, pa.int32()), ids)
    return pa.record_batch(
        {
            "segment": pa.array([name] * rows),
            "term": term,
            "n": pa.array(np.concatenate([[len(ids)], np.diff(bounds)])),
            "ids": pa.concat_arrays([first, pa.nulls(rows - 1, first.type)]),
            "docs": pa.concat_arrays(
                [binary_column(numbers, np.array(listed)), binary_column(docs[order], bounds)]
            ),
            "positions": pa.concat_arrays(
                [binary_column(lengths, np.array(listed)), binary_column(places[order], bounds)]
            ),
        }
    )


def build_index(docs: DataFrame, segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """The stored positional index of all of ``docs`` (doc_id, text); see the module text."""

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        parts, held, made = [], 0, 0
        for batch in batches:
            ids = batch.column("doc_id")
            for row, end, data, offsets in chunks(batch):
                words = words_of(data, offsets, PLAIN_WORDS)
                parts.append(
                    (ids[row:end], words.counts, words.hashes, words.texts, words.places)
                )
                held += len(words.hashes) + (end - row)
                if held >= segment_words:
                    yield _segment(f"{task}-{made}", parts)
                    parts, held, made = [], 0, made + 1
        if parts:
            yield _segment(f"{task}-{made}", parts)

    return materialise(id_and_text(docs).mapInArrow(segments, INDEX), "postings")


def phrases(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """All windows of the items (item_id, text): item, phrase number, terms in order."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        made = 0
        for batch in batches:
            for row, end, data, offsets in chunks(batch):
                words = words_of(data, offsets, PLAIN_WORDS)
                short = np.minimum(words.counts, window)
                n = np.where(words.counts > 0, words.counts - short + 1, 0)
                item = np.repeat(np.arange(end - row), n)
                place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                sizes = short[item]
                bounds = np.concatenate([[0], np.cumsum(sizes)])
                inside = np.arange(bounds[-1]) - np.repeat(bounds[:-1], sizes)
                taken = np.repeat(words.firsts[item] + place, sizes) + inside
                numbers = made + np.arange(len(item))
                made += len(item)
                yield pa.record_batch(
                    {
                        "item": batch.column("item")[row:end].take(pa.array(item)),
                        "phrase": pa.array([f"{task}-{i}" for i in numbers]),
                        "terms": list_column(words.hashes[taken].view(np.int64), bounds),
                    }
                )

    named = items.select(
        F.coalesce(items["item_id"].cast("string"), F.lit("")).alias("item"),
        items["text"].cast("string").alias("text"),
    )
    schema = "item string, phrase string, terms array<long>"
    return materialise(named.mapInArrow(cut, schema), "phrases")


def rarest_first(cut: DataFrame, index: DataFrame) -> DataFrame:
    """Phrases with their terms as (total postings, offset, term), the rarest first.

    A phrase with a term that no document has cannot occur and is left out.
    """
    terms = cut.select("item", "phrase", F.posexplode("terms").alias("place", "term"))
    wanted = terms.select("term").distinct()
    counts = index.filter(F.col("term").isNotNull()).select("term", "n")
    counts = counts.join(wanted, "term", "left_semi").groupBy("term").agg(F.sum("n").alias("n"))
    listed = terms.join(counts, "term", "left").groupBy("item", "phrase")
    ordered = listed.agg(
        F.array_sort(F.collect_list(F.struct("n", "place", "term"))).alias("terms"),
        F.count(F.when(F.col("n").isNull(), 1)).alias("unseen"),
    )
    return ordered.filter(F.col("unseen") == 0).drop("unseen")


def _lists(postings: pa.Table) -> tuple[dict[int, np.ndarray], list]:
    """Term positions as ``document << 32 | place``, and the segment's ids and lengths."""
    lists, documents = {}, []
    rows = zip(
        postings["term"].to_pylist(),
        postings["docs"].to_pylist(),
        postings["positions"].to_pylist(),
        strict=True,
    )
    for row, (term, docs, places) in enumerate(rows):
        if term is None:
            ids = postings["ids"][row].as_py()
            documents = list(zip(ids, np.frombuffer(places, np.int32).tolist(), strict=True))
        else:
            # places are moved up, so that an offset never reaches the document before
            held = np.frombuffer(docs, np.int32).astype(np.int64) << 32
            lists[term] = held + np.frombuffer(places, np.int32) + (1 << 30)
    return lists, documents


def _among(sought: np.ndarray, held: np.ndarray) -> np.ndarray:
    place = np.minimum(np.searchsorted(held, sought), len(held) - 1)
    return held[place] == sought


def exact_starts(terms: list[dict], lists: dict[int, np.ndarray]) -> np.ndarray:
    """Starts of a phrase, from its rarest term's list through all others."""
    starts = None
    for term in terms:
        held = lists.get(term["term"])
        if held is None:
            return np.zeros(0, np.int64)
        if starts is None:
            starts = held - term["place"]
        else:
            starts = starts[_among(starts + term["place"], held)]
        if not len(starts):
            break
    return starts


def near_spans(
    terms: list[dict], lists: dict[int, np.ndarray], most: int
) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the spans of at most ``most`` words that hold a phrase's words.

    Words may be in any order; a word that the phrase has several times is needed as often.
    Spans are the shortest ones: none holds another, so each begins and ends with a word of
    the phrase. Only words near one of the rarest term are looked at.
    """
    wanted: dict[int, int] = {}
    for term in terms:
        wanted[term["term"]] = wanted.get(term["term"], 0) + 1
    none = np.zeros(0, np.int64)
    if any(len(lists.get(term, none)) < times for term, times in wanted.items()):
        return none, none
    rarest = lists[next(iter(wanted))]
    around = []
    for term in wanted:
        held = lists[term]
        after = rarest[np.minimum(np.searchsorted(rarest, held), len(rarest) - 1)] - held
        around.append(held[(after >= 0) & (after < most)])
    starts = np.unique(np.concatenate(around))
    ends = starts
    for term, times in wanted.items():
        held = lists[term]
        place = np.searchsorted(held, starts) + times - 1
        inside = place < len(held)
        starts, ends, place = starts[inside], ends[inside], place[inside]
        ends = np.maximum(ends, held[place])
        near = ends - starts < most
        starts, ends = starts[near], ends[near]
    # ends never fall as starts rise, so of the spans with one end the last is the shortest
    shortest = np.append(ends[1:] != ends[:-1], True)[: len(ends)]
    return starts[shortest], ends[shortest] + 1


def _result(documents: list, found: list[tuple[str, np.ndarray, np.ndarray]]) -> pa.Table:
    """A row per document of the segment from (item, span starts, span ends)."""
    spans: dict[int, list] = {}
    items: dict[int, set] = {}
    for item, starts, ends in found:
        for doc in np.unique(starts >> 32).tolist():
            items.setdefault(doc, set()).add(item)
        for start, size in zip(starts.tolist(), (ends - starts).tolist(), strict=True):
            place = (start & 0xFFFFFFFF) - (1 << 30)
            spans.setdefault(start >> 32, []).append((place, place + size))
    rows = []
    for number, (doc_id, n_words) in enumerate(documents):
        merged: list[dict] = []
        for start, end in sorted(set(spans.get(number, ()))):
            if merged and start <= merged[-1]["end"]:
                merged[-1]["end"] = max(end, merged[-1]["end"])
            else:
                merged.append({"start": start, "end": end})
        named = sorted(items.get(number, ()))
        n_hit = sum(span["end"] - span["start"] for span in merged)
        rows.append((doc_id, n_words, n_hit, len(named), named, merged))
    names = ["doc_id", "n_words", "n_hit", "n_items", "items", "spans"]
    span = pa.struct({"start": pa.int64(), "end": pa.int64()})
    kinds = [pa.int64()] * 4 + [pa.list_(pa.string()), pa.list_(span)]
    columns = list(zip(*rows, strict=True)) or [[]] * 6
    return pa.table(
        {n: pa.array(list(c), k) for n, c, k in zip(names, columns, kinds, strict=True)}
    )


def lookup(index: DataFrame, cut: DataFrame, slop: int | None = None) -> DataFrame:
    """Every document of the index with its number of words and what was found in it.

    ``items`` are the ids of items with an occurring phrase, ``spans`` the words covered
    and ``n_hit`` their number. Without ``slop`` a phrase occurs where its words follow
    each other exactly; with it, where all its words, each as often as in the phrase, lie
    within its own length plus ``slop`` words, in any order.

    Only lists of the phrases' terms leave the index, and a phrase goes only to the
    segments that have its rarest term.
    """
    ranked = materialise(rarest_first(cut, index), "ranked")
    terms = ranked.select(F.explode("terms.term").alias("term")).distinct()
    lists = index.filter(F.col("term").isNotNull()).join(terms, "term", "left_semi")
    postings = lists.unionByName(index.filter(F.col("term").isNull()))
    places = index.filter(F.col("term").isNotNull()).select("segment", "term")
    asked = ranked.withColumn("term", F.col("terms")[0]["term"])
    asked = asked.join(places, "term").select(
        F.col("segment").alias("asked"), "item", "terms"
    )

    def match(held: pa.Table, wanted: pa.Table) -> pa.Table:
        lists, documents = _lists(held)
        found = []
        items, asked_terms = wanted["item"].to_pylist(), wanted["terms"].to_pylist()
        for item, ordered in zip(items, asked_terms, strict=True):
            if slop is None:
                starts = exact_starts(ordered, lists)
                ends = starts + len(ordered)
            else:
                starts, ends = near_spans(ordered, lists, len(ordered) + slop)
            if len(starts):
                found.append((item, starts, ends))
        return _result(documents, found)

    return (
        postings.groupBy("segment")
        .cogroup(asked.groupBy("asked"))
        .applyInArrow(match, FOUND)
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    slop: int | None = None,
    segment_words: int = SEGMENT_WORDS,
) -> DataFrame:
    """Index ``docs`` (doc_id, text) and look up all windows of ``items`` (item_id, text)."""
    return lookup(build_index(docs, segment_words), phrases(items, window), slop)


def report(found: DataFrame) -> DataFrame:
    """Digest of the found items per document."""
    listed = F.array_join("items", ",")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(listed.cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
