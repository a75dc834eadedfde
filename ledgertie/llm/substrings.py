"""Passages that an earlier document has too, found with fixed blocks as anchors.

A window of ``window`` words always holds one of the blocks of half that size into which
its document is cut without overlap. So the non-overlapping blocks of all documents are
the index, every rolling window of block size probes it, and each hit is extended: the
full windows around it are grouped by their words, and where the smallest document of
a group comes before the own one, the window is a repeat. Windows that overlap or touch
make up the maximal repeats, whose words go.

Two things keep this linear. Only windows whose least hash of a few words occurs in two
documents are indexed or probed; equal windows have equal least hashes, so no repeat is
lost. And hits never meet in pairs: documents are taken in chunks, a chunk sends each
hash once with its least document, and is told the least document of all chunks.

Words are runs of anything but blank, tab, newline, vertical tab, form feed and carriage
return. Defined results: a null text has no words; a document without id takes no part
and loses nothing; rows with one id count as one document, each judged by itself; texts
shorter than a window lose nothing; texts may be of any length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgertie.llm.tables import id_and_text, materialise
from ledgertie.llm.text import (
    BLANK_WORDS,
    WINDOW_BASE,
    Words,
    chunks,
    list_column,
    span_hashes,
    words_of,
)

WINDOW = 50
ANCHOR = 8  # words of which a window's least hash is taken
CHUNK_WORDS = 1_000_000
SCAN = "doc_id long, n_words long, sha256 string, anchors array<long>"
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _rolling_least(values: np.ndarray, size: int) -> np.ndarray:
    """The least of every ``size`` consecutive values."""
    span, least = 1, values
    while span * 2 <= size:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = size - span
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


class Windows:
    """All windows of a run of texts with the hashes of the blocks inside them."""

    def __init__(self, words: Words, window: int):
        self.words, self.window = words, window
        self.block = (window + 1) // 2
        anchor = min(ANCHOR, self.block)
        n = len(words.hashes)
        if n < window:
            self.starts = np.zeros(0, np.int64)
            return
        first = np.arange(n - anchor + 1)
        anchors = span_hashes(words.hashes, first, first + anchor, WINDOW_BASE + 64)
        least = _rolling_least(anchors, window - anchor + 1)
        last = words.firsts[1:][words.texts] - window
        self.starts = np.flatnonzero(np.arange(n) <= last)
        self.least = least[self.starts]

    def keep(self, chosen: np.ndarray) -> None:
        self.starts, self.least = self.starts[chosen], self.least[chosen]

    def blocks(self) -> np.ndarray:
        """Hashes of the rolling blocks from every word on that has enough words after it."""
        first = np.arange(len(self.words.hashes) - self.block + 1)
        return span_hashes(self.words.hashes, first, first + self.block, WINDOW_BASE)

    def probes(self) -> np.ndarray:
        """First words of all rolling blocks inside the windows."""
        marks = np.zeros(len(self.words.hashes) + 1, dtype=np.int64)
        np.add.at(marks, self.starts, 1)
        np.add.at(marks, self.starts + self.window - self.block + 1, -1)
        return np.flatnonzero(np.cumsum(marks)[:-1])

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Two independent hashes of each window's words."""
        ends = self.starts + self.window
        return tuple(
            span_hashes(self.words.hashes, self.starts, ends, WINDOW_BASE + step).view(np.int64)
            for step in (8, 32)
        )

    def covered(self, repeats: np.ndarray) -> np.ndarray:
        """For each word, whether one of the windows ``repeats`` covers it."""
        marks = np.zeros(len(self.words.hashes) + 1, dtype=np.int64)
        np.add.at(marks, repeats, 1)
        np.add.at(marks, repeats + self.window, -1)
        return np.cumsum(marks)[:-1] > 0


def _digest(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> str:
    held = data.tobytes()
    words = [held[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _scan(docs: DataFrame, window: int) -> DataFrame:
    """Number and digest of each document's words, and the least hashes of its windows."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in chunks(batch):
                words = words_of(data, offsets, BLANK_WORDS)
                windows = Windows(words, window)
                text = words.texts[windows.starts] if len(windows.starts) else windows.starts
                least = windows.least if len(text) else np.zeros(0, np.uint64)
                order = np.lexsort((least, text))
                text, least = text[order], least[order]
                fresh = np.ones(len(text), dtype=bool)
                fresh[1:] = (text[1:] != text[:-1]) | (least[1:] != least[:-1])
                text, least = text[fresh], least[fresh]
                bounds = np.searchsorted(text, np.arange(end - row + 1))
                cuts = zip(words.firsts[:-1].tolist(), words.firsts[1:].tolist(), strict=True)
                digests = [_digest(data, words.starts[a:b], words.ends[a:b]) for a, b in cuts]
                yield pa.record_batch(
                    {
                        "doc_id": batch.column("doc_id")[row:end],
                        "n_words": pa.array(words.counts),
                        "sha256": pa.array(digests, pa.string()),
                        "anchors": list_column(least.view(np.int64), bounds),
                    }
                )

    return materialise(docs.mapInArrow(scan, SCAN), "scanned")


def _grouped(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of a chunk's documents: ids, bytes and offsets of the texts."""
    ids = table["doc_id"].combine_chunks().to_numpy()
    for row, end, data, offsets in chunks(table):
        yield ids[row:end], data, offsets


def _held(table: pa.Table, name: str) -> np.ndarray:
    return np.sort(table[name].combine_chunks().to_numpy())


def _among(sought: np.ndarray, held: np.ndarray) -> np.ndarray:
    if not len(held):
        return np.zeros(len(sought), dtype=bool)
    return held[np.minimum(np.searchsorted(held, sought), len(held) - 1)] == sought


def _shared_windows(table: pa.Table, window: int) -> Iterator[tuple]:
    """Runs of documents with the windows whose least hash some other document has too."""
    shared = np.unique(table["anchors"].combine_chunks().flatten().to_numpy())
    for ids, data, offsets in _grouped(table):
        words = words_of(data, offsets, BLANK_WORDS)
        windows = Windows(words, window)
        if len(windows.starts):
            windows.keep(_among(windows.least.view(np.int64), shared))
        yield ids, data, words, windows


def _folded(keys: list[np.ndarray], docs: np.ndarray, flag: np.ndarray) -> list[np.ndarray]:
    """Per key its least document, whether it has others, and whether any is flagged."""
    order = np.lexsort((docs, *keys))
    keys, docs, flag = [key[order] for key in keys], docs[order], flag[order]
    fresh = np.ones(len(docs), dtype=bool)
    if len(docs):
        fresh[1:] = np.any([key[1:] != key[:-1] for key in keys], axis=0)
    first = np.flatnonzero(fresh)
    last = np.concatenate([first[1:], [len(docs)]])[: len(first)] - 1
    seen = np.logical_or.reduceat(flag, first) if len(first) else flag
    return [*(key[first] for key in keys), docs[first], docs[first] < docs[last], seen]


def _blocks(window: int):
    """Every probe of a chunk, once: its documents' range, and whether a block is equal."""

    def blocks(key: tuple, table: pa.Table) -> pa.Table:
        hashes, docs, aligned = [], [], []
        for ids, _, words, windows in _shared_windows(table, window):
            if not len(windows.starts):
                continue
            probes = windows.probes()
            hashes.append(windows.blocks()[probes].view(np.int64))
            docs.append(ids[words.texts[probes]])
            aligned.append(words.places[probes] % windows.block == 0)
        joined = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (hashes, docs)]
        flag = np.concatenate(aligned) if aligned else np.zeros(0, bool)
        block, low, more, seen = _folded(joined[:1], joined[1], flag)
        chunk = np.full(len(block), key[0].as_py())
        names = {"chunk": chunk, "block": block, "low": low, "more": more, "indexed": seen}
        return pa.table(names)

    return blocks


def _windows(window: int):
    """The full windows around the hits of a chunk."""

    def extend(key: tuple, table: pa.Table, hits: pa.Table) -> pa.Table:
        hit = _held(hits, "block")
        firsts, seconds, docs = [], [], []
        for ids, _, words, windows in _shared_windows(table, window):
            if not len(windows.starts):
                continue
            marks = _among(windows.blocks().view(np.int64), hit)
            around = np.concatenate([[0], np.cumsum(marks)])
            reach = windows.starts + window - windows.block + 1
            windows.keep(around[reach] > around[windows.starts])
            first, second = windows.hashes()
            firsts.append(first)
            seconds.append(second)
            docs.append(ids[words.texts[windows.starts]])
        empty = np.zeros(0, np.int64)
        keys = [np.concatenate(x) if x else empty for x in (firsts, seconds)]
        docs = np.concatenate(docs) if docs else empty
        first, second, low, more, _ = _folded(keys, docs, np.zeros(len(docs), bool))
        chunk = np.full(len(first), key[0].as_py())
        names = {"chunk": chunk, "first": first, "second": second, "low": low, "more": more}
        return pa.table(names)

    return extend


def _removals(window: int):
    """The documents of a chunk without the words of their repeats."""

    def remove(key: tuple, table: pa.Table, repeats: pa.Table) -> pa.Table:
        known = np.rec.fromarrays(
            [repeats[n].combine_chunks().to_numpy() for n in ("first", "second", "low")],
            names="first,second,low",
        )
        known = known[np.argsort(known["first"], kind="stable")]
        rows = []
        for ids, data, words, windows in _shared_windows(table, window):
            covered = np.zeros(len(words.hashes), dtype=bool)
            if len(windows.starts) and len(known):
                first, second = windows.hashes()
                place = np.searchsorted(known["first"], first)
                found = np.zeros(len(first), dtype=bool)
                # equal first hashes lie side by side; almost always there is one
                pending = np.arange(len(first))
                while len(pending):
                    at = place[pending]
                    inside = at < len(known)
                    pending, at = pending[inside], at[inside]
                    alike = known["first"][at] == first[pending]
                    pending, at = pending[alike], at[alike]
                    own = ids[words.texts[windows.starts[pending]]]
                    same = known["second"][at] == second[pending]
                    found[pending[same & (known["low"][at] < own)]] = True
                    pending = pending[~same]
                    place[pending] += 1
                covered = windows.covered(windows.starts[found])
            for i, doc_id in enumerate(ids.tolist()):
                a, b = words.firsts[i], words.firsts[i + 1]
                kept = ~covered[a:b]
                digest = _digest(data, words.starts[a:b][kept], words.ends[a:b][kept])
                rows.append((doc_id, int(b - a), int(b - a - kept.sum()), digest))
        names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
        kinds = [pa.int64()] * 3 + [pa.string()]
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        return pa.table(
            {n: pa.array(list(c), k) for n, c, k in zip(names, columns, kinds, strict=True)}
        )

    return remove


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, chunk_words: int = CHUNK_WORDS
) -> DataFrame:
    """Per document (doc_id, text) its number of words, of removed ones, and what is left.

    A word is removed if a window of ``window`` words that covers it also starts in
    a document with a smaller id.
    """
    docs = id_and_text(docs)
    scanned = _scan(docs, window)
    anchors = scanned.filter(F.col("doc_id").isNotNull()).select(
        "doc_id", F.explode("anchors").alias("anchor")
    )
    shared = (
        anchors.groupBy("anchor")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        .filter(F.col("low") < F.col("high"))
        .select("anchor")
    )
    flagged = materialise(
        anchors.join(shared, "anchor", "left_semi")
        .groupBy("doc_id")
        .agg(F.collect_set("anchor").alias("anchors")),
        "flagged",
    )
    clean = scanned.join(flagged, "doc_id", "left_anti").select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"),
        F.col("sha256").alias("kept_sha256"),
    )
    held = scanned.join(flagged.select("doc_id"), "doc_id", "left_semi")
    total = held.agg(F.sum("n_words")).first()[0] or 0
    chunk = F.pmod(F.xxhash64("doc_id"), F.lit(total // chunk_words + 1)).alias("chunk")
    chosen = materialise(docs.join(flagged, "doc_id").select("*", chunk), "chosen")

    probes = chosen.groupBy("chunk").applyInArrow(
        _blocks(window), "chunk long, block long, low long, more boolean, indexed boolean"
    )
    hits = _told(probes, "block").filter("indexed")
    full = chosen.groupBy("chunk").cogroup(hits.groupBy("told")).applyInArrow(
        _windows(window), "chunk long, first long, second long, low long, more boolean"
    )
    repeats = _told(full, "first", "second")
    removed = chosen.groupBy("chunk").cogroup(repeats.groupBy("told")).applyInArrow(
        _removals(window), RESULT
    )
    return clean.unionByName(removed)


def _told(found: DataFrame, *keys: str) -> DataFrame:
    """Keys that two documents have, with the least one, for each chunk that has them.

    A chunk has a key once, so a window holds at most as many rows as there are chunks.
    """
    alike = Window.partitionBy(*keys)
    marks = {"indexed": F.max("indexed").over(alike)} if "indexed" in found.columns else {}
    known = found.withColumns(
        {
            "least": F.min("low").over(alike),
            "most": F.max("low").over(alike),
            "more": F.max("more").over(alike),
            **marks,
        }
    )
    shared = known.filter(F.col("more") | (F.col("least") < F.col("most")))
    return shared.select(*keys, F.col("least").alias("low"), F.col("chunk").alias("told"), *marks)
