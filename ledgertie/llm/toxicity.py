"""Toxicity by two Kneser-Ney models, one of toxic and one of ordinary documents.

Both are bigram models over words with absolute discounting, always interpolated. A
bigram backs off to the word's frequency in the class, and that to continuation counts
that the classes share: in how many different contexts a word occurs in any document,
labelled or not. Discounts are n1 / (n1 + 2 n2) of each class's own counts of counts. A
document's log-likelihoods are divided by its length and compared, over all words and
over those alone that speak strongly for toxic text; a logistic curve turns the
differences into a score.

Words and bigrams are told apart by 64-bit hashes, and their counts are tables that grow
with the input. Documents are packed into chunks of whole texts. A chunk asks the bigram
table, cut by hash, for its distinct bigrams, then the word table for its words; each
answer holds the counts of the whole input. So no task holds the model, and no bigram
travels more than once per chunk. The chunks are stored in buckets and stay there.

All labelled rows count, the held-out ones apart. A bounded sample of them fits the
curve, each document's own counts taken out of what it is compared with, so the curve
sees likelihoods of unseen documents. It weighs strong words at several levels.

Labels are taken from rows whose crc32 of the id is not 2 modulo 4. Defined results: null
counts as empty; a text without words gets the score of no evidence; rows with a null id
are scored and never learned from; of several labels of one id the greatest counts; with
no labels of one kind every score is the share of toxic ones, or 0. Texts may be of any
length.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgertie.llm.tables import materialise
from ledgertie.llm.text import PLAIN_WORDS, chunks, mix, words_of
from ledgertie.sources.session import scratch_path

FOLDS, HELD_OUT = 4, 2
CHUNK_WORDS = 2_000_000
PART_WORDS = 2_000_000  # the tables are cut into a part for about so many words of text
SLICE = 200_000  # words of a chunk that are scored at a time, which bounds a task's memory
BUCKETS = 128
ROUNDS = 4  # the bigram table is made in so many, each of which frees its shuffle
CURVE_ROWS = 20_000  # labelled rows, at most about, that fit the curve
STRONG = (1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0)  # from which a word is evidence by itself
THRESHOLD = 0.3
START = np.uint64(1)  # the word before a text's first
PAIRS, SINGLES, SUMS = 0, 1, -1
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
CHUNK = (
    "chunk long, size long, ids array<long>, counts binary, toxic binary, drawn binary, "
    "words binary, sequence binary"
)
ASKED = "part int, chunk long, keys binary, counts binary"
ANSWER = "chunk long, kind int, part int, held binary"
SEEN = "row long, n long, mean double, strong array<double>, toxic int, own array<double>"


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))


def _packed(values: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, compressed."""
    return zlib.compress(values.ravel().view(np.uint8).reshape(values.size, -1).T.tobytes(), 1)


def _unpacked(cell: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(cell), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(kind).ravel()


def _matrix(cell: bytes, rows: int) -> np.ndarray:
    return _unpacked(cell, np.int64).reshape(rows, -1)


def _chunk(name: int, parts: list) -> pa.RecordBatch:
    """A row of whole documents: each word as its rank by frequency among the chunk's words."""
    ids, toxic, drawn, counts, hashes = zip(*parts, strict=True)
    counts = np.concatenate(counts).astype(np.int64)
    words, places, times = np.unique(
        np.concatenate(hashes), return_inverse=True, return_counts=True
    )
    order = np.argsort(-times, kind="stable")
    rank = np.empty(len(words), np.int32)
    rank[order] = np.arange(len(words), dtype=np.int32)
    ids = pa.concat_arrays(ids)
    row = {
        "chunk": pa.array([name], pa.int64()),
        "size": pa.array([len(places)], pa.int64()),
        "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
    }
    packed = {
        "counts": counts,
        "toxic": np.concatenate(toxic),
        "drawn": np.concatenate(drawn),
        "words": words[order],
        "sequence": rank[places],
    }
    return pa.record_batch(row | {k: pa.array([_packed(v)], pa.binary()) for k, v in packed.items()})


def _chunked(docs: DataFrame) -> DataFrame:
    """All documents (row, text, toxic, drawn) in chunks; toxic is -1 without a label."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            toxic, drawn = (
                batch.column(k).to_numpy(zero_copy_only=False).astype(np.int8)
                for k in ("toxic", "drawn")
            )
            for row, end, data, offsets in chunks(batch):
                words = words_of(data, offsets, PLAIN_WORDS)
                ids = batch.column("row")[row:end]
                held.append((ids, toxic[row:end], drawn[row:end], words.counts, words.hashes))
                size += len(words.hashes) + end - row
                if size >= CHUNK_WORDS:
                    yield _chunk(name, held)
                    name, held, size = name + 1, [], 0
        if held:
            yield _chunk(name, held)

    return docs.mapInArrow(pack, CHUNK)


@dataclass
class Chunk:
    """A chunk's documents, its distinct words and bigrams, and where each word has its own.

    Words are in the order of their hashes, the one before a text's first among them.
    """

    ids: pa.Array
    counts: np.ndarray
    toxic: np.ndarray
    drawn: np.ndarray
    words: np.ndarray
    word: np.ndarray
    before: np.ndarray
    keys: np.ndarray  # distinct bigrams, sorted
    pair: np.ndarray

    @classmethod
    def of(cls, row: pa.Table | pa.RecordBatch, at: int = 0) -> Chunk:
        def column(name: str, kind: type) -> np.ndarray:
            return _unpacked(row[name][at].as_py(), kind)

        counts = column("counts", np.int64)
        words, places = np.unique(
            np.concatenate([column("words", np.uint64), [START]]), return_inverse=True
        )
        places = places.astype(np.int32)
        word = places[column("sequence", np.int32)]
        before = np.empty_like(word)
        before[1:] = word[:-1]
        before[(np.cumsum(counts) - counts)[counts > 0]] = places[-1]
        keys, pair = np.unique(mix(mix(words[before]) + words[word]), return_inverse=True)
        return cls(
            row["ids"][at].values,
            counts,
            column("toxic", np.int8),
            column("drawn", np.int8),
            words,
            word,
            before,
            keys,
            pair.astype(np.int32),
        )

    @property
    def texts(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def by_class(self, places: np.ndarray, size: int) -> list[np.ndarray]:
        """How often each place occurs in ordinary and in toxic documents."""
        kind = self.toxic[self.texts]
        return [np.bincount(places[kind == k], minlength=size) for k in (0, 1)]

    def asks(
        self, name: int, keys: np.ndarray, told: list, bits: int, turn: int = 0, turns: int = 1
    ) -> pa.RecordBatch:
        """A row per part with the sorted ``keys`` of this chunk in it, and what it tells.

        Only of the parts whose turn it is.
        """
        told = np.stack(told).astype(np.int64)
        part = (keys >> np.uint64(64 - bits)).astype(np.int64)
        bounds = np.searchsorted(part, np.arange((1 << bits) + 1))
        rows = np.flatnonzero(np.diff(bounds))
        rows = rows[rows % turns == turn]
        cut = [slice(bounds[r], bounds[r + 1]) for r in rows]
        steps = np.diff(keys, prepend=np.uint64(0))
        steps[bounds[rows]] = keys[bounds[rows]]  # a part begins with a whole key
        return pa.record_batch(
            {
                "part": pa.array(rows.astype(np.int32)),
                "chunk": pa.array([name] * len(rows), pa.int64()),
                "keys": pa.array([_packed(steps[x]) for x in cut], pa.binary()),
                "counts": pa.array([_packed(told[:, x]) for x in cut], pa.binary()),
            }
        )


def _ask_pairs(stored: DataFrame, bits: int, turn: int) -> DataFrame:
    """Each chunk's distinct bigrams with their counts of either class."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, name in enumerate(batch.column("chunk").to_pylist()):
                held = Chunk.of(batch, at)
                told = held.by_class(held.pair, len(held.keys))
                yield held.asks(name, held.keys, told, bits, turn, ROUNDS)

    return stored.mapInArrow(ask, ASKED)


def _ask_words(stored: DataFrame, pairs: DataFrame, bits: int) -> DataFrame:
    """Each chunk's words with what it adds to their rows of the word table.

    These are, of either class, the word's count, its count as a history and its number
    of followers, and the number of its contexts. A bigram adds to the last two in the
    first chunk that has it.
    """

    def ask(row: pa.Table, answers: pa.Table) -> pa.Table:
        held = Chunk.of(row)
        size = len(held.words)
        seen = _answers(answers, PAIRS, 3)
        first = np.empty(len(held.keys), np.int64)
        first[held.pair] = np.arange(len(held.pair))  # a place where each bigram occurs
        before, word, new = held.before[first], held.word[first], seen[2] > 0
        followers = [np.bincount(before[new & (seen[k] > 0)], minlength=size) for k in (0, 1)]
        told = [
            *held.by_class(held.word, size),
            *held.by_class(held.before, size),
            *followers,
            np.bincount(word[new], minlength=size),
        ]
        asked = held.asks(row["chunk"][0].as_py(), held.words, told, bits)
        return pa.Table.from_batches([asked])

    both = stored.groupBy("chunk").cogroup(pairs.groupBy("chunk"))
    return both.applyInArrow(ask, ASKED)


def _answers(table: pa.Table, kind: int, rows: int) -> np.ndarray:
    """What the parts told a chunk, in the order of its keys."""
    held = [
        (part, cell)
        for part, cell, k in zip(
            table["part"].to_pylist(),
            table["held"].to_pylist(),
            table["kind"].to_pylist(),
            strict=True,
        )
        if k == kind
    ]
    told = [_matrix(cell, rows) for _, cell in sorted(held)]
    return np.concatenate(told, axis=1) if told else np.zeros((rows, 0), np.int64)


def _added(table: pa.Table, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
    """Sums of the counts of each distinct key, each asked key's place, and its chunk's rows."""
    keys = [np.cumsum(_unpacked(x, np.uint64), dtype=np.uint64) for x in table["keys"].to_pylist()]
    counts = [_matrix(x, rows) for x in table["counts"].to_pylist()]
    ends = np.cumsum([0] + [len(x) for x in keys])
    order = np.argsort(table["chunk"].to_numpy(), kind="stable")  # so that the first is told alike
    distinct, first, places = np.unique(
        np.concatenate([keys[i] for i in order]), return_index=True, return_inverse=True
    )
    counts = np.concatenate([counts[i] for i in order], axis=1)
    sums = np.stack([np.bincount(places, c, len(distinct)) for c in counts]).astype(np.int64)
    ends = np.cumsum([0] + [len(keys[i]) for i in order])
    cut = [
        (table["chunk"][int(i)].as_py(), slice(a, b))
        for i, a, b in zip(order, ends[:-1], ends[1:], strict=True)
    ]
    return sums, first, places, cut


def _ones_and_twos(counts: np.ndarray) -> list[int]:
    return [int((counts == n).sum()) for n in (1, 2)]


def _told(part: int, kind: int, cut: list, told: np.ndarray, sums: list[int]) -> pa.Table:
    """A row per chunk that asked, and one of sums over the part's distinct keys."""
    cells = [_packed(np.ascontiguousarray(told[:, x])) for _, x in cut]
    n = len(cut) + 1
    return pa.table(
        {
            "chunk": pa.array([*(name for name, _ in cut), SUMS], pa.int64()),
            "kind": pa.array([kind] * n, pa.int32()),
            "part": pa.array([part] * n, pa.int32()),
            "held": pa.array([*cells, _packed(np.array(sums, np.int64))], pa.binary()),
        }
    )


def _merge_pairs(key: tuple, table: pa.Table) -> pa.Table:
    """A part of the bigram table: counts of both classes, and who has a bigram first."""
    sums, first, places, cut = _added(table, 2)
    new = np.zeros(len(places), np.int64)
    new[first] = 1
    told = np.concatenate([sums[:, places], new[None, :]])
    return _told(
        key[0].as_py(), PAIRS, cut, told, [*_ones_and_twos(sums[0]), *_ones_and_twos(sums[1])]
    )


def _merge_words(key: tuple, table: pa.Table) -> pa.Table:
    """A part of the word table; see ``_ask_words``."""
    sums, _, places, cut = _added(table, 7)
    totals = [
        *_ones_and_twos(sums[0]),
        *_ones_and_twos(sums[1]),
        *(int(x.sum()) for x in sums[:2]),
        *(int((x > 0).sum()) for x in sums[:2]),
        int(sums[6].sum()),
        int((sums[6] > 0).sum()),
    ]
    return _told(key[0].as_py(), SINGLES, cut, sums[:, places], totals)


def _sums(answers: DataFrame) -> np.ndarray:
    rows = answers.filter(F.col("chunk") == SUMS).select("held").toLocalIterator()
    return sum(_unpacked(row["held"], np.int64) for row in rows)


def discount(ones: int, twos: int) -> float:
    """The share of a count that absolute discounting takes away, from counts of counts."""
    return ones / (ones + 2 * twos) if ones and twos else 0.5


@dataclass
class Model:
    """Discounts and totals; in arrays, class 0 is ordinary, class 1 toxic."""

    pair_discounts: list[float]
    word_discounts: list[float]
    totals: list[int]
    kinds: list[int]  # distinct words of each class
    contexts: int
    vocabulary: int

    @classmethod
    def of(cls, pairs: np.ndarray, words: np.ndarray) -> Model:
        def discounts(told: np.ndarray) -> list[float]:
            return [discount(int(a), int(b)) for a, b in told[:4].reshape(2, 2)]

        ends = (words[4:6], words[6:8])
        totals, kinds = ([int(x) for x in held] for held in ends)
        return cls(discounts(pairs), discounts(words), totals, kinds, int(words[8]), int(words[9]))

    def differences(
        self, seen: list, word: list, history: list, followers: list, contexts: np.ndarray
    ) -> np.ndarray:
        """Log-likelihood of words after others, toxic less ordinary, from the counts of each."""
        shared = (contexts + 1) / (self.contexts + self.vocabulary + 1)
        logs = []
        for k in (0, 1):
            rest = self.word_discounts[k] * self.kinds[k] / self.totals[k]
            single = np.maximum(word[k] - self.word_discounts[k], 0) / self.totals[k]
            single = single + rest * shared
            total = np.maximum(history[k], 1)
            back = np.where(history[k] > 0, self.pair_discounts[k] * followers[k] / total, 1)
            chance = np.maximum(seen[k] - self.pair_discounts[k], 0) / total + back * single
            logs.append(np.log(chance))
        return logs[1] - logs[0]


def _differences(
    held: Chunk, pairs: np.ndarray, words: np.ndarray, model: Model
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log-likelihood of each word after the one before it, toxic less ordinary.

    Also the words of the drawn documents, and their differences without the document's
    own counts. The classes' totals and discounts keep them, which is a document in many.
    """
    word, before, pair = held.word, held.before, held.pair
    classes = (0, 1)

    def between(start: int) -> np.ndarray:
        w, b, p = (places[start : start + SLICE] for places in (word, before, pair))
        return model.differences(
            [pairs[k][p] for k in classes],
            [words[k][w] for k in classes],
            [words[2 + k][b] for k in classes],
            [words[4 + k][b] for k in classes],
            words[6][w],
        )

    apart = np.empty(len(word))
    for start in range(0, len(word), SLICE):
        apart[start : start + SLICE] = between(start)
    texts = held.texts
    at = np.flatnonzero(held.drawn[texts] > 0)
    word, before, pair, texts = word[at], before[at], pair[at], texts[at]
    if not len(at):
        return apart, at, apart[at]

    def own(places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        _, first, back, n = np.unique(
            texts * np.int64(size) + places,
            return_index=True,
            return_inverse=True,
            return_counts=True,
        )
        return n[back], first

    size = len(held.words)
    own_pair, first = own(pair, len(held.keys))
    own_word, own_history = own(word, size)[0], own(before, size)[0]
    kind = held.toxic[texts]
    # bigrams of the class that are this document's alone, by document and history
    total = np.where(kind == 1, pairs[1][pair], pairs[0][pair])
    alone = first[total[first] == own_pair[first]]
    place = texts * np.int64(size) + before
    names, back = np.unique(place, return_inverse=True)
    lost = np.bincount(np.searchsorted(names, place[alone]), minlength=len(names))[back]
    mine = [kind == k for k in classes]
    own_apart = model.differences(
        [pairs[k][pair] - own_pair * mine[k] for k in classes],
        [words[k][word] - own_word * mine[k] for k in classes],
        [words[2 + k][before] - own_history * mine[k] for k in classes],
        [words[4 + k][before] - lost * mine[k] for k in classes],
        words[6][word],
    )
    return apart, at, own_apart


def _evidence(stored: DataFrame, answers: DataFrame, model: Model) -> DataFrame:
    """Per document its number of words and its differences by length: all, the strong.

    Drawn documents also have them without their own counts, the first of ``own`` over
    all words, and their label.
    """

    def run(row: pa.Table, told: pa.Table) -> pa.Table:
        held = Chunk.of(row)
        pairs, words = _answers(told, PAIRS, 3), _answers(told, SINGLES, 7)
        apart, at, own = _differences(held, pairs, words, model)
        texts, n = held.texts, len(held.counts)

        def means(values: np.ndarray, texts: np.ndarray) -> np.ndarray:
            return np.bincount(texts, values, n) / np.maximum(held.counts, 1)

        def strong(values: np.ndarray, texts: np.ndarray) -> list[np.ndarray]:
            return [means(np.where(values > least, values, 0.0), texts) for least in STRONG]

        mean, several = means(apart, texts), np.stack(strong(apart, texts), axis=1)
        alone = np.stack([means(own, texts[at]), *strong(own, texts[at])], axis=1)
        drawn = held.drawn > 0
        columns = {
            "row": held.ids,
            "n": held.counts,
            "mean": mean,
            "strong": list(several),
            "toxic": pa.array(held.toxic.astype(np.int32), mask=~drawn),
            "own": [x if d else None for x, d in zip(alone, drawn, strict=True)],
        }
        kinds = {"strong": pa.list_(pa.float64()), "own": pa.list_(pa.float64())}
        return pa.table({k: pa.array(v, kinds.get(k)) for k, v in columns.items()})

    both = stored.groupBy("chunk").cogroup(answers.groupBy("chunk"))
    return both.applyInArrow(run, SEEN)


def features(n, mean, strong: list, functions) -> list:
    """What the curve sees of documents, as arrays or as columns, by their ``functions``.

    Both differences, the strong ones at every level, also by the length and its root.
    """
    root, log, least = functions
    told = [mean, log(n)]
    for level, held in zip(STRONG, strong, strict=True):
        told += [held, held * root(n), log(held * n), least(held * n, 2.5 * level)]
    return told


def curve(x: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression, by Newton steps with a small ridge."""
    scale = np.maximum(np.abs(x).max(axis=0, initial=0.0), 1e-9)
    x, weights = x / scale, np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (toxic - p) - 1e-2 * weights
        bend = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(x.shape[1])
        step = np.linalg.solve(bend, slope)
        weights += step / max(1.0, np.abs(step).max() / 4)
    return weights / scale


def _stored(docs: DataFrame) -> tuple[DataFrame, str]:
    """The chunks in buckets, so that they are not moved to meet their answers."""
    name = f"toxicity_chunks_{uuid.uuid4().hex}"
    path = scratch_path(docs.sparkSession, "chunks")
    writer = _chunked(docs).write.bucketBy(BUCKETS, "chunk").option("compression", "zstd")
    writer.option("path", path).format("parquet").saveAsTable(name)
    return docs.sparkSession.table(name), name


def score_toxicity(docs: DataFrame, labels: DataFrame, key: str | None = None) -> DataFrame:
    """Score each document (doc_id, text) by what ``labels`` (doc_id, toxic) mark.

    Returns doc_id, held_out, score and predicted. Labels, languages, sources and ids are
    no part of a score. With ``key``, a column of numbers that tells rows apart, the result
    has that in place of doc_id and held_out.
    """
    row = docs[key or "doc_id"].cast("long").alias("row")
    docs = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"), row
    )
    marks = labels.select(
        labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("int").alias("toxic")
    )
    marks = marks.filter(F.col("toxic").isin(0, 1) & (fold(F.col("doc_id")) != HELD_OUT))
    marks = marks.groupBy("doc_id").agg(F.max("toxic").cast("byte").alias("toxic"))
    marks = materialise(marks.sort("doc_id"), "marks")
    n_marks, prior = marks.agg(F.count("*"), F.avg("toxic")).first()
    share = min(1.0, CURVE_ROWS / max(1, n_marks))
    draw = F.pmod(F.xxhash64(docs["doc_id"]), F.lit(1 << 30)) < int(share * (1 << 30))
    marked = docs.join(marks, "doc_id", "left").select(
        "row",
        "text",
        F.coalesce("toxic", F.lit(-1).cast("byte")).alias("toxic"),
        (F.col("toxic").isNotNull() & draw).alias("drawn"),
    )
    spark = docs.sparkSession
    stored, name = _stored(marked)
    freed = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        seen = _seen(stored)
    finally:
        spark.conf.set(CLEANUP, freed)
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    out = F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False))
    if seen is None:
        scored = docs.select("row", F.lit(float(prior or 0.0)).alias("score"))
    else:
        sample = seen.filter(F.col("own").isNotNull()).select("n", "own", "toxic").toPandas()
        n, toxic = (sample[k].to_numpy(float) for k in ("n", "toxic"))
        own = np.array(sample["own"].tolist(), float).reshape(len(n), 1 + len(STRONG))
        x = features(n, own[:, 0], list(own[:, 1:].T), (np.sqrt, np.log1p, np.minimum))
        weights = curve(np.column_stack([np.ones(len(n)), *x]), toxic)
        strong = [F.col("strong")[i] for i in range(len(STRONG))]
        native = (F.sqrt, F.log1p, lambda value, most: F.least(value, F.lit(most)))
        x = features(F.col("n").cast("double"), F.col("mean"), strong, native)
        sense = F.lit(float(weights[0]))
        for w, told in zip(weights[1:], x, strict=True):
            sense = sense + F.lit(float(w)) * told
        score = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), sense))))
        scored = seen.select("row", score.alias("score"))
    scored = scored.withColumnRenamed("row", key or "doc_id").withColumn(
        "predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0)
    )
    told = [key] if key else ["doc_id", out.alias("held_out")]
    return scored.select(*told, "score", "predicted")


def _seen(stored: DataFrame) -> DataFrame | None:
    """The evidence of every document, or nothing without labelled words of both kinds."""
    size = stored.agg(F.sum("size")).first()[0] or 0
    bits = max(3, (size // PART_WORDS).bit_length())

    def merged(asked: DataFrame, merge, name: str) -> DataFrame:
        return materialise(asked.groupBy("part").applyInArrow(merge, ANSWER), name)

    pairs = merged(_ask_pairs(stored, bits, 0), _merge_pairs, "pairs")
    for turn in range(1, ROUNDS):
        pairs = pairs.unionByName(merged(_ask_pairs(stored, bits, turn), _merge_pairs, "pairs"))
    chunked = pairs.filter(F.col("chunk") != SUMS)
    words = merged(_ask_words(stored, chunked, bits), _merge_words, "words")
    model = Model.of(_sums(pairs), _sums(words)) if size else None
    if model is None or not all(model.totals):
        return None
    answers = chunked.unionByName(words.filter(F.col("chunk") != SUMS))
    return materialise(_evidence(stored, answers, model), "evidence")
