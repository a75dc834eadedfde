"""Quality scores by histogram gradient-boosted trees over document statistics.

Every text is told by a few dozen statistics of the whole of it: sizes, kinds of
characters, lengths of words and lines, and how much of it repeats. The trees are grown
level by level on histograms: statistics are cut into bins at quantiles, and gradients
are summed per node, statistic and bin. They are flattened into arrays of statistic,
threshold, children and value, through which numpy takes whole batches of documents at
a time, all trees at once.

Labels of the rows whose id's CRC leaves ``HELD_OUT`` are never read, and no label,
language, source or id is part of a score. The trees are fitted on a sample of labelled
rows drawn by a hash of their numbers, about ``FIT_ROWS`` at most; statistics are taken
of, and scores given to, all documents.

Defined results: a null text counts as empty, whose statistics are all 0; a null id is
in no fold and has no label; rows with one id are scored each for itself; of several
labels of one id the greatest counts, others than 0 and 1 do not; without labels of both
kinds every score is the labels' mean, or 0.5 without any. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgertie.llm.tables import materialise
from ledgertie.llm.text import BASE, BLANK_WORDS, BYTE_VALUES, chunks, mix, span_hashes, words_of

FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.5
FIT_ROWS = 60_000  # labelled rows that fit the trees, about and at most
BINS = 64
TREES, DEPTH, RATE = 80, 4, 0.2
LEAST_WEIGHT, RIDGE = 2.0, 1.0  # of a node, in sums of second derivatives

STATISTICS = [
    "bytes", "words", "lines", "word_mean", "word_spread", "word_longest", "line_mean",
    "letters", "upper", "digits", "blanks", "stops", "symbols", "beyond_ascii", "kinds", "entropy",
    "symbol_ends", "upper_words", "short_words", "letterless_words", "stopped_words",
    "distinct_words", "commonest_word", "stuttered_words", "distinct_pairs", "distinct_lines",
    "stopped_lines",
]


def _class(held: bytes | range) -> np.ndarray:
    inside = np.zeros(256, dtype=bool)
    inside[list(held)] = True
    return inside


UPPER, LOWER, DIGIT = _class(range(65, 91)), _class(range(97, 123)), _class(range(48, 58))
BLANK, STOP, FAR = _class(b" \t\n\r\x0b\x0c"), _class(b".,;:!?"), _class(range(128, 256))
SYMBOL = ~(UPPER | LOWER | DIGIT | BLANK | STOP | FAR)
LETTER = UPPER | LOWER | FAR


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _within(held: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many of each span's bytes are ``held``."""
    sums = np.concatenate([[0], np.cumsum(held)])
    return sums[ends] - sums[starts]


def _repeats(hashes: np.ndarray, texts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text, how many of its hashes are distinct, and how often it has the commonest."""
    if not len(hashes):
        return np.zeros(n), np.zeros(n)
    own = mix(hashes + texts.astype(np.uint64) * np.uint64(BASE))
    _, first, counts = np.unique(own, return_index=True, return_counts=True)
    of = texts[first]
    most = np.zeros(n)
    np.maximum.at(most, of, counts)
    return np.bincount(of, minlength=n), most


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The statistics of each text ``data[offsets[i]:offsets[i + 1]]``, a row for each."""
    n, starts, ends = len(offsets) - 1, offsets[:-1], offsets[1:]
    size = ends - starts
    words = words_of(data, offsets, BLANK_WORDS)
    count, length = words.counts, words.ends - words.starts

    def per_text(values: np.ndarray, texts: np.ndarray) -> np.ndarray:
        return np.bincount(texts, values, n)

    def of_words(values: np.ndarray) -> np.ndarray:
        return _share(per_text(values, words.texts), count)

    def of_bytes(held: np.ndarray) -> np.ndarray:
        return _share(_within(held[data], starts, ends), size)

    mean = of_words(length)
    spread = np.sqrt(np.maximum(of_words(length.astype(float) ** 2) - mean**2, 0))
    longest = np.zeros(n)
    np.maximum.at(longest, words.texts, length)
    letters = _within(LETTER[data], starts, ends)
    text_of = np.repeat(np.arange(n), size)
    seen = np.zeros((n, 256))
    np.add.at(seen.reshape(-1), text_of * 256 + data, 1)
    part = seen / np.maximum(size, 1)[:, None]
    entropy = -(part * np.log2(np.where(part > 0, part, 1))).sum(axis=1)

    final = data[words.ends - 1] if len(words.ends) else np.zeros(0, np.uint8)
    in_letters = _within(LETTER[data], words.starts, words.ends)
    in_upper = _within(UPPER[data], words.starts, words.ends)
    distinct, most = _repeats(words.hashes, words.texts, n)
    next_to = (words.texts[1:] == words.texts[:-1]) if count.sum() else np.zeros(0, bool)
    again = np.zeros(len(words.hashes))
    again[1:] = next_to & (words.hashes[1:] == words.hashes[:-1])
    first, pairs = words.windows(2)
    distinct_pairs, _ = _repeats(pairs, words.texts[first], n)

    breaks = np.flatnonzero(data == 10)
    line_starts = np.sort(np.concatenate([starts, breaks + 1]))
    line_ends = np.sort(np.concatenate([ends, breaks]))
    line_of = np.searchsorted(offsets, line_starts, side="right") - 1
    line_of = np.minimum(line_of, n - 1)
    full = line_ends > line_starts
    line_starts, line_ends, line_of = line_starts[full], line_ends[full], line_of[full]
    lines = np.bincount(line_of, minlength=n)
    line_hashes = span_hashes(BYTE_VALUES[data], line_starts, line_ends, BASE)
    distinct_lines, _ = _repeats(line_hashes, line_of, n)
    stopped = STOP[data[line_ends - 1]] if len(line_ends) else np.zeros(0, bool)

    columns = [
        np.log1p(size), np.log1p(count), np.log1p(lines), mean, spread, np.log1p(longest),
        np.log1p(_share(size, lines)),
        of_bytes(LETTER), _share(_within(UPPER[data], starts, ends), letters), of_bytes(DIGIT),
        of_bytes(BLANK), of_bytes(STOP), of_bytes(SYMBOL), of_bytes(FAR),
        (seen > 0).sum(axis=1), entropy,
        of_words(SYMBOL[final]), of_words((in_upper == in_letters) & (in_letters > 1)),
        of_words(length <= 3), of_words(in_letters == 0), of_words(STOP[final]),
        _share(distinct, count), _share(most, count), of_words(again),
        _share(distinct_pairs, np.maximum(count - 1, 0)), _share(distinct_lines, lines),
        _share(per_text(stopped, line_of), lines),
    ]
    return np.column_stack(columns).astype(np.float32)


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, end, data, offsets in chunks(batch):
            held = statistics(data, offsets)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(held.reshape(-1)), held.shape[1])
            ids = batch.column("doc_id").slice(row, end - row)
            told = lists.cast(pa.list_(pa.float32()))
            yield pa.record_batch({"doc_id": ids, "told": told})


@dataclass(frozen=True)
class Forest:
    """Trees in flat arrays; a leaf is its own child, so all ways are ``DEPTH`` steps long."""

    base: float
    roots: np.ndarray  # a node for each tree
    statistic: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def senses(self, x: np.ndarray) -> np.ndarray:
        """The log odds of each row of statistics."""
        node = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        rows = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            low = x[rows, self.statistic[node]] <= self.threshold[node]
            node = np.where(low, self.left[node], self.right[node])
        return self.base + self.value[node].sum(axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _edges(x: np.ndarray) -> list[np.ndarray]:
    """Where each statistic is cut: between distinct values, at quantiles if they are many."""
    cuts = []
    for column in x.T:
        held = np.unique(np.quantile(column, np.linspace(0, 1, BINS), method="nearest"))
        cuts.append(((held[1:] + held[:-1]) / 2).astype(np.float32)[: BINS - 1])
    return cuts


def _best_splits(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per node of (node, statistic, bin) sums: gain, statistic and last bin to the left."""
    gl, hl = g.cumsum(axis=2), h.cumsum(axis=2)
    gt, ht = gl[:, :1, -1:], hl[:, :1, -1:]
    gr, hr = gt - gl, ht - hl
    gain = gl**2 / (hl + RIDGE) + gr**2 / (hr + RIDGE) - gt**2 / (ht + RIDGE)
    gain = np.where((hl >= LEAST_WEIGHT) & (hr >= LEAST_WEIGHT), gain, -1.0)
    flat = gain.reshape(len(g), -1)
    best = flat.argmax(axis=1)
    return flat[np.arange(len(g)), best], best // g.shape[2], best % g.shape[2]


def fit(x: np.ndarray, y: np.ndarray) -> Forest:
    """Trees for the log odds that ``y`` is 1, from rows of statistics."""
    cuts = _edges(x)
    wide = x.shape[1]
    bins = np.column_stack([np.searchsorted(c, column) for c, column in zip(cuts, x.T, strict=True)])
    cells = bins + np.arange(wide) * BINS
    mean = y.mean()
    base = float(np.log(mean / (1 - mean)))
    sense = np.full(len(y), base)
    roots, statistic, threshold, left, right, value = [], [], [], [], [], []

    def grown() -> int:
        for column, held in ((statistic, 0), (threshold, np.inf), (value, 0.0)):
            column.append(held)
        left.append(len(value) - 1)
        right.append(len(value) - 1)
        return len(value) - 1

    for _ in range(TREES):
        p = _sigmoid(sense)
        gradient, weight = p - y, np.maximum(p * (1 - p), 1e-9)
        level, place = [grown()], np.zeros(len(y), dtype=np.int64)  # place: within the level
        roots.append(level[0])
        own = np.full(len(y), level[0])
        for _ in range(DEPTH):
            inside = place >= 0
            at = (place[inside, None] * (wide * BINS) + cells[inside]).reshape(-1)
            shape, size = (len(level), wide, BINS), len(level) * wide * BINS
            g = np.bincount(at, np.repeat(gradient[inside], wide), size).reshape(shape)
            h = np.bincount(at, np.repeat(weight[inside], wide), size).reshape(shape)
            gain, of, last = _best_splits(g, h)
            below, side = [], np.full((len(level), 2), -1)
            for i, node in enumerate(level):
                if gain[i] <= 1e-6 or last[i] >= len(cuts[of[i]]):
                    continue
                statistic[node], threshold[node] = int(of[i]), float(cuts[of[i]][last[i]])
                left[node], right[node] = grown(), grown()
                side[i] = len(below), len(below) + 1
                below += [left[node], right[node]]
            if not below:
                break
            rows = np.flatnonzero(inside)
            here = place[rows]
            over = (bins[rows, of[here]] > last[here]).astype(int)
            place[rows] = side[here, over]
            moved = place >= 0
            own[moved] = np.array(below)[place[moved]]
            level = below
        g, h = (np.bincount(own, held, len(value)) for held in (gradient, weight))
        for node in np.unique(own):
            value[node] = float(-RATE * g[node] / (h[node] + RIDGE))
        sense += np.array(value)[own]
    kinds = (np.int64, np.int64, np.float64, np.int64, np.int64, np.float64)
    held = (roots, statistic, threshold, left, right, value)
    return Forest(base, *(np.array(a, kind) for a, kind in zip(held, kinds, strict=True)))


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> DataFrame:
    """Score each document by what ``labels`` (its id and a label of 0 or 1) mark.

    Returns doc_id, held_out, score and predicted.
    """
    marks = labels.select(
        labels[id_col].cast("long").alias("of"), labels[label_col].cast("int").alias("label")
    )
    marks = marks.filter(F.col("label").isin(0, 1) & (fold(F.col("of")) != HELD_OUT))
    marks = marks.groupBy("of").agg(F.max("label").alias("label"))
    texts = docs.select(
        docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")
    )
    told = texts.mapInArrow(_told, "doc_id long, told array<float>")
    told = materialise(told.withColumn("row", F.monotonically_increasing_id()), "statistics")
    marked = materialise(
        told.select("row", "doc_id").join(marks, F.col("doc_id") == F.col("of")).select("row", "label"),
        "marked",
    )
    rows, mean = marked.agg(F.count("*"), F.avg("label")).first()
    if mean is None or mean in (0.0, 1.0):
        score = F.lit(0.5 if mean is None else mean)
        scored = told.select("doc_id", score.alias("score"))
    else:
        share = int(min(1.0, FIT_ROWS / rows) * (1 << 30))
        drawn = marked.filter(F.pmod(F.xxhash64("row"), F.lit(1 << 30)) < share)
        sample = told.join(drawn, "row").select("row", "told", "label").toArrow().sort_by("row")
        x = np.array(sample["told"].to_pylist(), dtype=np.float32).reshape(-1, len(STATISTICS))
        scored = _scored(told, fit(x, sample["label"].to_numpy().astype(float)))
    out = F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False))
    return scored.select(
        "doc_id",
        out.alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def _scored(told: DataFrame, forest: Forest) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("told").flatten().to_numpy().reshape(-1, len(STATISTICS))
            score = pa.array(_sigmoid(forest.senses(x)))
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "score": score})

    return told.select("doc_id", "told").mapInArrow(run, "doc_id long, score double")
