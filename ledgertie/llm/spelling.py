"""Spelling variants grouped under their common forms, by an index of variable-length grams.

Words are maximal runs of Latin letters that are frequent and long enough. Two words are
near if one insertion, deletion or replacement of a code point makes one the other. A
word's form is its most frequent near word, if that is much more frequent than itself;
forms are followed to their root.

Near words are found by a gram index. The dictionary holds every gram of two letters, and
a longer one only where the gram without its last letter is frequent, so that frequent
grams split into longer, rarer ones. At each place of a word the longest gram of the
dictionary counts, unless an earlier one covers it. One edit changes a bounded number of
a word's grams (``affected``), so of any more than that one is left over in every near
word: each word enters the lists of its rarest ``affected + 1`` grams. The edit then
lies behind a left-over gram, and all before it agrees, or before it, and all behind it
agrees; lists are therefore told apart by that agreeing side and by the word's length.
Lists are merged by a join that passes only verified pairs on. Words whose grams can all
be affected by one edit are listed under their rarest three bigrams as well, of which an
edit changes two; a pair of two such words meets there.

Counting reads whole texts as byte arrays: the CRC of each occurrence is the CRC of its
document's prefix, shifted by the length of the run, and that of the run.

Defined results: a null text has no words; a null id counts as an empty one; rows with
one id are documents of their own; runs of any length count; an empty table has no words.
Other columns are not read. The dictionary has at most ``92 ** 2 + 2 * 92 * HOT`` grams
at any size (letters, and a mark for either end), which bounds what tasks are sent.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgertie.llm.tables import id_and_text, materialise
from ledgertie.llm.text import BASE, BYTE_VALUES, chunks, span_hashes

MIN_CHARS = 6
MIN_COUNT = 5
RATIO = 5  # a form is at least so many times as frequent
ODDS = 199  # one occurrence in so many loses a letter
QMIN, QMAX = 2, 4
HOT = 2000  # at most so many frequent grams of each length
HELD_WORDS = 400_000  # distinct words that a task holds before it passes counts on
SHORT_BYTES = 64  # runs up to this length have their CRC combined, longer ones computed

WORD_COUNT = "word string, n long"
ENTRY = "word string, n long, size int, signs long, kind int, side string, gram int"


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


CRC_TABLE = _crc_table()


def _shifted(crcs: np.ndarray, most: int) -> np.ndarray:
    """Each CRC after 0, 1, ... ``most`` zero bytes, a row for each."""
    out = np.empty((len(crcs), most + 1), dtype=np.uint32)
    out[:, 0] = crcs
    for k in range(most):
        out[:, k + 1] = (out[:, k] >> 8) ^ CRC_TABLE[out[:, k] & 255]
    return out


def _runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of A-Z, a-z and U+00C0 to U+00FF (C3 80 to C3 BF)."""
    low = data | 0x20
    inside = ((low >= 0x61) & (low <= 0x7A)) | (data == 0xC3)
    inside[1:] |= data[:-1] == 0xC3
    borders = np.zeros(len(data) + 1, dtype=bool)
    borders[offsets] = True
    held = np.zeros(len(data) + 2, dtype=bool)
    held[1:-1] = inside
    starts = np.flatnonzero(held[1:] & (~held[:-1] | borders))
    ends = np.flatnonzero(held[:-1] & (~held[1:] | borders))
    return starts, ends


def chunk_counts(ids: list, data: np.ndarray, offsets: np.ndarray, least: int) -> Counter:
    """Words of ``least`` code points or more in a chunk of texts, as bytes, with their counts."""
    counts: Counter = Counter()
    starts, ends = _runs(data, offsets)
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    sizes = points[ends] - points[starts]
    long = sizes >= least
    starts, ends, sizes = starts[long], ends[long], sizes[long]
    if not len(starts):
        return counts
    upper = (data >= 65) & (data <= 90)
    folded = data + (upper * 32).astype(np.uint8)
    hashes = span_hashes(BYTE_VALUES[folded], starts, ends, BASE)
    _, first, word, total = np.unique(
        hashes, return_index=True, return_inverse=True, return_counts=True
    )
    text = folded.tobytes()
    spans = zip(starts[first].tolist(), ends[first].tolist(), strict=True)
    words = [text[start:end] for start, end in spans]
    docs = np.searchsorted(offsets, starts, side="right") - 1
    prefixes = [f"{'' if i is None else i}:".encode() for i in ids]
    befores = np.array([zlib.crc32(prefix) for prefix in prefixes], dtype=np.uint32)
    own = np.array([zlib.crc32(held) for held in words], dtype=np.uint32)
    lengths = ends - starts
    most = min(SHORT_BYTES, int(lengths.max()))
    table = _shifted(befores, most)
    crcs = table[docs, np.minimum(lengths, most)] ^ own[word]
    for at in np.flatnonzero(lengths > most).tolist():
        crcs[at] = zlib.crc32(words[word[at]], int(befores[docs[at]]))
    spoilt = np.flatnonzero(crcs % ODDS == 0)
    total -= np.bincount(word[spoilt], minlength=len(words))
    for held, n in zip(words, total.tolist(), strict=True):
        if n:
            counts[held] = n
    for at in spoilt.tolist():
        if sizes[at] > least:
            held = words[word[at]].decode()
            place = int(crcs[at]) % len(held)
            counts[(held[:place] + held[place + 1 :]).encode()] += 1
    return counts


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def passed() -> pa.RecordBatch:
        words = pa.array(list(held.keys()), pa.binary()).cast(pa.string())
        return pa.record_batch({"word": words, "n": pa.array(list(held.values()), pa.int64())})

    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        for row, end, data, offsets in chunks(batch):
            held.update(chunk_counts(ids[row:end], data, offsets, MIN_CHARS))
            if len(held) > HELD_WORDS:
                yield passed()
                held.clear()
    if held:
        yield passed()


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Frequent words of all texts with their counts (word, n)."""
    found = id_and_text(docs, id_col, text_col).mapInArrow(_counted, WORD_COUNT)
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)


def marked(word: str) -> str:
    """A word between marks of its ends, which are no letters."""
    return f"^{word}$"


@dataclass(frozen=True)
class Grams:
    """The dictionary: grams and how often the words have them."""

    counts: dict[str, int]

    @cached_property
    def heads(self) -> set[str]:
        """What longer grams begin with."""
        return {gram[:k] for gram in self.counts for k in range(1, len(gram))}

    @cached_property
    def tails(self) -> set[str]:
        """What longer grams end with."""
        return {gram[k:] for gram in self.counts for k in range(1, len(gram))}

    def of(self, text: str) -> list[tuple[int, int]]:
        """Start and end of the grams of a marked word; none lies inside another."""
        out, covered = [], 0
        for start in range(len(text) - QMIN + 1):
            end = start + QMIN
            while end < min(len(text), start + QMAX) and text[start : end + 1] in self.counts:
                end += 1
            if end > covered:
                out.append((start, end))
                covered = end
        return out

    def affected(self, text: str, spans: list[tuple[int, int]]) -> int:
        """The most grams that one edit of a marked word can change.

        An edit takes away no or one letter at ``a``. It changes the grams over that
        place; grams before it that could go on as longer ones; and grams behind it that
        a longer one, starting earlier, could cover.
        """
        most, last, starts = 0, len(text) - 1, [start for start, _ in spans]
        for a in range(1, last + 1):
            close = spans[bisect_left(starts, a - QMAX) : bisect_left(starts, a + QMAX)]
            for b in (a, a + 1) if a < last else (a,):
                n = 0
                for start, end in close:
                    if end <= a:
                        n += text[start:a] in self.heads
                    elif start >= b:
                        n += text[b:end] in self.tails
                    else:
                        n += 1
                most = max(most, n)
        return most

    def rarest(self, text: str, spans: list[tuple[int, int]], n: int) -> list[tuple[int, int]]:
        def order(span: tuple[int, int]) -> tuple:
            gram = text[span[0] : span[1]]
            return self.counts.get(gram, 0), gram, span

        return sorted(spans, key=order)[:n]

    def listed(self, word: str) -> Iterable[tuple[int, str, int]]:
        """The lists a word is in: kind, the side that agrees with its gram, the gram's length.

        Kinds 0 and 1 are for what lies before and behind a variable gram, 2 and 3 the
        same for bigrams.
        """
        text = marked(word)
        spans = self.of(text)
        changed = self.affected(text, spans)
        lists = [(0, span) for span in self.rarest(text, spans, changed + 1)]
        if changed >= len(spans):
            pairs = [(i, i + QMIN) for i in range(len(text) - QMIN + 1)]
            lists += [(2, span) for span in self.rarest(text, pairs, 3)]
        for kind, (start, end) in lists:
            yield kind, text[:end], end - start
            yield kind + 1, text[start:], end - start


def gram_dictionary(words: DataFrame) -> Grams:
    """The dictionary of the words' grams: those of two letters, and what frequent ones go on to."""
    text = F.concat(F.lit("^"), "word", F.lit("$"))
    starts = F.sequence(F.lit(1), F.length("text") - QMIN + 1)
    sizes = F.sequence(F.lit(QMIN), F.lit(QMAX))
    counted = (
        words.select(text.alias("text"))
        .select("text", F.explode(starts).alias("at"))
        .select("text", "at", F.explode(sizes).alias("size"))
        .filter(F.col("at") + F.col("size") - 1 <= F.length("text"))
        .groupBy(F.col("text").substr(F.col("at"), F.col("size")).alias("gram"))
        .agg(F.count("*").alias("n"))
    )
    counted = materialise(counted, "grams")
    total = counted.filter(F.length("gram") == QMIN).agg(F.sum("n")).first()[0] or 0
    frequent = counted.filter(F.col("n") > total // HOT).select(F.col("gram").alias("head"))
    head = F.expr("left(gram, length(gram) - 1)")
    longer = counted.filter(F.length("gram") > QMIN).join(frequent, head == F.col("head"))
    known = counted.filter(F.length("gram") == QMIN).unionByName(longer.drop("head"))
    return Grams({row["gram"]: row["n"] for row in known.toLocalIterator()})


def _entries(words: DataFrame, grams: Grams) -> DataFrame:
    """A row for each list a word is in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[str, list] = {name: [] for name in ("kind", "side", "gram")}
            at, sizes, signs = [], [], []
            for i, word in enumerate(batch.column("word").to_pylist()):
                seen = 0
                for letter in word:
                    seen |= 1 << (ord(letter) & 63)
                for listed in grams.listed(word):
                    for name, value in zip(rows, listed, strict=True):
                        rows[name].append(value)
                    at.append(i)
                    sizes.append(len(word))
                    signs.append(seen - (1 << 64) if seen >> 63 else seen)
            of = pa.array(at, pa.int32())
            yield pa.record_batch(
                {
                    "word": batch.column("word").take(of),
                    "n": batch.column("n").take(of),
                    "size": pa.array(sizes, pa.int32()),
                    "signs": pa.array(signs, pa.int64()),
                    "kind": pa.array(rows["kind"], pa.int32()),
                    "side": pa.array(rows["side"], pa.string()),
                    "gram": pa.array(rows["gram"], pa.int32()),
                }
            )

    return words.mapInArrow(run, ENTRY)


def near_words(words: DataFrame) -> DataFrame:
    """All pairs of near words, both ways (word, near, near_n)."""
    entries = materialise(_entries(words, gram_dictionary(words)), "entries")
    size = F.col("size")

    def key(size):
        return F.xxhash64("kind", "side", "gram", size)

    held = entries.select(
        key(size).alias("key"),
        F.col("word").alias("b"),
        F.col("n").alias("b_n"),
        F.col("signs").alias("b_signs"),
    )
    asked = entries.select(
        F.explode(F.array(key(size), key(size + 1))).alias("key"),
        F.col("word").alias("a"),
        F.col("n").alias("a_n"),
        F.col("signs").alias("a_signs"),
    )
    # one edit changes two letters at most; of two words of one length the lesser asks
    alike = F.bit_count(F.col("a_signs").bitwiseXOR(F.col("b_signs"))) <= 2
    once = (F.length("a") < F.length("b")) | (F.col("a") < F.col("b"))
    close = F.levenshtein("a", "b", 1) == 1
    pairs = asked.join(held, "key").filter(alike & once & close)
    pairs = pairs.select("a", "a_n", "b", "b_n").distinct()
    sides = F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")),
    )
    return pairs.select(F.inline(sides))


def _roots(forms: DataFrame) -> DataFrame:
    """The last of the forms that follow each other (word, root), from (word, form).

    Counts grow along the way by a factor, so ways are short and have an end; each round
    doubles the part of them that is known.
    """
    known = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = known.join(further, "root", "left")
        known = materialise(
            stepped.select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
            "roots",
        )
        if not known.agg(F.max("moved")).first()[0]:
            return known.select("word", "root")
        known = known.select("word", "root")


def spelling_variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: int = RATIO
) -> DataFrame:
    """Every frequent word of ``docs`` with its form and root.

    Returns word, form, root, n, n_near and form_n; form and form_n are null for a word
    that is its own root.
    """
    words = materialise(vocabulary(docs, id_col, text_col), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    has_form = -F.col("best")["less"] >= ratio * F.col("n")
    told = materialise(
        words.join(near, "word", "left").select(
            "word",
            F.when(has_form, F.col("best")["near"]).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(has_form, -F.col("best")["less"]).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(told.filter(F.col("form").isNotNull()))
    return told.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
