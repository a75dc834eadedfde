"""Personal data: fixed patterns, and further spans by a semi-Markov random field.

The base spans are the leftmost non-overlapping matches of four patterns that pass their
checks. A pattern takes all it can: a card number beside other digits, or after a number
it was joined to, fails as a whole. So stretches of digits and their separators are also
cut into segments by a semi-Markov conditional random field. Its features look at whole
segments (checksum, digits, grouping, sign, neighbours), and dynamic programming over
segments of bounded length chooses boundaries and types together. What it finds beside
the base spans is added; base spans always stay.

The weights are fitted by likelihood on a bounded sample of stretches, labelled by the
base spans in them. Defined results: null counts as empty; ids may be null or repeat;
positions are code points, ends exclusive; texts may be of any length; without a base
span to learn from nothing is added.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgertie.llm.tables import id_and_text

KINDS = ("email", "ip", "card", "phone")
# The domain of an email; the part before the @ is found by walking left from it.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
# A match never begins or ends inside a digit run, so runs are taken whole and only once.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
STRETCH = re.compile(r"[+(]?[0-9][0-9+(). -]{6,}[0-9]")
UNIT = re.compile(r"[0-9]+|[^0-9]")
MOST_UNITS = 37  # digit groups or separators in a segment: a card of 19 digits, one by one
SAMPLE = 400  # documents, at most, whose stretches fit the weights
ROUNDS = 60
FEATURES = 9
TYPES = ("ip", "card", "phone")
NUMBERS = (0, 1)  # types that begin with a digit
STARTS_OF = {"+": (2,)} | dict.fromkeys("(). -", ())  # types by first character
RESULT = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
    "base_sha256 string, spans string"
)


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    doubled = [2 * d - 9 if d > 4 else 2 * d for d in values[1::2]]
    return (sum(values[::2]) + sum(doubled)) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def valid(kind: str, text: str) -> bool:
    """The check of a pattern's match."""
    if kind == "ip":
        return all(len(p.lstrip("0")) < 4 and int(p[-4:]) <= 255 for p in text.split("."))
    digits = _digits(text)
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return 8 <= len(digits) <= 15


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the pattern: each has one @, so every @ is looked at once, from the left."""
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns by kind, then start."""
    found = [("email", *span) for span in emails(text)]
    for kind, pattern in (("ip", IP), ("card", CARD), ("phone", PHONE)):
        if kind == "phone" and "+" not in text:
            continue
        spans = (m.span() for m in pattern.finditer(text))
        found += [(kind, a, b) for a, b in spans if valid(kind, text[a:b])]
    return found


def units_of(stretch: str) -> list[tuple[int, int]]:
    return [m.span() for m in UNIT.finditer(stretch)]


def segment_features(stretch: str, start: int, end: int, kind: str) -> np.ndarray | None:
    """Features of a segment as one entity, None where the kind cannot look like that."""
    text = stretch[start:end]
    digits = _digits(text)
    if kind == "ip":
        shaped = IP.fullmatch(text) is not None
    elif kind == "card":
        shaped = len(digits) > 1 and CARD.fullmatch(text) is not None
    else:
        shaped = PHONE.fullmatch(text) is not None
    if not shaped:
        return None
    groups = [len(g) for g in re.findall("[0-9]+", text)]
    before, after = stretch[start - 1 : start], stretch[end : end + 1]
    return np.array(
        [
            1.0,
            valid(kind, text),
            not valid(kind, text),
            len(set(groups)) == 1,
            len(groups) > 1,
            len(digits) / 20,
            before in ("", " "),
            after in ("", " "),
            before == "." or after == "." or before == "-" or after == "-",
        ],
        dtype=float,
    )


class Lattice:
    """Segments of a short stretch to fit: (first unit, end unit, type, features); -1 is none."""

    def __init__(self, stretch: str):
        self.units = units_of(stretch)
        n = len(self.units)
        self.arcs = [(i, i + 1, -1, None) for i in range(n)]
        for i in range(n):
            for j in range(i + 1, min(n, i + MOST_UNITS) + 1):
                for t, kind in enumerate(TYPES):
                    held = segment_features(stretch, self.units[i][0], self.units[j - 1][1], kind)
                    if held is not None:
                        self.arcs.append((i, j, t, held))
        self.arcs.sort(key=lambda arc: arc[1])

    def scores(self, weights: np.ndarray) -> list[float]:
        return [0.0 if t < 0 else float(weights[t] @ held) for _, _, t, held in self.arcs]

    def slope(self, weights: np.ndarray, gold: set[tuple[str, int, int]]) -> np.ndarray:
        """Gradient of the log-likelihood of the segmentation ``gold``."""
        n, scores = len(self.units), self.scores(weights)
        ahead, behind = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
        ahead[0] = behind[n] = 0.0
        for (i, j, _, _), s in zip(self.arcs, scores, strict=True):
            ahead[j] = np.logaddexp(ahead[j], ahead[i] + s)
        by_start = sorted(zip(self.arcs, scores, strict=True), key=lambda x: -x[0][0])
        for (i, j, _, _), s in by_start:
            behind[i] = np.logaddexp(behind[i], behind[j] + s)
        slope = np.zeros_like(weights)
        for (i, j, t, held), s in zip(self.arcs, scores, strict=True):
            if t >= 0:
                span = (TYPES[t], self.units[i][0], self.units[j - 1][1])
                chance = np.exp(ahead[i] + s + behind[j] - ahead[n])
                slope[t] += ((span in gold) - chance) * held
        return slope


def best(stretch: str, weights: np.ndarray) -> list[tuple[str, int, int]]:
    """The segments of the best segmentation, as spans of ``stretch``.

    A segment spans at most MOST_UNITS units, so time and memory grow with the length.
    """
    units = units_of(stretch)
    top, back = [0.0], [(0, -1)]
    for j in range(1, len(units) + 1):
        end = units[j - 1][1]
        score, step = top[j - 1], (j - 1, -1)
        if stretch[end - 1].isdigit():
            for i in range(max(0, j - MOST_UNITS), j):
                start = units[i][0]
                for t in STARTS_OF.get(stretch[start], NUMBERS):
                    held = segment_features(stretch, start, end, TYPES[t])
                    if held is not None and top[i] + weights[t] @ held > score:
                        score, step = top[i] + float(weights[t] @ held), (i, t)
        top.append(score)
        back.append(step)
    at, found = len(units), []
    while at:
        i, t = back[at]
        if t >= 0:
            found.append((TYPES[t], units[i][0], units[at - 1][1]))
        at = i
    return found[::-1]


def stretches(text: str) -> Iterator[tuple[int, str]]:
    for m in STRETCH.finditer(text):
        yield m.start(), m.group()


def fit(texts: list[str]) -> np.ndarray:
    """Weights by gradient ascent over the stretches of ``texts``."""
    known = []
    for text in texts:
        base = base_spans(text)
        for start, stretch in stretches(text):
            if len(stretch) <= 200:
                inside = {(k, a - start, b - start) for k, a, b in base if k in TYPES}
                gold = {x for x in inside if 0 <= x[1] and x[2] <= len(stretch)}
                known.append((Lattice(stretch), gold))
    weights = np.zeros((len(TYPES), FEATURES))
    if not any(gold for _, gold in known):
        weights[:, 0] = -30.0
        return weights
    for turn in range(ROUNDS):
        slope = sum(lattice.slope(weights, gold) for lattice, gold in known) / len(known)
        weights += 4.0 / (1 + turn / 20) * (slope - 1e-3 * weights)
    return weights


def added_spans(
    text: str, base: list[tuple[str, int, int]], weights: np.ndarray
) -> list[tuple[str, int, int]]:
    """Spans of the best segmentations that no base span overlaps."""
    spans = {(a, b) for _, a, b in base}
    covered: list[list[int]] = []  # the union of the base spans
    for a, b in sorted(spans):
        if covered and a <= covered[-1][1]:
            covered[-1][1] = max(b, covered[-1][1])
        else:
            covered.append([a, b])
    starts = [a for a, _ in covered]
    found = []
    for start, stretch in stretches(text):
        if (start, start + len(stretch)) in spans:
            continue
        for kind, a, b in best(stretch, weights):
            a, b = a + start, b + start
            before = bisect_left(starts, b) - 1  # the last that begins before the end
            if before < 0 or covered[before][1] <= a:
                found.append((kind, a, b))
    return found


def _joined(spans: list[tuple[str, int, int]]) -> str:
    ordered = sorted(spans, key=lambda span: (KINDS.index(span[0]), span[1]))
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in ordered)


def _drawn(docs: DataFrame, sample: int) -> list[str]:
    """What surrounds the digit stretches of ``sample`` documents, drawn by hash.

    The least hashes are chosen first, so no text travels that is not drawn; rows with
    equal hashes are copies and count once.
    """
    keyed = docs.filter(F.col("text").rlike(r"[0-9][0-9 ().-]{6,}[0-9]")).select(
        F.xxhash64("doc_id", "text").alias("key"), "text"
    )
    least = keyed.select("key").distinct().orderBy("key").limit(sample).agg(F.max("key")).first()[0]
    part = r"regexp_extract_all(text, '.{0,40}[0-9][0-9+(). -]{6,}[0-9].{0,40}', 0)"
    chosen = keyed.filter(F.col("key") <= F.lit(least)).select(
        "key", F.concat_ws(" ", F.expr(part)).alias("part")
    )
    rows = chosen.groupBy("key").agg(F.min("part").alias("part")).orderBy("key").collect()
    return [row["part"] for row in rows]


def find_personal_data(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Base spans and all spans of each document (doc_id, text)."""
    docs = id_and_text(docs)
    texts = _drawn(docs, sample)
    weights = fit(texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                base = base_spans(text or "")
                every = base + added_spans(text or "", base, weights)
                counts = [sum(span[0] == kind for span in base) for kind in KINDS]
                digest = hashlib.sha256(_joined(base).encode()).hexdigest()
                rows.append((*counts, digest, _joined(every)))
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            cells = [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]
            names = [*(f"n_{kind}" for kind in KINDS), "base_sha256", "spans"]
            yield pa.record_batch([batch.column("doc_id"), *cells], ["doc_id", *names])

    return docs.mapInArrow(run, RESULT)
