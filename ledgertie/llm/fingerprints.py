"""Quartile bucket digests of documents, and of their edited texts.

The byte triplets of a text, three from every four bytes in a row, are hashed into 128
buckets. The digest holds for each bucket in which quarter of all buckets its count
lies, the length on a logarithmic scale, and two ratios of the quartiles. Two digests
differ by a bounded score: the distances of the buckets' quarters, as an average over
the buckets that either text uses, plus what length and ratios differ.

Defined results: null is the empty text, which has no triplets and is like itself only;
texts under three bytes differ by length alone; equal texts have equal digests. The next
document is the next in the order of id and text; ids may be null, which come first, or
repeat. Texts may be of any length; a single document is its own next one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgertie.llm.tables import constants, id_and_text, range_parts
from ledgertie.llm.text import CHUNK_BYTES

BUCKETS = 128
BOUND = 300  # the greatest difference
PART_ROWS = 4000
# which of four bytes in a row make up a triplet, and the odd multiplier of its hash
TRIPLETS = (
    ((0, 1, 2), 0x9E3779B1),
    ((0, 1, 3), 0x85EBCA77),
    ((0, 2, 3), 0xC2B2AE3D),
)
RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def bucket_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Triplet counts by bucket for texts whose bytes are ``data[offsets[i]:offsets[i + 1]]``."""
    texts = len(offsets) - 1
    counts = np.zeros(texts * BUCKETS, dtype=np.int64)
    if len(data) < 3:
        return counts.reshape(texts, BUCKETS)
    own = np.repeat(np.arange(texts, dtype=np.int32) * BUCKETS, np.diff(offsets))
    wide = data.astype(np.uint32)
    for places, multiplier in TRIPLETS:
        reach = places[2]
        if len(data) <= reach:
            continue
        n = len(data) - reach
        value = wide[:n] << 16
        value |= wide[places[1] : places[1] + n] << 8
        value |= wide[reach:]
        value += 1
        value *= np.uint32(multiplier)
        value ^= value >> 15
        value *= np.uint32(0x2C1B3C6D)
        bucket = (value >> 25).astype(np.int32) + own[:n]
        counts += np.bincount(bucket[own[:n] == own[reach:]], minlength=len(counts))
    return counts.reshape(texts, BUCKETS)


def quarters(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The quarter of each bucket, 0 to 3, and both ratios of the quartiles, 0 to 15."""
    held = np.sort(counts, axis=1)
    q1, q2, q3 = (held[:, BUCKETS * k // 4 - 1][:, None] for k in (1, 2, 3))
    codes = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    top = np.maximum(q3, 1)
    return codes.astype(np.uint8), np.hstack([q1 * 100 // top % 16, q2 * 100 // top % 16])


class Digests:
    """Digests of a run of texts as arrays."""

    def __init__(self, texts: list[bytes]):
        sizes = np.array([len(text) for text in texts], dtype=np.int64)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        parts, row = [], 0
        while row < len(texts):
            end = int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, side="right")) - 1
            end = max(row + 1, end)
            data = np.frombuffer(b"".join(texts[row:end]), np.uint8)
            parts.append(bucket_counts(data, offsets[row : end + 1] - offsets[row]))
            row = end
        counts = np.concatenate(parts) if parts else np.zeros((0, BUCKETS), np.int64)
        self.codes, self.ratios = quarters(counts)
        self.lengths = np.floor(np.log(sizes + 1.0) / np.log(1.3)).astype(np.int64)

    def names(self) -> list[str]:
        """Length code, ratios and quarters as hexadecimal digits."""
        packed = self.codes.reshape(-1, BUCKETS // 4, 4) << np.array([6, 4, 2, 0], np.uint8)
        body = packed.sum(axis=2).astype(np.uint8)
        heads = zip(self.lengths.tolist(), self.ratios.tolist(), strict=True)
        return [
            f"{length:02x}{a:x}{b:x}{row.tobytes().hex()}"
            for (length, (a, b)), row in zip(heads, body, strict=True)
        ]

    def likeness(self, rows: np.ndarray, other: Digests, others: np.ndarray) -> np.ndarray:
        """1 less the bounded difference of two digests, as a share of the bound."""
        mine, theirs = self.codes[rows].astype(np.int64), other.codes[others].astype(np.int64)
        apart = np.abs(mine - theirs)
        apart[apart == 3] = 6
        used = np.maximum(((mine > 0) | (theirs > 0)).sum(axis=1), 1)
        score = BUCKETS * apart.sum(axis=1) / used
        length = np.abs(self.lengths[rows] - other.lengths[others])
        score += np.where(length > 1, 12 * (length - 1), length)
        ratio = np.abs(self.ratios[rows] - other.ratios[others])
        ratio = np.minimum(ratio, 16 - ratio)
        score += np.where(ratio > 1, 12 * (ratio - 1), ratio).sum(axis=1)
        return 1.0 - np.minimum(score, BOUND) / BOUND


def _with_next(docs: DataFrame, part_rows: int) -> DataFrame:
    """Ranges of documents in order, each ending with the first ones of the next range."""
    parts = range_parts(docs, "doc_id", part_rows)
    placed = docs.withColumn("part", parts.column("doc_id"))
    least = placed.groupBy("part").agg(F.min(F.struct("doc_id")).getField("doc_id").alias("id"))
    firsts = dict(least.toLocalIterator())  # a row per range
    count = parts.count
    # ids without a value come first and lie in the first range
    no_id = firsts.get(0) is None
    known = constants([firsts.get(part) or 0 for part in range(count)], "long")
    first = F.col("doc_id") == F.element_at(known, F.col("part") + 1)
    if no_id:
        first = F.when(F.col("part") == 0, F.col("doc_id").isNull()).otherwise(first)
    before = F.pmod(F.col("part") + count - 1, F.lit(count))
    own = F.struct(F.col("part").alias("part"), F.lit(0).alias("follows"))
    also = F.struct(before.alias("part"), F.lit(1).alias("follows"))
    places = F.when(first, F.array(own, also)).otherwise(F.array(own))
    return (
        placed.select("doc_id", "text", F.explode(places).alias("place"))
        .select("place.part", "place.follows", "doc_id", "text")
        .repartitionById(count, "part")
        .sortWithinPartitions("part", "follows", "doc_id", "text")
    )


def _rows(run: list[tuple], following: str) -> pa.RecordBatch:
    """Results of consecutive documents, the last followed by ``following``."""
    texts = [text for _, text in run]
    edited = []
    for text, after in zip(texts, [*texts[1:], following], strict=True):
        half = len(text) // 2
        edited.append((text[: len(text) - half] + after[:half]).encode())
    plain = Digests([text.encode() for text in [*texts, following]])
    changed = Digests(edited)
    rows = np.arange(len(run))
    return pa.record_batch(
        {
            "doc_id": pa.array([doc_id for doc_id, _ in run], pa.int64()),
            "n_chars": pa.array([len(text) for text in texts], pa.int64()),
            "edited_sha256": [hashlib.sha256(text).hexdigest() for text in edited],
            "fingerprint": plain.names()[:-1],
            "edited_fingerprint": changed.names(),
            "near_edited": plain.likeness(rows, changed, rows),
            "near_next": plain.likeness(rows, plain, rows + 1),
        }
    )


def fingerprints(docs: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """Digests of each document (doc_id, text) and of its text edited with the next one's.

    The edited text has its last half of code points replaced by as many, or all, of the
    first ones of the next document by id; the last is followed by the first. Documents
    are dealt out by ranges of ids, so a text moves once; the driver learns the least id
    of each range.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            names = ("follows", "doc_id", "text")
            for follows, doc_id, text in zip(
                *(batch.column(name).to_pylist() for name in names), strict=True
            ):
                text = text or ""
                if held and (follows or size > CHUNK_BYTES):
                    yield _rows(held, text)
                    held, size = [], 0
                if not follows:
                    held.append((doc_id, text))
                    size += len(text)

    return _with_next(id_and_text(docs), part_rows).mapInArrow(run, RESULT)
