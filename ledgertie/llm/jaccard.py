"""Near-duplicate documents: an exact Jaccard join with Bayesian pruning of candidates.

A document is the set of its runs of five words. Documents with equal sets are one
class from the start. Classes whose MinHash signatures agree in a band are candidates;
a candidate's signatures are compared a few values at a time, and it is dropped as soon
as the posterior probability that its similarity reaches the threshold falls below a
tolerance. What is left is verified on the sets themselves.

Candidates are compared inside their band's bucket, and a large bucket is cut into
blocks that are compared two by two, so no task holds a bucket as a whole. A pair that
shares several bands counts in the first alone. Pairs are never written: a comparison
gives per document its number of links, and a tree of links that keeps connected
documents connected. Components of those trees are the groups of near-duplicates.

Words are runs of ASCII letters and digits and of everything beyond ASCII, with A-Z
lower-cased; fewer than five words are one shingle. Defined results: texts without words
are alike only if they are equal, and null counts as empty; rows with equal or null ids
are documents of their own; a group's id is its least document id, null if it has none;
texts may be of any length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgertie.llm.tables import id_and_text, materialise
from ledgertie.llm.text import PLAIN_WORDS, Words, binary_column, chunks, mix, words_of

SHINGLE = 5
THRESHOLD = 0.8
HASHES, ROWS = 128, 4  # 32 bands of 4 values: of pairs at 0.8, one in 20 million is missed
STEP = 16  # signature values compared at a time
TOLERANCE = 1e-6
BLOCK = 512
PAIRS = 200_000  # pairs compared at a time in a task
MULTIPLIERS = mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)
ADDENDS = mix(np.arange(HASHES + 1, 2 * HASHES + 1, dtype=np.uint64))
SCAN = "doc_id long, digest binary, signature binary"
SETS = "digest binary, shingles binary"
PLACE = ["bucket", "low", "high"]
LINKED = "digest binary, links long, root binary"


def least_matches(threshold: float, tolerance: float) -> list[int]:
    """After n compared values, the fewest matches that keep a pair, by n.

    With every similarity equally likely beforehand, m matches among n values leave
    P(similarity >= t) = P(Binomial(n + 1, t) <= m).
    """
    least = []
    for n in range(HASHES + 1):
        below, m = 0.0, -1
        while below < tolerance:
            m += 1
            below += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        least.append(m)
    return least


def shingles_of(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, and where each text's begin."""
    first, hashes = words.windows(size)
    texts = words.texts[first]
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    if len(short):
        few = [_whole(words, i) for i in short.tolist()]
        hashes = np.concatenate([hashes, np.array(few, dtype=np.uint64)])
        texts = np.concatenate([texts, short])
    order = np.lexsort((hashes, texts))
    hashes, texts = hashes[order], texts[order]
    fresh = np.ones(len(hashes), dtype=bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (texts[1:] != texts[:-1])
    hashes, texts = hashes[fresh], texts[fresh]
    return hashes, np.searchsorted(texts, np.arange(len(words.counts) + 1))


def _whole(words: Words, text: int) -> int:
    held = words.hashes[words.firsts[text] : words.firsts[text + 1]]
    return int.from_bytes(hashlib.blake2b(held.tobytes(), digest_size=8).digest(), "little")


def signatures(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """MinHash values of each set; a row of the greatest value for an empty one."""
    rows = np.full((len(bounds) - 1, HASHES), 0xFFFFFFFF, dtype=np.uint32)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        held = np.empty_like(hashes)
        for k in range(HASHES):
            np.multiply(hashes, MULTIPLIERS[k], out=held)
            np.add(held, ADDENDS[k], out=held)
            rows[full, k] = np.minimum.reduceat(held, bounds[:-1][full]) >> np.uint64(32)
    return rows


def _digest(held: bytes, kind: bytes) -> bytes:
    return hashlib.blake2b(held, digest_size=16, person=kind).digest()


def _sets(batch: pa.RecordBatch, size: int) -> Iterator[tuple]:
    """Runs of a batch: first and end row, digests, shingles and their bounds."""
    for row, end, data, offsets in chunks(batch):
        words = words_of(data, offsets, PLAIN_WORDS)
        hashes, bounds = shingles_of(words, size)
        digests = [
            _digest(hashes[a:b].tobytes(), b"set") if b > a else _digest(data[c:d], b"text")
            for a, b, c, d in zip(bounds[:-1], bounds[1:], offsets[:-1], offsets[1:], strict=True)
        ]
        yield row, end, pa.array(digests, pa.binary()), hashes, bounds


def _scan(docs: DataFrame, size: int) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, digests, hashes, bounds in _sets(batch, size):
                full = np.diff(bounds) > 0
                signed = signatures(hashes, bounds).ravel()
                cells = binary_column(signed, np.arange(end - row + 1) * HASHES)
                none = pa.nulls(end - row, pa.binary())
                yield pa.record_batch(
                    {
                        "doc_id": batch.column("doc_id")[row:end],
                        "digest": digests,
                        "signature": pc.if_else(pa.array(full), cells, none),
                    }
                )

    return materialise(docs.mapInArrow(scan, SCAN), "signatures")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, HASHES)


def _bands(classes: DataFrame) -> DataFrame:
    """A row per class and band: the bucket of the band's values."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = HASHES // ROWS
        for batch in batches:
            signed = _matrix(batch.column("signature"))
            bucket = np.arange(1, count + 1, dtype=np.uint64)[None, :].repeat(len(signed), 0)
            for k in range(ROWS):
                bucket = mix(bucket ^ signed[:, k::ROWS].astype(np.uint64))
            rows = np.repeat(np.arange(len(signed)), count)
            yield pa.record_batch(
                {
                    "bucket": pa.array(bucket.ravel().view(np.int64)),
                    "band": pa.array(np.tile(np.arange(count, dtype=np.int32), len(signed))),
                    "digest": batch.column("digest").take(pa.array(rows)),
                }
            )

    signed = classes.filter(F.col("signature").isNotNull()).select("digest", "signature")
    return signed.mapInArrow(cut, "bucket long, band int, digest binary")


def _placed(bands: DataFrame, block: int) -> DataFrame:
    """Members of shared buckets, once for each pair of blocks they are compared in."""
    shared = bands.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    blocks = F.expr(f"cast((size + {block - 1}) div {block} as int)")
    own = F.expr("cast(pmod(xxhash64(digest), blocks) as int)")
    return (
        bands.join(shared, "bucket")
        .withColumn("blocks", blocks)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .select(
            "bucket",
            F.least("own", "other").alias("low"),
            F.greatest("own", "other").alias("high"),
            "own",
            "band",
            "digest",
        )
    )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups of a partition sorted by place, and each row's group end."""
    held = None
    for batch in _with_end(batches):
        if batch is not None:
            more = pa.Table.from_batches([batch])
            held = more if held is None else pa.concat_tables([held, more])
        if held is None or not len(held):
            continue
        keys = [held[name].combine_chunks().to_numpy() for name in PLACE]
        changes = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
        whole = len(held) if batch is None else (int(changes[-1]) if len(changes) else 0)
        if whole:
            ends = np.concatenate([changes[changes < whole], [whole]])
            sizes = np.diff(np.concatenate([[0], ends]))
            yield held.slice(0, whole), np.repeat(ends, sizes)
            held = held.slice(whole)


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _survivors(table: pa.Table, ends: np.ndarray, least: list[int]) -> Iterator[tuple]:
    """Pairs of rows, some at a time, that the signatures cannot rule out."""
    signed = _matrix(table["signature"].combine_chunks())
    low, high, own, band = (
        table[name].combine_chunks().to_numpy() for name in ("low", "high", "own", "band")
    )
    follow = ends - np.arange(len(ends)) - 1
    reach = np.concatenate([[0], np.cumsum(follow)])
    row = 0
    while row < len(ends):
        stop = max(row + 1, int(np.searchsorted(reach, reach[row] + PAIRS, side="right")) - 1)
        some = follow[row:stop]
        left = np.repeat(np.arange(row, stop), some)
        right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(some) - some, some)
        meet = (low[left] == high[left]) | (own[left] != own[right])
        left, right = left[meet], right[meet]
        alike = np.zeros(len(left), dtype=np.int32)
        for k in range(0, HASHES, STEP):
            equal = signed[left, k : k + STEP] == signed[right, k : k + STEP]
            alike += np.count_nonzero(equal, axis=1).astype(np.int32)
            keep = alike >= least[k + STEP]
            left, right, alike = left[keep], right[keep], alike[keep]
        if len(left):
            equal = (signed[left] == signed[right]).reshape(len(left), -1, ROWS).all(axis=2)
            here = equal.argmax(axis=1) == band[left]
            left, right = left[here], right[here]
        if len(left):
            yield left, right
        row = stop


def _prune(least: list[int]) -> Callable:
    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Members that keep a candidate in their place."""
        for table, ends in _runs(batches):
            kept = np.zeros(len(table), dtype=bool)
            for left, right in _survivors(table, ends, least):
                kept[left] = True
                kept[right] = True
            chosen = table.select([*PLACE, "own", "band", "digest"]).filter(pa.array(kept))
            yield from chosen.combine_chunks().to_batches()

    return prune


def _verify(least: list[int], threshold: float) -> Callable:
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per member its exact links in this place, and the least member they lead to."""
        for table, ends in _runs(batches):
            sets = [np.frombuffer(x, np.uint64) for x in table["shingles"].to_pylist()]
            sizes = np.array([len(x) for x in sets])
            copies = table["copies"].combine_chunks().to_numpy()
            links = np.zeros(len(table), dtype=np.int64)
            parent = list(range(len(table)))

            def root(i: int, parent: list[int] = parent) -> int:
                while parent[i] != i:
                    parent[i] = parent[parent[i]]
                    i = parent[i]
                return i

            for left, right in _survivors(table, ends, least):
                small, large = np.minimum(sizes[left], sizes[right]), np.maximum(
                    sizes[left], sizes[right]
                )
                near = small >= threshold * large
                for i, j in zip(left[near].tolist(), right[near].tolist(), strict=True):
                    if similar(sets[i], sets[j], threshold):
                        links[i] += copies[j]
                        links[j] += copies[i]
                        a, b = root(i), root(j)
                        parent[max(a, b)] = min(a, b)
            linked = np.flatnonzero(links)
            roots = pa.array([root(i) for i in linked.tolist()], pa.int64())
            digests = table["digest"].combine_chunks()
            yield pa.record_batch(
                {
                    "digest": digests.take(pa.array(linked)),
                    "links": pa.array(links[linked]),
                    "root": digests.take(roots),
                }
            )

    return verify


def similar(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    """Whether the Jaccard similarity of two sorted sets reaches the threshold."""
    if len(a) > len(b):
        a, b = b, a
    place = np.searchsorted(b, a)
    place[place == len(b)] = 0
    common = int(np.count_nonzero(b[place] == a))
    return common >= threshold * (len(a) + len(b) - common)


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Every node of the edges with the least node of its component (node, root).

    Alternates two steps until nothing changes: each node ties its greater neighbours to
    the least node it knows, then itself and its smaller ones. A step keeps at most one
    row per edge, and a node's neighbours are folded to their least, never listed.
    """

    def state(pairs: DataFrame) -> tuple:
        total = F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))
        return tuple(pairs.agg(F.count("*"), total).first())

    high, low = F.greatest(F.col(a), F.col(b)), F.least(F.col(a), F.col(b))
    pairs = edges.select(high.alias("high"), low.alias("low")).filter("high <> low").distinct()
    pairs = materialise(pairs, "edges")
    before, now = None, state(pairs)
    while now != before:
        both = pairs.select(F.col("high").alias("node"), F.col("low").alias("other")).unionByName(
            pairs.select(F.col("low").alias("node"), F.col("high").alias("other"))
        )
        least = both.groupBy("node").agg(F.min("other").alias("least"))
        greater = (
            both.filter("other > node")
            .join(least, "node")
            .select(F.col("other").alias("high"), F.least("node", "least").alias("low"))
            .distinct()
        )
        greater = materialise(greater, "edges")
        least = greater.groupBy("high").agg(F.min("low").alias("least"))
        smaller = (
            greater.join(least, "high")
            .filter("low <> least")
            .select(F.col("low").alias("high"), F.col("least").alias("low"))
        )
        pairs = smaller.unionByName(least.select("high", F.col("least").alias("low"))).distinct()
        pairs = materialise(pairs, "edges")
        before, now = now, state(pairs)
    return pairs.select(F.col("high").alias("node"), F.col("low").alias("root"))


def _sets_of(docs: DataFrame, members: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """The shingle sets of the classes among ``members``, from one document of each."""
    wanted = classes.join(members.select("digest").distinct(), "digest", "left_semi")
    ids = wanted.select(F.col("label")).distinct()
    texts = docs.join(ids, docs["doc_id"].eqNullSafe(ids["label"]), "left_semi")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, digests, hashes, bounds in _sets(batch, size):
                yield pa.record_batch(
                    {"digest": digests, "shingles": binary_column(hashes, bounds)}
                )

    sets = texts.mapInArrow(cut, SETS).join(wanted, "digest")
    return sets.dropDuplicates(["digest"])


def near_duplicates(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    size: int = SHINGLE,
    tolerance: float = TOLERANCE,
    block: int = BLOCK,
) -> DataFrame:
    """Each document (doc_id, text) with its group's id and its number of links.

    A link joins two documents whose shingle sets have a Jaccard similarity of at least
    ``threshold``; copies count each. Groups are the connected components of the links,
    and ``class_id`` is the least document id of the group.
    """
    docs = id_and_text(docs)
    least = least_matches(threshold, tolerance)
    scanned = _scan(docs, size)
    classes = materialise(
        scanned.groupBy("digest").agg(
            F.min("doc_id").alias("label"),
            F.count("*").alias("copies"),
            F.max("signature").alias("signature"),
        ),
        "classes",
    )
    signed = classes.select("digest", "signature", "copies")
    placed = _placed(_bands(classes), block).join(signed.drop("copies"), "digest")
    place = "bucket long, low int, high int, own int, band int, digest binary"
    members = materialise(
        placed.repartition(*PLACE).sortWithinPartitions(*PLACE).mapInArrow(_prune(least), place),
        "members",
    )
    sets = _sets_of(docs, members, classes, size).select(
        "digest", "signature", "copies", "shingles"
    )
    linked = materialise(
        members.join(sets, "digest")
        .repartition(*PLACE)
        .sortWithinPartitions(*PLACE)
        .mapInArrow(_verify(least, threshold), LINKED),
        "linked",
    )
    links = linked.groupBy("digest").agg(F.sum("links").alias("links"))
    roots = components(linked, "digest", "root")
    grouped = classes.select("digest", "label", "copies").join(
        roots, classes["digest"] == roots["node"], "left"
    )
    grouped = grouped.withColumn("root", F.coalesce("root", "digest")).drop("node")
    labels = grouped.groupBy("root").agg(F.min("label").alias("class_id"))
    told = (
        grouped.join(labels, "root")
        .join(links, "digest", "left")
        .select(
            "digest",
            "class_id",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        )
    )
    return scanned.select("doc_id", "digest").join(told, "digest").drop("digest")
