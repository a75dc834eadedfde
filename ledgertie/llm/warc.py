"""WARC archives of pages, written in shards and committed through a manifest.

Pages are dealt out by ranges of ids that depend on the ids alone and sorted, so the same
table gives the same files, byte by byte. A task compresses each record by itself and
begins a new file when the compressed size is reached. Files get a temporary name of
their own for every attempt; the attempts that succeeded are listed in a manifest, and
only those files get their final name. A lost executor's files keep their temporary
names and are never read.

Of records with equal payloads of at least ``least_bytes`` bytes, the one with the
smallest page id is a response and the others refer to it. Defined results: null html is
an empty payload; a page without id is a response; of rows with one id and one payload
the first is a response, the others refer to it; payloads may be of any length that one
file's row can hold. Line breaks in an address are left out of the headers.

The archive's folder has to be one that ``pyarrow.fs`` can write, such as file, s3, gs or
hdfs addresses.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgertie.llm.tables import materialise, range_parts

LEAST_BYTES = 0
PART_ROWS = 4000
ROLL_BYTES = 4 << 20
DATE = "2020-01-01T00:00:00Z"  # when the pages were fetched is not known
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "name string, temporary string, records long, bytes long, sha256 string"
RECORD = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long"
)
FOLDER = "records"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}/{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record with new headers and digests; a revisit keeps the HTTP headers alone."""
    digest = base32_sha1(payload)
    head = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = head if refers_to is not None else head + payload
    headers = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": record_id(page_id if refers_to is None else (page_id, "revisit"), digest),
        "WARC-Date": DATE,
        "WARC-Target-URI": "".join((url or "").splitlines()),
        "WARC-Page-ID": "" if page_id is None else page_id,
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Block-Digest": f"sha1:{base32_sha1(block)}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    if refers_to is not None:
        headers["WARC-Profile"] = PROFILE
        headers["WARC-Refers-To"] = record_id(refers_to, digest)
        headers["WARC-Refers-To-Page-ID"] = refers_to
    lines = "".join(f"{name}: {value}\r\n" for name, value in headers.items() if value != "")
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def _headers(stream: io.BufferedIOBase) -> dict[str, str]:
    held = {}
    while (line := stream.readline().strip()):
        name, _, value = line.decode().partition(":")
        held[name.lower()] = value.strip()
    return held


def parse(archive: bytes) -> Iterator[tuple]:
    """Records of one file: page, size and digest of the payload, type, referred page.

    A response's payload is measured and hashed anew and must agree with its headers.
    """
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(archive)))
    while (version := stream.readline()):
        if version != b"WARC/1.1\r\n":
            raise ValueError(f"no record begins with {version[:20]!r}")
        held = _headers(stream)
        block = stream.read(int(held["content-length"]))
        stream.read(4)
        head, _, payload = block.partition(b"\r\n\r\n")
        kind = held["warc-type"]
        digest = held["warc-payload-digest"].removeprefix("sha1:")
        size = int(_headers(io.BytesIO(head.partition(b"\r\n")[2]))["content-length"])
        if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
            raise ValueError(f"the payload of page {held.get('warc-page-id')} has changed")
        page, other = held.get("warc-page-id"), held.get("warc-refers-to-page-id")
        yield (page and int(page), size, digest, kind, other and int(other))


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    address = folder if "://" in folder else folder.replace("file:/", "file:///", 1)
    return fs.FileSystem.from_uri(address)


def _revisits(pages: DataFrame, least_bytes: int) -> DataFrame:
    """Pages whose payload a page with a smaller id has too (page_id, digest, refers_to)."""
    named = pages.filter(
        F.col("page_id").isNotNull() & (F.octet_length("html") >= least_bytes)
    ).select("page_id", "digest")
    firsts = (
        named.groupBy("digest")
        .agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last"))
        .filter("refers_to < last")
        .drop("last")
    )
    return named.join(firsts, "digest").filter("page_id > refers_to").distinct()


def _write(folder: str, least_bytes: int, roll_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _opened(folder)
        system.create_dir(f"{root}/{FOLDER}")
        system.create_dir(f"{root}/temporary")
        attempt, made = uuid.uuid4().hex, 0
        held, size, part = [], 0, None

        def close() -> pa.RecordBatch:
            nonlocal held, size, made
            data = b"".join(held)
            name = f"{part:05d}-{made:05d}.warc.gz"
            temporary = f"{name}.{attempt}"
            with system.open_output_stream(f"{root}/temporary/{temporary}") as out:
                out.write(data)
            row = [name, temporary, len(held), len(data), hashlib.sha256(data).hexdigest()]
            held, size, made = [], 0, made + 1
            names = [column.split()[0] for column in MANIFEST.split(", ")]
            return pa.RecordBatch.from_pylist([dict(zip(names, row, strict=True))])

        refers, before = None, None
        for batch in batches:
            names = ("part", "page_id", "digest", "follows", "refers_to", "url", "html")
            for at, page_id, digest, follows, other, url, html in zip(
                *(batch.column(name).to_pylist() for name in names), strict=True
            ):
                if at != part:
                    if held:
                        yield close()
                    part, made = at, 0
                if not follows:
                    refers = (page_id, digest, other)
                    continue
                payload = (html or "").encode()
                target = None
                if page_id is not None and len(payload) >= least_bytes:
                    if refers and refers[:2] == (page_id, digest):
                        target = refers[2]
                    elif before == (page_id, digest):
                        target = page_id
                before = (page_id, digest)
                cell = gzip.compress(record(page_id, url, payload, target), 6, mtime=0)
                if held and size + len(cell) > roll_bytes:
                    yield close()
                held.append(cell)
                size += len(cell)
        if held:
            yield close()

    return write


def _commit(folder: str):
    def commit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Final names for the files of the manifest; doing it again changes nothing."""
        system, root = _opened(folder)
        for batch in batches:
            for row in batch.to_pylist():
                source, target = f"{root}/temporary/{row['temporary']}", f"{root}/{FOLDER}/{row['name']}"
                if system.get_file_info(source).type == fs.FileType.File:
                    system.move(source, target)
                elif system.get_file_info(target).type != fs.FileType.File:
                    raise FileNotFoundError(target)
            yield batch

    return commit


def write_archive(
    pages: DataFrame,
    folder: str,
    least_bytes: int = LEAST_BYTES,
    part_rows: int = PART_ROWS,
    roll_bytes: int = ROLL_BYTES,
) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to archives in ``folder``; returns the manifest.

    Html moves once, to its range of ids; which pages are revisits is found on digests
    and travels beside it.
    """
    held = pages.select(
        pages["page_id"].cast("long").alias("page_id"),
        pages["url"].cast("string").alias("url"),
        F.coalesce(pages["html"].cast("string"), F.lit("")).alias("html"),
    )
    held = held.withColumn("digest", F.sha1(F.encode("html", "UTF-8")))
    parts = range_parts(held, "page_id", part_rows)
    revisits = _revisits(held, least_bytes).withColumn("follows", F.lit(0))
    rows = held.withColumn("follows", F.lit(1)).unionByName(revisits, allowMissingColumns=True)
    order = ["part", "page_id", "digest", "follows"]
    dealt = rows.withColumn("part", parts.column("page_id")).repartitionById(parts.count, "part")
    written = dealt.sortWithinPartitions(*order).mapInArrow(
        _write(folder, least_bytes, roll_bytes), MANIFEST
    )
    manifest = materialise(written, "manifest")
    manifest.mapInArrow(_commit(folder), MANIFEST).write.parquet(f"{folder}/manifest")
    return pages.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """All records of the committed archives in ``folder``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [column.split()[0] for column in RECORD.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        for batch in batches:
            for content in batch.column("content"):
                columns = list(zip(*parse(content.as_buffer()), strict=True)) or [[]] * 5
                cells = [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]
                yield pa.record_batch(cells, names)

    files = spark.read.format("binaryFile").load(f"{folder}/{FOLDER}")
    return files.select("content").mapInArrow(read, RECORD)
