"""WARC records in seekable Zstandard bundles.

Records are grouped into independent Zstandard frames of about ``frame_bytes``; a bundle file is a run of
frames and ends with a seek table in a skippable frame, so that one frame can be read without the others.
The index maps every record to (file, frame, offset inside the frame).

Writers are Spark tasks. A file name is unique to the attempt, and only files named in the written index count:
what a lost attempt left behind is never read. Pages with equal payloads of at least ``min_dedup_bytes`` are
stored once, as the response of the largest ``page_id``; the others become revisit records. Every record has the date of its crawl, which is a parameter:
the clock decides nothing. A bundle may start with a frame of its own that holds a warcinfo record.

Defined cases: a null html is an empty payload; a null url gives no target line; rows repeated with the largest
page_id are all responses; a null page_id never is the largest unless all are null; a record id is made of page id
and digest, followed by a unique mark for revisits and where rows share a page id (nulls too), so no two records have
one; a revisit names page and digest of its response, without the mark. Very long pages are one record and frame. An empty table gives an empty index; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from openbell.llm.common import rows_to_frames, table
from openbell.session import materialize, scratch_dir

# Zstandard seekable format
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1

URN = "urn:openbell:page:"
DATE = "2024-01-01T00:00:00Z"
INDEX = "page_id long, file string, frame int, record_offset long, record_length long"
RECORDS = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"
CONTENT = RECORDS + ", payload binary"


def records(pages: DataFrame, min_dedup_bytes: int = 1000) -> DataFrame:
    """(page_id, url, payload, digest, refers_to, again): ``refers_to`` is null for a response, ``again`` tells
    that several rows have the page id.

    Sizes and digests alone are grouped, one partial row per digest and task, and only groups of two or more
    are joined back; written first, so that Spark picks the join by their real size.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    large = rows.where(F.length("payload") >= min_dedup_bytes)
    repeated = materialize(
        large.groupBy("digest").agg(F.max("page_id").alias("keep"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"),
        "warc-repeated",
    )
    is_copy = (F.length("payload") >= min_dedup_bytes) & F.col("keep").isNotNull() & ~F.col("keep").eqNullSafe(F.col("page_id"))
    several = rows.groupBy("page_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    several = materialize(several.select(F.col("page_id").alias("several"), F.lit(True).alias("again")), "warc-several")
    return rows.join(repeated, "digest", "left").join(several, F.col("page_id").eqNullSafe(F.col("several")), "left").select(
        "page_id", "url", "payload", "digest", F.when(is_copy, F.col("keep")).alias("refers_to"), F.coalesce("again", F.lit(False)).alias("again")
    )


def _info(name: str, date: str, fields: str) -> bytes:
    """The record that describes a bundle; ``fields`` are lines of ``name: value``."""
    block = "".join(f"{x}\r\n" for x in fields.splitlines()).encode()
    ident = name.removeprefix("bundle-").removesuffix(".warc.zst")
    head = ["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: <urn:openbell:bundle:{ident}>", f"WARC-Date: {date}", f"WARC-Filename: {name}"]
    head += ["Content-Type: application/warc-fields", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _record(page_id, url, payload: bytes, digest: str, refers_to, mark: str = "", date: str = DATE) -> bytes:
    ident = ("" if page_id is None else str(page_id)) + f":{digest}" + (mark and f":{mark}")
    copy = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if copy else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if copy else 'response'}", f"WARC-Record-ID: <{URN}{ident}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if copy:
        head.append(f"WARC-Refers-To: <{URN}{refers_to}:{digest}>")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int = 0) -> tuple[tuple, int]:
    """The record that starts at ``at`` as a ``CONTENT`` row, and where the next one starts."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no record at {at}")
    head = dict(x.split(": ", 1) for x in lines[1:])
    start, n = end + 4, int(head["Content-Length"])
    block = data[start : start + n]
    split = block.index(b"\r\n\r\n") + 4
    http = dict(x.split(": ", 1) for x in block[:split].decode().split("\r\n")[1:] if x)
    size, digest = int(http["Content-Length"]), head["WARC-Payload-Digest"].removeprefix("sha1:")
    payload = None if head["WARC-Type"] == "revisit" else block[split:]
    if payload is not None and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"damaged payload in {head['WARC-Record-ID']}")
    ident = lambda x: int(y) if (y := x.removeprefix(f"<{URN}").split(":")[0]) else None
    url = head.get("WARC-Target-URI")
    url = url and url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
    refers = ident(head["WARC-Refers-To"]) if "WARC-Refers-To" in head else None
    return (ident(head["WARC-Record-ID"]), url, head["WARC-Type"], size, digest, refers, payload), start + n + 4


def _open_store(path: str):
    """A pyarrow file system for a folder that all tasks share, and the path inside it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1) if "://" in path or path.startswith("file:") else f"file://{path}")


class _Bundle:
    """One file of frames; holds at most one frame in memory."""

    def __init__(self, store, folder: str, frame_bytes: int, level: int):
        import zstandard

        self.name = f"bundle-{uuid.uuid4().hex}.warc.zst"
        self.out = store.open_output_stream(f"{folder}/{self.name}", compression=None)
        self.codec = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.frame_bytes, self.frame, self.sizes, self.written = frame_bytes, bytearray(), [], 0

    def add(self, record: bytes) -> tuple[str, int, int, int]:
        if self.frame and len(self.frame) + len(record) > self.frame_bytes:
            self.flush()
        place = (self.name, len(self.sizes), len(self.frame), len(record))
        self.frame += record
        return place

    def flush(self) -> None:
        packed = self.codec.compress(bytes(self.frame))
        self.out.write(packed)
        self.sizes.append((len(packed), len(self.frame)))
        self.written += len(packed)
        self.frame = bytearray()

    def close(self) -> None:
        if self.frame:
            self.flush()
        entries = b"".join(struct.pack("<II", *x) for x in self.sizes)
        footer = struct.pack("<IBI", len(self.sizes), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer)
        self.out.close()


def write_bundles(
    recs: DataFrame, path: str, frame_bytes: int = 1 << 20, bundle_bytes: int = 256 << 20, level: int = 3,
    date: str = DATE, info: str | None = None,
) -> DataFrame:
    """Write the records below ``path`` (a shared folder); returns the written index (``INDEX``).

    ``date`` is the records' WARC-Date; ``info`` (lines of ``name: value``) starts every bundle with a warcinfo record.
    """

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def places():
            store, folder = _open_store(path)
            store.create_dir(folder, recursive=True)
            bundle = None
            for pdf in frames:
                for page_id, url, payload, digest, refers_to, again in pdf.itertuples(index=False):
                    if bundle is None or bundle.written >= bundle_bytes:
                        if bundle:
                            bundle.close()
                        bundle, n = _Bundle(store, folder, frame_bytes, level), 0
                        if info is not None:
                            bundle.add(_info(bundle.name, date, info))
                            bundle.flush()
                    page = None if pd.isna(page_id) else int(page_id)
                    to = None if pd.isna(refers_to) else int(refers_to)
                    n += 1
                    mark = f"{bundle.name[7:39]}-{n}" if again or to is not None else ""
                    yield page_id, *bundle.add(_record(page, url, bytes(payload), digest, to, mark, date))
            if bundle:
                bundle.close()

        yield from rows_to_frames(places(), ["page_id", "file", "frame", "record_offset", "record_length"])

    # ids travel as text: pandas would turn a nullable long into a float
    rows = recs.select(F.col("page_id").cast("string"), "url", "payload", "digest", F.col("refers_to").cast("string"), "again")
    index = rows.mapInPandas(write, INDEX.replace("page_id long", "page_id string"))
    return materialize(index.withColumn("page_id", F.col("page_id").cast("long")), "warc-index")


def seek_table(file) -> list[tuple[int, int, int]]:
    """(start, packed size, plain size) of every frame, read from the footer of an open bundle."""
    end = file.size()
    file.seek(end - 9)
    n, flags, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table")
    width = 12 if flags & 0x80 else 8
    file.seek(end - 9 - n * width)
    table, at, out = file.read(n * width), 0, []
    for k in range(n):
        packed, plain = struct.unpack_from("<II", table, k * width)
        out.append((at, packed, plain))
        at += packed
    return out


def _frames(path: str, wanted: list[tuple[str, int]]) -> Iterator[tuple[str, int, bytes]]:
    import zstandard

    store, folder = _open_store(path)
    codec = zstandard.ZstdDecompressor()
    name, file, seeks = None, None, []
    for file_name, frame in sorted(wanted):
        if file_name != name:
            if file:
                file.close()
            name, file = file_name, store.open_input_file(f"{folder}/{file_name}")
            seeks = seek_table(file)
        start, packed, plain = seeks[frame]
        file.seek(start)
        yield file_name, frame, codec.decompress(file.read(packed), max_output_size=plain)
    if file:
        file.close()


def read_bundles(index: DataFrame, path: str, payloads: bool = False, frames_per_task: int = 16) -> DataFrame:
    """All records of the frames named in the index, parsed from the archives (``RECORDS`` or ``CONTENT``)."""
    columns = [x.split()[0] for x in CONTENT.split(", ")]

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows():
            for pdf in frames:
                for _, _, data in _frames(path, list(zip(pdf["file"], pdf["frame"], strict=True))):
                    at = 0
                    while at < len(data):
                        (page_id, url, kind, size, digest, refers, payload), at = parse_record(data, at)
                        text = lambda x: None if x is None else str(x)
                        yield text(page_id), url, kind, size, digest, text(refers), payload if payloads else None

        yield from rows_to_frames(rows(), columns, 500 if payloads else 5000)

    wanted = index.select("file", "frame").distinct()
    # a row is a frame: tiny rows stand for much work, so their number sets the tasks
    wanted = wanted.repartition(max(1, -(-wanted.count() // frames_per_task)), "file", "frame")
    out = wanted.mapInPandas(read, CONTENT.replace("page_id long", "page_id string").replace("refers_to long", "refers_to string"))
    out = out.withColumns({c: F.col(c).cast("long") for c in ("page_id", "refers_to")})
    return out if payloads else out.drop("payload")


def lookup(index: DataFrame, path: str, ids: DataFrame) -> DataFrame:
    """Payload records of the wanted page ids (column ``page_id``): reads only the frames that hold them."""
    wanted = index.join(ids.select("page_id").distinct(), "page_id")
    return read_bundles(wanted, path, payloads=True).join(ids.select("page_id").distinct(), "page_id", "left_semi")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive all pages and return what the archives say of each."""
    path = scratch_dir(spark, "warc")
    index = write_bundles(records(table(spark, sf_dir, "pages")), path, info="software: openbell\nformat: WARC File Format 1.1")
    return read_bundles(index, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"
    )


ORACLE_SQL = """
WITH p AS (
  SELECT page_id, url, encode(coalesce(html, '')) AS b FROM pages
), d AS (
  SELECT page_id, url, octet_length(b) AS n, sha1(b) AS h FROM p
), g AS (
  SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY h, n) ELSE page_id END AS keep FROM d
)
SELECT page_id, n::BIGINT AS payload_bytes, h AS payload_digest,
       CASE WHEN keep = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN keep <> page_id THEN keep END AS refers_to, url
FROM g
"""
