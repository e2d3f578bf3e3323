"""Repeated substrings by prefix doubling over content-chosen positions.

Every byte covered by a string of ``length`` bytes that also starts earlier is removed. Sorting all suffixes would
move every byte position several times, so positions are thinned first without losing a match: every string of
``length`` bytes is filed at its anchor, the leftmost smallest hash of its 32-byte pieces. Equal strings have equal
anchors at equal distances. Neighbouring starts with one anchor form a segment; what its strings cover together is
its hull, what they share its core.

Rounds, each one Spark sort by rank, with ranks of growing prefixes as pairs of hashes:
1. segments by the rank of their anchor's 32 bytes. A rank that occurs once holds no repeat and drops out; segments
   of equal hulls repeat whole: all but the first are spans to remove. The first ones of different hulls stay open;
2. open segments as blocks of eight distances from the anchor, by the rank of the block's core (``length`` - 7 bytes);
3. what is open then start by start, by the pair of the ranks of its two halves: ``length`` bytes, all is decided.

Equal segments of a task are combined before the shuffle: the later ones are certain already and go to random ranks,
so a passage that a third of all documents share sends one row per task to its rank. Texts are dealt to the places
of their document twice; the hulls of open segments (less than twice ``length`` bytes) are written once.

Defined cases: a null text is empty; documents without a repeat are returned whole; a null doc_id is later than any
other; rows that share a doc_id are one document's versions: none is earlier than another at the same start, and each
loses the spans of all that its bytes hold; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from openbell.llm.common import table
from openbell.session import materialize

LENGTH, GRAM, BLOCK = 100, 32, 8
NO_ID = (1 << 63) - 1
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
ROW = "rank long, hull long, id long, place long, seg long, sure boolean"


def place(start, far, count):
    """First start, its distance to the anchor and the number of starts (both below 128) as one long."""
    return (start * 128 + far) * 128 + count


def unplace(place):
    return place // 16384, place // 128 % 128, place % 128


@functools.cache
def _byte_values() -> np.ndarray:
    """A fixed random 64-bit value for every byte."""
    return np.random.default_rng(100).integers(1, 1 << 63, 256, dtype=np.uint64)


def rolling(data: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` (a power of two) bytes, by doubling: a run's rank is the pair of its halves'."""
    h, step, k = _byte_values()[data], int(MULTIPLIER), 1
    while k < n:
        h = h[:-k] * np.uint64(step) + h[k:]
        step, k = step * step % (1 << 64), k * 2
    h = (h ^ (h >> np.uint64(32))) * MULTIPLIER
    return h ^ (h >> np.uint64(29))


def leftmost_min(x: np.ndarray, n: int) -> np.ndarray:
    """Place of the leftmost smallest value of every ``n`` neighbours."""
    at, k = np.arange(len(x)), 1
    while k < n:
        step = min(k, n - k)
        left = x[:-step] <= x[step:]
        x, at, k = np.where(left, x[:-step], x[step:]), np.where(left, at[:-step], at[step:]), k + step
    return at


def segments(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rank, hull, place) of all segments of a text of at least ``length`` bytes."""
    grams = rolling(data, GRAM)
    at = leftmost_min(grams, length - GRAM + 1)
    start = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    count = np.diff(np.append(start, len(at)))
    anchor = at[start]
    far = anchor - start
    # hash of any run: the sum up to its end less that up to its start, brought to power zero
    power = np.concatenate([[np.uint64(1)], np.full(len(data), MULTIPLIER)]).cumprod(dtype=np.uint64)
    total = np.concatenate([[np.uint64(0)], (_byte_values()[data] * power[:-1]).cumsum(dtype=np.uint64)])
    undo = np.concatenate([[np.uint64(1)], np.full(len(data), np.uint64(pow(int(MULTIPLIER), -1, 1 << 64)))]).cumprod(dtype=np.uint64)
    hull = (total[start + count - 1 + length] - total[start]) * undo[start]
    hull = (hull ^ (hull >> np.uint64(31))) * MULTIPLIER + (far * 128 + count).astype(np.uint64)
    return grams[anchor], hull, place(start, far, count)


def _combine(rank, hull, key, at, seg) -> pd.DataFrame:
    """Rows of a task: of equal (rank, hull) the first stays, later ones are certain and get a rank of their own."""
    rank, hull, key, at, seg = (np.asarray(x) for x in (rank, hull, key, at, seg))
    order = np.lexsort((at, key, hull, rank))
    rank, hull, key, at, seg = rank[order], hull[order], key[order], at[order], seg[order]
    new = np.concatenate([[True], (rank[1:] != rank[:-1]) | (hull[1:] != hull[:-1])]) if len(rank) else np.zeros(0, bool)
    lead = np.flatnonzero(new)[np.cumsum(new) - 1]
    later = (key != key[lead]) | (at // 16384 != at[lead] // 16384)
    spread = (key * 1_000_003 + at) * np.int64(0x1E3779B97F4A7C15)
    frame = {"rank": np.where(later, spread, rank.view(np.int64)), "hull": hull.view(np.int64), "id": key, "place": at, "seg": seg, "sure": later}
    return pd.DataFrame(frame)[new | later]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("data"),
    )


def _scan(docs: DataFrame, length: int, flush: int = 1_000_000) -> DataFrame:
    """All segments; ``flush`` only bounds a task's memory."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, n = [], 0
        for pdf in frames:
            for key, data in pdf.itertuples(index=False):
                if len(data) >= length:
                    rank, hull, at = segments(np.frombuffer(data, np.uint8), length)
                    parts.append((rank, hull, np.full(len(rank), key, np.int64), at, np.zeros(len(rank), np.int64)))
                    n += len(rank)
                if n >= flush:
                    yield _combine(*(np.concatenate(x) for x in zip(*parts, strict=True)))
                    parts, n = [], 0
        if parts:
            yield _combine(*(np.concatenate(x) for x in zip(*parts, strict=True)))

    return _texts(docs).mapInPandas(run, ROW)


def _sort_ranks(rows: DataFrame) -> DataFrame:
    """Rows that are ``later`` than an equal hull or ``open`` (first of their hull, other hulls have the rank)."""
    by_rank = Window.partitionBy("rank")
    by_hull = Window.partitionBy("rank", "hull").orderBy("id", "place")
    start = F.struct("id", F.floor(F.col("place") / 16384).alias("start"))
    rows = rows.withColumns({"low": F.min("hull").over(by_rank), "high": F.max("hull").over(by_rank)})
    rows = rows.withColumns({"lead": F.first(start).over(by_hull), "n": F.row_number().over(by_hull)})
    later, still = F.col("sure") | (start > F.col("lead")), ~F.col("sure") & (F.col("low") != F.col("high")) & (F.col("n") == 1)
    return rows.select("id", "place", "seg", later.alias("later"), still.alias("open")).where("later OR open")


def _with_places(data: DataFrame, keys: list[str], places: DataFrame, how: str) -> DataFrame:
    """``data`` with the sorted array of its places."""
    return data.join(places.groupBy(*keys).agg(F.array_sort(F.collect_set("place")).alias("places")).hint("merge"), keys, how)


def _hulls(texts: DataFrame, places: DataFrame, length: int) -> DataFrame:
    """(id, seg, data): bytes of the hull of every place."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for key, data, marks in pdf.itertuples(index=False):
                for mark in marks:
                    start, _, count = unplace(int(mark))
                    if start + count - 1 + length <= len(data):
                        rows.append((key, mark, bytes(data[start : start + count - 1 + length])))
            yield pd.DataFrame(rows, columns=["id", "seg", "data"])

    return _with_places(texts, ["id"], places, "inner").mapInPandas(run, "id long, seg long, data binary")


def _blocks(frames: Iterator[pd.DataFrame], length: int) -> Iterator[pd.DataFrame]:
    """Open segments as blocks of distances: the rank is that of the whole block's core, inside every start's string."""
    import xxhash

    for pdf in frames:
        rank, hull, ids, at, segs = [], [], [], [], []
        for key, seg, data in pdf.itertuples(index=False):
            start, far, count = unplace(seg)
            high = far
            while high > far - count:
                block = high // BLOCK
                low = max(block * BLOCK, far - count + 1)
                first = far - high  # of the block's starts, inside the hull
                core = far - block * BLOCK
                rank.append(xxhash.xxh64_intdigest(data[core : core + length - BLOCK + 1], block))
                hull.append(xxhash.xxh64_intdigest(data[first : first + high - low + length], high * 128 + low))
                ids.append(key)
                at.append(place(start + first, high, high - low + 1))
                segs.append(seg)
                high = low - 1
        yield _combine(np.array(rank, np.uint64), np.array(hull, np.uint64), np.array(ids, np.int64), np.array(at, np.int64), np.array(segs, np.int64))


def _starts(frames: Iterator[pd.DataFrame], length: int) -> Iterator[pd.DataFrame]:
    """The single starts of open blocks: the pair of the ranks of both halves is the string's."""
    import xxhash

    half = length // 2
    for pdf in frames:
        rank, hull, ids, at = [], [], [], []
        for key, seg, data, marks in pdf.itertuples(index=False):
            origin = unplace(seg)[0]
            for mark in marks:
                start, far, count = unplace(int(mark))
                for k in range(count):
                    string = data[start + k - origin : start + k - origin + length]
                    rank.append(xxhash.xxh64_intdigest(string[:half]))
                    hull.append(xxhash.xxh64_intdigest(string[half:]))
                    ids.append(key)
                    at.append(place(start + k, far - k, 1))
        yield _combine(np.array(rank, np.uint64), np.array(hull, np.uint64), np.array(ids, np.int64), np.array(at, np.int64), np.zeros(len(at), np.int64))


def repeated_places(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(id, place): segments of which every string also starts earlier."""
    first = materialize(_sort_ranks(_scan(docs, length)), "suffix-anchors")
    hulls = materialize(_hulls(_texts(docs), first.where("open"), length), "suffix-hulls")
    blocks = hulls.mapInPandas(functools.partial(_blocks, length=length), ROW)
    second = materialize(_sort_ranks(blocks), "suffix-blocks")
    singles = _with_places(hulls, ["id", "seg"], second.where("open"), "inner").mapInPandas(functools.partial(_starts, length=length), ROW)
    third = materialize(_sort_ranks(singles).where("later"), "suffix-starts")
    return functools.reduce(DataFrame.unionByName, [x.where("later").select("id", "place") for x in (first, second, third)])


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): ``kept`` is the remaining bytes."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for key, data, marks in pdf.itertuples(index=False):
                edge = np.zeros(len(data) + 1, np.int64)
                if marks is not None and len(marks):
                    start, _, count = unplace(np.asarray(marks, np.int64))
                    end = start + count - 1 + length
                    inside = end <= len(data)  # rows that share a doc_id may be shorter
                    np.add.at(edge, start[inside], 1)
                    np.add.at(edge, end[inside], -1)
                lost = edge[:-1].cumsum() > 0
                spans = int((lost & ~np.concatenate([[False], lost])[:-1]).sum())
                rows.append((key, len(data), int(lost.sum()), spans, np.frombuffer(data, np.uint8)[~lost].tobytes()))
            yield pd.DataFrame(rows, columns=["id", "n_bytes", "n_removed", "n_spans", "kept"])

    out = _with_places(_texts(docs), ["id"], repeated_places(docs, length), "left")
    out = out.mapInPandas(run, "id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.select(F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE_SQL = f"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), s AS (
  SELECT doc_id, p, md5_number(substr(x, 2 * p + 1, {2 * LENGTH})) AS k
  FROM (SELECT doc_id, x, unnest(range(n - {LENGTH} + 1)) AS p FROM d WHERE n >= {LENGTH})
), f AS (
  SELECT k, min(doc_id * 1000000000 + p) AS lead, count(*) AS c FROM s GROUP BY k HAVING count(*) > 1
), later AS (
  SELECT doc_id, p FROM s JOIN f USING (k) WHERE doc_id * 1000000000 + p > lead
), runs AS (
  SELECT *, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + {LENGTH} THEN 0 ELSE 1 END AS new FROM later
), named AS (
  SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS r FROM runs
), spans AS (
  SELECT doc_id, r, min(p) AS a, max(p) + {LENGTH} AS b FROM named GROUP BY doc_id, r
), gaps AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS from_ FROM spans
), pieces AS (
  SELECT g.doc_id, string_agg(substr(x, 2 * from_ + 1, 2 * (a - from_)), '' ORDER BY a) AS front,
         max(b) AS last, sum(b - a) AS gone, count(*) AS n_spans
  FROM gaps g JOIN d USING (doc_id) GROUP BY g.doc_id
)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(front, '') || substr(x, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN pieces USING (doc_id)
"""
