"""Quality rules: surface counts, then a hashed n-gram likelihood ratio of a trusted target against the raw corpus.

Words are maximal runs of other than ASCII white space. Every word and every pair of neighbouring words, A-Z
lower-cased, is hashed into one of ``buckets`` buckets. The raw multinomial counts the n-grams of all documents, one
added to every bucket; the target multinomial counts those of the trusted ones, with ``buckets`` n-grams of the raw
multinomial added, so that what the target has too little of to tell counts slightly against a document, never for it.
A document's score is the mean over its n-grams of log(target / raw), its own n-grams taken out of both counts first,
so that a trusted document is not praised for itself. A document is kept if it passes the base rules and its score reaches the threshold: the
largest value that at most ``lose`` of the trusted documents (those passing the base rules) stay below.

All sums are exact: log ratios count in units of 2^-16, scores are cut to thousandths. So no order of rows or
partitions can change a verdict.

Plan: one pass over the texts; a document leaves it as its base counts and its n-grams per bucket, deflated (about a
third of the text as Parquet stores it, and bounded by ``buckets`` however long the text). These rows, not the texts,
are joined with the stored trusted ids and stored, so no list of ids passes the driver and no text is shuffled; Spark
broadcasts the ids while they are small. Every task sums its buckets and sends ``buckets`` rows; the sums are broadcast
(their size is fixed). The stored n-grams are then scored into narrow rows; the histogram of trusted scores has a
bounded number of values (thousandths between log ratios). The target, the counts of the raw corpus, the threshold,
scores and verdicts cover every document and every label. (The SQL below stops at MAX_TRUSTED trusted ids, which the
tables it is compared on stay below.)

Defined cases: a null, empty or blank text has no words, score null and fails the base rules; a text of any length
is taken whole (memory in proportion to the longest one); rows equal in doc_id are judged one by one, and each of
them counts; a null doc_id is never trusted. A label row counts as trusted if quality is 1 in all, and toxic 1 in none, of
its document's rows. Without trusted documents the base rules decide alone. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from openbell.llm.common import rows_to_frames, table
from openbell.session import materialize

BUCKETS, LOSE, MAX_TRUSTED = 10_000, 0.002, 100_000
UNIT, PAIR = 1 << 16, 1_000_003
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
SYMBOLS, BLANKS = "#*$%&|<>", " \t\n\v\f\r"

COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
NAMES = [c.split()[0] for c in COUNTS.split(", ")]


def repeated_words(words: list[bytes], n: int = 3) -> int:
    """Words that lie in an n-word window found twice or more."""
    if len(words) <= n:
        return 0
    ids: dict[bytes, int] = {}
    own = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    codes = own
    for k in range(1, n):  # numbers of the distinct windows of k + 1 words, exact at any length
        codes = np.unique(codes[:-1] * len(ids) + own[k:], return_inverse=True)[1]
    again = np.bincount(codes)[codes] > 1
    covered = np.zeros(len(words), bool)
    for k in range(n):
        covered[k : k + len(again)] |= again
    return int(covered.sum())


def surface(text: str | None) -> tuple[int, int, int, int, int]:
    """The counts of the base rules."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # splits bytes at ASCII white space only
    seen: set[bytes] = set()
    lines = again = 0
    for line in raw.split(b"\n"):
        if line.strip():
            lines += 1
            again += line in seen
            seen.add(line)
    return (
        len(words),
        len(text) - sum(text.count(c) for c in BLANKS),
        sum(text.count(c) for c in SYMBOLS),
        again,
        repeated_words(words),
    )


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEATED_PERCENT * n_words


class Hasher:
    """Buckets of a text's words and word pairs; remembers words, and forgets them all beyond ``keep``."""

    def __init__(self, buckets: int, keep: int = 500_000):
        self.buckets, self.keep, self.known = buckets, keep, {}

    def _word(self, word: bytes) -> int:
        found = self.known[word] = int(hashlib.md5(word).hexdigest()[:8], 16)
        return found

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The buckets, in order, and how often each occurs."""
        if len(self.known) > self.keep:
            self.known.clear()
        known, word = self.known, self._word
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # lowers A-Z only
        ones = np.fromiter((known.get(w) or word(w) for w in words), np.int64, len(words))
        pairs = (ones[:-1] * PAIR + ones[1:]) % self.buckets
        return np.unique(np.concatenate([ones % self.buckets, pairs]), return_counts=True)


def pack(at: np.ndarray, n: np.ndarray) -> bytes:
    """Ascending buckets, as gaps, and their counts; the bytes of each place together deflate best."""
    return zlib.compress(np.stack([np.diff(at, prepend=0), n]).astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    places = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    gaps, n = np.ascontiguousarray(places.T).view("<i4").reshape(2, -1).astype(np.int64)
    return np.cumsum(gaps), n


def trusted_labels(labels: DataFrame) -> DataFrame:
    """(doc_id): the distinct ids of all trusted documents."""
    each = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    good = each.agg(F.min("quality").alias("q"), F.max("toxic").alias("t")).where("q = 1 AND coalesce(t, 0) <> 1")
    return good.select("doc_id")


def trusted_ids(labels: DataFrame, most: int = MAX_TRUSTED) -> np.ndarray:
    """Some trusted ids to look at, sorted; at most ``most`` (those with the least MD5). ``judge`` takes all of them."""
    rows = trusted_labels(labels).orderBy(F.md5(F.col("doc_id").cast("string").cast("binary")), "doc_id").limit(most)
    return np.sort(np.array([r.doc_id for r in rows.collect()], np.int64))


def counted(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, base counts, grams) of every row; ``grams`` is its packed buckets, which stand for the text from here on."""
    # ids pass Python as strings: beside nulls, pandas would round them to doubles
    rows = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher(buckets)
        for pdf in frames:
            out = pd.DataFrame([(*surface(text), pack(*hasher(text))) for text in pdf["text"]], columns=[*NAMES, "grams"])
            out.insert(0, "doc_id", pdf["doc_id"].to_numpy())
            yield out

    out = rows.mapInPandas(count, f"doc_id string, {COUNTS}, grams binary")
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


def marked(rows: DataFrame, good: DataFrame) -> DataFrame:
    """The ``counted`` rows with ``trusted``; ``good`` has distinct ids. Null ids match nothing and are spread."""
    deal = F.when(F.col("doc_id").isNull(), F.xxhash64("grams")).otherwise(F.lit(0))
    flags = good.select("doc_id", F.lit(0).cast("long").alias("_deal"), F.lit(True).alias("_trusted"))
    found = rows.withColumn("_deal", deal).join(flags, ["doc_id", "_deal"], "left")
    return found.select(*rows.columns, F.coalesce("_trusted", F.lit(False)).alias("trusted"))


def bucket_counts(rows: DataFrame, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """N-grams per bucket, of all ``marked`` documents and of the trusted ones."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for pdf in frames:
            for grams, good in zip(pdf["grams"], pdf["trusted"], strict=True):
                at, n = unpack(grams)
                raw[at] += n
                if good:
                    target[at] += n
        used = np.flatnonzero(raw)
        yield from rows_to_frames(zip(used, raw[used], target[used], strict=True), ["bucket", "raw", "target"])

    parts = rows.select("grams", "trusted").mapInPandas(count, "bucket long, raw long, target long")
    sums = parts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()
    raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for r in sums:
        raw[r.bucket], target[r.bucket] = r.raw, r.target
    return raw, target


def ratio_units(at: np.ndarray, n: np.ndarray, raw: np.ndarray, target: np.ndarray, good: bool) -> int:
    """Sum over a document's n-grams of log(target / raw) in units of 1 / UNIT, the document left out."""
    size, buckets = int(n.sum()), len(raw)
    others = (raw[at] - n + 1) / (int(raw.sum()) - size + buckets)
    ratio = ((target[at] - n * good) / others + buckets) / (int(target.sum()) - size * good + buckets)
    return int((np.floor(np.log(ratio) * UNIT + 0.5).astype(np.int64) * n).sum())


def score(rows: DataFrame, raw: np.ndarray, target: np.ndarray) -> DataFrame:
    """(doc_id, base counts, trusted, n_grams, units) of every ``marked`` document; ``units`` is the summed log ratio."""
    shared = rows.sparkSession.sparkContext.broadcast((raw, target))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        raw, target = shared.value
        for pdf in frames:
            sums = []
            for grams, good in zip(pdf["grams"], pdf["trusted"], strict=True):
                at, n = unpack(grams)
                sums.append((int(n.sum()), ratio_units(at, n, raw, target, bool(good))))
            yield pdf.drop(columns="grams").join(pd.DataFrame(sums, columns=["n_grams", "units"], index=pdf.index))

    rows = rows.withColumn("doc_id", F.col("doc_id").cast("string"))
    out = rows.mapInPandas(run, f"doc_id string, {COUNTS}, trusted boolean, n_grams long, units long")
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


def threshold(scored: DataFrame, lose: float = LOSE) -> int | None:
    """The least score in thousandths that is kept; null without trusted documents."""
    own = scored.where("trusted AND NOT base_failed").groupBy("milli").count().orderBy("milli").collect()
    spare = int(sum(r["count"] for r in own) * lose)
    for r in own:
        if spare < r["count"]:
            return r.milli
        spare -= r["count"]
    return None


def judge(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, lose: float = LOSE) -> DataFrame:
    """One row per document: the base counts, ``base_failed``, ``score`` and ``kept``."""
    rows = marked(counted(docs, buckets), materialize(trusted_labels(labels), "trusted-labels"))
    rows = materialize(rows, "quality-grams")
    raw, target = bucket_counts(rows, buckets)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    # a document without words has no score; two divisions of whole numbers, so the same cut everywhere
    milli = F.when(F.col("n_grams") > 0, F.floor(F.col("units") * 1000 / (F.col("n_grams") * UNIT)))
    scored = score(rows, raw, target).withColumn("base_failed", failed).withColumn("milli", milli)
    scored = materialize(scored, "quality-scores")
    least = threshold(scored, lose)
    verdict = F.lit(True) if least is None else F.coalesce(F.col("milli") >= least, F.lit(False))
    return scored.select(
        "doc_id", *NAMES, "base_failed",
        (F.col("milli") / 1000.0).alias("score"),
        (~F.col("base_failed") & verdict).alias("kept"),
    )


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE_SQL = f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), w AS MATERIALIZED (
  SELECT r, generate_subscripts(s, 1) AS i, unnest(s) AS word
  FROM (SELECT r, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS s FROM d)
), grams AS (
  SELECT r, i, word, lead(word) OVER o || chr(10) || lead(word, 2) OVER o AS rest FROM w WINDOW o AS (PARTITION BY r ORDER BY i)
), windows AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, word, rest) > 1 AS again FROM grams WHERE rest IS NOT NULL
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM windows, (SELECT unnest([0, 1, 2]) AS k) WHERE again GROUP BY r
), lines AS (
  SELECT r, unnest(string_split(text, chr(10))) AS line FROM d
), dup AS (
  SELECT r, (count(*) - count(DISTINCT line)) AS n FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r
), counts AS (
  SELECT r, count(*) AS n, sum(length(word)) AS chars FROM w GROUP BY r
), base AS MATERIALIZED (
  SELECT d.r, doc_id, coalesce(counts.n, 0) AS n_words, coalesce(chars, 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(dup.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
         coalesce(counts.n, 0) < {MIN_WORDS} OR 100 * coalesce(covered.n, 0) > {MAX_REPEATED_PERCENT} * coalesce(counts.n, 0) AS base_failed
  FROM d LEFT JOIN counts USING (r) LEFT JOIN dup USING (r) LEFT JOIN covered USING (r)
), hashed AS MATERIALIZED (
  SELECT r, i, ('0x' || substr(md5(translate(word, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')), 1, 8))::BIGINT AS h FROM w
), buckets AS (
  SELECT r, h % {BUCKETS} AS b FROM hashed
  UNION ALL
  SELECT r, (h * {PAIR} + nxt) % {BUCKETS} FROM (SELECT r, h, lead(h) OVER (PARTITION BY r ORDER BY i) AS nxt FROM hashed) WHERE nxt IS NOT NULL
), own AS MATERIALIZED (
  SELECT r, b, count(*) AS n FROM buckets GROUP BY r, b
), good AS (
  SELECT doc_id FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1 AND coalesce(max(toxic), 0) <> 1
  ORDER BY md5(doc_id::VARCHAR), doc_id LIMIT {MAX_TRUSTED}
), flagged AS MATERIALIZED (
  SELECT base.*, doc_id IN (SELECT doc_id FROM good) AS trusted, coalesce(s.n, 0) AS size
  FROM base LEFT JOIN (SELECT r, sum(n)::BIGINT AS n FROM own GROUP BY r) s USING (r)
), model AS MATERIALIZED (
  SELECT b, sum(n)::BIGINT AS raw, coalesce(sum(n) FILTER (trusted), 0)::BIGINT AS target FROM own JOIN flagged USING (r) GROUP BY b
), total AS (
  SELECT sum(raw)::BIGINT AS raw, sum(target)::BIGINT AS target FROM model
), units AS (
  SELECT r, sum(n * floor(ln(((m.target - CASE WHEN trusted THEN n ELSE 0 END)::DOUBLE / ((m.raw - n + 1)::DOUBLE / (t.raw - size + {BUCKETS})) + {BUCKETS})
                        / (t.target - CASE WHEN trusted THEN size ELSE 0 END + {BUCKETS})) * {UNIT} + 0.5)::BIGINT)::BIGINT AS units
  FROM own JOIN flagged USING (r) JOIN model m USING (b), total t GROUP BY r
), scored AS MATERIALIZED (
  SELECT flagged.*, floor((units * 1000)::DOUBLE / (size * {UNIT}))::BIGINT AS milli FROM flagged LEFT JOIN units USING (r)
), ranked AS (
  SELECT milli, row_number() OVER (ORDER BY milli) AS k, count(*) OVER () AS n FROM scored WHERE trusted AND NOT base_failed
), least AS (
  SELECT max(milli) AS least FROM ranked WHERE k = floor(n * {LOSE}) + 1
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, milli / 1000.0::DOUBLE AS score,
       NOT base_failed AND CASE WHEN least IS NULL THEN true ELSE coalesce(milli >= least, false) END AS kept
FROM scored, least
"""
