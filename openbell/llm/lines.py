"""Line dedup by content-defined chunks of lines, in DataFrame functions only.

A rolling hash over the hashes of the last ``window`` lines ends a chunk after the line where it is smaller than
one line before and not larger than one line after: boundaries depend on nearby lines alone, so a passage keeps its
inner chunks wherever it stands, and two boundaries are never neighbours. With none beside the first or last line
either, every chunk of a text of several lines has two or more. A chunk that is repeated anywhere is kept where it
stands first (smallest doc_id, then earliest line) and removed elsewhere, after its bytes are compared with the
first one's. So an exact copy of such a text vanishes whole.

Plan: chunk digests are counted first (narrow rows, partial counts per task); only chunks whose digest repeats
carry their text into the comparison; decisions are grouped per document and joined to the documents once.
All three joins are merge joins at every size: the sides grow with the data, so none is broadcast. A hot chunk is
one row on the side of first texts, so the skewed side can be split by Spark.

Defined cases: a null or empty text is one empty line and is kept as it is; chunks of blank lines are kept;
texts of any length are taken whole; runs of equal lines have no boundary inside; rows equal in doc_id and text are
treated alike; a null doc_id is smaller than any other; other columns pass through, but
those named like an added one are replaced.

A chunk has three lines on average and a passage loses only chunks that lie inside it: its lines up to the first
boundary and behind the last one stay, and so do passages too short to hold two boundaries (README: shares by
length). A text of a single line stays. ``dedup_passages`` removes repeated passages whole; the pipeline removes what
either rule does (``dedup_lines`` with ``passages``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from openbell.llm.common import table
from openbell.session import materialize

WINDOW = 2
PRIME, BASE = 1_000_003, 31


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _chunks(docs: DataFrame, window: int) -> DataFrame:
    """Adds ``_chunks``: array of (at, n, body), at the first line (from 0), n lines."""
    number = lambda s: F.conv(F.substring(F.md5(s), 1, 15), 16, 10).cast("long") % PRIME
    lines = docs.withColumn("_lines", F.split(_text(), "\n", -1))
    hashed = lines.withColumn("_hashes", F.transform("_lines", number)).withColumn("_n", F.size("_lines"))

    def rolled(i: Column) -> Column:
        terms = [F.when(i > j, F.get(F.col("_hashes"), i - j - 1)).otherwise(0) * (BASE**j) for j in range(window)]
        return sum(terms[1:], terms[0]) % PRIME

    hashed = hashed.withColumn("_rolled", F.transform(F.sequence(F.lit(1), F.col("_n")), rolled))

    def ends_chunk(i: Column) -> Column:
        at = lambda k: F.get(F.col("_rolled"), k)
        return (i == F.col("_n")) | ((i >= 2) & (i <= F.col("_n") - 2) & (at(i - 1) < at(i - 2)) & (at(i - 1) <= at(i)))

    cut = hashed.withColumn("_ends", F.filter(F.sequence(F.lit(1), F.col("_n")), ends_chunk)).drop("_hashes", "_rolled")

    def chunk(end: Column, k: Column) -> Column:
        start = F.when(k == 0, 0).otherwise(F.get(F.col("_ends"), k - 1))
        body = F.array_join(F.slice("_lines", start + 1, end - start), "\n")
        return F.struct(start.alias("at"), (end - start).alias("n"), body.alias("body"))

    return cut.withColumn("_chunks", F.transform("_ends", chunk)).drop("_ends")


def _keys(docs: DataFrame) -> DataFrame:
    """Row identity: doc_id and a 128-bit key of the text."""
    return docs.withColumns({"_k1": F.xxhash64(_text()), "_k2": F.xxhash64(_text(), F.lit(1))})


def _multi(docs: DataFrame, window: int) -> DataFrame:
    """One row per removable chunk: (doc_id, _k1, _k2, at, body, h1, h2)."""
    able = lambda c: (c["n"] >= 2) & c["body"].rlike(r"[^ \t\r\n]")
    rows = _chunks(_keys(docs.select("doc_id", "text")), window).select(
        "doc_id", "_k1", "_k2", F.explode(F.filter("_chunks", able)).alias("c")
    )
    body = F.col("c.body")
    return rows.select(
        "doc_id", "_k1", "_k2", F.col("c.at").alias("at"), body.alias("body"),
        F.xxhash64(body).alias("h1"), F.xxhash64(body, F.lit(1)).alias("h2"),
    )


def _repeats(docs: DataFrame, window: int, order: tuple[str, ...]) -> DataFrame:
    """(doc_id, _k1, _k2, at, body): the repeated chunks, without those that stand first in ``order``."""
    place = F.struct(*order)
    chunks = _multi(docs, window)
    repeated = materialize(
        chunks.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).where("n > 1").drop("n"),
        "line-repeated",
    )
    found = materialize(chunks.join(repeated.hint("merge"), ["h1", "h2"]).withColumn("is_first", place.eqNullSafe(F.col("first"))), "line-chunks")
    # rows equal in doc_id and text share one place: one of them is enough to compare with
    firsts = found.where("is_first").groupBy("h1", "h2").agg(F.first("body").alias("kept"))
    return found.where("NOT is_first").join(firsts.hint("merge"), ["h1", "h2"]).where(F.col("body") == F.col("kept"))


def removals(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, _k1, _k2, gone): first lines of the chunks to remove, one row per document that loses any."""
    gone = _repeats(docs, window, ("doc_id", "at", "_k1", "_k2"))
    return gone.groupBy("doc_id", "_k1", "_k2").agg(F.collect_set("at").alias("gone"))


def dedup_lines(docs: DataFrame, window: int = WINDOW, passages: bool = False) -> DataFrame:
    """The documents with ``text`` shortened, and ``_n_lines``, ``_gone_lines``, ``_gone_chunks``.

    With ``passages`` the lines that ``dedup_passages`` removes go too. Both are judged on the texts as given, so that
    neither hides a repeat from the other, and in the same order (doc_id, text, line), so that every line removed stands
    somewhere earlier.
    """
    columns = [c for c in docs.columns if c not in ("_n_lines", "_gone_lines", "_gone_chunks")]
    if passages:
        return _without(docs, columns, _chunks_and_passages(docs, window)).select(
            *[F.col("_made.text") if c == "text" else F.col(f"_row.`{c}`") for c in columns],
            F.col("_made.lines").alias("_n_lines"),
            F.col("_made.gone_lines").alias("_gone_lines"),
            F.col("_made.gone_chunks").alias("_gone_chunks"),
        )
    gone = materialize(removals(docs, window), "line-removals").select(
        F.col("doc_id").alias("_id"), F.col("_k1").alias("_g1"), F.col("_k2").alias("_g2"), "gone"
    )
    keyed = _keys(docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"))).drop("text")
    joined = keyed.join(
        gone.hint("merge"), keyed["doc_id"].eqNullSafe(gone["_id"]) & (keyed["_k1"] == gone["_g1"]) & (keyed["_k2"] == gone["_g2"]), "left"
    ).withColumn("text", F.col("_row.text"))
    lost = lambda c: F.array_contains("gone", c["at"])
    cut = _chunks(joined, window)
    kept = F.array_join(F.transform(F.filter("_chunks", lambda c: ~lost(c)), lambda c: c["body"]), "\n")
    gone_lines = F.aggregate(F.filter("_chunks", lost), F.lit(0), lambda a, c: a + c["n"])
    touched = F.col("gone").isNotNull()
    # exploding one struct keeps later filters from being pushed into, and so repeating, these expressions
    made = F.struct(
        F.when(touched, kept).otherwise(F.col("_row.text")).alias("text"),
        F.col("_n").cast("long").alias("lines"),
        F.when(touched, gone_lines).otherwise(0).cast("long").alias("gone_lines"),
        F.when(touched, F.size("gone")).otherwise(0).cast("long").alias("gone_chunks"),
    )
    return cut.select("_row", F.explode(F.array(made)).alias("_made")).select(
        *[F.col("_made.text") if c == "text" else F.col(f"_row.`{c}`") for c in columns],
        F.col("_made.lines").alias("_n_lines"),
        F.col("_made.gone_lines").alias("_gone_lines"),
        F.col("_made.gone_chunks").alias("_gone_chunks"),
    )


# --- repeated passages, for the pipeline ---------------------------------------------------------------------


def _units(docs: DataFrame) -> DataFrame:
    """Adds ``_lines``, and ``_at``: the places (from 0) of the lines that are not blank."""
    lines = docs.withColumn("_lines", F.split(_text(), "\n", -1))
    shown = lambda i: F.get("_lines", i).rlike(r"[^ \t\r\n]")
    return lines.withColumn("_at", F.filter(F.sequence(F.lit(0), F.size("_lines") - 1), shown))


def _passages(docs: DataFrame) -> DataFrame:
    """(doc_id, _k1, _k2, gone): numbers (of the lines not blank, from 0) to remove, one row per document that loses any."""
    # rows equal in doc_id and text share their places
    units = _units(_keys(docs.select("doc_id", "text")))
    line = lambda k: F.get("_lines", F.get("_at", k))
    pair = lambda k: F.struct(k.alias("k"), F.unhex(F.md5(F.concat_ws("\n", line(k - 1), line(k)))).alias("h"))
    pairs = F.when(F.size("_at") > 1, F.transform(F.sequence(F.lit(1), F.size("_at") - 1), pair))
    rows = units.select("doc_id", "_k1", "_k2", F.explode(pairs).alias("c")).select("doc_id", "_k1", "_k2", "c.k", "c.h")
    rows = materialize(rows, "line-pairs")
    place = F.struct("doc_id", "_k1", "_k2", "k")
    repeated = rows.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).where("n > 1").drop("n")
    repeated = materialize(repeated, "line-repeated")
    found = rows.join(repeated.hint("merge"), "h").where(~place.eqNullSafe(F.col("first")))
    same = F.struct("doc_id", "_k1", "_k2").eqNullSafe(F.struct("first.doc_id", "first._k1", "first._k2"))
    # the line between is the first pair's too where a pair follows on its own first place
    lost = F.when(same & (F.col("k") == F.col("first.k") + 1), F.array("k")).otherwise(F.array(F.col("k") - 1, F.col("k")))
    return found.groupBy("doc_id", "_k1", "_k2").agg(F.array_distinct(F.flatten(F.collect_set(lost))).alias("gone"))


def dedup_passages(docs: DataFrame) -> DataFrame:
    """The documents with ``text`` shortened, and ``_gone_lines``: repeated passages of two or more lines go.

    Every pair of neighbouring lines, blank ones between them skipped, that stands earlier (smaller doc_id, then
    earlier line) is removed, so a passage of any length goes whole wherever it stands, and an exact copy of a text
    of several lines leaves nothing. Every line removed stands somewhere earlier. Blank lines go with the line
    before them, leading ones with the first line. A line alone, without a repeated neighbour, stays.

    Pairs are equal if their MD5 is. Plan: one narrow row per line; only decisions are joined to the texts.
    Defined cases as above.
    """
    columns = [c for c in docs.columns if c != "_gone_lines"]
    none = {"chunks": F.lit(0), "lost": F.array().cast("array<int>")}
    return _without(docs, columns, _passages(docs).withColumns(none)).select(
        *[F.col("_made.text") if c == "text" else F.col(f"_row.`{c}`") for c in columns], F.col("_made.gone_lines").alias("_gone_lines")
    )


def _chunks_and_passages(docs: DataFrame, window: int) -> DataFrame:
    """``_passages``, with ``lost``: numbers (of all lines, from 0) of the ``chunks`` to remove."""
    ids = ["doc_id", "_k1", "_k2"]
    chunk = F.struct("at", F.size(F.split("body", "\n", -1)).alias("n"))
    chunks = _repeats(docs, window, (*ids, "at")).groupBy(*ids).agg(F.collect_set(chunk).alias("c"))
    numbers = F.flatten(F.transform("c", lambda c: F.sequence(c["at"], c["at"] + c["n"] - 1)))
    none = F.lit(None).cast("array<int>")
    both = chunks.select(*ids, F.size("c").alias("chunks"), numbers.alias("lost"), none.alias("gone")).unionByName(
        _passages(docs).select(*ids, F.lit(0).alias("chunks"), none.alias("lost"), "gone")
    )
    joined = [F.flatten(F.collect_list(c)).alias(c) for c in ("lost", "gone")]  # nulls are not collected
    return both.groupBy(*ids).agg(F.sum("chunks").alias("chunks"), *joined)


def _without(docs: DataFrame, columns: list[str], found: DataFrame) -> DataFrame:
    """(_row, _made): ``columns`` of every document, and what is left of its text without the lines that ``found`` names."""
    gone = materialize(found, "line-removals").select(
        F.col("doc_id").alias("_id"), F.col("_k1").alias("_g1"), F.col("_k2").alias("_g2"), "chunks", "lost", "gone"
    )
    keyed = _keys(docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"))).drop("text")
    joined = keyed.join(
        gone.hint("merge"), keyed["doc_id"].eqNullSafe(gone["_id"]) & (keyed["_k1"] == gone["_g1"]) & (keyed["_k2"] == gone["_g2"]), "left"
    ).withColumn("text", F.col("_row.text"))
    units = _units(joined)
    touched = F.col("gone").isNotNull()

    def unit(k: Column) -> Column:
        start = F.when(k == 0, 0).otherwise(F.get("_at", k))
        return F.sequence(start, F.coalesce(F.get("_at", k + 1), F.size("_lines")) - 1)

    numbers = F.concat("lost", F.flatten(F.transform("gone", unit)))
    left = units.withColumn("_left", F.when(touched, F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), numbers)))
    # exploding one struct keeps later filters from being pushed into, and so repeating, these expressions
    made = F.struct(
        F.when(touched, F.array_join(F.transform("_left", lambda i: F.get("_lines", i)), "\n")).otherwise(F.col("_row.text")).alias("text"),
        F.size("_lines").cast("long").alias("lines"),
        F.when(touched, F.size("_lines") - F.size("_left")).otherwise(0).cast("long").alias("gone_lines"),
        F.when(touched, F.col("chunks")).otherwise(0).cast("long").alias("gone_chunks"),
    )
    return left.select("_row", F.explode(F.array(made)).alias("_made"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id",
        F.col("_n_lines").alias("n_lines"),
        F.col("_gone_lines").alias("n_removed_lines"),
        F.col("_gone_chunks").alias("n_removed_chunks"),
        F.length(text).cast("long").alias("kept_chars"),
        F.md5(text).alias("kept_md5"),
    )


ORACLE_SQL = f"""
WITH l AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents
), e AS (
  SELECT doc_id, generate_subscripts(s, 1) AS i, unnest(s) AS line FROM l
), h AS (
  SELECT *, ('0x' || substr(md5(line), 1, 15))::BIGINT % {PRIME} AS h FROM e
), r AS (
  SELECT *, (h + {BASE} * coalesce(lag(h) OVER (PARTITION BY doc_id ORDER BY i), 0)) % {PRIME} AS r FROM h
), b AS (
  SELECT *, coalesce(r < lag(r) OVER o AND r <= lead(r) OVER o AND i <= count(*) OVER (PARTITION BY doc_id) - 2, false) AS cut
  FROM r WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), c AS (
  SELECT *, coalesce(sum(cut::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k FROM b
), chunks AS (
  SELECT doc_id, k, min(i) AS pos, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS body FROM c GROUP BY doc_id, k
), judged AS (
  SELECT *, n >= 2 AND regexp_matches(body, '[^ \\t\\r\\n]')
            AND row_number() OVER (PARTITION BY body ORDER BY doc_id, pos) > 1 AS gone FROM chunks
)
SELECT doc_id, sum(n)::BIGINT AS n_lines, coalesce(sum(n) FILTER (gone), 0)::BIGINT AS n_removed_lines,
       count(*) FILTER (gone) AS n_removed_chunks,
       length(coalesce(string_agg(body, chr(10) ORDER BY pos) FILTER (NOT gone), ''))::BIGINT AS kept_chars,
       md5(coalesce(string_agg(body, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_md5
FROM judged GROUP BY doc_id
"""
