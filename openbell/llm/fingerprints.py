"""SimHash document fingerprints, in DataFrame functions only.

Terms are runs of letters and digits, lower-cased. Every occurrence of a term votes with its length on the 64 signed
bits of its XXH64; a bit is 1 if its sum is above zero. Words are exploded and summed in the same task, so one
partial row per text leaves it.

``search`` finds all fingerprints within a Hamming radius by permuted block tables: the 64 bits are cut into
``radius + 3`` blocks; two fingerprints within the radius agree on at least three of them, so they meet in the table
of these three. Candidates share about 32 bits; no bucket is compared in pairs with itself, only queries against
distinct fingerprints.

Defined cases: a null text is empty; a text without terms has fingerprint zero; documents are ordered by doc_id
(null last), then by text hash; rows equal in doc_id and text are one document and one result row; a single document is
its own next; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from openbell.llm.common import table
from openbell.session import materialize

KEY = ["id", "h1", "h2"]
#: Stands for a null doc_id, so that joins need no null-safe keys.
NO_ID = -(1 << 63)


def _keyed(docs: DataFrame) -> DataFrame:
    """(id, h1, h2, text): doc_id and a 128-bit key of the text name a document."""
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    return rows.withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64("text", F.lit(1))})


def _doc_id() -> Column:
    return F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id")


def ring(keys: DataFrame, rows_per_part: int = 100_000) -> DataFrame:
    """Adds the next row's key (``next_*``) and the previous one's (``prev_*``) and its length ``prev_n``, in
    descending order of id and round again. ``keys``: distinct (id, h1, h2, n).

    Ranges of ids are windows of their own; the rows at their ends meet in one row per range.
    """
    order = [F.desc("id"), F.col("h1"), F.col("h2")]
    parts = max(1, -(-keys.count() // rows_per_part))
    ranged = materialize(keys.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "ring")
    row = F.struct(*KEY, "n")
    inside = Window.partitionBy("part").orderBy(*order)
    near = ranged.withColumns({"p": F.lag(row).over(inside), "q": F.lead(row).over(inside)})
    ends = near.groupBy("part").agg(
        F.first(F.when(F.col("p").isNull(), row), True).alias("first"), F.first(F.when(F.col("q").isNull(), row), True).alias("last")
    )
    # one row per range: at most `parts`
    over = Window.partitionBy(F.lit(0)).orderBy("part")
    whole = over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select(
        "part",
        F.coalesce(F.lag("last").over(over), F.last("last").over(whole)).alias("before"),
        F.coalesce(F.lead("first").over(over), F.first("first").over(whole)).alias("after"),
    )
    joined = near.join(ends, "part").withColumns({"p": F.coalesce("p", "before"), "q": F.coalesce("q", "after")})
    return joined.select(
        *KEY, "n", *[F.col(f"q.{k}").alias(f"next_{k}") for k in KEY], *[F.col(f"p.{k}").alias(f"prev_{k}") for k in KEY],
        F.col("p.n").alias("prev_n"),
    )


def votes(texts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, fp): fingerprint of column ``body``, zero for a text without terms."""
    terms = texts.select(*keys, F.explode_outer(F.split(F.lower("body"), r"[^\p{L}\p{N}]+")).alias("term"))
    hashed = terms.select(*keys, F.xxhash64("term").alias("h"), F.length("term").cast("long").alias("w"))
    signed = [F.sum(F.when(F.getbit("h", F.lit(k)) == 1, F.col("w")).otherwise(-F.col("w"))).alias(f"b{k}") for k in range(64)]
    summed = hashed.groupBy(*keys).agg(*signed)
    fp = F.lit(0).cast("long")
    for k in range(64):
        fp = fp.bitwiseOR(F.when(F.col(f"b{k}") > 0, F.lit((1 << k) - (1 << 64 if k == 63 else 0))).otherwise(F.lit(0)).cast("long"))
    return summed.select(*keys, fp.alias("fp"))


def likeness(a: Column, b: Column) -> Column:
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def hexed(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def block_keys(fps: DataFrame, radius: int) -> DataFrame:
    """One row per fingerprint and table: (fp, table, block): ``block`` keeps the bits of the table's three blocks."""
    n = radius + 3
    edges = [64 * k // n for k in range(n + 1)]
    masks = []
    for chosen in combinations(range(n), 3):
        mask = sum(((1 << edges[b + 1]) - 1) ^ ((1 << edges[b]) - 1) for b in chosen)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    tables = F.array(*[F.struct(F.lit(k).alias("table"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("block")) for k, m in enumerate(masks)])
    return fps.select("fp", F.explode(tables).alias("t")).select("fp", "t.table", "t.block")


def search(queries: DataFrame, fps: DataFrame, radius: int = 3) -> DataFrame:
    """(query, fp, distance) of all distinct fingerprints (column ``fp``) within the radius of each query."""
    left = block_keys(queries.select("fp").distinct(), radius).withColumnRenamed("fp", "query")
    right = block_keys(fps.select("fp").distinct(), radius)
    found = left.hint("merge").join(right, ["table", "block"])
    found = found.select("query", "fp", F.bit_count(F.col("query").bitwiseXOR(F.col("fp"))).alias("distance"))
    return found.where(F.col("distance") <= radius).distinct()


def fingerprint(docs: DataFrame) -> DataFrame:
    """(doc_id, fp): one row per distinct document."""
    return votes(_keyed(docs).withColumnRenamed("text", "body"), KEY).select(_doc_id(), "fp")


def edited_texts(docs: DataFrame, around: DataFrame) -> DataFrame:
    """(key, text, edited): the last third of the characters replaced by as many first ones of the next document.

    The beginning of every document travels to the one before it; the text itself is dealt once, by its key.
    """
    own = _keyed(docs)
    before = around.select(*KEY, *[f"prev_{k}" for k in KEY], "prev_n")
    moved = own.join(before.hint("merge"), KEY).select(
        *[F.col(f"prev_{k}").alias(k) for k in KEY], F.substring("text", F.lit(1), F.floor(F.col("prev_n") / 3).cast("int")).alias("part")
    )
    moved = moved.groupBy(*KEY).agg(F.first("part").alias("part"))  # a repeated next document counts once
    n = F.length("text")
    head = F.substring("text", F.lit(1), (n - F.floor(n / 3)).cast("int"))
    return own.join(moved.hint("merge"), KEY).select(*KEY, "text", F.concat(head, "part").alias("edited"))


def compare_edits(docs: DataFrame, radius: int = 3, every: int = 20) -> DataFrame:
    """Fingerprints of the texts and of their edited forms, one row per distinct (doc_id, text).

    ``n_near``, for ids divisible by ``every``: how many other fingerprints of the table lie within the radius.
    """
    lengths = _keyed(docs).select(*KEY, F.length("text").cast("long").alias("n")).distinct()
    around = materialize(ring(lengths), "ring-next")
    own, edited = F.struct(F.lit(0).alias("side"), F.col("text").alias("body"), F.lit(None).cast("string").alias("sha")), F.struct(
        F.lit(1).alias("side"), F.col("edited").alias("body"), F.sha2(F.col("edited").cast("binary"), 256).alias("sha")
    )
    sides = edited_texts(docs, around).select(*KEY, F.explode(F.array(own, edited)).alias("s")).select(*KEY, "s.side", "s.body", "s.sha")
    prints = materialize(votes(sides, [*KEY, "side", "sha"]), "fingerprints")
    first = prints.where("side = 0").select(*KEY, "fp")
    second = prints.where("side = 1").select(*KEY, F.col("fp").alias("edited_fp"), "sha")
    after = first.toDF(*[f"next_{k}" for k in KEY], "next_fp")
    joined = (
        around.select(*KEY, "n", *[f"next_{k}" for k in KEY])
        .join(first, KEY)
        .join(second, KEY)
        .join(after, [f"next_{k}" for k in KEY])
    )
    asked = first.where(F.col("id") % every == 0)
    near = search(asked, first, radius).where("distance > 0").groupBy("query").agg(F.count(F.lit(1)).alias("n_near"))
    joined = joined.join(near.withColumnRenamed("query", "fp"), "fp", "left")
    return joined.select(
        _doc_id(),
        F.col("n").alias("n_chars"),
        F.col("sha").alias("edited_sha256"),
        hexed(F.col("fp")).alias("fingerprint"),
        hexed(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        F.when(F.col("id") % every == 0, F.coalesce("n_near", F.lit(0))).alias("n_near"),
    )


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_edits(table(spark, sf_dir, "documents"))
