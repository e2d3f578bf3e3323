"""The corpus pipeline: documents in, packed training sequences out.

Every stage works on all rows that its predecessor kept, is written as Parquet and read again as the next one's
input. All but the last return the columns of ``documents``.

Defined cases: every stage handles null texts and ids, repeated rows and empty tables as its operator says; texts
that are null or hold no letter end at the first stage; an empty table gives empty sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from openbell.llm import language, lines, packing, tiling, vptree
from openbell.session import drop_materialized, materialize, materialized_count

#: Texts less like every learned language than this (1: alike, 0: no common n-gram) are rejected. Clean text scores
#: above 0.4, also single words and mixed languages.
MIN_LANGUAGE_SCORE = 0.25


def _aside(docs: DataFrame) -> DataFrame:
    """``text``, and all other columns as one struct ``row``, so that no other name can clash and no text is held twice."""
    return docs.select("text", F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"))


def _restored(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in columns])


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in one of the languages that the labelled rows teach.

    Without any labelled row only texts that have no letter are rejected.
    """
    profiles = language.learn(docs)
    if not profiles.names:
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    found = language.predict(_aside(docs), profiles)
    return _restored(found.where((F.col("lang_pred") != "und") & (F.col("lang_score") >= MIN_LANGUAGE_SCORE)), docs.columns)


def unique_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without chunks and passages of two or more lines that stand earlier; documents of which nothing is left go."""
    rest = [c for c in docs.columns if c != "text"]
    cut = lines.dedup_lines(docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row")), passages=True)
    left = cut.where((F.col("_gone_lines") == 0) | F.col("text").rlike(r"[^ \t\r\n]"))
    length = F.when(F.col("_gone_lines") > 0, F.length("text").cast("long"))
    named = {"text": F.col("text"), "n_chars": F.coalesce(length, F.col("row.n_chars"))} if "n_chars" in rest else {"text": F.col("text")}
    return left.select(*[named.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8)."""
    return vptree.keep_one(docs)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    judged = tiling.contaminations(_aside(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _restored(judged.where(F.size("_items") == 0), docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in training sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("language", known_language),
    ("line_dedup", unique_lines),
    ("near_dedup", one_of_each),
    ("decontaminate", clean_of_benchmark),
    ("packing", packed),
]

#: Profiles, fingerprints, tilings and packings are beyond SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage; a stage's own tables go once its result is written, and the result once the next is."""
    docs, since = spark.read.parquet(f"{sf_dir}/documents.parquet"), materialized_count()
    for name, stage in STAGES:
        made = stage(spark, docs, sf_dir)
        docs = materialize(made, name)
        drop_materialized(spark, since, materialized_count() - 1)
    return docs
