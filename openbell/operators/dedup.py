"""Deduplication with a total order.

Each variant is one ``row_number() == 1`` filter. Spark turns that into a
WindowGroupLimit before the shuffle, so a key that holds a third of all rows
arrives as at most one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Optional column with the place of a row inside its load.
DELIVERY = "delivery"


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key. Ties of ``order`` go to the earliest delivered row where the
    table says so, and then by the values themselves: never by partitioning."""
    rest = [c for c, kind in df.dtypes if c not in keys and c != DELIVERY and not kind.startswith(("map", "void"))]
    ties = ([F.col(DELIVERY)] if DELIVERY in df.columns else []) + [F.xxhash64(*rest)] * bool(rest)
    w = Window.partitionBy(*keys).orderBy(*order, *ties)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def keep_first(df: DataFrame, keys: Sequence[str], seq: str = "load_seq") -> DataFrame:
    return keep_one(df, keys, [F.col(seq).asc()])


def keep_last(df: DataFrame, keys: Sequence[str], seq: str = "load_seq") -> DataFrame:
    return keep_one(df, keys, [F.col(seq).desc()])


def keep_by_rule(
    df: DataFrame, volume_rules: Column, keys: Sequence[str] = ("symbol", "ts"), seq: str = "load_seq"
) -> DataFrame:
    """The most traded row where ``volume_rules`` holds, else the first."""
    volume = F.when(volume_rules, F.col("volume"))
    return keep_one(df, keys, [volume.desc_nulls_last(), F.col(seq).asc()])


def keep_highest_volume(
    df: DataFrame, keys: Sequence[str] = ("symbol", "ts"), seq: str = "load_seq"
) -> DataFrame:
    """One bar per minute where contract months overlap: the most traded one,
    the earliest loaded on a tie. A missing volume loses."""
    return keep_one(df, keys, [F.col("volume").desc_nulls_last(), F.col(seq).asc()])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count.

    Text keys are counted by their full digest (null apart from empty), so whole
    texts are read again for the repeated ones only.
    """
    kinds = dict(df.dtypes)
    if not any(kinds[c] == "string" for c in keys):
        return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")
    marks = [
        F.coalesce(F.sha2(F.col(c), 256), F.lit("-")) if kinds[c] == "string" else F.col(c) for c in keys
    ]
    marked = df.select(*keys, F.sha2(F.to_json(F.struct(*marks)), 256).alias("_digest"))
    counted = marked.groupBy("_digest").agg(F.count("*").alias("n_rows")).filter("n_rows > 1")
    # within a task one row per key is left before anything is shuffled
    return marked.join(counted, "_digest").dropDuplicates(["_digest"]).select(*keys, "n_rows")


def latest_per_day(
    articles: DataFrame, cap: int = 500, ts: str = "published_at", tie: Sequence[str] = ("title",)
) -> DataFrame:
    """The provider's daily page budget: the newest ``cap`` articles of a UTC day.

    Optional on landing; the cap is the feature, not a guard against volume.
    """
    w = Window.partitionBy(F.to_date(ts)).orderBy(F.col(ts).desc(), *[F.col(c) for c in tie])
    return (
        articles.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= cap).drop("_rn")
    )
