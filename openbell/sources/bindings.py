"""Market, news and score tables derived from the shared test tables.

Each binding reads one whole table, so its size follows the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from openbell.functions.clock import HALF_HOUR, NEW_YORK, from_wall_clock, is_weekday, seconds
from openbell.sources.bars import SourceConfig

CLOCK = HALF_HOUR
SLOTS = ("08:30", "09:00", "09:30", "12:30", "15:30", "18:00")
EVENT_SOURCES = [SourceConfig("vix", "error"), SourceConfig("tenY", "view", invert_sign=True)]
LINE_SOURCES = [SourceConfig("vix", "N"), SourceConfig("tenY", "R", invert_sign=True)]
LINE_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: 30-minute bars of one month; symbol = event type, price = 100 + value."""
    ticks = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"), "ts", (100 + F.col("value")).alias("price")
    )
    return (
        ticks.groupBy("symbol", F.window("ts", "30 minutes").alias("w"))
        .agg(
            F.min_by("price", "ts").alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", "ts").alias("close"),
            F.count("*").cast("double").alias("volume"),
        )
        .select("symbol", F.col("w.start").alias("ts"), "open", "high", "low", "close", "volume")
    )


def _line_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a rank-free total order: the five columns together are unique
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("symbol"),
        F.to_date("l_shipdate").alias("day"),
        F.struct(*LINE_ORDER).alias("ord"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("quantity"),
        "l_orderkey", "l_linenumber", "l_partkey",
    )


def _ohlcv(grouped) -> DataFrame:
    return grouped.agg(
        F.min_by("price", "ord").alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", "ord").alias("close"),
        F.sum("quantity").alias("volume"),
    )


def daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2: seven years of daily OHLCV per return flag, weekdays only."""
    lines = _line_prices(spark, sf_dir).filter(is_weekday("day"))
    return _ohlcv(lines.groupBy("symbol", F.col("day").alias("date")))


def line_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven years of half-hour bars: every line falls into one of six session
    slots, chosen by its keys. Long enough for 200- and 252-row windows. The bars
    come stamped with their local day and second, as a stored bar table is."""
    slot = F.pmod(F.col("l_orderkey") + F.col("l_linenumber") + F.col("l_partkey"), F.lit(len(SLOTS)))
    lines = _line_prices(spark, sf_dir)
    bars = _ohlcv(lines.groupBy("symbol", "day", slot.alias("slot")))
    second = F.element_at(F.array(*[F.lit(seconds(s)) for s in SLOTS]), (F.col("slot") + 1).cast("int"))
    local = F.col("day").cast("timestamp_ntz") + F.make_dt_interval(secs=second)
    return bars.select(
        "symbol", from_wall_clock(local, NEW_YORK).alias("ts"), "open", "high", "low", "close", "volume",
        F.col("day").alias("et_date"), second.alias("et_second"),
    )


def as_articles(documents: DataFrame, start: str = "2024-01-01") -> DataFrame:
    """B3: one article per document, 127 minutes apart. The title is the first 60
    characters and the description all the rest, so no text is cut."""
    at = F.lit(f"{start} 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        mins=(F.col("doc_id") * 127).cast("int")
    )
    return documents.select(
        "doc_id",
        at.alias("published_at"),
        F.substring("text", 1, 60).alias("title"),
        F.expr("substr(text, 61)").alias("description"),
        F.col("doc_id").alias("load_seq"),
    )


def articles(spark: SparkSession, sf_dir: str, start: str = "2024-01-01") -> DataFrame:
    return as_articles(table(spark, sf_dir, "documents"), start)


def article_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B4: class probabilities and tier-2 scores per document, by arithmetic."""
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id",
        "doc_id * 7919 % 17 + 1 AS a",
        "doc_id * 104729 % 23 + 1 AS b",
        "doc_id * 1299709 % 29 + 1 + CASE WHEN doc_id % 4 = 0 THEN 400 ELSE 0 END AS c",
    ).selectExpr(
        "doc_id",
        "a * 1e0 / (a + b + c) AS prob_pos",
        "b * 1e0 / (a + b + c) AS prob_neg",
        "c * 1e0 / (a + b + c) AS prob_neu",
        *[
            f"CASE WHEN doc_id % 13 = 0 THEN NULL ELSE 0.10e0 + (doc_id * {k} % 91) / 1e2 END AS {n}"
            for n, k in (("relevance", 31), ("novelty", 37), ("subjectivity", 41))
        ],
    )


def scored_articles(
    spark: SparkSession, sf_dir: str, start: str = "2024-01-01", embedding: bool = False
) -> DataFrame:
    """B3 time-boxed, joined with its B4 scores (and B5 vectors when asked)."""
    from openbell.operators.scoring import gate
    from openbell.sources.articles import aligned

    boxed = aligned(articles(spark, sf_dir, start), extra=("doc_id",)).drop("news_text")
    scored = gate(boxed.join(article_scores(spark, sf_dir), "doc_id"))
    if not embedding:
        return scored
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    # every vector id is used by docs id, id + n, id + 2n, ...
    count = vectors.agg(F.count("*").alias("n")).first()["n"]
    return scored.withColumn("vec_id", F.col("doc_id") % count).join(vectors, "vec_id").drop("vec_id")
