"""Article sources: landing, incremental loads and time-boxing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from openbell.functions.clock import article_date
from openbell.functions.text import news_text
from openbell.operators.dedup import DELIVERY, keep_first, keep_last
from openbell.schemas import ARTICLES_LANDING

ARTICLE_KEY = ["title", "published_at"]


def read_landing(spark: SparkSession, path: str, load_seq: int = 0) -> DataFrame:
    """JSON records as delivered, with parsed timestamps and the load's number.

    ``delivery`` orders the rows of a load by file name, block and place in the block,
    whatever the partitioning.
    """
    raw = spark.read.schema(ARTICLES_LANDING).json(path)
    raw = raw.select(
        *raw.columns,
        F.struct("_metadata.file_name", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row")).alias(DELIVERY),
    )
    parsed = F.coalesce(
        F.col("published_at").try_cast("timestamp").cast("timestamp_ntz"),
        F.try_to_timestamp("published_at").cast("timestamp_ntz"),
    )
    return raw.withColumns({"published_at": parsed, "load_seq": F.lit(load_seq).cast("bigint")})


def landed(records: DataFrame) -> DataFrame:
    """First delivery of an article wins."""
    return keep_first(records, ARTICLE_KEY).drop(DELIVERY)


def table_state(existing: DataFrame, *by: str) -> DataFrame:
    """Rows, newest stored timestamp and ``corrupt``, per group: a table without a valid timestamp is corrupt."""
    newest = F.max("published_at")
    return existing.groupBy(*by).agg(
        F.count("*").alias("n"), newest.alias("last_seen"), newest.isNull().alias("corrupt")
    )


def last_seen(existing: DataFrame) -> dt.datetime:
    """Newest stored timestamp; a table without one is corrupt, not empty."""
    state = table_state(existing).first()
    if state["corrupt"]:
        raise ValueError("article table has no valid published_at; refusing to reload history")
    return state["last_seen"]


def missing_days(manifest: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Days of ``[first, last]`` without a good load."""
    days = manifest.sparkSession.range(1).select(
        F.explode(F.sequence(F.lit(first), F.lit(last))).alias("load_date")
    )
    return days.join(manifest.filter("ok").select("load_date").distinct(), "load_date", "left_anti")


def check_manifest(manifest: DataFrame, first: dt.date, last: dt.date) -> None:
    """All or nothing: raise unless every day of ``[first, last]`` loaded.

    The expected days are generated, so a day without a manifest row counts as
    failed too.
    """
    failed = missing_days(manifest, first, last).agg(
        F.sort_array(F.collect_list(F.col("load_date").cast("string"))).alias("days")
    ).first()["days"]
    if failed:
        raise RuntimeError(f"article load incomplete, nothing written: {', '.join(failed)}")


def merged(existing: DataFrame, incoming: DataFrame, since: dt.datetime | None = None) -> DataFrame:
    """Existing plus incoming, newest load wins per (title, published_at).

    The load is taken again from the start of the last seen *day*, so articles
    that arrived late on that day are caught. Days before it are untouched and
    skip the merge entirely.
    """
    if since is None:
        return keep_last(existing.unionByName(incoming, allowMissingColumns=True), ARTICLE_KEY)
    day = F.lit(dt.datetime.combine(since.date(), dt.time())).cast("timestamp_ntz")
    old = existing.filter(F.col("published_at") < day)
    retaken = existing.filter(F.col("published_at") >= day)
    fresh = incoming.filter(F.col("published_at") >= day)
    both = keep_last(retaken.unionByName(fresh, allowMissingColumns=True), ARTICLE_KEY)
    return old.unionByName(both, allowMissingColumns=True)


def aligned(articles: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per pre-market article: trading day, publish time, whole text.

    A pure projection and filter, no shuffle; duplicates are kept.
    """
    return (
        articles.withColumns({"Date": article_date("published_at"), "news_text": news_text()})
        .filter(F.col("Date").isNotNull())
        .select("Date", "published_at", "news_text", *extra)
    )
