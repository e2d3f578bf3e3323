"""Article scores -> one row per trading day, topic components, time-series features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from openbell.operators.indicators import ewma

# Fixed values of the published features.
BUZZ_ROWS = 10
EWMA_SPAN = 5
PCA_K = 5
LAGS = range(1, 6)
TAIL_ROWS = 252


def _weighted(weight: str | None):
    """avg and count that honour copies when rows carry a weight."""
    if weight is None:
        return F.avg, F.count

    def avg(c: Column) -> Column:
        return F.try_divide(F.sum(c * F.col(weight)), F.sum(F.when(c.isNotNull(), F.col(weight))))

    def count(c: Column) -> Column:
        return F.sum(F.when(c.isNotNull(), F.col(weight)).otherwise(0))

    return avg, count


def _deviation(c: Column, weight: str | None) -> Column:
    if weight is None:
        return F.stddev_samp(c)
    n = F.sum(F.when(c.isNotNull(), F.col(weight)))
    spread = F.sum(c * c * F.col(weight)) - F.try_divide(F.pow(F.sum(c * F.col(weight)), F.lit(2)), n)
    return F.sqrt(F.greatest(F.try_divide(spread, F.when(n > 1, n - 1)), F.lit(0.0)))


def aggregate_daily(
    scored: DataFrame, by: Sequence[str] = (), weight: str | None = None, embedding: bool = False
) -> DataFrame:
    """One row per day (and ``by``): class means over all articles, tier-2 metrics
    over the non-neutral ones.

    One aggregation with map-side partials, so a day of breaking news costs one
    partial row per task. A day with neutral articles only has NULL metrics and a
    NULL count. One row per text is the default; to let copies count, pass rows
    pre-counted per (text, day) and name their count as ``weight``: the copies
    themselves never shuffle.
    """
    avg, count = _weighted(weight)
    active = ~F.col("is_neutral")

    def on_active(c: Column) -> Column:
        return F.when(active, c)

    polarity = on_active(F.col("prob_pos") - F.col("prob_neg"))
    impact = polarity * F.col("relevance") * F.col("subjectivity")
    n = count(polarity)
    columns = {f"prob_{k}_mean": avg(F.col(f"prob_{k}")) for k in ("pos", "neg", "neu")}
    columns |= {f"{c}_mean": avg(on_active(F.col(c))) for c in ("relevance", "novelty", "subjectivity")}
    columns |= {
        "weighted_impact": avg(impact),
        "sentiment_entropy": _deviation(polarity, weight),
        "article_count": F.when(n > 0, n).cast("double"),
    }
    if embedding:
        columns["mean_embedding"] = mean_vector("embedding", weight)
    return scored.groupBy(*by, "Date").agg(*[c.alias(k) for k, c in columns.items()])


def mean_vector(c: str, weight: str | None = None) -> Column:
    """Element-wise mean; one buffer per group instead of one row per element."""
    vector = array_to_vector(F.col(c))
    mean = Summarizer.mean(vector) if weight is None else Summarizer.mean(vector, F.col(weight))
    return vector_to_array(mean)


def copies_per_day(keyed: DataFrame, scores: DataFrame) -> DataFrame:
    """Rows of (text, day, n_rows) with the text's scores: the input of the
    copies-count variant. Copies collapse in the map-side partial of the count."""
    counted = keyed.groupBy("text_hash", "Date").agg(F.count("*").alias("n_rows"))
    return counted.join(scores.drop("Date", "published_at", "n_copies"), "text_hash")


# --- topic components -------------------------------------------------------

def fit_topics(daily: DataFrame, k: int = PCA_K) -> PipelineModel:
    """Centre and rotate the daily mean vectors. Fit once, persist, and only
    transform afterwards: a refit would turn the axes under old rows. Spark's PCA
    does not centre, hence the scaler."""
    vectors = daily.select(array_to_vector("mean_embedding").alias("vec"))
    return Pipeline(stages=[
        StandardScaler(inputCol="vec", outputCol="centred", withMean=True, withStd=False),
        PCA(k=k, inputCol="centred", outputCol="topics"),
    ]).fit(vectors)


def with_topics(daily: DataFrame, model: PipelineModel, k: int = PCA_K) -> DataFrame:
    out = model.transform(daily.withColumn("vec", array_to_vector("mean_embedding")))
    topics = vector_to_array("topics")
    return out.withColumns({f"context_pca_{i + 1}": topics[i] for i in range(k)}).drop(
        "vec", "centred", "topics", "mean_embedding"
    )


# --- time-series features ---------------------------------------------------

def _days(by: Sequence[str]):
    """Ordered days of one group; a table without groups is a single calendar,
    one row per day, so its one window partition stays small."""
    return Window.partitionBy(*by).orderBy("Date") if by else Window.partitionBy(F.lit(0)).orderBy("Date")


def buzz(count: str, w, n: int = BUZZ_ROWS) -> Column:
    """Today's count against the mean of the previous rows (at most n, at least
    one); a missing count is zero and a zero mean gives NULL."""
    filled = F.coalesce(F.col(count), F.lit(0.0))
    return F.try_divide(filled, F.avg(filled).over(w.rowsBetween(-n, -1)))


def with_lags(daily: DataFrame, value: str = "weighted_impact", by: Sequence[str] = (), count: str | None = "article_count") -> DataFrame:
    """Add buzz, momentum and the five explicit lags."""
    w = _days(by)
    out = {"sentiment_momentum": F.col(value) - F.lag(value).over(w)}
    out |= {f"impact_lag_{k}": F.lag(value, k).over(w) for k in LAGS}
    if count:
        out["buzz_factor"] = buzz(count, w)
    return daily.withColumns(out)


def with_time_series(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    smoothed = ewma(daily, "weighted_impact", "sentiment_ewma_5d", EWMA_SPAN, by=by, date="Date")
    return with_lags(smoothed, by=by)


def with_tail_flags(
    daily: DataFrame,
    value: str = "weighted_impact",
    by: Sequence[str] = (),
    n: int = TAIL_ROWS,
    share: float = 0.02,
    date: str = "Date",
) -> DataFrame:
    """Flags for days beyond the trailing 98th or below the 2nd percentile of the
    n rows before them; NULL until n values exist, so no row sees itself."""
    w = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy(date)
    frame = w.rowsBetween(-n, -1)
    cuts = F.percentile(value, F.array(F.lit(1 - share), F.lit(share))).over(frame)
    warm = F.count(value).over(frame) == n

    def flag(c: Column) -> Column:
        return F.when(F.col("_warm"), c.cast("tinyint"))

    return daily.withColumns({"_cuts": cuts, "_warm": warm}).withColumns({
        "is_top_2pct_weighted_impact": flag(F.col(value) > F.col("_cuts")[0]),
        "is_bot_2pct_weighted_impact": flag(F.col(value) < F.col("_cuts")[1]),
    }).drop("_cuts", "_warm")


def daily_sentiment(scored: DataFrame, topics: PipelineModel, by: Sequence[str] = ()) -> DataFrame:
    """The published daily table: 22 features per trading day."""
    from openbell.schemas import DAILY_SENTIMENT

    daily = with_topics(aggregate_daily(scored, by, embedding=True), topics)
    return with_time_series(daily, by).select(*by, "Date", *DAILY_SENTIMENT)
