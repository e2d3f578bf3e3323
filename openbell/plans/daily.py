"""The daily run: land, settle, rebuild, train, predict, record, report.

One function per step, each DataFrame -> table; tables meet only through the
store, so any step can be rerun alone. ``as_of`` decides everything, the wall
clock nothing: a second run of a day writes the same tables.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from openbell.functions.clock import ONE_MINUTE, SessionClock, is_weekday, lookback, snapshot_bound
from openbell.operators import calendar as cal
from openbell.operators import daily_news as news
from openbell.operators import day_sums
from openbell.operators import ledger as led
from openbell.operators import model as ml
from openbell.operators import report as rep
from openbell.operators import scoring as sc
from openbell.operators import sessions as ses
from openbell.operators.contracts import Observed
from openbell.plans import market
from openbell.schemas import DAILY_SENTIMENT
from openbell.session import drop_materialized, materialize, materialized_count
from openbell.sources import articles as art
from openbell.sources import bars as src
from openbell.sources.store import TableStore

REQUIRED = {
    "bar_watermarks": "load the bar history once with seed_bars",
    "articles_loaded": "load the article history once with seed_articles",
}


@dataclass(frozen=True)
class Run:
    """Settings of one daily run. ``batch`` grows with every day's load; running a
    batch again replaces what that batch wrote."""

    store: TableStore
    as_of: dt.date
    batch: int
    scorer: sc.Scorer
    instruments: tuple[str, ...]
    sources: list[src.SourceConfig]
    clock: SessionClock = ONE_MINUTE
    mode: str = "mae"
    years: int = 5
    trials: int = ml.TRIALS
    max_rounds: int = ml.MAX_ROUNDS
    parallelism: int = 4
    keep_versions: int = 3
    keep_batches: int = 30
    force_search: bool = False
    features: list[str] | None = None
    level_source: str = "vix"
    calendar: tuple = field(default=(cal.DEFAULT_START, cal.DEFAULT_END))

    @property
    def bound(self) -> dt.datetime:
        return snapshot_bound(self.as_of, clock=self.clock)

    @property
    def level_symbol(self) -> str:
        return next(s.symbol for s in self.sources if s.source == self.level_source)

    @property
    def bars_path(self) -> str:
        return f"{self.store.root}/bars"

    @property
    def daily_path(self) -> str:
        return f"{self.store.root}/daily"

    @property
    def articles_path(self) -> str:
        return f"{self.store.root}/articles"


# --- landing ------------------------------------------------------------------

def _write_load(run: Run, fresh: DataFrame, batch: int) -> None:
    """One folder per load, so a repeated load overwrites itself; the table of last
    bars per symbol and load spares the next load a scan of the history."""
    src.append_bars(fresh, f"{run.bars_path}/load={batch}", run.clock, mode="overwrite")
    written = run.store.spark.read.parquet(f"{run.bars_path}/load={batch}")
    marks = written.groupBy("symbol").agg(F.max("ts").alias("last_ts")).withColumn("load", F.lit(batch))
    if run.store.exists("bar_watermarks"):
        marks = run.store.read("bar_watermarks").filter(F.col("load") < batch).unionByName(marks)
    run.store.replace("bar_watermarks", marks)


def seed_bars(run: Run, history: DataFrame) -> None:
    clean, _ = src.healed(history)
    _write_load(run, clean, 0)


def land_bars(run: Run, incoming: DataFrame) -> None:
    """Append what extends each symbol; nothing is rewritten."""
    known = run.store.read("bar_watermarks").filter(F.col("load") < run.batch)
    known = known.select("symbol", F.col("last_ts").alias("ts"))
    # contract months of macro series overlap: the most traded bar; an instrument keeps its first
    macro = [s.symbol for s in run.sources if s.symbol not in run.instruments]
    _write_load(run, src.new_bars(known, incoming, run.bound, keep=F.col("symbol").isin(*macro)), run.batch)


def refresh_daily(run: Run) -> None:
    """Bring the per-day table up to date: one aggregation over the months that
    loads since the last refresh have touched, whatever the length of history."""
    spark, built = run.store.spark, -1
    if run.store.exists("daily_built"):
        built = min(run.store.read("daily_built").first()["load"], run.batch)
    loads = spark.read.parquet(run.bars_path).filter(F.col("load").between(max(built, 0), run.batch))
    month = loads.agg(F.min("et_month").alias("m")).first()["m"]
    if month is not None:
        first = dt.date.fromisoformat(f"{month}-01")
        before = (first - dt.timedelta(days=1)).strftime("%Y-%m")
        # the evening bar of a month's last day belongs to the next month
        bars = src.read_stamped(spark, run.bars_path, before).filter(
            F.col("ts") < F.lit(run.bound).cast("timestamp_ntz")
        )
        wide = ses.daily_anchors_wide(bars, run.clock, asof=True).filter(F.col("date") >= F.lit(first))
        (
            wide.withColumn("month", F.date_format("date", "yyyy-MM"))
            .hint("rebalance", "month").write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(run.daily_path)
        )
    run.store.replace("daily_built", spark.range(1).select(F.lit(run.batch).alias("load")))


def daily_table(run: Run) -> DataFrame:
    """All per-day rows, about 250 a year and symbol: recursive means and settlements
    must not depend on where a table was cut. The lookback applies to outputs."""
    return run.store.spark.read.parquet(run.daily_path).drop("month")


def _write_articles(run: Run, rows: DataFrame) -> None:
    """Replace the UTC days that ``rows`` covers, leave all others alone."""
    by_day = rows.withColumn("day", F.to_date("published_at"))
    (
        by_day.hint("rebalance", "day").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(run.articles_path)
    )
    newest = rows.agg(F.max("published_at").alias("published_at"), F.lit(run.batch).alias("batch"))
    run.store.replace("articles_loaded", newest)


def seed_articles(run: Run, history: DataFrame) -> None:
    _write_articles(run, art.landed(history))


def articles(run: Run) -> DataFrame:
    return run.store.spark.read.parquet(run.articles_path)


def land_articles(run: Run, incoming: DataFrame, manifest: DataFrame | None = None) -> None:
    """Take the load again from the last seen day on; earlier days are not read."""
    since = art.last_seen(run.store.read("articles_loaded"))
    if manifest is not None:
        art.check_manifest(manifest, since.date(), run.as_of)
    recent = articles(run).filter(F.col("day") >= F.lit(since.date())).drop("day")
    merged = art.merged(recent, incoming.select(*recent.columns), since)
    # the rewritten days are inputs too: write them aside before replacing them
    _write_articles(run, materialize(merged, "articles"))


# --- stages -------------------------------------------------------------------

def score(run: Run) -> DataFrame:
    """Score the days landed since the last completed scoring, and retry failures
    from the days they were published on; other days are not read."""
    everything, recent, retry = articles(run), articles(run), None
    if run.store.exists("scored_through"):
        through = run.store.read("scored_through").first()["day"]
        recent = everything.filter(F.col("day") >= F.lit(through))
        failed = sc.open_failures(sc.checkpoint(run.store))
        days = failed.select(F.to_date("published_at").alias("day")).distinct()
        retry = art.aligned(everything.join(days, "day", "left_semi"))
    out = sc.score_articles(art.aligned(recent), run.scorer, run.store, run.batch, retry_from=retry)
    newest = run.store.read("articles_loaded").select(F.to_date("published_at").alias("day"))
    run.store.replace("scored_through", newest)
    return out


def _news_days(run: Run) -> DataFrame:
    """One row per day from the stored sums: only the scores of batches that the sums
    lack are read, and running a batch again replaces that batch's sums."""
    store, scores = run.store, sc.checkpoint(run.store)
    fresh, after = not store.exists("day_sums"), -1
    store.declare("day_sums", day_sums.STATE, ("batch",))
    if not fresh:
        marks = store.read("day_sums").agg(
            F.max(F.when(F.col("batch") < run.batch, F.col("batch"))).alias("before"), F.min("batch").alias("first")
        ).first()
        if marks["before"] is None and marks["first"] is not None and marks["first"] > run.batch:
            raise ValueError(f"batch {run.batch} was folded into batch {marks['first']} and cannot run again")
        after = -1 if marks["before"] is None else marks["before"]
    store.overwrite("day_sums", day_sums.deltas(scores, after, run.batch))
    state = store.read("day_sums").filter(F.col("batch") <= run.batch)
    return store.replace("daily_scores", day_sums.finished(day_sums.merged(state)))


def fold_news(run: Run) -> None:
    """Keep the score checkpoint and the sums at a bounded number of batches."""
    store, last = run.store, run.batch - run.keep_batches
    sc.compact_batches(store, run.batch, run.keep_batches)
    state = store.read("day_sums")
    if state.select("batch").distinct().count() > 2 * run.keep_batches:
        old = day_sums.merged(state.filter(F.col("batch") <= last)).withColumn("batch", F.lit(last).cast("bigint"))
        store.replace("day_sums", old.unionByName(state.filter(F.col("batch") > last)).hint("rebalance", "batch"))


def sentiment(run: Run) -> DataFrame:
    """Daily table; the topic axes are fitted once and loaded ever after."""
    daily = _news_days(run)
    if run.store.exists("topics"):
        topics = PipelineModel.load(run.store.location("topics") + "/model")
    elif run.store.exists("sentiment"):
        raise RuntimeError("the fitted topic axes are lost: new ones would not fit the stored components")
    else:
        topics = news.fit_topics(daily)
        path = run.store.next_location("topics")
        topics.write().overwrite().save(path + "/model")
        # the marker makes the version visible, as Spark's own writes do
        run.store.spark.range(0).write.mode("append").parquet(path)
    out = news.with_time_series(news.with_topics(daily, topics)).select("Date", *DAILY_SENTIMENT)
    return run.store.replace("sentiment", news.with_tail_flags(out))


def settle(run: Run) -> None:
    led.Ledger(run.store).settle(run.store.read("ranges"), f"settle-{run.batch}")


def rebuild(run: Run) -> DataFrame:
    """Feature tables, all from the per-day table: no bar is read here."""
    spark, stored = run.store.spark, daily_table(run)
    sessions = ses.complete_sessions(stored.filter("has_session"), run.as_of)
    run.store.replace("ranges", ses.realized_range(sessions))
    level = stored.filter(F.col("symbol") == run.level_symbol).filter("snapshot_9am IS NOT NULL")
    run.store.replace("level", level.select("date", F.col("snapshot_9am").alias("vix_level")))
    matrix = run.store.replace("market", market.matrix_from_daily(
        stored.filter(F.col("symbol").isin(*run.instruments)), run.as_of, run.years, keep_unsettled=True
    ))
    anchors = stored.filter(is_weekday("date") & F.coalesce("snapshot_9am", "close_4pm").isNotNull())
    macro = ses.macro_features_wide(anchors, run.sources)
    macro = run.store.replace("macro", lookback(macro, run.as_of, run.years))
    calendar = run.store.replace("calendar", cal.calendar_features(
        cal.default_bounds(spark, *run.calendar), cal.event_table(spark)
    ))
    merged = market.merge_features(
        matrix, macro, market.prepare_sentiment(run.store.read("sentiment")), calendar, keep_unsettled=True,
        check_rows="inside",
    )
    seen = Observed(merged)
    out = run.store.replace("model_data", seen.frame)
    run.store.replace("model_data_nulls", seen.nulls().coalesce(1))
    return out


def train(run: Run) -> tuple[PipelineModel, DataFrame]:
    data = market.assemble(
        run.store.read("model_data").filter("y IS NOT NULL"), run.store.read("ranges"), run.store.read("level")
    )
    names = run.features or [c for c in data.columns if c not in ("symbol", "date", "target")]
    # a column without a single value cannot be imputed (tail flags in the first year)
    filled = data.agg(*[F.count(c).alias(c) for c in names]).first()
    names = [c for c in names if filled[c]]
    meta = run.store.read("model_meta") if run.store.exists("model_meta") else None
    nullable = [c for c in names if c in ("vix_level", "is_top_2pct_weighted_impact", "is_bot_2pct_weighted_impact")]
    model, new = ml.train_or_refit(
        data, names, dt.datetime.combine(run.as_of, dt.time()), f"{run.store.root}/model_{run.mode}/{run.batch}",
        run.mode, meta, run.force_search, nullable, run.trials, run.max_rounds,
        run.parallelism,
    )
    others = meta.filter(F.col("mode") != run.mode) if meta is not None else None
    run.store.replace("model_meta", new if others is None else others.unionByName(new))
    return model, new


def predict(run: Run, model: PipelineModel, meta: DataFrame) -> DataFrame:
    """Score ``as_of`` and record it; returns the feature rows with predictions."""
    spark = run.store.spark
    wanted = spark.createDataFrame([(s, run.as_of) for s in run.instruments], "symbol STRING, date DATE")
    rows = market.features_for_dates(
        run.store.read("model_data"), run.store.read("ranges"), run.store.read("level"), wanted
    )
    info = meta.first()
    scored = ml.predict(model, market.check_scoring_rows(rows), info["feature_names"])
    entry = scored.select(
        "symbol", "date", "predicted_range",
        F.lit(None).cast("double").alias("actual_range"), F.lit(None).cast("double").alias("abs_error"),
        F.lit(run.as_of.isoformat()).alias("prediction_timestamp"), F.lit(run.mode).alias("model_mode"),
        F.lit(str(info["trained_at"])).alias("model_trained_at"),
        F.lit(info["train_rows"]).cast("bigint").alias("model_train_rows"),
        F.lit(str(info["last_search"])).alias("last_search"),
    )
    led.Ledger(run.store).upsert(entry, f"predict-{run.batch}")
    return scored


def report(run: Run, scored: DataFrame, meta: DataFrame) -> DataFrame:
    keys = scored.select("symbol", "date")
    merged = run.store.read("model_data").select("symbol", "date", "weighted_impact")
    info = meta.first()
    tested = (info["test_metrics"] or {}).get("model")
    context = {
        "model_trained_at": F.lit(str(info["trained_at"])), "last_search": F.lit(str(info["last_search"])),
        "model_train_rows": F.lit(str(info["train_rows"])), "train_start": F.lit(info["train_start"]),
        "train_end": F.lit(info["train_end"]),
        "test_mae": F.lit(tested["mae"] if tested else None).cast("double"),
        "test_coverage": F.lit(tested["coverage_at_mae"] if tested else None).cast("double"),
    }
    rows = (
        scored.join(rep.range_history(run.store.read("ranges"), keys), ["symbol", "date"], "left")
        .join(rep.tone_history(merged), ["symbol", "date"], "left")
        .join(led.last_settled(run.store.read("predictions")), "symbol", "left")
        .withColumns(context)
    )
    return run.store.replace("report", rep.forecast_report(rows))


def run_daily(
    run: Run, new_bars: DataFrame | None = None, new_articles: DataFrame | None = None
) -> DataFrame:
    """All steps in order; returns the report. Intermediate tables go at the end, and
    so do all but the last ``keep_versions`` versions of each stage table."""
    run.store.require(**REQUIRED)
    before = materialized_count()
    if new_bars is not None:
        land_bars(run, new_bars)
    if new_articles is not None:
        land_articles(run, new_articles)
    refresh_daily(run)
    score(run)
    sentiment(run)
    rebuild(run)
    settle(run)
    model, meta = train(run)
    scored = predict(run, model, meta)
    out = report(run, scored, meta)
    fold_news(run)
    drop_materialized(run.store.spark, before)
    run.store.prune(run.keep_versions)
    return out
