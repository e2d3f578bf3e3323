import datetime as dt
import tempfile

from conftest import rows
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from openbell.functions.clock import from_wall_clock
from openbell.operators import scoring as sc
from openbell.operators.sessions import daily_anchors_wide
from openbell.plans import daily
from openbell.plans.scorers import hash_scorer
from openbell.sources.bars import SourceConfig
from openbell.sources.store import TableStore

D = dt.date
FIRST = D(2023, 1, 2)
TIMES = ("08:30", "09:00", "09:30", "12:00", "15:59", "18:00")


def make_history(spark, n_days):
    """Six bars per day for an index and two macro series, weekends without bars."""
    days = spark.range(n_days).select(F.expr(f"date_add(date'{FIRST}', cast(id as int))").alias("d"), "id")
    slots = F.explode(F.array(*[
        F.struct(F.lit(s).alias("symbol"), F.lit(k).alias("k"), F.lit(t).alias("t"))
        for s in ("ES", "VX", "ZN") for k, t in enumerate(TIMES)
    ]))
    bars = days.filter("weekday(d) < 5").withColumn("slot", slots).select("d", "id", "slot.*")
    level = 100 + (F.xxhash64("symbol", "d", "k") % 500) / 100
    at = F.to_timestamp_ntz(F.concat(F.col("d").cast("string"), F.lit(" "), "t"), F.lit("yyyy-MM-dd HH:mm"))
    return bars.select(
        "symbol", from_wall_clock(at, "America/New_York").alias("ts"), level.alias("open"),
        (level * (1.004 + F.col("id") % 5 / 1000)).alias("high"), (level * 0.997).alias("low"),
        (level + F.col("k") % 3 - 1).alias("close"), F.lit(10.0).alias("volume"),
        F.lit(1).cast("bigint").alias("load_seq"),
    )


def make_articles(spark, n_days):
    return spark.range(n_days * 2).select(
        F.concat(F.lit("title "), F.col("id") % (n_days - 3)).alias("title"), F.lit("text").alias("description"),
        F.expr(f"timestamp_ntz'{FIRST} 02:00:00' + make_dt_interval(0, cast(id * 12 as int))").alias("published_at"),
        F.lit(1).cast("bigint").alias("load_seq"),
    )


def test_two_days_and_a_rerun(spark):
    store = TableStore(spark, tempfile.mkdtemp(prefix="openbell-daily-"))
    today = D(2023, 12, 12)
    n = (today - FIRST).days + 1
    settings = dict(
        store=store, scorer=hash_scorer(), instruments=("ES",),
        sources=[SourceConfig("vix", "VX"), SourceConfig("tenY", "ZN", invert_sign=True)],
        years=1, trials=1, max_rounds=2, calendar=(D(2022, 1, 1), D(2024, 12, 31)),
        features=["prev_day_range", "rv_lag_5", "rv_lag_22", "rsi_14", "buzz_factor", "days_to_opex", "vix_level",
                  "is_top_2pct_weighted_impact"],
    )
    history, news = make_history(spark, n + 1).persist(), make_articles(spark, n + 1).persist()
    cut = F.lit(dt.datetime(2023, 12, 1)).cast("timestamp_ntz")
    run = daily.Run(as_of=today, batch=1, **settings)
    daily.seed_bars(run, history.filter(F.col("ts") < cut))
    daily.seed_articles(run, news.filter(F.col("published_at") < cut))
    report = daily.run_daily(run, history, news).collect()
    assert len(report) == 1 and report[0]["date"] == today and report[0]["title"].startswith("ES: ")

    # nothing of the session was stored: the bound stops at the snapshot
    stored = spark.read.parquet(run.bars_path)
    assert stored.agg(F.max("ts")).first()[0] == dt.datetime(2023, 12, 12, 14, 0)
    assert stored.groupBy("symbol", "ts").count().filter("count > 1").count() == 0
    ledger = store.read("predictions")
    assert rows(ledger, "date", "actual_range") == [(today, None)]
    n_bars, texts = stored.count(), sc.current_scores(store.read("article_scores")).count()

    # landing, scoring and predicting the same day again changes nothing
    daily.land_bars(run, history)
    daily.land_articles(run, news)
    daily.refresh_daily(run)
    daily.score(run)
    daily.rebuild(run)
    meta = store.read("model_meta")
    daily.predict(run, PipelineModel.load(meta.first()["model_path"]), meta)
    assert spark.read.parquet(run.bars_path).count() == n_bars
    assert sc.current_scores(store.read("article_scores")).count() == texts
    assert rows(store.read("predictions"), "date", "predicted_range") == rows(ledger, "date", "predicted_range")

    # the stored daily table equals one built from all bars at once
    wide = daily_anchors_wide(spark.read.parquet(run.bars_path), asof=True)
    kept = spark.read.parquet(run.daily_path).select(*wide.columns)
    assert wide.exceptAll(kept).count() == 0 and kept.exceptAll(wide).count() == 0

    # the next day settles the first and keeps its parameters
    searched = store.read("model_meta").first()["last_search"]
    later = daily.Run(as_of=today + dt.timedelta(days=1), batch=2, **settings)
    daily.run_daily(later, history, news)
    book = {r["date"]: r for r in store.read("predictions").collect()}
    assert set(book) == {today, later.as_of}
    assert book[today]["actual_range"] is not None and book[today]["abs_error"] is not None
    assert book[later.as_of]["actual_range"] is None
    assert store.read("model_meta").first()["last_search"] == searched
    last = store.read("report").first()
    assert [f["name"] for f in last["fields"]][0] == "Latest settled day"
