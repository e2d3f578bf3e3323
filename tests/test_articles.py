import datetime as dt
import json
import tempfile

import pandas as pd
import pytest
from conftest import rows, utc
from pyspark.sql import functions as F

from openbell.functions.text import news_text, tier2_scores
from openbell.operators import daily_news as news
from openbell.operators import scoring as sc
from openbell.plans.scorers import hash_scorer
from openbell.sources import articles as art
from openbell.sources.store import TableStore

D = dt.date


def make(spark, *data):
    """(local time, title[, description])"""
    return spark.createDataFrame(
        [(utc(at), title, *(rest or ("d",))) for at, title, *rest in data],
        "published_at TIMESTAMP_NTZ, title STRING, description STRING",
    )


@pytest.mark.parametrize(("at", "day"), [
    ("2024-03-05 08:59", D(2024, 3, 5)), ("2024-03-05 09:00", None), ("2024-03-05 15:59", None),
    ("2024-03-05 16:00", D(2024, 3, 6)), ("2024-03-08 16:00", D(2024, 3, 11)), ("2024-03-09 08:00", D(2024, 3, 11)),
    ("2024-03-09 12:00", None), ("2024-03-10 17:00", D(2024, 3, 11)), ("2024-11-01 17:00", D(2024, 11, 4)),
    ("2024-11-02 08:00", D(2024, 11, 4)),
])
def test_time_boxing(spark, at, day):
    out = [r[0] for r in rows(art.aligned(make(spark, (at, "t"))), "Date")]
    assert out == ([] if day is None else [day])


@pytest.mark.parametrize(("title", "description", "text"), [
    ("Up.", "More", "Up. More"), ("Up", None, "Up. "), (None, "More", ". More"),
    ("\t Up \n", " More \x1f", "Up. More"), ("a.. b", "c", "a. b. c"),
])
def test_text_assembly(spark, title, description, text):
    df = spark.createDataFrame([(title, description)], "title STRING, description STRING")
    assert rows(df.select(news_text().alias("t")), "t") == [(text,)]


@pytest.mark.parametrize(("raw", "want"), [
    ('{"relevance": 0.5, "novelty": 0.25, "subjectivity": "1"}', (0.5, 0.25, 1.0)),
    ('Here:\n{"relevance": 0.5,\n"novelty": 0.25, "subjectivity": 1} done', (0.5, 0.25, 1.0)),
    ('{"rel": 0.5, "nov_x": 0.25, "subject": 1}', (0.5, 0.25, 1.0)),
    ("garbage", None), ('{"relevance": 0.5, "novelty": 0.25}', None),
    ('{"relevance": "high", "novelty": 0.25, "subjectivity": 1}', None), (None, None),
])
def test_score_parsing(spark, raw, want):
    df = spark.createDataFrame([(raw,)], "raw STRING")
    got = df.select(tier2_scores(F.col("raw")).alias("s")).first()["s"]
    assert (None if got is None else tuple(got)) == want


def test_gate_is_strict(spark):
    df = spark.createDataFrame(
        [(0.80, 0.5), (0.8001, 0.5), (0.1, None)], "prob_neu DOUBLE, relevance DOUBLE"
    ).withColumns({"novelty": F.col("relevance"), "subjectivity": F.col("relevance")})
    assert rows(sc.gate(df), "prob_neu", "is_neutral", "relevance", "tier2_scored") == [
        (0.1, False, None, False), (0.8, False, 0.5, True), (0.8001, True, None, True)
    ]


def scored(spark, *data):
    return spark.createDataFrame(
        [(D(2024, 3, day), pos, neg, neu, rel, neu > 0.8) for day, pos, neg, neu, rel in data],
        "Date DATE, prob_pos DOUBLE, prob_neg DOUBLE, prob_neu DOUBLE, relevance DOUBLE, is_neutral BOOLEAN",
    ).withColumns({"novelty": F.col("relevance"), "subjectivity": F.col("relevance")})


def test_daily_aggregates(spark):
    out = {r["Date"].day: r for r in news.aggregate_daily(scored(
        spark, (4, 0.05, 0.05, 0.9, None), (5, 0.6, 0.2, 0.2, 0.5), (6, 0.6, 0.2, 0.2, None), (6, 0.2, 0.6, 0.2, 0.5),
    )).collect()}
    assert out[4]["article_count"] is None and out[4]["weighted_impact"] is None
    assert out[4]["prob_neu_mean"] == pytest.approx(0.9)
    assert out[5]["article_count"] == 1 and out[5]["sentiment_entropy"] is None
    assert out[5]["weighted_impact"] == pytest.approx(0.4 * 0.25)
    # a failed tier 2 is counted, not averaged
    assert out[6]["article_count"] == 2 and out[6]["relevance_mean"] == 0.5
    assert out[6]["weighted_impact"] == pytest.approx(-0.1)


def test_counting_copies_equals_repeating_rows(spark):
    rows_ = [(5, 0.6, 0.2, 0.2, 0.5), (5, 0.3, 0.4, 0.3, None), (5, 0.05, 0.05, 0.9, None)]
    repeated = news.aggregate_daily(scored(spark, *[r for r, n in zip(rows_, (3, 2, 4)) for _ in range(n)]))
    counted = scored(spark, *rows_).withColumn(
        "n_rows", F.when(F.col("prob_pos") == 0.6, 3).when(F.col("prob_pos") == 0.3, 2).otherwise(4)
    )
    weighted = news.aggregate_daily(counted, weight="n_rows")
    a, b = repeated.first().asDict(), weighted.first().asDict()
    assert a.keys() == b.keys()
    for k in a.keys() - {"Date"}:
        assert a[k] == pytest.approx(b[k]), k


def test_hot_texts_get_their_scores(spark):
    keyed = spark.createDataFrame([("h", i) for i in range(9)] + [("c", 9)], "text_hash STRING, id INT")
    scores = spark.createDataFrame([("h", 9, 0.1), ("c", 1, 0.2)], "text_hash STRING, n_copies BIGINT, p DOUBLE")
    out = sc.spread_to_copies(keyed, scores, hot_copies=3)
    assert rows(out, "id", "p") == [(i, 0.1) for i in range(9)] + [(9, 0.2)]


def test_score_once_retry_and_rerun(spark):
    base = hash_scorer()
    failing = sc.Scorer(base.tier1, lambda t: pd.Series([None] * len(t), index=t.index), base.embed)
    store = TableStore(spark, tempfile.mkdtemp(prefix="openbell-test-"))
    first = make(spark, *[(f"2024-03-05 0{i}:00", f"title {i % 3}") for i in range(6)])
    out = sc.score_articles(art.aligned(first), failing, store, batch=1)
    assert out.count() == 3  # one row per text
    assert out.filter("n_copies <> 2").count() == 0
    open_rows = out.filter("NOT tier2_scored").count()
    assert open_rows == out.filter("NOT is_neutral").count() > 0
    more = first.unionByName(make(spark, ("2024-03-05 07:30", "title 9")))
    good = sc.Scorer(
        base.tier1,
        lambda t: t.map(lambda _: json.dumps({"relevance": 0.5, "novelty": 0.5, "subjectivity": 0.5})),
        base.embed,
    )
    again = sc.score_articles(art.aligned(more), good, store, batch=2)
    assert again.count() == 4 and again.filter("NOT tier2_scored").count() == 0
    before = {r["text_hash"]: r["prob_pos"] for r in out.collect()}
    assert all(before.get(r["text_hash"], r["prob_pos"]) == r["prob_pos"] for r in again.collect())
    third = sc.score_articles(art.aligned(more), failing, store, batch=3)
    assert rows(third, "text_hash", "relevance") == rows(again, "text_hash", "relevance")
    stored = store.read("article_scores").count()
    assert sc.compact(store).count() == 4 <= stored


def test_old_checkpoints_are_upgraded(spark):
    df = spark.createDataFrame([(True, None), (False, 0.5), (False, None)], "is_neutral BOOLEAN, relevance DOUBLE")
    assert [r[2] for r in rows(sc.upgraded(df), "is_neutral", "relevance", "tier2_scored")] == [True, False, True]


def test_topics_fit_once(spark):
    data = [(D(2024, 3, i + 1), [float((i * k) % 7) for k in range(1, 7)]) for i in range(12)]
    daily = spark.createDataFrame(data, "Date DATE, mean_embedding ARRAY<DOUBLE>")
    model = news.fit_topics(daily, k=2)
    path = tempfile.mkdtemp(prefix="openbell-test-") + "/m"
    model.write().save(path)
    from pyspark.ml import PipelineModel

    a = news.with_topics(daily, model, 2)
    b = news.with_topics(daily.filter("day(Date) > 6"), PipelineModel.load(path), 2)
    assert b.exceptAll(a).count() == 0
    # centred scores have zero mean
    assert a.agg(F.avg("context_pca_1")).first()[0] == pytest.approx(0, abs=1e-9)
    import numpy as np

    m = np.array([d[1] for d in data])
    m = m - m.mean(axis=0)
    _, _, vt = np.linalg.svd(m, full_matrices=False)
    got = np.array([r[0] for r in a.orderBy("Date").select("context_pca_1").collect()])
    assert np.allclose(np.abs(got), np.abs(m @ vt[0]))


def test_scoring_resumes_after_a_failed_part(spark):
    """Texts of finished parts are not scored again."""
    store = TableStore(spark, tempfile.mkdtemp(prefix="openbell-test-"))
    articles = spark.range(40).select(
        F.lit(dt.date(2024, 3, 5)).alias("Date"), F.lit(dt.datetime(2024, 3, 5, 10)).cast("timestamp_ntz").alias("published_at"),
        F.concat(F.lit("text "), F.col("id")).alias("news_text"),
    )
    good = hash_scorer()
    append, calls = store.append, []

    def failing(name, df):
        calls.append(name)
        if len(calls) == 3:
            raise RuntimeError("the model went away")
        append(name, df)

    store.append = failing
    with pytest.raises(RuntimeError, match="went away"):
        sc.score_articles(articles, good, store, batch=1, parts=4)
    store.append = append
    done = store.read("article_scores").count()
    assert 0 < done < 40
    assert sc.pending_keys(sc.with_key(articles), store.read("article_scores")).count() == 40 - done
    assert sc.score_articles(articles, good, store, batch=2, parts=4).count() == 40
    assert store.read("article_scores").select("text_hash").distinct().count() == 40
