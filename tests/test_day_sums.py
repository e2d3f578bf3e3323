import datetime as dt
import json
import tempfile
from pathlib import Path

import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from openbell.operators import daily_news as news
from openbell.operators import day_sums
from openbell.operators import scoring as sc
from openbell.plans import daily
from openbell.plans.scorers import hash_scorer
from openbell.sources.store import TableStore

D = dt.date


def articles(spark, first, n, day=D(2024, 3, 4), per_day=7):
    at = F.expr(f"timestamp_ntz'{day} 02:00:00' + make_dt_interval(cast(id div {per_day} as int))")
    return spark.range(first, first + n).select(
        F.to_date(at).alias("Date"), at.alias("published_at"), F.concat(F.lit("text "), F.col("id") % 90).alias("news_text")
    )


def assert_equal_days(got, want):
    a = {r["Date"]: r.asDict() for r in got.collect()}
    b = {r["Date"]: r.asDict() for r in want.collect()}
    assert set(a) == set(b)
    for day, row in b.items():
        for k, v in row.items():
            if isinstance(v, float):
                assert a[day][k] == pytest.approx(v, rel=1e-12, abs=1e-8 if k == "sentiment_entropy" else 1e-12), (day, k)
            elif isinstance(v, list):
                assert a[day][k] == pytest.approx(v, abs=1e-12)
            else:
                assert a[day][k] == v, (day, k)


def recovering(fail: bool):
    base = hash_scorer()
    reply = lambda _: None if fail else json.dumps({"relevance": 0.5, "novelty": 0.25, "subjectivity": 0.75})
    return sc.Scorer(base.tier1, lambda t: pd.Series([reply(x) for x in t], index=t.index, dtype="object"), base.embed)


def run_of(store, batch, **kw):
    return daily.Run(store=store, as_of=D(2024, 4, 1), batch=batch, scorer=None, instruments=("ES",), sources=[], **kw)


def test_sums_merge_and_take_back(spark):
    store = TableStore(spark, tempfile.mkdtemp(prefix="openbell-test-"))
    scored = sc.score_articles(articles(spark, 0, 80), hash_scorer(), store, 1).persist()
    want = news.aggregate_daily(scored, embedding=True)
    parts = [day_sums.sums(scored.filter(F.pmod(F.xxhash64("text_hash"), F.lit(3)) == k), embedding=True) for k in range(3)]
    state = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert_equal_days(day_sums.finished(day_sums.merged(state)), want)
    # taking two thirds back leaves the sums of the last third, to the last bit
    signed = scored.withColumn("s", F.lit(1)).unionByName(
        scored.filter(F.pmod(F.xxhash64("text_hash"), F.lit(3)) < 2).withColumn("s", F.lit(-1)))
    left = day_sums.sums(signed, sign="s", embedding=True).filter("n_rows > 0")
    last = parts[2].select(*left.columns)
    assert left.exceptAll(last).count() == 0 and last.exceptAll(left).count() == 0
    # a day whose rows are all taken back is gone; equal values have no deviation
    none = day_sums.sums(scored.withColumn("s", F.lit(1)).unionByName(scored.withColumn("s", F.lit(-1))), sign="s", embedding=True)
    assert day_sums.finished(none).count() == 0
    same = scored.limit(1).crossJoin(spark.range(5)).withColumns({"is_neutral": F.lit(False), "prob_pos": F.lit(0.3), "prob_neg": F.lit(0.1)})
    assert day_sums.finished(day_sums.sums(same)).first()["sentiment_entropy"] == 0.0
    assert day_sums.finished(day_sums.sums(scored.limit(0))).count() == 0


def test_a_batch_reads_its_own_scores(spark):
    """Failures of the first batch recover in the second; the folders of scored older rows are not opened."""
    root = tempfile.mkdtemp(prefix="openbell-test-")
    store = TableStore(spark, root)
    sc.score_articles(articles(spark, 0, 60), recovering(True), store, 1)
    first = daily._news_days(run_of(store, 1)).persist()
    assert_equal_days(first, news.aggregate_daily(sc.current_scores(sc.checkpoint(store)), embedding=True))
    assert first.filter("weighted_impact IS NOT NULL").count() == 0
    sc.score_articles(articles(spark, 0, 75), recovering(False), store, 2)
    want = news.aggregate_daily(sc.current_scores(sc.checkpoint(store)), embedding=True).persist()
    assert want.filter("weighted_impact IS NULL AND article_count IS NOT NULL").count() == 0
    broken = list(Path(root).glob("article_scores/v1/updated_at=1/status=scored/*.parquet"))
    kept = {p: p.read_bytes() for p in broken}
    for p in broken:
        p.write_bytes(b"not parquet")
        p.with_name(f".{p.name}.crc").unlink(missing_ok=True)
    second = daily._news_days(run_of(store, 2)).persist()
    assert broken and second.count() == want.count()
    assert_equal_days(second, want)
    for p, data in kept.items():
        p.write_bytes(data)
    # running the batch again changes nothing, neither does a batch without news
    assert_equal_days(daily._news_days(run_of(store, 2)), want)
    sc.score_articles(articles(spark, 0, 75), recovering(False), store, 3)
    assert_equal_days(daily._news_days(run_of(store, 3)), want)
    # and the first batch alone gives its days again
    assert_equal_days(daily._news_days(run_of(store, 1)), first)


def test_files_stay_bounded_over_many_batches(spark):
    """Forty batches of news: folders of batches are folded, values stay, a crash before the switch is harmless."""
    root = tempfile.mkdtemp(prefix="openbell-test-")
    store = TableStore(spark, root)
    good = hash_scorer()
    for batch in range(1, 13):
        sc.score_articles(articles(spark, 7 * (batch - 1), 7), good, store, batch, parts=1)
        days = daily._news_days(run_of(store, batch, keep_batches=3))
        daily.fold_news(run_of(store, batch, keep_batches=3))
        assert store.read("article_scores").select("updated_at").distinct().count() <= 6
        assert store.read("day_sums").select("batch").distinct().count() <= 6
    newest = Path(store.location("article_scores"))
    assert len(list(newest.glob("updated_at=*/status=*/*.parquet"))) <= 24
    want = news.aggregate_daily(sc.current_scores(sc.checkpoint(store)), embedding=True)
    assert want.count() == 12
    assert_equal_days(days, want)
    assert rows(sc.current_scores(store.read("article_scores")), "text_hash") == sorted(
        {(r[0],) for r in sc.with_key(articles(spark, 0, 84)).select("text_hash").collect()})
    # a version that was never finished is not seen
    store.read("article_scores").limit(1).write.parquet(f"{root}/article_scores/v99/x")
    assert store.location("article_scores") == str(newest)
    # a batch that was folded cannot run again
    with pytest.raises(ValueError, match="folded"):
        daily._news_days(run_of(store, 1, keep_batches=3))


def test_an_older_checkpoint_is_taken_over(spark):
    root = tempfile.mkdtemp(prefix="openbell-test-")
    plain = TableStore(spark, root)
    scored = sc.score_articles(articles(spark, 0, 30), hash_scorer(), TableStore(spark, root + "/other"), 1)
    plain.append("article_scores", scored.drop("tier2_scored", "updated_at"))
    store = TableStore(spark, root)
    again = sc.score_articles(articles(spark, 0, 40), hash_scorer(), store, 5)
    assert again.count() == 40 and rows(store.read("article_scores").select("updated_at").distinct(), "updated_at") == [(0,), (5,)]
    assert_equal_days(daily._news_days(run_of(store, 5)), news.aggregate_daily(again, embedding=True))
