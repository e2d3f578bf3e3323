import datetime as dt
import tempfile

import pytest
from conftest import rows
from pyspark.sql import functions as F

from openbell.operators import contracts
from openbell.operators import ledger as led
from openbell.operators import metrics as met
from openbell.operators import report as rep
from openbell.plans import market
from openbell.sources.store import TableStore

D = dt.date


def dated(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


def tables(spark):
    days = [D(2024, 3, 4), D(2024, 3, 5)]
    m = dated(spark, "symbol STRING, date DATE, a DOUBLE, y TINYINT", ("ES", days[0], 1.0, 1), ("ES", days[1], 2.0, None))
    others = [dated(spark, f"date DATE, {c} DOUBLE", (days[0], 1.0), (days[1], None)) for c in "bcd"]
    return m, others


def test_merge_keeps_unsettled_rows_only_on_request(spark):
    m, (b, c, d) = tables(spark)
    assert market.merge_features(m, b, c, d).count() == 1
    out = market.merge_features(m, b, c, d, keep_unsettled=True)
    assert out.count() == 2 and out.columns == ["symbol", "date", "a", "y", "b", "c", "d"]
    assert market.merge_features(m, b, c, d, cutoff=D(2024, 3, 4), keep_unsettled=True).count() == 1


def test_merge_contracts(spark):
    m, (b, c, d) = tables(spark)
    with pytest.raises(ValueError, match="macro: duplicate"):
        market.merge_features(m, b.union(b), c, d)
    with pytest.raises(ValueError, match="collisions.*'b'"):
        market.merge_features(m, b, b, d)
    with pytest.raises(KeyError, match="y"):
        market.merge_features(m.drop("y"), b, c, d)


def test_merge_checks_inside_its_own_job(spark):
    m, (b, c, d) = tables(spark)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("merge-plan", "building the checked merge")
    good = market.merge_features(m, b, c, d, keep_unsettled=True, check_rows="inside")
    assert len(tracker.getJobIdsForGroup("merge-plan")) == 0  # nothing has run
    spark.sparkContext.setJobGroup("merge-run", "")
    assert rows(good, *good.columns) == rows(market.merge_features(m, b, c, d, keep_unsettled=True), *good.columns)
    for frames, source in (((m.union(m), b, c, d), "market"), ((m, b, c.union(c), d), "sentiment"), ((m, b, c, d.union(d)), "calendar")):
        with pytest.raises(Exception, match=f"{source}: duplicate key .*2024-03-0"):
            market.merge_features(*frames, keep_unsettled=True, check_rows="inside").collect()


def test_violations_and_observed_nulls(spark):
    df = dated(spark, "symbol STRING, date DATE, x DOUBLE", ("a", D(2024, 3, 4), None), ("a", D(2024, 3, 4), 1.0), (None, D(2024, 3, 5), None))
    seen = contracts.Observed(df, ["x", "date"])
    seen.frame.write.format("noop").mode("overwrite").save()
    assert seen.rows() == 3 and rows(seen.nulls(), "column_name", "n_null") == [("x", 2)]
    found = contracts.violations({"a": df, "b": df.select("x")}, {"a": ["symbol", "date"], "b": ["date"]}, {"b": ["z"]})
    assert rows(found, "source", "rule", "detail", "n") == sorted([
        ("a", "column collision", "x", None), ("b", "column collision", "x", None),
        ("a", "duplicate key", '{"symbol":"a","date":"2024-03-04"}', 2), ("a", "null key", '{"symbol":null,"date":"2024-03-05"}', 1),
        ("b", "missing column", "date", None), ("b", "missing column", "z", None),
    ], key=lambda t: tuple(map(str, t)))


def test_sentiment_last_per_day(spark):
    df = dated(spark, "Date TIMESTAMP, x DOUBLE, seq BIGINT", (dt.datetime(2024, 3, 4), 1.0, 1), (dt.datetime(2024, 3, 4), 2.0, 2))
    assert rows(market.prepare_sentiment(df, "seq"), "date", "x") == [(D(2024, 3, 4), 2.0)]


def ranges(spark, n, start=D(2024, 1, 1)):
    return dated(spark, "symbol STRING, date DATE, realized_range DOUBLE",
                 *[("ES", start + dt.timedelta(days=i), float(i)) for i in range(n)])


def test_scoring_rows_for_any_day(spark):
    realized = ranges(spark, 30)
    today = D(2024, 2, 5)
    wanted = dated(spark, "symbol STRING, date DATE", ("ES", today), ("ES", D(2024, 1, 29)), ("ES", D(2024, 2, 3)))
    model = wanted.withColumns({"x": F.lit(1.0), "y": F.lit(None).cast("tinyint")})
    level = wanted.select("date", F.lit(15.0).alias("vix_level"))
    out = market.features_for_dates(model, realized, level, wanted)
    got = {r["date"]: r for r in out.collect()}
    assert got[today]["rv_lag_5"] == 27.0 and got[today]["rv_lag_22"] == pytest.approx(18.5)
    assert got[D(2024, 2, 3)]["rv_lag_5"] == 27.0
    # a settled day does not see itself
    assert got[D(2024, 1, 29)]["rv_lag_5"] == 25.0
    assert market.check_scoring_rows(out).columns == ["symbol", "date", "rv_lag_5", "rv_lag_22", "x", "vix_level"]


@pytest.mark.parametrize(("n", "drop", "message"), [
    (21, None, "fewer than 22"), (30, "model", "no feature row"), (30, "level", "no vix_level")
])
def test_incomplete_scoring_rows_are_refused(spark, n, drop, message):
    wanted = dated(spark, "symbol STRING, date DATE", ("ES", D(2024, 3, 5)))
    model = wanted.withColumns({"x": F.lit(1.0), "y": F.lit(None).cast("tinyint")})
    level = wanted.select("date", F.lit(15.0).alias("vix_level"))
    out = market.features_for_dates(
        model.limit(0) if drop == "model" else model, ranges(spark, n),
        level.limit(0) if drop == "level" else level, wanted,
    )
    with pytest.raises(ValueError, match=message):
        market.check_scoring_rows(out)


LEDGER = "symbol STRING, date DATE, predicted_range DOUBLE, actual_range DOUBLE, abs_error DOUBLE"


def test_settlement(spark):
    book = dated(spark, LEDGER, ("ES", D(2024, 1, 3), 1.5, None, None), ("ES", D(2024, 1, 4), 1.0, 9.0, 8.0),
                 ("ES", D(2024, 6, 1), 1.0, None, None))
    out = led.settle(book, ranges(spark, 30))
    want = [(D(2024, 1, 3), 2.0, 0.5), (D(2024, 1, 4), 9.0, 8.0), (D(2024, 6, 1), None, None)]
    assert rows(out, "date", "actual_range", "abs_error") == want
    assert rows(led.settle(out, ranges(spark, 30)), "date", "actual_range", "abs_error") == want


def test_ledger_rerun_replaces_the_day(spark):
    book = dated(spark, LEDGER, ("ES", D(2024, 1, 3), 1.0, 2.0, 1.0))
    new = dated(spark, LEDGER, ("ES", D(2024, 1, 4), 5.0, None, None))
    once = led.upsert(book, new)
    twice = led.upsert(once, new.withColumn("predicted_range", F.lit(6.0)))
    assert rows(twice, "date", "predicted_range") == [(D(2024, 1, 3), 1.0), (D(2024, 1, 4), 6.0)]


def test_text_in_numeric_columns_is_coerced(spark):
    book = dated(spark, "predicted_range STRING, actual_range STRING", ("0.5", "<NA>"))
    assert rows(led.coerced(book), "predicted_range", "actual_range") == [(0.5, None)]


def test_rolling_error_uses_settled_rows(spark):
    book = dated(spark, LEDGER, *[("ES", D(2024, 1, i), 1.0, 1.0 if i != 5 else None, float(i)) for i in range(1, 11)])
    out = dict(rows(led.rolling_error(book), "date", "mae_7d"))
    assert out[D(2024, 1, 1)] == 1.0 and D(2024, 1, 5) not in out
    assert out[D(2024, 1, 10)] == pytest.approx((10 + 9 + 8 + 7 + 6 + 4 + 3) / 7)
    last = led.last_settled(book).first()
    assert last["settled_date"] == D(2024, 1, 10) and last["rolling_mae"] == out[D(2024, 1, 10)]


def test_split_counts(spark):
    days = spark.range(1158).select(F.expr("date_add(date'2020-01-01', cast(id as int))").alias("date"))
    panel = days.withColumn("symbol", F.explode(F.array(F.lit("a"), F.lit("b"))))
    out = dict(rows(met.chronological_split(panel).groupBy("split").count(), "split", "count"))
    assert out == {"train": 740 * 2, "validation": 186 * 2, "test": 232 * 2}


def test_metrics(spark):
    df = dated(spark, "y DOUBLE, p DOUBLE, q DOUBLE", (1.0, 1.0, None), (2.0, 3.0, 2.0), (3.0, 3.0, 3.0))
    out = {r["predictor"]: r for r in met.compare_predictors(df, "y", {"model": "p", "other": "q"}).collect()}
    m = out["model"]
    assert (m["n"], m["mae"], m["r2"], m["coverage_at_mae"]) == (3, pytest.approx(1 / 3), pytest.approx(0.5), pytest.approx(2 / 3))
    assert m["pred_std"] == pytest.approx((8 / 9) ** 0.5)
    assert out["other"]["n"] == 2 and out["other"]["rmse"] == 0


@pytest.mark.parametrize(("n", "pred", "band"), [(29, 0.0, "Normal"), (30, 0.0, "Calm"), (30, 15.0, "Normal"), (30, 29.0, "Active")])
def test_bands(spark, n, pred, band):
    asked = dated(spark, "symbol STRING, date DATE", ("ES", D(2024, 6, 1)))
    row = rep.range_history(ranges(spark, n), asked).withColumn("p", F.lit(pred))
    assert row.select(rep.range_band("p", "p25", "p75", "n_ranges")).first()[0] == band


@pytest.mark.parametrize(("value", "n", "tone"), [
    (5.0, 29, "—"), (None, 40, "—"), (200.0, 100, "Extreme Bullish"), (95.0, 100, "Strong Bullish"),
    (80.0, 100, "Mild Bullish"), (65.0, 100, "Neutral"), (35.0, 100, "Neutral"), (20.0, 100, "Mild Bearish"),
    (5.0, 100, "Strong Bearish"), (4.0, 100, "Extreme Bearish"),
])
def test_tones(spark, value, n, tone):
    days = [("ES", D(2024, 1, 1) + dt.timedelta(days=i), float(i)) for i in range(n)]
    df = dated(spark, "symbol STRING, date DATE, weighted_impact DOUBLE", *days, ("ES", D(2025, 1, 1), value))
    row = rep.tone_history(df).filter("date = date'2025-01-01'")
    assert row.select(rep.tone_label("share_below", "n_impacts")).first()[0] == tone


def test_history_is_bounded(spark):
    asked = dated(spark, "symbol STRING, date DATE", ("ES", D(2026, 1, 1)))
    row = rep.range_history(ranges(spark, 400), asked).first()
    assert row["n_ranges"] == 252 and row["p25"] == pytest.approx(148 + 0.25 * 251)


def test_report_drops_missing_lines(spark):
    base = dated(spark, "symbol STRING, date DATE, predicted_range DOUBLE", ("ES", D(2024, 3, 5), 0.0125))
    bare = rep.forecast_report(base).first()
    assert [f["name"] for f in bare["fields"]] == ["Dates and levels", "Overnight articles", "Fit"]
    assert bare["fields"][0]["value"] == "Tuesday"
    assert bare["fields"][1]["value"] == "Tone —\nArticles: 0"
    assert "Interval: 95 to 155 bps" in bare["description"]
    full = rep.forecast_report(base.withColumns({
        "days_to_fomc": F.lit(0.0), "is_fomc_day": F.lit(1), "days_to_opex": F.lit(10), "is_quarterly_opex": F.lit(1),
        "vix_level": F.lit(15.04), "weighted_impact": F.lit(0.1234), "share_below": F.lit(96.0), "n_impacts": F.lit(252),
        "article_count": F.lit(12.0), "buzz_factor": F.lit(1.25), "prob_pos_mean": F.lit(0.5), "prob_neg_mean": F.lit(0.2),
        "prob_neu_mean": F.lit(0.3), "sentiment_momentum": F.lit(-0.01), "is_top_2pct_weighted_impact": F.lit(1),
        "prev_day_range": F.lit(0.01), "test_mae": F.lit(0.002), "test_coverage": F.lit(0.6),
    })).first()
    text = {f["name"]: f["value"] for f in full["fields"]}
    assert text["Dates and levels"] == "Tuesday\nNext rate decision in days: 0, today\nNext expiry in days: 10, quarterly\nVolatility index at 09:00: 15.0"
    news = text["Overnight articles"].split("\n")
    assert news[0] == "Tone Extreme Bullish, impact +0.123"
    assert news[1] == "Articles: 12, 1.2 times the usual" and news[2] == "Positive 50%, negative 20%, neutral 30%"
    assert news[3] == "Change -0.010" and news[4].startswith("Impact is in the highest")
    assert text["Simple forecasts"] == "Yesterday 100 bps, forecast is off it by +25 bps"
    assert full["description"].endswith("Interval: 105 to 145 bps, held on 60% of test days")
    assert '"inline":true' in full["payload"]


def test_ledger_by_month_rewrites_what_it_touches(spark):
    store = TableStore(spark, tempfile.mkdtemp(prefix="openbell-test-"))
    old = dated(spark, "symbol STRING, date DATE, predicted_range DOUBLE, actual_range DOUBLE, abs_error DOUBLE",
                *[("ES", D(2024, m, 5), 0.01 * m, None if m == 5 else 0.01, None if m == 5 else 0.0) for m in range(1, 6)])
    store.replace("predictions", old)  # as an earlier release left it
    ledger = led.Ledger(store)
    files = lambda: {f["part"]: f["path"] for f in ledger.table.snapshot()[1]["files"]}
    before, opened = files(), store.read("predictions")
    assert len(before) == 5 and rows(ledger.read(), *old.columns) == rows(old, *old.columns)
    new = dated(spark, "symbol STRING, date DATE, predicted_range DOUBLE, actual_range DOUBLE, abs_error DOUBLE",
                ("ES", D(2024, 5, 5), 0.5, None, None), ("NQ", D(2024, 5, 6), 0.02, None, None))
    ledger.upsert(new, "a")
    ledger.upsert(new, "a")  # a rerun
    after = files()
    assert {p for p in before if before[p] != after[p]} == {"month=2024-05"}
    assert rows(ledger.read().filter("month(date) = 5"), "symbol", "predicted_range") == [("ES", 0.5), ("NQ", 0.02)]
    ledger.settle(dated(spark, "symbol STRING, date DATE, realized_range DOUBLE", ("ES", D(2024, 5, 5), 0.4), ("ES", D(2024, 1, 5), 9.0)), "s")
    settled = files()
    assert {p for p in after if after[p] != settled[p]} == {"month=2024-05"}
    done = {(r.symbol, r.date.month): (r.actual_range, r.abs_error) for r in ledger.read().collect()}
    assert done["ES", 5] == (0.4, pytest.approx(0.1)) and done["NQ", 5] == (None, None) and done["ES", 1] == (0.01, 0.0)
    ledger.settle(dated(spark, "symbol STRING, date DATE, realized_range DOUBLE", ("ES", D(2024, 5, 5), 0.7)), "t")
    assert files() == settled  # nothing pending, nothing written
    assert opened.count() == 5 and opened.filter("actual_range = 0.4").count() == 0  # a reader keeps its version
    store.prune(keep=1)
    assert rows(store.read("predictions"), "symbol", "date") == rows(ledger.read(), "symbol", "date")
