import datetime as dt
import tempfile

import pytest
from conftest import rows
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from openbell.operators import model as ml
from openbell.operators import sessions as ses
from openbell.session import shared_dir
from openbell.sources import bars as src
from openbell.streaming import jobs as st


@pytest.fixture(scope="module")
def panel(spark):
    days = spark.range(120).select(
        F.lit("ES").alias("symbol"), F.expr("date_add(date'2023-01-02', cast(id as int))").alias("date"),
        (F.col("id") % 7 / 700).alias("prev_day_range"), ((F.col("id") % 5) / 500 + 0.001).alias("rv_lag_5"),
        F.when(F.col("id") % 11 > 0, F.col("id") * 1.0).alias("vix_level"),
    )
    return days.withColumn("target", F.col("prev_day_range") * 2 + 0.005).persist()


NAMES = ["prev_day_range", "rv_lag_5", "vix_level"]


def test_draws_are_seeded_and_in_range():
    for mode, space in ml.SPACE.items():
        draws = ml.draw_params(mode, 20)
        assert draws == ml.draw_params(mode, 20)
        for p in draws:
            assert all(lo <= p[k] <= hi for k, (lo, hi) in space.items())


def test_collapsed_trials_cannot_win():
    t = [ml.Trial({}, None, 3, True), ml.Trial({}, 0.2, 3, False), ml.Trial({}, 0.1, 3, False)]
    assert ml.best_trial(t).score == 0.1
    with pytest.raises(RuntimeError, match="collapsed"):
        ml.best_trial(t[:1])


def test_rounds_and_staleness():
    assert ml.final_rounds(3) == 10 and ml.final_rounds(100) == 110
    now = dt.datetime(2024, 1, 8)
    assert ml.is_stale(None, now) and ml.is_stale(dt.datetime(2024, 1, 1), now)
    assert not ml.is_stale(dt.datetime(2024, 1, 2), now)


def test_train_search_then_refit(spark, panel):
    path = tempfile.mkdtemp(prefix="openbell-test-")
    day = dt.datetime(2024, 1, 8)
    _, meta = ml.train_or_refit(panel, NAMES, day, f"{path}/m1", trials=2, max_rounds=8, parallelism=2)
    first = meta.first()
    assert first["train_rows"] == 120 and set(first["test_metrics"]) == {"model", "persist", "rv_lag_5"}
    assert first["importance"]["prev_day_range"] > 0.5
    assert sum(first["importance"].values()) == pytest.approx(1)
    # two days later the parameters and metrics carry over
    later = day + dt.timedelta(days=2)
    model, again = ml.train_or_refit(panel, NAMES, later, f"{path}/m2", meta=meta)
    second = again.first()
    assert second["last_search"] == first["last_search"] and second["trained_at"] == later
    assert second["best_params"] == first["best_params"] and second["test_metrics"] == first["test_metrics"]
    # a saved model predicts the same, extra columns are ignored, missing ones named
    loaded = PipelineModel.load(f"{path}/m2")
    a = ml.predict(model, panel, NAMES)
    b = ml.predict(loaded, panel.withColumn("extra", F.lit(1)), NAMES).drop("extra")
    assert a.exceptAll(b).count() == 0 and a.filter("predicted_range IS NULL").count() == 0
    error = a.agg(F.avg(F.abs(F.col("predicted_range") - F.col("target")))).first()[0]
    assert error < 0.004
    with pytest.raises(KeyError, match="rv_lag_5.*vix_level"):
        ml.predict(model, panel.drop("rv_lag_5", "vix_level"), NAMES)


def _stream(spark, *loads):
    """A file stream that sees the loads one after the other."""
    path = shared_dir(spark, "test-source")
    for df in loads:
        df.coalesce(1).write.mode("append").parquet(path)
    schema = loads[0].schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(path)


def _run(spark, stream, name):
    return st.run_to_table(stream, shared_dir(spark, name), shared_dir(spark, f"{name}-cp"))


DAYS = ("2024-03-07", "2024-03-08", "2024-03-11", "2024-03-12")
TIMES = ("08:30", "09:00", "09:30", "12:00", "15:59", "18:00")


def history(make_bars, days=DAYS):
    return make_bars(*[(f"{d} {t}", 100 + i + j, 103 + i + j, 98 + i, 101 + i - j)
                       for i, d in enumerate(days) for j, t in enumerate(TIMES)])


def test_stream_sessions_equal_batch(spark, make_bars):
    a, b = history(make_bars, DAYS[:2]), history(make_bars, DAYS[2:])
    sentinel = make_bars(("2024-03-14 12:00", 1, 1, 1, 1))
    out = _run(spark, st.sessions(_stream(spark, a, b, sentinel)), "t-sessions")
    columns = ("date", "open", "high", "low", "close", "volume")
    assert rows(out, *columns) == rows(ses.session_ohlcv(a.unionByName(b)), *columns)


def test_stream_snapshot_equals_batch(spark, make_bars):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        bars = history(make_bars)
        sentinel = make_bars(("2024-03-13 12:00", 1, 1, 1, 1))
        stream = _stream(spark, bars.filter("ts < '2024-03-10'"), bars.filter("ts > '2024-03-10'"), sentinel)
        out = _run(spark, st.snapshot_features(stream), "t-snapshot")
    finally:
        spark.conf.set(key, before)
    columns = ("date", "overnight_gap", "premarket_trend", "macro_vol_830", "macro_dir_830")
    want = rows(ses.premarket_features(bars), *columns)
    assert [r[0] for r in want] == [dt.date.fromisoformat(d) for d in DAYS]
    assert rows(out, *columns) == want


def test_stream_snapshot_by_the_watermark_alone(spark, make_bars):
    """Another symbol's bar moves the time: the last snapshot of a dead symbol comes out, and its state goes."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    path, cp = shared_dir(spark, "t-timers"), shared_dir(spark, "t-timers-cp")

    source = shared_dir(spark, "t-timers-source")

    def load(*bars):
        """(symbol, day) of all snapshots so far, and the symbols with state, after one more load."""
        make_bars(*bars).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(make_bars().schema).parquet(source)
        query = (st.snapshot_features(stream, expiry_days=10).writeStream.format("parquet").option("path", path)
                 .option("checkpointLocation", cp).trigger(availableNow=True).start())
        query.awaitTermination()
        state = spark.read.format("statestore").option("operatorId", _tws_operator(spark, cp)).option("stateVarName", "last").load(cp)
        return set(rows(spark.read.schema("symbol STRING, date DATE").parquet(path), "symbol", "date")), {r[0] for r in state.select("key.symbol").collect()}

    at = lambda t, symbol="ES": (t, 1, 2, 1, 1, 1.0, symbol)
    monday = ("ES", dt.date(2024, 3, 11))
    try:
        assert load(*[at(f"{d} {t}") for d in DAYS[:2] for t in TIMES]) == ({("ES", dt.date.fromisoformat(d)) for d in DAYS[:2]}, {"ES"})
        assert monday not in load(at("2024-03-11 08:30"), at("2024-03-11 09:00"))[0]  # 09:01 has not passed
        seen, state = load(at("2024-03-11 09:01", "NQ"))
        assert monday in seen and state == {"ES"}
        load(at("2024-04-10 09:00", "NQ"))
        seen, state = load(at("2024-04-11 12:00", "NQ"))
        assert ("NQ", dt.date(2024, 4, 10)) in seen and state == {"NQ"}  # ES is dead
    finally:
        spark.conf.set(key, before)


def _tws_operator(spark, checkpoint):
    ops = spark.read.format("state-metadata").load(checkpoint).filter("operatorName LIKE 'transformWithState%'")
    return ops.first()["operatorId"]


def test_late_ticks_are_kept_and_repaired(spark, make_bars):
    root = shared_dir(spark, "t-late")
    all_bars = history(make_bars)
    late = (F.hour("ts") == 17) & (F.dayofmonth("ts") != 12)  # noon in New York
    sentinel = make_bars(("2024-03-14 12:00", 1, 1, 1, 1))
    emitted = None
    for load in (all_bars.filter(~late), sentinel, all_bars.filter(late)):
        load.coalesce(1).write.mode("append").parquet(f"{root}/source")
        stream = lambda: spark.readStream.schema(all_bars.schema).parquet(f"{root}/source")
        emitted = st.run_to_table(st.sessions(stream()), f"{root}/out", f"{root}/out-cp")
        st.keep_late(stream(), f"{root}/kept", f"{root}/kept-cp").awaitTermination()
    kept = spark.read.parquet(f"{root}/kept/late")
    assert rows(kept, "ts") == rows(all_bars.filter(late), "ts") and kept.count() > 0
    columns = ("date", "open", "high", "low", "close", "volume")
    want = rows(ses.session_ohlcv(all_bars), *columns)
    assert rows(emitted, *columns) != want
    now = st.current_sessions(emitted, st.repaired_sessions(spark, f"{root}/kept"))
    assert rows(now.filter("date < '2024-03-14'"), *columns) == want


def test_stream_dedupe_across_batches(spark, make_bars):
    one = make_bars(("2024-03-05 10:00", 1, 1, 1, 1))
    again = make_bars(("2024-03-05 10:00", 2, 2, 2, 2), ("2024-03-05 10:01", 3, 3, 3, 3))
    out = _run(spark, st.dedupe_bars(_stream(spark, one, again)).drop("event_time"), "t-dedupe")
    assert rows(out, "open") == [(1.0,), (3.0,)]


def test_stream_maintained_table_survives_a_restart(spark, make_bars):
    path, cp = shared_dir(spark, "t-bars"), shared_dir(spark, "t-bars-cp")
    source = shared_dir(spark, "t-bars-source")
    schema = history(make_bars).schema

    def go():
        stream = spark.readStream.schema(schema).parquet(source)
        st.maintain_bars(stream, path, cp).awaitTermination()

    history(make_bars, DAYS[:1]).write.parquet(source)
    go()
    go()
    make_bars(("2024-03-08 09:30", 1, 1, 1, 1), ("2024-03-07 18:00", 9, 9, 9, 9)).write.mode("append").parquet(source)
    go()
    table = src.read_stamped(spark, path)
    assert table.count() == 7 and table.filter("open = 9").count() == 0


def test_best_round_waits_for_patience():
    slow = [1.0 - 0.001 * k for k in range(200)] + [0.9] * 60
    assert ml.best_round(slow, 50) == 200
    assert ml.best_round([3, 2, 1, 2, 2, 2, 0.5], patience=3) == 3
    assert ml.best_round([3, 2, 1, 2, 2, 2, 0.5], patience=10) == 7
    assert ml.best_round([1.0], 50) == 1


def test_search_does_not_stop_at_the_start_of_a_slow_curve(panel, monkeypatch):
    """A small step improves by far less than a percent a round and must train on."""
    draw = {"maxDepth": 1, "stepSize": 0.01, "subsamplingRate": 1.0, "featureShare": 1.0, "minInstancesPerNode": 1, "gamma": 0.0}
    monkeypatch.setattr(ml, "draw_params", lambda *a: [draw])
    split = ml.chronological_split(panel)
    parts = [split.filter(f"split = '{s}'").coalesce(1) for s in ("train", "validation")]
    (trial,) = ml.search("aggressive", *parts, NAMES, [], trials=1, max_rounds=48, patience=20)
    assert trial.best_iter > 30 and not trial.collapsed


def test_search_grows_through_three_blocks(panel, monkeypatch):
    """The curve still falls at the end of the first and the second block of rounds."""
    draw = {"maxDepth": 1, "stepSize": 0.05, "subsamplingRate": 1.0, "featureShare": 1.0, "minInstancesPerNode": 1, "gamma": 0.0}
    monkeypatch.setattr(ml, "draw_params", lambda *a: [draw])
    tried, plain = [], ml.regressor
    monkeypatch.setattr(ml, "regressor", lambda mode, params, rounds, n: tried.append(rounds) or plain(mode, params, rounds, n))
    split = ml.chronological_split(panel)
    parts = [split.filter(f"split = '{s}'").coalesce(1) for s in ("train", "validation")]
    (trial,) = ml.search("aggressive", *parts, NAMES, [], trials=1, max_rounds=40, patience=5, first_rounds=8)
    assert tried[:3] == [8, 16, 32] and trial.best_iter > 16 and not trial.collapsed


def test_draws_follow_a_given_space():
    space = {"maxDepth": (2, 2), "stepSize": (0.5, 0.5)}
    assert ml.draw_params("mae", 2, space=space) == [{"maxDepth": 2, "stepSize": 0.5}] * 2


def test_holdout_columns_name_collapsed_predictions(spark):
    rows_ = spark.createDataFrame([("a", 1.0, 1.0), ("a", 3.0, 2.0), ("b", 1.0, 2.0), ("b", 3.0, 2.0), ("c", 1.0, None)], "k STRING, target DOUBLE, p DOUBLE")
    got = {r["k"]: (r["score"], r["collapsed"]) for r in rows_.groupBy("k").agg(*ml.holdout_columns("mae", "p")).collect()}
    assert got["a"] == (0.5, False) and got["b"] == (1.0, True) and got["c"][0] is None


def test_merged_stream_has_twelve_batches_whatever_the_files(spark, tmp_path, monkeypatch):
    from openbell.plans.catalog import QUERIES
    from openbell.sources.snapshots import SnapshotTable

    ts = "TIMESTAMP_NTZ '2024-01-02 00:00:00' + make_dt_interval(0, 0, CAST(id AS INT))"
    events = spark.range(3000).selectExpr("id AS event_id", f"{ts} AS ts", "'a' AS event_type", "CAST(id AS DOUBLE) AS value")
    events.repartition(5).write.parquet(f"{tmp_path}/events.parquet")
    loads, append = [], SnapshotTable.append
    monkeypatch.setattr(SnapshotTable, "append", lambda self, df, load: loads.append(load) or append(self, df, load))
    out = QUERIES["stream_append_merged"](spark, str(tmp_path))
    assert len(loads) == len(set(loads)) == 12
    assert out.agg({"close": "sum"}).first()[0] == sum(100 + k for k in range(3000)) and out.count() == 3000
