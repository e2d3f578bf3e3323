import datetime as dt

import pytest
from conftest import rows

from openbell.functions.clock import lookback, snapshot_bound, snapshot_bounds
from openbell.operators import sessions as ses
from openbell.schemas import PREMARKET

D = dt.date


def test_session_edges_are_inclusive(make_bars):
    bars = make_bars(
        ("2024-03-05 09:29", 1, 99, 1, 1), ("2024-03-05 09:30", 10, 12, 9, 11),
        ("2024-03-05 15:59", 11, 13, 8, 12), ("2024-03-05 16:00", 1, 99, 1, 1),
    )
    assert rows(ses.session_ohlcv(bars), "date", "open", "high", "low", "close", "volume") == [
        (D(2024, 3, 5), 10.0, 13.0, 8.0, 12.0, 2.0)
    ]


def test_weekend_and_zero_close_are_dropped(make_bars):
    bars = make_bars(("2024-03-09 10:00", 1, 1, 1, 1), ("2024-03-05 10:00", 1, 1, 0, 0))
    assert ses.session_ohlcv(bars).count() == 0


def test_null_first_open_is_skipped(make_bars):
    bars = make_bars(("2024-03-05 09:30", None, 12, 9, 11), ("2024-03-05 09:31", 10, 12, 9, 11))
    assert rows(ses.session_ohlcv(bars), "open") == [(10.0,)]


def test_asof_level(make_bars):
    bars = make_bars(
        ("2024-03-05 08:57", 1, 1, 1, 5), ("2024-03-05 09:00", 7, 9, 6, 8),
        ("2024-03-06 08:57", 1, 1, 1, 5), ("2024-03-07 09:01", 1, 1, 1, 5), ("2024-03-09 08:00", 1, 1, 1, 4),
    )
    assert rows(ses.asof_level(bars), "date", "level") == [
        (D(2024, 3, 5), 7.0), (D(2024, 3, 6), 5.0), (D(2024, 3, 9), 4.0)
    ]


def test_label_tie_is_zero(make_bars):
    bars = make_bars(("2024-03-05 09:30", 10, 10, 10, 10), ("2024-03-05 15:59", 10, 10, 10, 10),
                     ("2024-03-06 09:30", 10, 10, 10, 10), ("2024-03-06 15:59", 10, 11, 10, 11),
                     ("2024-03-07 09:30", 10, 10, 10, 10))
    assert rows(ses.updown_label(bars), "date", "y") == [(D(2024, 3, 5), 0), (D(2024, 3, 6), 1)]


def test_evening_of_sunday_opens_monday(make_bars):
    bars = make_bars(("2024-03-03 18:00", 100, 1, 1, 1), ("2024-03-04 09:00", 110, 1, 1, 1))
    [(_, trend)] = rows(ses.premarket_features(bars), "date", "premarket_trend")
    assert trend == pytest.approx(0.1)


def test_early_close_gap_exact_and_asof(make_bars):
    bars = make_bars(("2024-07-03 09:00", 100, 1, 1, 100), ("2024-07-03 12:59", 100, 1, 1, 100),
                     ("2024-07-05 09:00", 110, 1, 1, 1))
    exact = dict(rows(ses.premarket_features(bars), "date", "overnight_gap"))
    asof = dict(rows(ses.premarket_features(bars, anchor="asof"), "date", "overnight_gap"))
    assert exact[D(2024, 7, 5)] is None
    assert asof[D(2024, 7, 5)] == pytest.approx(0.1)


def test_clock_change_days_follow_local_time(make_bars):
    bars = make_bars(("2024-03-08 09:30", 1, 2, 1, 2), ("2024-03-11 09:30", 3, 4, 3, 4),
                     ("2024-11-01 15:59", 5, 6, 5, 6), ("2024-11-04 15:59", 7, 8, 7, 8))
    assert [r[0] for r in rows(ses.session_ohlcv(bars), "open")] == [1.0, 3.0, 5.0, 7.0]


def test_features_do_not_see_past_the_snapshot(make_bars):
    history = [(f"2024-03-{d:02d} {t}", 100 + d, 101 + d, 99 + d, 100.5 + d)
               for d in (4, 5, 6) for t in ("08:30", "09:00", "09:30", "15:59", "18:00")]
    whole = make_bars(*history)
    cut = make_bars(*[r for r in history if r[0] < "2024-03-06 09:00"],
                    ("2024-03-06 09:00", 106, None, None, None, None))
    pick = lambda df: [r for r in rows(df, "date", *PREMARKET) if r[0] == D(2024, 3, 6)]
    assert pick(ses.premarket_features(whole)) == pick(ses.premarket_features(cut))
    assert None not in pick(ses.premarket_features(cut))[0]
    level = lambda df: [r for r in rows(ses.asof_level(df), "date", "level") if r[0] == D(2024, 3, 6)]
    assert level(whole) == level(cut)


def test_macro_pairs_need_no_common_days(make_bars):
    from openbell.sources.bars import MACRO_SOURCES

    bars = make_bars(
        ("2024-03-04 15:59", 1, 1, 1, 10, 1, "VX"), ("2024-03-05 09:00", 11, 1, 1, 1, 1, "VX"),
        ("2024-03-06 15:59", 1, 1, 1, 100, 1, "ZN"), ("2024-03-07 09:00", 110, 1, 1, 1, 1, "ZN"),
    )
    out = {r["date"]: r for r in ses.macro_features(bars, list(MACRO_SOURCES)).collect()}
    assert out[D(2024, 3, 5)]["vix_overnight"] == pytest.approx(0.1)
    assert out[D(2024, 3, 5)]["tenY_overnight"] is None
    assert out[D(2024, 3, 7)]["tenY_overnight"] == pytest.approx(-0.1)


def test_har_lags_warm_up(make_daily):
    daily = make_daily([(100, 100 + i, 100, 100, 1) for i in range(1, 25)])
    out = rows(ses.realized_range(daily), "date", "rv_lag_5", "rv_lag_22")
    assert [r[1] is None for r in out[:6]] == [True] * 5 + [False]
    assert out[5][1] == pytest.approx(0.03)
    assert [r[2] is None for r in out].count(False) == 2


def test_today_is_no_label_until_final(make_daily):
    daily = make_daily([1, 2, 3])
    last = D(2020, 1, 3)
    assert ses.complete_sessions(daily, last).count() == 2
    assert ses.complete_sessions(daily, last, today_is_final=True).count() == 3


def test_snapshot_bound():
    assert snapshot_bound(D(2024, 1, 5)) == dt.datetime(2024, 1, 5, 14, 1)
    assert snapshot_bound(D(2024, 7, 5)) == dt.datetime(2024, 7, 5, 13, 1)
    with pytest.raises(ValueError):
        snapshot_bound(D(2024, 1, 5), now=dt.datetime(2024, 1, 5, 14, 0))


def test_lookback_is_inclusive(make_daily):
    daily = make_daily([1, 2, 3])
    assert lookback(daily, D(2025, 1, 2)).count() == 2


def test_session_zone_does_not_matter(spark, make_bars):
    bars = make_bars(("2024-03-08 09:30", 1, 2, 1, 2), ("2024-03-11 15:59", 3, 4, 3, 4), ("2024-07-01 16:00", 1, 1, 1, 1))
    want = rows(ses.session_ohlcv(bars), "date", "open", "close")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert rows(ses.session_ohlcv(bars), "date", "open", "close") == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [r[0] for r in want] == [D(2024, 3, 8), D(2024, 3, 11)]


def test_snapshot_bounds_equal_the_single_bound(spark):
    days = [D(2024, 1, 5), D(2024, 3, 8), D(2024, 3, 11), D(2024, 7, 5), D(2024, 11, 4)]
    got = spark.createDataFrame([(d,) for d in days] + [(None,)], "day DATE").select("day", snapshot_bounds("day").alias("b")).collect()
    assert {r["day"]: r["b"] for r in got} == {d: snapshot_bound(d) for d in days} | {None: None}
