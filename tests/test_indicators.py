import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from openbell.operators import indicators as ind
from openbell.operators.daily_news import with_tail_flags, with_time_series
from openbell.functions.numeric import full_mean
from openbell.schemas import TECHNICALS


def test_full_mean_warm_up_and_gaps(make_daily):
    closes = [float(i) for i in range(1, 46)]
    closes[21] = None
    df = make_daily([(1, 1, 1, c, 1) for c in closes])
    w = ind.by_date()
    out = rows(df.select("date", full_mean("close", w, 20).alias("m"),
                         full_mean("close", w, 20, start=-20).alias("lagged")), "date", "m", "lagged")
    assert [r[1] is not None for r in out[18:21]] == [False, True, True]
    assert [r[2] is not None for r in out[19:22]] == [False, True, True]
    assert sum(r[1] is None for r in out[21:]) == 20


def test_flat_band_is_half(make_daily):
    out = rows(make_daily([5.1] * 21).select("date", ind.bollinger_pct_b().alias("b")), "date", "b")
    assert [r[1] for r in out] == [None] * 19 + [0.5, 0.5]


def test_stochastic_of_a_flat_market_is_null(make_daily):
    assert ind.with_stochastic(make_daily([5.0] * 20)).filter("stoch_k IS NOT NULL").count() == 0


def _loop_mean(x, alpha, n):
    y, seen, out = None, 0, []
    for v in x:
        if v is not None:
            y = v if y is None else y + alpha * (v - y)
            seen += 1
        out.append(y if seen >= n else None)
    return out


def test_recursive_indicators_against_plain_loops(make_daily):
    rng = random.Random(5)
    price, data = 100.0, []
    for _ in range(60):
        o = price
        price *= 1 + rng.uniform(-0.02, 0.02)
        data.append((o, max(o, price) * 1.003, min(o, price) * 0.997, price, 10.0))
    got = ind.with_recursive(make_daily(data)).orderBy("date").toPandas()
    close = [d[3] for d in data]
    gains = [None] + [max(b - a, 0) for a, b in zip(close, close[1:])]
    losses = [None] + [max(a - b, 0) for a, b in zip(close, close[1:])]
    up, down = _loop_mean(gains, 1 / 14, 14), _loop_mean(losses, 1 / 14, 14)
    rsi = [None if u is None else 100 * u / (u + d) for u, d in zip(up, down)]
    ranges = [None] + [max(h - lo, abs(h - p), abs(lo - p))
                       for (_, h, lo, _, _), p in zip(data[1:], close)]
    e12, e26 = _loop_mean(close, 2 / 13, 12), _loop_mean(close, 2 / 27, 26)
    line = [None if b is None else a - b for a, b in zip(e12, e26)]
    for name, want in (("rsi_14", rsi), ("atr_14", _loop_mean(ranges, 1 / 14, 14)), ("macd", line),
                       ("macd_signal", _loop_mean(line, 0.2, 9))):
        want = pd.Series([np.nan if v is None else v for v in want])
        assert np.allclose(got[name], want, equal_nan=True), name


def test_ewma_with_gaps(spark):
    values = [1.0, None, None, 4.0, 2.0, None, 3.0]
    df = spark.createDataFrame(
        [("a", dt.date(2024, 1, i + 1), v) for i, v in enumerate(values)], "symbol STRING, date DATE, v DOUBLE"
    )
    out = [r[1] for r in rows(ind.ewma(df, "v", "y"), "date", "y")]
    assert out == pytest.approx([1, 1, 1, 2.588235, 2.392157, 2.392157, 2.652661], abs=1e-6)


def test_placeholder_takes_yesterdays_values(make_daily):
    daily = make_daily([(100 + i, 102 + i, 99 + i, 101 + i, 5) for i in range(30)])
    last = daily.agg(F.max("date")).first()[0]
    today = last + dt.timedelta(days=1)
    out = ind.daily_technicals(daily, as_of=today)
    assert out.filter(F.col("date") == today).count() == 1
    row = out.filter(F.col("date") == today).first()
    assert row["prev_rth_momentum"] == pytest.approx(1 / 129)
    assert set(TECHNICALS) <= set(out.columns)
    # adding the row changes nothing before it
    before = ind.daily_technicals(daily)
    assert rows(before, "date", "prev_day_range") == rows(
        out.filter(F.col("date") != today), "date", "prev_day_range"
    )


def test_buzz_counts_missing_days_as_zero(spark):
    data = [(dt.date(2024, 1, i + 1), c, 0.1 * i) for i, c in enumerate([None, 4.0, None, 6.0])]
    df = spark.createDataFrame(data, "Date DATE, article_count DOUBLE, weighted_impact DOUBLE")
    out = [r[1] for r in rows(with_time_series(df), "Date", "buzz_factor")]
    # no history; zero mean; 0/2; 6/(4/3)
    assert out == [None, None, 0.0, pytest.approx(4.5)]


def test_tail_flags_wait_for_the_window(spark):
    days = [(dt.date(2020, 1, 1) + dt.timedelta(days=i), float(i % 7)) for i in range(252)]
    days += [(dt.date(2021, 1, 1), 99.0), (dt.date(2021, 1, 2), -99.0), (dt.date(2021, 1, 3), 3.0)]
    df = spark.createDataFrame(days, "Date DATE, weighted_impact DOUBLE")
    out = rows(with_tail_flags(df), "Date", "is_top_2pct_weighted_impact", "is_bot_2pct_weighted_impact")
    assert all(r[1:] == (None, None) for r in out[:252])
    assert [r[1:] for r in out[252:]] == [(1, 0), (0, 1), (0, 0)]
