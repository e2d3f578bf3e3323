"""Technical indicators per symbol on a daily OHLCV series.

Rolling ones are built-in window functions. The recursive ones (Wilder means,
EMAs) have no Spark window; they run in one grouped pandas call per symbol,
whose group is bounded by trading days (about 250 a year), never by bars.

Definitions the inputs do not fix (seeds, degrees of freedom):
* Wilder mean of n: y += (x - y) / n, seeded with the first non-null x and
  published once n non-null values were seen; EMA of n likewise with 2/(n+1).
* Bollinger bands use the sample standard deviation.
"""

from __future__ import annotations

import datetime as dt

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from openbell.functions.clock import is_weekday
from openbell.functions.numeric import change, full_mean
from openbell.schemas import OHLCV, TECHNICALS

KEY = ["symbol", "date"]


def by_date(group: tuple[str, ...] = ("symbol",)) -> WindowSpec:
    return Window.partitionBy(*group).orderBy("date")


# --- rolling indicators ----------------------------------------------------

def sma_distance(n: int, w: WindowSpec | None = None) -> Column:
    w = w or by_date()
    return change("close", full_mean("close", w, n))


def bollinger_pct_b(n: int = 20, width: float = 2.0, w: WindowSpec | None = None) -> Column:
    """Position of the close inside the band; 0.5 in a flat band."""
    w = w or by_date()
    frame = w.rowsBetween(-(n - 1), 0)
    mean = full_mean("close", w, n)
    deviation = F.stddev_samp("close").over(frame)
    # flat means equal prices, tested exactly rather than by a rounded deviation
    flat = F.max("close").over(frame) == F.min("close").over(frame)
    lower = mean - F.lit(width) * deviation
    position = F.try_divide(F.col("close") - lower, F.lit(2 * width) * deviation)
    return F.when(mean.isNotNull(), F.when(flat, F.lit(0.5)).otherwise(position))


def relative_volume(n: int = 20, w: WindowSpec | None = None) -> Column:
    w = w or by_date()
    return F.try_divide("volume", full_mean("volume", w, n))


def with_stochastic(
    daily: DataFrame, k: int = 14, d: int = 3, smooth: int = 3, w: WindowSpec | None = None
) -> DataFrame:
    """Add stoch_k and stoch_d; a range of zero gives NULL."""
    w = w or by_date()
    frame = w.rowsBetween(-(k - 1), 0)
    low, high = F.min("low").over(frame), F.max("high").over(frame)
    full = (F.count("low").over(frame) == k) & (F.count("high").over(frame) == k)
    raw = F.when(full, 100 * F.try_divide(F.col("close") - low, high - low))
    return (
        daily.withColumn("_raw", raw)
        .withColumn("stoch_k", full_mean("_raw", w, smooth))
        .withColumn("stoch_d", full_mean("stoch_k", w, d))
        .drop("_raw")
    )


def day_momentum() -> Column:
    return F.try_divide(F.col("close") - F.col("open"), "open")


def day_range() -> Column:
    return F.try_divide(F.col("high") - F.col("low"), "open")


# --- inputs of the recursive indicators: plain lag expressions --------------

def with_moves(daily: DataFrame, w: WindowSpec | None = None, prev: dict[str, Column] | None = None) -> DataFrame:
    """Add gain, loss, true range and directional moves (NULL on the first row).

    ``prev`` gives the previous high, low and close where they are columns already.
    """
    w = w or by_date()
    prev = prev or {c: F.lag(c).over(w) for c in ("high", "low", "close")}
    step = F.col("close") - prev["close"]
    up, down = F.col("high") - prev["high"], prev["low"] - F.col("low")
    true_range = F.greatest(
        F.col("high") - F.col("low"),
        F.abs(F.col("high") - prev["close"]),
        F.abs(F.col("low") - prev["close"]),
    )
    # greatest() skips NULLs, so the first row of a symbol needs an explicit one
    known = prev["close"].isNotNull()
    return daily.withColumns({
        "gain": F.when(known, F.greatest(step, F.lit(0.0))),
        "loss": F.when(known, F.greatest(-step, F.lit(0.0))),
        "true_range": F.when(known, true_range),
        "plus_move": F.when((up > down) & (up > 0), up).when(up.isNotNull(), 0.0),
        "minus_move": F.when((down > up) & (down > 0), down).when(down.isNotNull(), 0.0),
    })


def _recursive_mean(x: pd.Series, alpha: float, n: int) -> pd.Series:
    return x.ewm(alpha=alpha, adjust=False, ignore_na=True, min_periods=n).mean()


RECURSIVE = ["rsi_14", "atr_14", "adx_14", "dmp_14", "dmn_14", "macd", "macd_hist", "macd_signal"]
MOVES = ["gain", "loss", "true_range", "plus_move", "minus_move"]


def _recursive_block(pdf: pd.DataFrame) -> pd.DataFrame:
    """All recursive indicators of one symbol; O(days)."""
    pdf = pdf.sort_values("date")

    def wilder(x: pd.Series) -> pd.Series:
        return _recursive_mean(x, 1 / 14, 14)

    def ema(x: pd.Series, n: int) -> pd.Series:
        return _recursive_mean(x, 2 / (n + 1), n)

    def share(a: pd.Series, b: pd.Series) -> pd.Series:
        return 100 * a / b.where(b != 0)

    gain, loss, atr = wilder(pdf["gain"]), wilder(pdf["loss"]), wilder(pdf["true_range"])
    plus, minus = share(wilder(pdf["plus_move"]), atr), share(wilder(pdf["minus_move"]), atr)
    macd = ema(pdf["close"], 12) - ema(pdf["close"], 26)
    signal = ema(macd, 9)
    return pdf.assign(
        rsi_14=share(gain, gain + loss),
        atr_14=atr,
        adx_14=wilder(share((plus - minus).abs(), plus + minus)),
        dmp_14=plus,
        dmn_14=minus,
        macd=macd,
        macd_hist=macd - signal,
        macd_signal=signal,
    ).drop(columns=MOVES)


def with_recursive(daily: DataFrame, group: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """Add RSI, ATR, ADX, +DI, -DI and MACD in one pass per group."""
    schema = StructType([*daily.schema.fields, *[StructField(c, DoubleType()) for c in RECURSIVE]])
    return with_moves(daily, by_date(group)).groupBy(*group).applyInPandas(_recursive_block, schema)


def ewma(df: DataFrame, value: str, out: str, span: int = 5, by=("symbol",), date="date") -> DataFrame:
    """Exponential mean with alpha = 2/(span+1). A gap carries the last value
    forward while its weight decays, as in an unadjusted pandas ewm."""
    schema = StructType([*df.schema.fields, StructField(out, DoubleType())])

    def block(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(date)
        return pdf.assign(**{out: pdf[value].astype("float64").ewm(span=span, adjust=False).mean()})

    return df.groupBy(*by).applyInPandas(block, schema)


# --- the published block ----------------------------------------------------

def with_technicals(daily: DataFrame, group: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """Add the 16 unlagged daily technicals."""
    w = by_date(group)
    # pandas output has no known partitioning; one exchange by symbol serves all
    # windows that follow
    recursive = with_recursive(daily, group).repartition("symbol")
    full = with_stochastic(recursive, w=w)
    out = {
        "dist_sma_50": sma_distance(50, w),
        "dist_sma_200": sma_distance(200, w),
        "pct_atr": F.try_divide("atr_14", "close"),
        "bb_pct_b": bollinger_pct_b(w=w),
        "relative_volume": relative_volume(w=w),
        "pct_macd": F.try_divide("macd", "close"),
        "pct_macd_hist": F.try_divide("macd_hist", "close"),
        "pct_macd_signal": F.try_divide("macd_signal", "close"),
        "prev_rth_momentum": day_momentum(),
        "prev_day_range": day_range(),
    }
    return full.withColumns(out).drop("atr_14", "macd", "macd_hist", "macd_signal")


def placeholders(daily: DataFrame, as_of: dt.date) -> DataFrame:
    """(symbol, date) rows for ``as_of`` of every symbol that has none."""
    day = F.lit(as_of)
    return (
        daily.groupBy("symbol")
        .agg(F.bool_or(F.col("date") == day).alias("present"))
        .filter(~F.col("present"))
        .select("symbol", day.alias("date"))
    )


def lagged(daily: DataFrame, columns: list[str], group: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """Every listed column moved to the next row of its group."""
    w = by_date(group)
    return daily.withColumns({c: F.lag(c).over(w) for c in columns})


def daily_technicals(daily: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """(symbol, date, 16 features): each row holds the previous session's values.

    ``as_of`` adds a row without values to symbols that have no session on that
    day yet, so that the lag hands yesterday's values to it.
    """
    base = daily.select(*KEY, *OHLCV)
    wide = with_technicals(base).select(*KEY, *TECHNICALS)
    if as_of is not None:
        wide = wide.unionByName(placeholders(base, as_of), allowMissingColumns=True)
    return lagged(wide, TECHNICALS)
