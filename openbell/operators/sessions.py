"""From bars to one row per (symbol, day): session OHLCV and point-in-time anchors.

Everything a day needs from the bars comes out of ONE aggregation. Its buffers
are fixed-width (min_by/max_by over a timestamp), so it stays a hash aggregate
with map-side partials: a symbol that holds a third of the bars is reduced to
one partial row per day before the shuffle. Columns nobody asks for are pruned.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from openbell.functions.clock import ONE_MINUTE, SessionClock, is_weekday, stamp
from openbell.functions.numeric import change, full_mean
from openbell.sources.bars import SourceConfig

KEY = ["symbol", "date"]


def _within(clock: SessionClock, first: str, last: str) -> Column:
    return F.col("et_second").between(clock.at(first), clock.at(last))


def _exactly(clock: SessionClock, name: str) -> Column:
    return F.col("et_second") == clock.at(name)


def _only(cond: Column, c: str) -> Column:
    return F.when(cond, F.col(c))


def _first(c: str, cond: Column) -> Column:
    """Earliest non-null value: a NULL ordering key is skipped by min_by."""
    return F.min_by(c, F.when(cond & F.col(c).isNotNull(), F.col("ts")))


def _last(c: str, cond: Column) -> Column:
    return F.max_by(c, F.when(cond & F.col(c).isNotNull(), F.col("ts")))


def _latest_row(c: str, cond: Column) -> Column:
    """Value on the latest row, NULL or not. Several of these with one condition
    read the same row because (symbol, ts) is unique."""
    return F.max_by(c, F.when(cond, F.col("ts")))


def _ohlcv(clock: SessionClock, first: str, last: str) -> dict[str, Column]:
    inside = _within(clock, first, last)
    return {
        "open": _first("open", inside),
        "high": F.max(_only(inside, "high")),
        "low": F.min(_only(inside, "low")),
        "close": _last("close", inside),
        "volume": F.sum(_only(inside, "volume")),
    }


def session_ohlcv(
    bars: DataFrame,
    clock: SessionClock = ONE_MINUTE,
    first: str = "rth_open",
    last: str = "rth_last",
) -> DataFrame:
    """Regular-session OHLCV of every weekday with a positive close."""
    inside = stamp(bars, clock).filter(_within(clock, first, last))
    daily = inside.groupBy("symbol", F.col("et_date").alias("date")).agg(
        *[c.alias(n) for n, c in _ohlcv(clock, first, last).items()]
    )
    return daily.filter(is_weekday("date") & (F.col("close") > 0))


def daily_anchors_wide(
    bars: DataFrame, clock: SessionClock = ONE_MINUTE, asof: bool = False
) -> DataFrame:
    """All per-day inputs of the feature matrix, one shuffle over the bars; with
    ``asof`` also the macro anchors, so that one stored daily table serves every
    builder and bars are read once per load.

    The evening bar opens the *next* trading day, so it is keyed one calendar
    day forward; no other column uses that bar.
    """
    stamped = stamp(bars, clock)
    evening = _exactly(clock, "evening")
    date = F.when(evening, F.date_add("et_date", 1)).otherwise(F.col("et_date"))
    rth = _ohlcv(clock, "rth_open", "rth_last")
    pre = _ohlcv(clock, "pre_start", "pre_last")
    # a coarse range on purpose: the aggregates pick their own bars out of it
    until_close = F.col("et_second") <= clock.at("rth_last")
    relevant = evening | (until_close if asof else _within(clock, "pre_start", "rth_last"))

    def exact(name: str, c: str) -> Column:
        return F.max(_only(_exactly(clock, name), c))

    anchors = [
        _asof_snapshot(clock).alias("snapshot_9am"),
        _latest_row("close", until_close).alias("close_4pm"),
    ]
    return (
        stamped.filter(relevant)
        .groupBy("symbol", date.alias("date"))
        .agg(
            *[c.alias(n) for n, c in rth.items()],
            *[pre[c].alias(f"pre_{c}") for c in ("open", "high", "low", "close")],
            F.coalesce(F.bool_or(_exactly(clock, "snapshot")), F.lit(False)).alias("has_snapshot"),
            exact("snapshot", "open").alias("snapshot_open"),
            exact("rth_last", "close").alias("official_close"),
            exact("rth_open", "open").alias("cash_open"),
            exact("evening", "open").alias("evening_open"),
            *(anchors if asof else []),
        )
        .withColumn(
            "has_session", F.coalesce(is_weekday("date") & (F.col("close") > 0), F.lit(False))
        )
    )


def with_premarket(daily: DataFrame, anchor: str = "exact") -> DataFrame:
    """Add the four pre-market features to rows that have a snapshot bar.

    The previous close is that of the previous *snapshot day*. With
    ``anchor='asof'`` a day that closed early lends its last session close.
    """
    close = "official_close" if anchor == "exact" else "close"
    snapshot_days = Window.partitionBy("symbol", "has_snapshot").orderBy("date")
    prev_close = F.lag(close).over(snapshot_days)

    def when_snapshot(c: Column) -> Column:
        return F.when(F.col("has_snapshot"), c)

    return daily.withColumns({
        "overnight_gap": when_snapshot(change("snapshot_open", prev_close)),
        "premarket_trend": when_snapshot(change("snapshot_open", "evening_open")),
        "macro_vol_830": F.try_divide(F.col("pre_high") - F.col("pre_low"), "pre_open"),
        "macro_dir_830": F.try_divide(F.col("pre_close") - F.col("pre_open"), "pre_open"),
    })


def label(close="official_close", cash_open="cash_open") -> Column:
    """1 if the official close is above the cash open, 0 otherwise (ties too),
    NULL unless both exact bars exist."""
    close, cash_open = F.col(close), F.col(cash_open)
    return F.when(
        close.isNotNull() & cash_open.isNotNull(), (close > cash_open).cast("tinyint")
    )


def premarket_features(
    bars: DataFrame, clock: SessionClock = ONE_MINUTE, anchor: str = "exact"
) -> DataFrame:
    from openbell.schemas import PREMARKET

    wide = with_premarket(daily_anchors_wide(bars, clock), anchor)
    return wide.filter("has_snapshot").select(*KEY, *PREMARKET)


def updown_label(bars: DataFrame, clock: SessionClock = ONE_MINUTE) -> DataFrame:
    edges = stamp(bars, clock).filter(_exactly(clock, "rth_last") | _exactly(clock, "rth_open"))
    daily = edges.groupBy("symbol", F.col("et_date").alias("date")).agg(
        F.max(_only(_exactly(clock, "rth_last"), "close")).alias("official_close"),
        F.max(_only(_exactly(clock, "rth_open"), "open")).alias("cash_open"),
    )
    return daily.select(*KEY, label().alias("y")).filter("y IS NOT NULL")


def _asof_snapshot(clock: SessionClock) -> Column:
    """Open of the snapshot bar, else the close of the latest bar before it."""
    until = F.col("et_second") <= clock.at("snapshot")
    exact = F.max(_only(until, "et_second")) == clock.at("snapshot")
    return F.when(exact, _latest_row("open", until)).otherwise(_latest_row("close", until))


def asof_level(
    bars: DataFrame, clock: SessionClock = ONE_MINUTE, name: str = "level"
) -> DataFrame:
    """Level known at the snapshot, for every day with a bar up to it (weekends too)."""
    return (
        stamp(bars, clock)
        .filter(F.col("et_second") <= clock.at("snapshot"))
        .groupBy("symbol", F.col("et_date").alias("date"))
        .agg(_asof_snapshot(clock).alias(name))
    )


def daily_anchors(bars: DataFrame, clock: SessionClock = ONE_MINUTE) -> DataFrame:
    """As-of snapshot and as-of close per weekday; either may be missing."""
    until_close = F.col("et_second") <= clock.at("rth_last")
    return (
        stamp(bars, clock)
        .filter(until_close)
        .groupBy("symbol", F.col("et_date").alias("date"))
        .agg(
            _asof_snapshot(clock).alias("snapshot_9am"),
            _latest_row("close", until_close).alias("close_4pm"),
        )
        .filter(is_weekday("date"))
    )


def macro_features_long(anchors: DataFrame, sources: list[SourceConfig], n: int = 20) -> DataFrame:
    """(source, date, overnight, dist_sma_n) for the configured symbols; both
    bases are lagged one row, the sign flips for inverse-priced series."""
    named = F.lit(None).cast("string")
    sign = F.lit(1.0)
    for s in sources:
        named = F.when(F.col("symbol") == s.symbol, F.lit(s.source)).otherwise(named)
        sign = F.when(F.col("symbol") == s.symbol, F.lit(-1.0 if s.invert_sign else 1.0)).otherwise(sign)
    w = Window.partitionBy("symbol").orderBy("date")
    prev_close = F.lag("close_4pm").over(w)
    prior_mean = full_mean("close_4pm", w, n, start=-n)
    return (
        anchors.filter(F.col("symbol").isin([s.symbol for s in sources]))
        .select(
            named.alias("source"),
            "date",
            (sign * change("snapshot_9am", prev_close)).alias("overnight"),
            (sign * change("snapshot_9am", prior_mean)).alias(f"dist_sma_{n}"),
        )
    )


def macro_features(
    bars: DataFrame, sources: list[SourceConfig], clock: SessionClock = ONE_MINUTE, n: int = 20
) -> DataFrame:
    """One row per date with a column pair per source; a date that only one
    source traded stays, with NULLs for the other."""
    # the symbol filter reaches the scan before anything is aggregated
    chosen = bars.filter(F.col("symbol").isin([s.symbol for s in sources]))
    return macro_features_wide(daily_anchors(chosen, clock), sources, n)


def macro_features_wide(anchors: DataFrame, sources: list[SourceConfig], n: int = 20) -> DataFrame:
    """The same from ready anchors (symbol, date, snapshot_9am, close_4pm)."""
    long = macro_features_long(anchors, sources, n)
    measures = ("overnight", f"dist_sma_{n}")
    return long.groupBy("date").agg(*[
        F.max(F.when(F.col("source") == s.source, F.col(m))).alias(f"{s.source}_{m}")
        for s in sources
        for m in measures
    ])


def realized_range(daily: DataFrame, short: int = 5, long: int = 22) -> DataFrame:
    """(high - low) / open per session, its lagged means and the target copy."""
    w = Window.partitionBy("symbol").orderBy("date")
    ranged = daily.select(
        *KEY, F.try_divide(F.col("high") - F.col("low"), "open").alias("realized_range")
    )
    return ranged.select(
        "*",
        full_mean("realized_range", w, short, start=-short).alias(f"rv_lag_{short}"),
        full_mean("realized_range", w, long, start=-long).alias(f"rv_lag_{long}"),
        F.col("realized_range").alias("target"),
    )


def complete_sessions(daily: DataFrame, as_of: dt.date, today_is_final: bool = False) -> DataFrame:
    """Drop ``as_of`` itself unless its session is over: a partial day must not
    become a label or a realized range."""
    keep = F.col("date") <= F.lit(as_of) if today_is_final else F.col("date") < F.lit(as_of)
    return daily.filter(keep)
