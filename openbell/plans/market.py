"""The market feature matrix and the merged model table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from openbell.functions.clock import ONE_MINUTE, SessionClock, lookback, up_to
from openbell.operators.contracts import check_collisions, check_schema, check_unique, require_columns, unique_inside
from openbell.operators.dedup import keep_last
from openbell.operators.indicators import lagged, with_technicals
from openbell.operators.sessions import daily_anchors_wide, label, with_premarket
from openbell.operators.trailing import answers, positioned, prior
from openbell.schemas import PREMARKET, TECHNICALS

KEY = ["symbol", "date"]


def _key_first(df: DataFrame) -> DataFrame:
    return df.select(*KEY, *[c for c in df.columns if c not in KEY])


def feature_matrix(
    bars: DataFrame,
    clock: SessionClock = ONE_MINUTE,
    as_of: dt.date | None = None,
    years: int | None = 5,
    keep_unsettled: bool = False,
    drop_incomplete: bool = True,
    anchor: str = "exact",
) -> DataFrame:
    """(symbol, date, 4 pre-market, 16 lagged technicals, y), one row per day
    with a snapshot bar. The bars are scanned and shuffled once."""
    return matrix_from_daily(
        daily_anchors_wide(bars, clock), as_of, years, keep_unsettled, drop_incomplete, anchor
    )


def matrix_from_daily(
    daily: DataFrame,
    as_of: dt.date | None = None,
    years: int | None = 5,
    keep_unsettled: bool = False,
    drop_incomplete: bool = True,
    anchor: str = "exact",
) -> DataFrame:
    """The feature matrix from the per-day table.

    Pre-market values, technicals and label live on one frame, where each
    ``previous row`` is a window partitioned by the flag that says which rows
    count for it, so the three tables need no joins.
    """
    # one exchange by symbol serves every window below, whatever flag it adds
    daily = daily.repartition("symbol")
    daily = with_premarket(daily, anchor).withColumn("y", label())
    today = F.lit(False) if as_of is None else F.col("date") == F.lit(as_of)
    daily = daily.withColumn("has_technicals", F.col("has_session") | today).drop(
        "pre_open", "pre_high", "pre_low", "pre_close",
        "snapshot_open", "official_close", "cash_open", "evening_open",
    )
    daily = with_technicals(daily, group=("symbol", "has_session"))
    daily = daily.withColumns({c: F.when(F.col("has_session"), F.col(c)) for c in TECHNICALS})
    daily = lagged(daily, TECHNICALS, group=("symbol", "has_technicals"))
    out = daily.filter("has_snapshot").select(
        *KEY,
        *PREMARKET,
        *[F.when(F.col("has_technicals"), F.col(c)).alias(c) for c in TECHNICALS],
        "y",
    )
    if years is not None and as_of is not None:
        out = lookback(out, as_of, years)
    if not drop_incomplete:
        return out
    return out.dropna(subset=PREMARKET + TECHNICALS + ([] if keep_unsettled else ["y"]))


def prepare_sentiment(daily: DataFrame, seq: str | None = None) -> DataFrame:
    """``Date`` becomes the plain-date key ``date``; the newest row per day wins
    when the table carries a load number."""
    require_columns(daily, ["Date"], "sentiment")
    features = [c for c in daily.columns if c != "Date"]
    out = daily.select(F.to_date("Date").alias("date"), *features)
    return keep_last(out, ["date"], seq).drop(seq) if seq else out


def merge_features(
    market: DataFrame,
    macro: DataFrame,
    sentiment: DataFrame,
    calendar: DataFrame,
    cutoff: dt.date | None = None,
    keep_unsettled: bool = False,
    check_rows: bool | str = True,
) -> DataFrame:
    """Checked inner merge of the four feature tables.

    Repeated keys raise at once (one job per table), or with ``check_rows="inside"`` when
    the merge itself runs, which then reads every table once.

    Macro, sentiment and calendar have one row per calendar day and so are
    broadcast by AQE when it measures them; market has one row per symbol and day.
    """
    frames: Mapping[str, DataFrame] = {
        "market": market, "macro": macro, "sentiment": sentiment, "calendar": calendar,
    }
    keys: Mapping[str, Sequence[str]] = {
        s: [k for k in KEY if k in df.columns] for s, df in frames.items()
    }
    for source, df in frames.items():
        check_schema(df, ["date"], source)
    require_columns(market, ["y"], "market")
    check_collisions(frames, KEY)
    if check_rows == "inside":
        frames = {source: unique_inside(df, keys[source], source) for source, df in frames.items()}
    elif check_rows:
        for source, df in frames.items():
            check_unique(df, keys[source], source)
    out, *others = frames.values()
    for df in others:
        out = out.join(df, [k for k in KEY if k in df.columns], "inner")
    out = _key_first(up_to(out, cutoff))
    return out if keep_unsettled else out.filter("y IS NOT NULL")


def assemble(model_data: DataFrame, ranges: DataFrame, level: DataFrame) -> DataFrame:
    """Training table: features with the lagged ranges and the target (inner),
    the volatility level (left, may be missing), rows without target dropped."""
    lags = ranges.select(*KEY, "rv_lag_5", "rv_lag_22", "target")
    level_keys = [k for k in KEY if k in level.columns]
    joined = model_data.drop("y").join(lags, KEY, "inner").join(level, level_keys, "left")
    return _key_first(joined.filter("target IS NOT NULL"))


def features_for_dates(
    model_data: DataFrame, realized: DataFrame, level: DataFrame, wanted: DataFrame
) -> DataFrame:
    """Feature rows to score, for any set of (symbol, date), settled or not.

    Range lags are means over the last 5 and 22 sessions strictly before the
    date. Every requested row must come out complete; ``check_scoring_rows``
    names what is missing.
    """
    series = positioned(realized, wanted, "realized_range")

    def trailing(n: int):
        return F.when(F.col("_k") >= 22, F.avg("realized_range").over(prior(n)))

    lags = answers(series, {
        "prior_sessions": F.col("_k"), "rv_lag_5": trailing(5), "rv_lag_22": trailing(22),
    })
    level_keys = [k for k in KEY if k in level.columns]
    features = model_data.drop("y").withColumn("has_features", F.lit(True))
    joined = lags.join(features, KEY, "left").join(level, level_keys, "left")
    return _key_first(
        joined.withColumn("has_features", F.coalesce("has_features", F.lit(False)))
    )


def check_scoring_rows(rows: DataFrame, level: str = "vix_level") -> DataFrame:
    """Raise for the first requested day that cannot be scored, else return the
    rows without the bookkeeping columns."""
    reason = (
        F.when(~F.col("has_features"), "no feature row")
        .when(F.col("prior_sessions") < 22, "fewer than 22 prior sessions")
        .when(F.col(level).isNull(), f"no {level}")
    )
    bad = rows.select(*KEY, reason.alias("reason")).filter("reason IS NOT NULL").limit(1).collect()
    if bad:
        raise ValueError(f"cannot score {bad[0]['symbol']} {bad[0]['date']}: {bad[0]['reason']}")
    return rows.drop("has_features", "prior_sessions")
