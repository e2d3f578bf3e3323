"""Bar sources: vendor normalisation, trimming and incremental loads."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from openbell.functions.clock import ONE_MINUTE, SessionClock, from_wall_clock, stamp
from openbell.functions.numeric import nan_to_null
from openbell.operators.dedup import DELIVERY, duplicate_keys, keep_by_rule, keep_first, keep_highest_volume
from openbell.schemas import BARS, OHLCV, SOURCE_CFG

# Prices of one vendor arrive as integers scaled by 1e9.
PRICE_SCALE = 1e9
PRICES = OHLCV[:4]


@dataclass(frozen=True)
class SourceConfig:
    """One macro series. ``invert_sign`` is for prices that move against the
    quantity of interest (bond futures against yields)."""

    source: str
    symbol: str
    fixed_point: bool = False
    invert_sign: bool = False


# The two macro series and their quirks.
VOLATILITY = SourceConfig("vix", "VX")
TEN_YEAR = SourceConfig("tenY", "ZN", fixed_point=True, invert_sign=True)
MACRO_SOURCES = (VOLATILITY, TEN_YEAR)


def source_table(spark: SparkSession, sources=MACRO_SOURCES) -> DataFrame:
    """The configuration as a dimension table: one row per configured source."""
    rows = [(s.source, s.symbol, s.fixed_point, s.invert_sign) for s in sources]
    return spark.createDataFrame(rows, SOURCE_CFG)


def read_bars(spark: SparkSession, path: str) -> DataFrame:
    """Stored bars; zone-less timestamps are UTC."""
    return nan_to_null(spark.read.schema(BARS).parquet(path))


def normalise_fixed_point(df: DataFrame) -> DataFrame:
    """Vendor A: scale integer prices, keep the bar columns. Columns that are
    already floating point pass through; the schema decides, not the rows."""
    types = {f.name: f.dataType for f in df.schema}
    out = {
        c: (F.col(c) / F.lit(PRICE_SCALE)) if isinstance(types[c], IntegralType) else F.col(c)
        for c in PRICES
    }
    out["volume"] = F.col("volume").cast("double")
    out["ts"] = F.col("ts").cast("timestamp_ntz")
    extra = [c for c in ("load_seq",) if c in df.columns]
    return nan_to_null(df.withColumns(out).select("symbol", "ts", *OHLCV, *extra))


def normalise_exchange_time(df: DataFrame, exchange_tz: str | None) -> DataFrame:
    """Vendor B: exchange wall time -> UTC (no zone given means UTC already),
    numbers to double, first row per timestamp."""
    ts = F.col("ts").cast("timestamp_ntz")
    if exchange_tz:
        ts = from_wall_clock("ts", exchange_tz)
    typed = df.withColumns({**{c: F.col(c).cast("double") for c in OHLCV}, "ts": ts})
    order = [DELIVERY] if DELIVERY in df.columns else []
    kept = keep_first(nan_to_null(typed.select("symbol", "ts", *OHLCV, "load_seq", *order)), ["symbol", "ts"])
    return kept.drop(DELIVERY)


def trim(bars: DataFrame, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """Half-open ``[start, end)``; both bounds reach the parquet scan."""
    return bars.filter(
        (F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
        & (F.col("ts") < F.lit(end).cast("timestamp_ntz"))
    )


def new_bars(
    existing: DataFrame,
    incoming: DataFrame,
    end: dt.datetime,
    keep: str | Column = "first",
) -> DataFrame:
    """Rows of ``incoming`` that extend ``existing``: per symbol from one minute
    past the last stored bar up to ``end`` (exclusive), one row per timestamp: the
    ``first`` one, that of the largest ``volume``, or the latter where a condition holds.

    All symbols go through one join; the watermark side has one row per symbol
    and AQE broadcasts it when it measures it to be small. A symbol without
    history contributes everything it has.
    """
    watermark = existing.groupBy("symbol").agg(
        (F.max("ts") + F.expr("INTERVAL 1 MINUTE")).alias("_start")
    )
    fresh = (
        incoming.filter(F.col("ts") < F.lit(end).cast("timestamp_ntz"))
        .join(watermark, "symbol", "left")
        .filter(F.col("_start").isNull() | (F.col("ts") >= F.col("_start")))
        .drop("_start")
    )
    if isinstance(keep, Column):
        out = keep_by_rule(fresh, keep)
    else:
        out = keep_highest_volume(fresh) if keep == "volume" else keep_first(fresh, ["symbol", "ts"])
    return out.drop(DELIVERY)


def extended(
    existing: DataFrame, incoming: DataFrame, end: dt.datetime, keep: str | Column = "first"
) -> DataFrame:
    """The whole table after a load. Storage does not need it: the new rows lie
    strictly after the old ones, so ``append_bars`` writes only those."""
    return existing.unionByName(new_bars(existing, incoming, end, keep), allowMissingColumns=True)


def append_bars(
    bars: DataFrame, path: str, clock: SessionClock = ONE_MINUTE, mode: str = "append"
) -> None:
    """Write stamped bars by local month.

    REBALANCE lets AQE merge small months and split one that a hot symbol fills;
    sorting inside files gives row-group statistics on symbol.
    """
    stamped = stamp(bars, clock).withColumn("et_month", F.date_format("et_date", "yyyy-MM"))
    (
        stamped.hint("rebalance", "et_month", "symbol")
        .sortWithinPartitions("et_month", "symbol", "ts")
        .write.mode(mode)
        .partitionBy("et_month")
        .parquet(path)
    )


def read_stamped(
    spark: SparkSession, path: str, first_month: str | None = None, last_month: str | None = None
) -> DataFrame:
    df = spark.read.parquet(path)
    if first_month:
        df = df.filter(F.col("et_month") >= first_month)
    if last_month:
        df = df.filter(F.col("et_month") <= last_month)
    return df


def healed(bars: DataFrame) -> tuple[DataFrame, bool]:
    """(clean bars, whether anything was wrong): rewrite a table only when
    duplicate timestamps are found in it."""
    dirty = not duplicate_keys(bars, ["symbol", "ts"]).isEmpty()
    return (keep_highest_volume(bars) if dirty else bars), dirty
