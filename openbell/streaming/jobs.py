"""Structured Streaming versions of the ingest, session and article steps.

Event-time columns are zone-less in the tables; a watermark needs TIMESTAMP, so
they are cast (the session zone is UTC, the value does not change). Windows that
follow the exchange's day use the local wall clock as event time.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from openbell.functions.clock import ONE_MINUTE, SessionClock, article_date, is_weekday, stamp, wall_clock
from openbell.functions.numeric import change
from openbell.functions.text import news_text
from openbell.operators.sessions import _first, _last, _only, _within, session_ohlcv
from openbell.sources.bars import append_bars
from openbell.sources.snapshots import SnapshotTable


def dedupe_bars(bars: DataFrame, lateness: str = "10 minutes") -> DataFrame:
    """First bar per (symbol, ts); state is dropped once the watermark passes."""
    return (
        bars.withColumn("event_time", F.col("ts").cast("timestamp"))
        .withWatermark("event_time", lateness)
        .dropDuplicatesWithinWatermark(["symbol", "ts"])
    )


def _local_time(bars: DataFrame, clock: SessionClock, lateness: str) -> DataFrame:
    local = wall_clock("ts", clock.tz).cast("timestamp")
    return stamp(bars, clock).withColumn("et_time", local).withWatermark("et_time", lateness)


def sessions(
    bars: DataFrame, clock: SessionClock = ONE_MINUTE, lateness: str = "10 minutes"
) -> DataFrame:
    """Session OHLCV per local trading day, emitted when the watermark leaves the
    day. Bars outside the session still advance time, so nothing filters them
    before the watermark."""
    inside = _within(clock, "rth_open", "rth_last")
    daily = _local_time(bars, clock, lateness).groupBy(
        "symbol", F.window("et_time", "1 day").alias("w")
    ).agg(
        _first("open", inside).alias("open"),
        F.max(_only(inside, "high")).alias("high"),
        F.min(_only(inside, "low")).alias("low"),
        _last("close", inside).alias("close"),
        F.sum(_only(inside, "volume")).alias("volume"),
    )
    date = F.to_date("w.start")
    return daily.filter(is_weekday(date) & (F.col("close") > 0)).select(
        "symbol", date.alias("date"), "open", "high", "low", "close", "volume"
    )


def articles(stream: DataFrame, lateness: str = "1 day") -> DataFrame:
    """Time-box articles and keep one per (title, published_at). The time box is
    stateless and drops intraday news before it reaches the state store."""
    boxed = stream.withColumns({"Date": article_date("published_at"), "news_text": news_text()})
    return (
        boxed.filter(F.col("Date").isNotNull())
        .withColumn("event_time", F.col("published_at").cast("timestamp"))
        .withWatermark("event_time", lateness)
        .dropDuplicatesWithinWatermark(["title", "published_at"])
        .select("Date", "published_at", "title", "news_text")
    )


def maintain_bars(bars: DataFrame, path: str, checkpoint: str, clock: SessionClock = ONE_MINUTE):
    """Keep the stored bar table current: each micro-batch appends its own bars.

    The stream is deduplicated by its state store and input offsets are
    checkpointed; a batch that runs again after a failure overwrites the folder
    of its batch number, so a retry adds nothing twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        append_bars(batch.drop("event_time"), f"{path}/batch={batch_id}", clock, mode="overwrite")

    return (
        dedupe_bars(bars)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def maintain_snapshots(
    bars: DataFrame, table: SnapshotTable, checkpoint: str, clock: SessionClock = ONE_MINUTE, most_files: int = 8
):
    """Keep a bar table of snapshots current: each micro-batch is one load, and months
    with more than ``most_files`` files are merged. Readers keep the version they opened."""

    def write(batch: DataFrame, batch_id: int) -> None:
        stamped = stamp(batch, clock).withColumn("et_month", F.date_format("et_date", "yyyy-MM"))
        table.append(stamped, f"batch-{batch_id}")
        table.merge(most_files)

    return bars.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def keep_late(bars: DataFrame, root: str, checkpoint: str, clock: SessionClock = ONE_MINUTE, lateness_minutes: int = 10):
    """Store every bar, and beside them those that came too late for ``sessions``.

    A watermark drops rows silently. Here each micro-batch is stored below ``bars``, its
    newest local time below ``marks``, and the rows of days that earlier batches had
    closed go below ``late`` as well. All three folders carry the batch number, so a
    batch that runs again replaces what it wrote.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, path = batch.sparkSession, f"{root}/bars/batch={batch_id}"
        append_bars(batch, path, clock, mode="overwrite")
        written = spark.read.parquet(path)
        local = F.col("et_date").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("et_second"))
        written.agg(F.max(local).alias("newest")).write.mode("overwrite").parquet(f"{root}/marks/batch={batch_id}")
        closed = (
            spark.read.parquet(f"{root}/marks").filter(F.col("batch") < batch_id)
            .agg((F.max("newest") - F.make_dt_interval(mins=F.lit(lateness_minutes))).alias("t")).first()["t"]
        )
        day_end = F.date_add("et_date", 1).cast("timestamp_ntz")
        late = written.filter(F.lit(False) if closed is None else day_end <= F.lit(closed).cast("timestamp_ntz"))
        late.write.mode("overwrite").parquet(f"{root}/late/batch={batch_id}")

    return bars.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def repaired_sessions(spark: SparkSession, root: str, clock: SessionClock = ONE_MINUTE) -> DataFrame:
    """The sessions that late bars touched, from all stored bars of those symbols and
    days; other months are pruned. Like ``sessions``, it counts the rows as they are."""
    touched = spark.read.parquet(f"{root}/late").select("symbol", "et_date", "et_month").distinct()
    bars = spark.read.parquet(f"{root}/bars").join(touched, ["symbol", "et_date", "et_month"], "left_semi")
    return session_ohlcv(bars, clock)


def current_sessions(emitted: DataFrame, repaired: DataFrame) -> DataFrame:
    """Emitted sessions, those with late bars replaced."""
    return emitted.join(repaired.select("symbol", "date"), ["symbol", "date"], "left_anti").unionByName(repaired)


def snapshot_windows(
    bars: DataFrame, clock: SessionClock = ONE_MINUTE, lateness: str = "0 seconds"
) -> DataFrame:
    """One row per symbol and *snapshot day*: the 24 hours that end one minute
    after the snapshot. Append mode emits it as soon as that moment has passed."""
    offset = f"{clock.at('snapshot') + 60} seconds"
    at_snapshot = F.col("et_second") == clock.at("snapshot")
    pre = _within(clock, "pre_start", "pre_last")

    def exact(name: str, c: str):
        return F.max(_only(F.col("et_second") == clock.at(name), c))

    return (
        _local_time(bars, clock, lateness)
        .groupBy("symbol", F.window("et_time", "1 day", "1 day", offset).alias("w"))
        .agg(
            F.max(_only(at_snapshot, "open")).alias("snapshot_open"),
            exact("rth_last", "close").alias("official_close"),
            exact("evening", "open").alias("evening_open"),
            _first("open", pre).alias("pre_open"),
            F.max(_only(pre, "high")).alias("pre_high"),
            F.min(_only(pre, "low")).alias("pre_low"),
            _last("close", pre).alias("pre_close"),
        )
    )


#: Days of event time without a window after which a symbol's state is dropped. Longer
#: than any market holiday; a longer gap has no previous session to compare with.
EXPIRY_DAYS = 14


class PreviousClose(StatefulProcessor):
    """Pairs each snapshot day with the official close of the previous one.

    A window ending on day X holds the session of X-1. State per symbol is two
    values: the last snapshot day and that day's close once it was seen. Every window
    moves the symbol's one timer; when the watermark passes it, the symbol is dead and
    its state goes. Time is event time alone, so a replay gives the same rows.
    """

    def __init__(self, expiry_days: int = EXPIRY_DAYS):
        self.expiry_ms = expiry_days * 86_400_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "day DATE, close DOUBLE")

    def _expire_after(self, newest: pd.Timestamp) -> None:
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        self.handle.registerTimer(int(newest.timestamp() * 1000) + self.expiry_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        yield pd.DataFrame()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows)).sort_values("date")
        day, close = self.last.get() if self.last.exists() else (None, None)
        out = []
        for row in pdf.to_dict("records"):
            if day is not None and (row["date"] - day).days == 1 and not pd.isna(row["official_close"]):
                close = row["official_close"]
            if not pd.isna(row["snapshot_open"]):
                out.append({**row, "prev_close": close})
                day, close = row["date"], None
        if day is not None:
            self.last.update((day, close))
        self._expire_after(pdf["et_end"].max())
        yield pd.DataFrame(out, columns=[*pdf.columns, "prev_close"]).drop(columns="et_end")

    def close(self) -> None:
        pass


def snapshot_features(
    bars: DataFrame, clock: SessionClock = ONE_MINUTE, lateness: str = "0 seconds", expiry_days: int = EXPIRY_DAYS
) -> DataFrame:
    """Pre-market features of a day, emitted once the watermark has passed its snapshot,
    whichever symbol's bar moved it.

    Bars are reduced by a built-in aggregate; only its one row per symbol and day
    meets the custom state, whose timers run in event time. Needs the RocksDB state
    store provider.
    """
    anchors = ["snapshot_open", "official_close", "evening_open", "pre_open", "pre_high", "pre_low", "pre_close"]
    windows = snapshot_windows(bars, clock, lateness).select(
        "symbol", F.to_date("w.end").alias("date"), *anchors, F.window_time("w").alias("et_end")
    )
    schema = f"symbol STRING, date DATE, {', '.join(c + ' DOUBLE' for c in anchors)}, prev_close DOUBLE"
    paired = windows.groupBy("symbol").transformWithStateInPandas(
        PreviousClose(expiry_days), outputStructType=schema, outputMode="Append", timeMode="EventTime"
    )
    return paired.select(
        "symbol", "date",
        change("snapshot_open", "prev_close").alias("overnight_gap"),
        change("snapshot_open", "evening_open").alias("premarket_trend"),
        F.try_divide(F.col("pre_high") - F.col("pre_low"), "pre_open").alias("macro_vol_830"),
        F.try_divide(F.col("pre_close") - F.col("pre_open"), "pre_open").alias("macro_dir_830"),
    )


def run_to_table(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Process everything available, then read the result back."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
