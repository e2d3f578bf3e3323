"""Exchange-local time: session clock, stamping, cutoffs, article time-boxing."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NEW_YORK = "America/New_York"


def seconds(hhmm: str) -> int:
    h, m = hhmm.split(":")
    return int(h) * 3600 + int(m) * 60


@dataclass(frozen=True)
class SessionClock:
    """Clock times of one exchange session, as local ``HH:MM``.

    Bars are left-labelled, so ``rth_last`` names the last bar *starting*
    inside the session; its close is the official close. Ranges are inclusive.
    """

    tz: str = NEW_YORK
    snapshot: str = "09:00"
    rth_open: str = "09:30"
    rth_last: str = "15:59"
    evening: str = "18:00"
    pre_start: str = "08:30"
    pre_last: str = "08:59"

    def at(self, name: str) -> int:
        return seconds(getattr(self, name))


ONE_MINUTE = SessionClock()
HALF_HOUR = SessionClock(rth_last="15:30", pre_last="08:30")


def _utc_session() -> bool:
    spark = SparkSession.getActiveSession()
    zone = spark.conf.get("spark.sql.session.timeZone") if spark else ""
    return zone in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")


def _shift(ts, from_tz: str, to_tz: str) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    if not _utc_session():
        return F.convert_timezone(F.lit(from_tz), F.lit(to_tz), ts.cast("timestamp_ntz"))
    # the same value in a UTC session, but a literal zone is resolved once per
    # task there, while convert_timezone looks it up for every row
    if from_tz == "UTC":
        return F.from_utc_timestamp(ts.cast("timestamp"), to_tz).cast("timestamp_ntz")
    return F.to_utc_timestamp(ts.cast("timestamp"), from_tz).cast("timestamp_ntz")


def wall_clock(ts, tz: str = NEW_YORK) -> Column:
    """UTC instant (zone-less) -> local wall time (zone-less)."""
    return _shift(ts, "UTC", tz)


def from_wall_clock(ts, tz: str) -> Column:
    return _shift(ts, tz, "UTC")


def second_of_day(local) -> Column:
    """In a UTC session one arithmetic expression: filters repeat it once per
    comparison, and each of hour(), minute() and second() repeats the conversion."""
    if not _utc_session():
        return (F.hour(local) * 3600 + F.minute(local) * 60 + F.second(local)).cast("int")
    return F.pmod(F.unix_seconds(local.cast("timestamp")), F.lit(86400)).cast("int")


def is_weekday(date) -> Column:
    return F.weekday(date) < 5


def stamp(bars: DataFrame, clock: SessionClock = ONE_MINUTE) -> DataFrame:
    """Add ``et_date`` and ``et_second``.

    Store bars stamped and partitioned by ``et_month``: a filter on a computed
    local time cannot reach the scan, a filter on these columns can.
    """
    if "et_second" in bars.columns:
        return bars
    local = wall_clock("ts", clock.tz)
    return bars.withColumns(
        {"et_date": F.to_date(local), "et_second": second_of_day(local)}
    )


def time_between(first: str, last: str) -> Column:
    return F.col("et_second").between(seconds(first), seconds(last))


def time_is(hhmm: str) -> Column:
    return F.col("et_second") == seconds(hhmm)


def lookback(df: DataFrame, as_of: dt.date, years: int = 5, date: str = "date") -> DataFrame:
    """Keep the last ``years`` calendar years before ``as_of`` (a parameter,
    never the wall clock, so reruns give the same table)."""
    return df.filter(F.col(date) >= F.add_months(F.lit(as_of), -12 * years))


def up_to(df: DataFrame, cutoff: dt.date | None, date: str = "date") -> DataFrame:
    return df if cutoff is None else df.filter(F.col(date) <= F.lit(cutoff))


def snapshot_bound(
    as_of: dt.date, now: dt.datetime | None = None, clock: SessionClock = ONE_MINUTE
) -> dt.datetime:
    """Upper fetch bound for ``as_of``: one minute past the snapshot, in UTC.

    Pinning it makes every rerun of a day see the same bars. Asking before the
    bound has passed is an error when ``now`` (UTC) is given.
    """
    zone = ZoneInfo(clock.tz)
    local = dt.datetime.combine(as_of, dt.time(), tzinfo=zone) + dt.timedelta(
        seconds=clock.at("snapshot") + 60
    )
    bound = local.astimezone(dt.timezone.utc).replace(tzinfo=None)
    if now is not None and now < bound:
        raise ValueError(f"the {clock.snapshot} bar of {as_of} is not final before {bound} UTC")
    return bound


def snapshot_bounds(day: str | Column, clock: SessionClock = ONE_MINUTE) -> Column:
    """``snapshot_bound`` of every day of a column (UTC, without zone)."""
    day = F.col(day) if isinstance(day, str) else day
    passed = F.make_dt_interval(secs=F.lit(clock.at("snapshot") + 60).cast("decimal(18,6)"))
    return F.convert_timezone(F.lit(clock.tz), F.lit("UTC"), day.cast("timestamp_ntz") + passed)


def article_date(published_at) -> Column:
    """Trading day an article belongs to, NULL for articles of the open session.

    Local hour < 9 counts for the same day, >= 16 for the next one; a weekend
    result moves to Monday. Date arithmetic keeps clock-change weekends right.
    """
    local = wall_clock(published_at)
    hour = F.hour(local)
    day = F.to_date(local)
    assigned = F.when(hour < 9, day).when(hour >= 16, F.date_add(day, 1))
    to_monday = F.when(F.weekday(assigned) >= 5, 7 - F.weekday(assigned)).otherwise(0)
    return F.date_add(assigned, to_monday)
