"""Calendar features: weekday one-hots, distance to scheduled events, expiries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from openbell.functions.clock import is_weekday
from openbell.schemas import EVENT_DATES

# Scheduled central-bank announcement days (second day of each
# meeting, emergency meetings excluded). Extend when a new year is published.
FOMC_DAYS = (
    "2018-01-31 2018-03-21 2018-05-02 2018-06-13 2018-08-01 2018-09-26 2018-11-08 2018-12-19 "
    "2019-01-30 2019-03-20 2019-05-01 2019-06-19 2019-07-31 2019-09-18 2019-10-30 2019-12-11 "
    "2020-01-29 2020-03-18 2020-04-29 2020-06-10 2020-07-29 2020-09-16 2020-11-05 2020-12-16 "
    "2021-01-27 2021-03-17 2021-04-28 2021-06-16 2021-07-28 2021-09-22 2021-11-03 2021-12-15 "
    "2022-01-26 2022-03-16 2022-05-04 2022-06-15 2022-07-27 2022-09-21 2022-11-02 2022-12-14 "
    "2023-02-01 2023-03-22 2023-05-03 2023-06-14 2023-07-26 2023-09-20 2023-11-01 2023-12-13 "
    "2024-01-31 2024-03-20 2024-05-01 2024-06-12 2024-07-31 2024-09-18 2024-11-07 2024-12-18 "
    "2025-01-29 2025-03-19 2025-05-07 2025-06-18 2025-07-30 2025-09-17 2025-10-29 2025-12-10 "
    "2026-01-28 2026-03-18 2026-04-29 2026-06-17 2026-07-29 2026-09-16 2026-10-28 2026-12-09"
).split()
DOW_NAMES = ("mon", "tue", "wed", "thu", "fri")
DEFAULT_START, DEFAULT_END = dt.date(2018, 1, 1), dt.date(2027, 12, 31)


def event_table(spark: SparkSession, days=FOMC_DAYS, event: str = "fomc") -> DataFrame:
    """A list of days as the dimension table ``event, date``."""
    rows = [(event, dt.date.fromisoformat(d)) for d in days]
    return spark.createDataFrame(rows, EVENT_DATES)


def business_days(bounds: DataFrame) -> DataFrame:
    """Mon-Fri days of one (start, end) row."""
    return bounds.select(F.explode(F.sequence("start", "end")).alias("date")).filter(
        is_weekday("date")
    )


def third_friday(month) -> Column:
    month = F.col(month) if isinstance(month, str) else month
    first = F.trunc(month, "month")
    return F.date_add(F.next_day(F.date_sub(first, 1), "FR"), 14)


def expiry_days(bounds: DataFrame) -> DataFrame:
    """Third Fridays of every month of [start, end] plus the month after, so that
    the days behind the last expiry still have a next one."""
    months = F.sequence(
        F.trunc("start", "month"), F.add_months(F.trunc("end", "month"), 1), F.expr("INTERVAL 1 MONTH")
    )
    return bounds.select(F.explode(months).alias("month")).select(third_friday("month").alias("date"))


def next_event(
    days: DataFrame, events: DataFrame, out: str, by: tuple[str, ...] = (), date: str = "date"
) -> DataFrame:
    """Forward as-of: calendar days from each row to the next event on or after
    it (0 on the day), NULL behind the last one.

    Facts and events meet in no range join. Both shrink to distinct days per key
    first, one window over that calendar carries the next event backwards, and
    the result joins on equality. The window's group is bounded by calendar days;
    it runs from the last day to the first, so its frame only ever grows and a day
    costs one step (a frame that ends at the last row is read anew for every day).
    """
    keys = [*by, date]
    ask = days.select(*keys).distinct().withColumn("_event", F.lit(None).cast("date"))
    tell = events.select(*keys).distinct().withColumn("_event", F.col(date))
    nearest = ask.unionByName(tell).groupBy(*keys).agg(F.max("_event").alias("_event"))
    onwards = Window.partitionBy(*by).orderBy(F.desc(date)).rowsBetween(Window.unboundedPreceding, 0)
    distance = nearest.withColumn(
        out, F.datediff(F.last("_event", ignorenulls=True).over(onwards), F.col(date))
    )
    return days.join(distance.select(*keys, out), keys, "left")


def event_flag(days: DataFrame, events: DataFrame, out: str, date: str = "date") -> DataFrame:
    """1 on event days, else 0."""
    hit = events.select(date).distinct().withColumn("_hit", F.lit(1).cast("tinyint"))
    return days.join(hit, date, "left").withColumn(
        out, F.coalesce("_hit", F.lit(0).cast("tinyint"))
    ).drop("_hit")


def calendar_features(bounds: DataFrame, fomc: DataFrame) -> DataFrame:
    """One row per Mon-Fri day of ``bounds`` (one row: start, end), keyed by date.

    The table has one row per calendar day, whatever the size of the fact tables.
    """
    days = business_days(bounds)
    expiries = expiry_days(bounds)
    quarterly = expiries.filter(F.month("date").isin(3, 6, 9, 12))
    days = event_flag(next_event(days, fomc, "days_to_fomc"), fomc, "is_fomc_day")
    days = event_flag(next_event(days, expiries, "days_to_opex"), quarterly, "is_quarterly_opex")
    # the one-hots come last: every join on date would copy their constraints
    return days.select(
        "date",
        *[(F.weekday("date") == k).cast("tinyint").alias(f"dow_{n}") for k, n in enumerate(DOW_NAMES)],
        F.col("days_to_fomc").cast("double").alias("days_to_fomc"),
        "is_fomc_day",
        # the expiry list always reaches past the end: a gap is a bug, not data
        F.coalesce(
            "days_to_opex", F.raise_error(F.lit("no expiry on or after a calendar day")).cast("int")
        ).alias("days_to_opex"),
        "is_quarterly_opex",
    )


def default_bounds(spark: SparkSession, start=DEFAULT_START, end=DEFAULT_END) -> DataFrame:
    return spark.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end"))
