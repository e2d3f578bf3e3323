import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from openbell.operators import calendar as cal

D = dt.date


def test_third_fridays(spark):
    df = spark.createDataFrame([(D(2024, 2, 20),), (D(2024, 3, 1),)], "m DATE")
    assert rows(df.select(cal.third_friday("m").alias("d")), "d") == [(D(2024, 2, 16),), (D(2024, 3, 15),)]


def test_default_calendar(spark):
    out = cal.calendar_features(cal.default_bounds(spark), cal.event_table(spark))
    table = {r["date"]: r for r in out.collect()}
    assert len(table) == 2610
    day = table[D(2024, 1, 31)]
    assert (day["days_to_fomc"], day["is_fomc_day"], day["dow_wed"], day["dow_thu"]) == (0.0, 1, 1, 0)
    assert table[D(2024, 3, 15)]["is_quarterly_opex"] == 1 and table[D(2024, 2, 16)]["is_quarterly_opex"] == 0
    assert table[D(2024, 2, 16)]["days_to_opex"] == 0 and table[D(2024, 2, 19)]["days_to_opex"] == 25
    # behind the last announcement the distance is unknown
    assert table[D(2026, 12, 9)]["days_to_fomc"] == 0 and table[D(2026, 12, 10)]["days_to_fomc"] is None
    # the last days still see the expiry of the month after
    assert table[D(2027, 12, 31)]["days_to_opex"] == 21


def test_next_event_per_key(spark):
    days = spark.createDataFrame(
        [("a", D(2024, 1, 1)), ("a", D(2024, 1, 3)), ("a", D(2024, 1, 4)), ("b", D(2024, 1, 1)), ("a", D(2024, 1, 1))],
        "symbol STRING, date DATE",
    )
    events = spark.createDataFrame([("a", D(2024, 1, 3)), ("a", D(2024, 1, 3))], "symbol STRING, date DATE")
    out = cal.next_event(days, events, "n", by=("symbol",))
    assert rows(out, "symbol", "date", "n") == [
        ("a", D(2024, 1, 1), 2), ("a", D(2024, 1, 1), 2), ("a", D(2024, 1, 3), 0), ("a", D(2024, 1, 4), None),
        ("b", D(2024, 1, 1), None),
    ]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_next_event_of_a_long_calendar(spark):
    """Every day costs one step: no frame reaches to the last row, and 200,000 days take seconds, not minutes."""
    days = spark.range(200_000).select(F.expr("date_add(DATE '1800-01-01', CAST(id AS INT))").alias("date"))
    events = days.filter("datediff(date, DATE '1800-01-01') % 50000 = 49999")
    out = cal.next_event(days, events, "n")
    assert "unboundedfollowing" not in out._jdf.queryExecution().toString().lower()
    found = out.agg(F.count("n"), F.min("n"), F.max("n"), F.sum("n")).first()
    assert tuple(found) == (200_000, 0, 49_999, 4 * sum(range(50_000)))
    gap = cal.next_event(days, events.union(spark.createDataFrame([(None,)], "date DATE")), "n").filter("n IS NULL")
    assert gap.count() == 0
