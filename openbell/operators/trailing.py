"""Windows that count observed values instead of rows.

Asked days (to score, to classify) may have no value yet and may repeat between
observed days. With k observed values before a day, an observed day sits at
2k+2 and an asked-only day at 2k+1, so "the n observed values before it" is the
value range [-2n, -1] for both.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

KEY = ("symbol", "date")


def positioned(
    observed: DataFrame, asked: DataFrame, value: str, keys: Sequence[str] = KEY
) -> DataFrame:
    """Observed values and asked keys on one ordered axis (``_k``, ``_pos``, ``_asked``)."""
    *group, date = keys
    known = observed.filter(F.col(value).isNotNull()).select(*keys, value)
    wanted = asked.select(*keys).distinct().withColumn("_asked", F.lit(True))
    before = Window.partitionBy(*group).orderBy(date).rowsBetween(Window.unboundedPreceding, -1)
    series = known.join(wanted, list(keys), "full_outer")
    return series.withColumn("_k", F.count(value).over(before)).withColumn(
        "_pos", 2 * F.col("_k") + F.when(F.col(value).isNotNull(), 2).otherwise(1)
    )


def prior(n: int, keys: Sequence[str] = KEY) -> WindowSpec:
    """The n observed values strictly before a row of ``positioned``."""
    return Window.partitionBy(*keys[:-1]).orderBy("_pos").rangeBetween(-2 * n, -1)


def answers(series: DataFrame, columns: dict[str, Column], keys: Sequence[str] = KEY) -> DataFrame:
    """Evaluate window columns and keep the asked rows."""
    return series.withColumns(columns).filter("_asked").select(*keys, *columns)
