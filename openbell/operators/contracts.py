"""Checks a table must pass before it is merged, trained on or scored."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from openbell.operators.dedup import duplicate_keys


def require_columns(df: DataFrame, columns: Sequence[str], source: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"{source}: missing required columns {missing}")
    return df


def check_schema(df: DataFrame, keys: Sequence[str], source: str, date: str = "date") -> DataFrame:
    """Key columns present and the day a plain DATE; needs no job."""
    require_columns(df, keys, source)
    kind = df.schema[date].dataType
    if not isinstance(kind, DateType):
        raise ValueError(f"{source}: {date} must be a date without time or zone, got {kind}")
    return df


def check_unique(df: DataFrame, keys: Sequence[str], source: str) -> DataFrame:
    """One pre-aggregated shuffle; the message shows one offending key."""
    bad = duplicate_keys(df, keys).limit(1).collect()
    if bad:
        raise ValueError(f"{source}: duplicate key {bad[0].asDict()}")
    return df


def unique_inside(df: DataFrame, keys: Sequence[str], source: str) -> DataFrame:
    """``df``, whose plan raises at the first repeated key when it runs.

    No job of its own: the rows are counted per key in the job that reads them anyway,
    and a shuffled join or aggregation by the same keys reuses the exchange. Rows with a
    null key are compared like any other.
    """
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    key = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    found = F.raise_error(F.concat(F.lit(f"{source}: duplicate key "), key))
    return df.withColumn("_n", n).filter(F.when(F.col("_n") == 1, F.lit(True)).otherwise(found)).drop("_n")


class Observed:
    """Row and null counts of a frame, collected by the job that writes it."""

    def __init__(self, df: DataFrame, columns: Sequence[str] | None = None):
        self.spark, self.columns = df.sparkSession, list(columns or df.columns)
        self._seen = Observation()
        counts = [F.count_if(F.col(c).isNull()).alias(f"null_{k}") for k, c in enumerate(self.columns)]
        self.frame = df.observe(self._seen, F.count(F.lit(1)).alias("rows"), *counts)

    def nulls(self) -> DataFrame:
        """What ``null_audit`` says of the frame; waits for the job."""
        counts = self._seen.get
        found = [(c, counts[f"null_{k}"]) for k, c in enumerate(self.columns) if counts[f"null_{k}"]]
        return self.spark.createDataFrame(found, "column_name STRING, n_null BIGINT")

    def rows(self) -> int:
        return self._seen.get["rows"]


def violations(
    frames: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]], required: Mapping[str, Sequence[str]], date: str = "date"
) -> DataFrame:
    """Everything that the checks would raise for, as rows (source, rule, detail, n).

    Rules: ``missing column``, ``not a date``, ``column collision`` (from the schemas), and
    ``duplicate key`` and ``null key`` (one row per key with the number of its rows; one
    aggregation per source that has its key columns).
    """
    spark = next(iter(frames.values())).sparkSession
    known, counted, all_keys = [], [], {k for ks in keys.values() for k in ks}
    owners: dict[str, list[str]] = {}
    for source, df in frames.items():
        missing = [c for c in dict.fromkeys([*keys[source], *required.get(source, [])]) if c not in df.columns]
        known += [(source, "missing column", c, None) for c in missing]
        if date in df.columns and not isinstance(df.schema[date].dataType, DateType):
            known.append((source, "not a date", f"{date}: {df.schema[date].dataType.simpleString()}", None))
        for c in set(df.columns) - all_keys:
            owners.setdefault(c, []).append(source)
        if not set(keys[source]) & set(missing):
            key = F.to_json(F.struct(*keys[source]), {"ignoreNullFields": "false"})
            empty = F.greatest(*[F.col(k).isNull() for k in keys[source]], F.lit(False))
            each = df.groupBy(*keys[source]).agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) | empty)
            rule = F.when(empty, "null key").otherwise("duplicate key")
            counted.append(each.select(F.lit(source).alias("source"), rule.alias("rule"), key.alias("detail"), "n"))
    known += [(s, "column collision", c, None) for c, all_of in owners.items() if len(all_of) > 1 for s in all_of]
    out = spark.createDataFrame(known, "source STRING, rule STRING, detail STRING, n BIGINT")
    for part in counted:
        out = out.unionByName(part)
    return out


def check_collisions(frames: Mapping[str, DataFrame], keys: Sequence[str]) -> None:
    """Feature names must be unique across all sources; needs no job."""
    owners: dict[str, list[str]] = {}
    for source, df in frames.items():
        for c in set(df.columns) - set(keys):
            owners.setdefault(c, []).append(source)
    shared = {c: s for c, s in sorted(owners.items()) if len(s) > 1}
    if shared:
        raise ValueError(f"column name collisions across sources: {shared}")


def null_audit(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, n_null) for the columns that have any, in one pass."""
    columns = list(columns or df.columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "n_null").filter("n_null > 0")
