"""The prediction ledger: idempotent writes, settlement, rolling error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from openbell.functions.numeric import as_double
from openbell.sources.store import TableStore

KEY = ["symbol", "date"]
NUMERIC = ["predicted_range", "actual_range", "abs_error"]


def coerced(predictions: DataFrame) -> DataFrame:
    """Numeric columns as doubles, whatever an older run stored."""
    return predictions.withColumns({c: as_double(c) for c in NUMERIC if c in predictions.columns})


def upsert(existing: DataFrame, new: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Rows of ``new`` replace those with the same key; a rerun of a day changes
    nothing but that day's row."""
    kept = existing.join(new.select(*keys), list(keys), "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def settle(predictions: DataFrame, realized: DataFrame) -> DataFrame:
    """Fill actual range and absolute error where the session is complete now.

    Settled rows keep their values; a pending row without a session stays pending.
    """
    actual = realized.filter("realized_range IS NOT NULL").select(
        *KEY, F.col("realized_range").alias("_actual")
    )
    joined = coerced(predictions).join(actual, KEY, "left")
    now = F.col("actual_range").isNull() & F.col("_actual").isNotNull()
    return joined.withColumns({
        "actual_range": F.coalesce("actual_range", "_actual"),
        "abs_error": F.when(now, F.abs(F.col("predicted_range") - F.col("_actual"))).otherwise(
            F.col("abs_error")
        ),
    }).drop("_actual")


class Ledger:
    """The stored ledger by month: a write replaces the months it touches, all others keep
    their files, and readers keep the version they opened."""

    def __init__(self, store: TableStore, name: str = "predictions"):
        legacy = store.read(name) if store.exists(name) and not store._by_snapshots(name) else None
        self.table = store.snapshots(name, "month", tuple(KEY))
        if legacy is not None:
            self.table.append(self._with_month(legacy), "legacy")

    @staticmethod
    def _with_month(rows: DataFrame) -> DataFrame:
        return rows.withColumn("month", F.date_format("date", "yyyy-MM"))

    def exists(self) -> bool:
        return self.table.snapshot()[0] > 0

    def read(self) -> DataFrame:
        return self.table.read().drop("month")

    def _months(self, rows: DataFrame) -> list[str]:
        return [r[0] for r in self._with_month(rows).select("month").distinct().collect()]

    def _part(self, months: list[str]) -> DataFrame:
        return self.table.read(where=lambda part: part.partition("=")[2] in months).drop("month")

    def upsert(self, new: DataFrame, load: str) -> None:
        """``upsert`` into the months of ``new``; only those are read."""
        if not self.exists():
            self.table.append(self._with_month(new), load)
            return
        months = self._months(new)
        self.table.replace_parts(self._with_month(upsert(self._part(months), new)), months, load)

    def settle(self, realized: DataFrame, load: str) -> None:
        """``settle`` the months that hold a pending row whose session is complete by now."""
        if not self.exists():
            return
        pending = coerced(self.read()).filter("actual_range IS NULL").select(*KEY)
        months = self._months(pending.join(realized.filter("realized_range IS NOT NULL").select(*KEY), KEY))
        if months:
            self.table.replace_parts(self._with_month(settle(self._part(months), realized)), months, load)


def settled(predictions: DataFrame) -> DataFrame:
    return coerced(predictions).filter("actual_range IS NOT NULL")


def rolling_error(predictions: DataFrame, n: int = 7) -> DataFrame:
    """Mean absolute error over the last n settled predictions, per settled row."""
    w = Window.partitionBy("symbol").orderBy("date").rowsBetween(-(n - 1), 0)
    return settled(predictions).select(*KEY, F.avg("abs_error").over(w).alias(f"mae_{n}d"))


def last_settled(predictions: DataFrame, n: int = 7) -> DataFrame:
    """Newest settled prediction per symbol with its rolling error."""
    w = Window.partitionBy("symbol").orderBy("date").rowsBetween(-(n - 1), 0)
    rows = settled(predictions).withColumn(f"mae_{n}d", F.avg("abs_error").over(w))
    fields = ["date", "predicted_range", "actual_range", "abs_error", f"mae_{n}d"]
    return rows.groupBy("symbol").agg(F.max_by(F.struct(*fields), "date").alias("r")).select(
        "symbol",
        F.col("r.date").alias("settled_date"),
        F.col("r.predicted_range").alias("settled_predicted"),
        F.col("r.actual_range").alias("settled_actual"),
        F.col("r.abs_error").alias("settled_error"),
        F.col(f"r.mae_{n}d").alias("rolling_mae"),
    )
