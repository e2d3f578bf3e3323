"""Null-safe arithmetic and guarded window means."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def change(a, b) -> Column:
    """``a / b - 1``; NULL when the base is zero or either side is missing."""
    return F.try_divide(a, b) - F.lit(1.0)


def as_double(c) -> Column:
    """Numeric coercion: unparsable text becomes NULL instead of an error."""
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast("double")


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN means "missing" in the inputs, but Spark's avg/max propagate NaN and
    count() counts it, so sources turn it into NULL once."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def full_mean(c, window: WindowSpec, n: int, start: int | None = None) -> Column:
    """Mean over n rows, NULL unless all n values are present.

    The frame ends at the current row, or starts ``start`` rows away from it
    (``start=-n`` gives the n rows before the current one).
    """
    first = -(n - 1) if start is None else start
    frame = window.rowsBetween(first, first + n - 1)
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.count(c).over(frame) == n, F.avg(c).over(frame))


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column for output; sums differ in the last bits
    with the order in which partitions arrive."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))]
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in floats})
