"""Chronological splits, regression metrics, baselines and table profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TEST_SHARE = 0.20
VALIDATION_SHARE = 0.20


def chronological_split(
    df: DataFrame,
    date: str = "date",
    test: float = TEST_SHARE,
    validation: float = VALIDATION_SHARE,
    out: str = "split",
) -> DataFrame:
    """Label rows train / validation / test by position of their day.

    The last ``test`` of the days, then the last ``validation`` of the rest. All
    symbols of a day share a label. Only the distinct days are ordered (one row
    per calendar day); the labels return by an equality join.
    """
    days = df.select(date).distinct()
    calendar = Window.partitionBy(F.lit(0))
    numbered = days.select(
        date,
        F.row_number().over(calendar.orderBy(date)).alias("_pos"),
        F.count("*").over(calendar).alias("_n"),
    )
    fit_days = F.floor(F.col("_n") * F.lit(1 - test))
    train_days = F.floor(fit_days * F.lit(1 - validation))
    labels = numbered.select(
        date,
        F.when(F.col("_pos") <= train_days, "train")
        .when(F.col("_pos") <= fit_days, "validation")
        .otherwise("test")
        .alias(out),
    )
    return df.join(labels, date)


def regression_metrics(
    df: DataFrame, actual: str, predicted: str, by: Sequence[str], max_groups: int | None = None
) -> DataFrame:
    """rmse, mae, r2, population std of the prediction and the share of errors
    within one mae, per group.

    The share needs the mae first, so a second pass joins one row per group back.
    Those rows are broadcast only if the caller knows how many groups there can
    be (``max_groups``); otherwise the planner decides by measured size.
    """
    rows = df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull()).select(
        *by, F.col(actual).alias("_y"), F.col(predicted).alias("_p")
    )
    error = F.col("_y") - F.col("_p")
    first = rows.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(F.sum(error * error), F.var_pop("_y") * F.count("*"))).alias("r2"),
        F.stddev_pop("_p").alias("pred_std"),
    )
    widths = first.select(*by, "mae")
    if max_groups is not None and max_groups <= 10_000:
        widths = F.broadcast(widths)
    within = (
        rows.join(widths, list(by))
        .groupBy(*by)
        .agg(F.avg((F.abs(error) <= F.col("mae")).cast("double")).alias("coverage_at_mae"))
    )
    return first.join(within, list(by))


def compare_predictors(
    df: DataFrame, actual: str, predictors: dict[str, str], by: Sequence[str] = ()
) -> DataFrame:
    """Metrics per named predictor column; each predictor's missing rows are left
    out of its own line only."""
    named = df.select(*by, F.col(actual).alias("_actual"), *[
        F.col(c).cast("double").alias(name) for name, c in predictors.items()
    ])
    long = named.unpivot([*by, "_actual"], list(predictors), "predictor", "_predicted")
    groups = None if by else len(predictors)
    return regression_metrics(long, "_actual", "_predicted", [*by, "predictor"], groups)


def profile(df: DataFrame, columns: Sequence[str], date: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows, day range, distinct days, and mean/std/min/max/null count per column."""
    stats: list[Column] = [
        F.count("*").alias("n_rows"),
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
    ]
    for c in columns:
        stats += [
            F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_std"),
            F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"),
            F.count_if(F.col(c).isNull()).alias(f"{c}_nulls"),
        ]
    return df.groupBy(*by).agg(*stats)


def distinct_days(df: DataFrame, date: str = "Date") -> DataFrame:
    return df.agg(F.count_distinct(date).alias("n_days"))


def latest_rows(df: DataFrame, n: int, by: Sequence[str] = ("symbol",), date: str = "date") -> DataFrame:
    """Last n rows per group; Spark trims each map task to n rows before the shuffle."""
    w = Window.partitionBy(*by).orderBy(F.col(date).desc())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def previous_day(labelled: DataFrame, reference, by: Sequence[str] = ("symbol",)) -> DataFrame:
    """Newest labelled day per group, NULL when it is not before the reference
    day: an unfinished day is never reported as a past one."""
    newest = F.max("date")
    return labelled.groupBy(*by).agg(
        F.when(newest < F.lit(reference), newest).alias("previous_day")
    )
