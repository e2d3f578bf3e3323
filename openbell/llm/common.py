"""Small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else, the same in every engine."""
    return F.translate(c, UPPER, UPPER.lower())


def rows_to_frames(rows: Iterable[tuple], columns: list[str], size: int = 5000) -> Iterator[pd.DataFrame]:
    """Frames of at most ``size`` rows, so that no partition is held whole."""
    chunk: list[tuple] = []
    for row in rows:
        chunk.append(row)
        if len(chunk) >= size:
            yield pd.DataFrame(chunk, columns=columns)
            chunk = []
    if chunk:
        yield pd.DataFrame(chunk, columns=columns)
