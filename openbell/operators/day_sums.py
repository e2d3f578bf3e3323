"""Per-day news aggregates as mergeable sums: batches add, recovered failures subtract.

Every measure of a scored row is turned into a whole number once, and only whole
numbers are added. So sums can be merged in any order and taken back exactly: a
stored row per (day, batch) replaces the history of scores, and a new batch reads
its own scores only. ``finished`` gives the columns of ``aggregate_daily``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Units of a measure (beyond the precision of its mean) and of the polarity whose squares are summed.
UNIT, SQUARED_UNIT = 2.0**50, 2.0**40
#: A vector element is stored as a high and a low part; both sums are whole doubles below 2**53 up to 2**32 rows a day.
HIGH, LOW = 2.0**20, 2.0**30
ALL = ["prob_pos", "prob_neg", "prob_neu"]
ACTIVE = ["relevance", "novelty", "subjectivity", "polarity", "impact"]
#: The stored table: one row per day and batch.
STATE = ", ".join([
    "Date DATE", "n_rows BIGINT", *[f"n_{c} BIGINT, s_{c} DECIMAL(38,0)" for c in [*ALL, *ACTIVE]],
    "q DECIMAL(38,0)", "qq DECIMAL(38,0)", "v ARRAY<DOUBLE>", "batch BIGINT",
])


def _whole(c: Column, unit: float) -> Column:
    return F.rint(c * F.lit(unit)).cast("bigint")


def _added(v: Column) -> Column:
    """Element-wise sum of vectors of whole numbers, one buffer per group. The mean and
    sum of ``Summarizer`` pass through a running mean and round; its L1 norm only adds, so
    positive and negative parts are added apart."""
    parts = F.concat(F.transform(v, lambda x: F.greatest(x, F.lit(0.0))), F.transform(v, lambda x: F.greatest(-x, F.lit(0.0))))
    both = vector_to_array(Summarizer.normL1(array_to_vector(parts)))
    half = (F.size(both) / 2).cast("int")
    return F.zip_with(F.slice(both, F.lit(1), half), F.slice(both, half + 1, half), lambda a, b: a - b)


def _split(sign: Column) -> Column:
    """High parts, then low parts, of the vector's elements."""
    high = F.transform("embedding", lambda x: F.floor(x.cast("double") * HIGH).cast("double"))
    low = F.transform("embedding", lambda x: F.rint((x.cast("double") * HIGH - F.floor(x.cast("double") * HIGH)) * LOW))
    return F.transform(F.concat(high, low), lambda x: x * sign)


def sums(scored: DataFrame, by: Sequence[str] = (), sign: str | None = None, embedding: bool = False) -> DataFrame:
    """One row of sums per day (and ``by``); rows whose ``sign`` is -1 are taken back."""
    s = F.col(sign) if sign else F.lit(1)
    active = ~F.col("is_neutral")
    polarity = F.when(active, F.col("prob_pos") - F.col("prob_neg"))
    value = {c: F.col(c) for c in ALL} | {c: F.when(active, F.col(c)) for c in ACTIVE[:3]}
    value |= {"polarity": polarity, "impact": polarity * F.col("relevance") * F.col("subjectivity")}
    square = _whole(polarity, SQUARED_UNIT)
    out = {"n_rows": F.sum(s.cast("bigint"))}
    for c, v in value.items():
        out[f"n_{c}"] = F.sum(F.when(v.isNotNull(), s).otherwise(0).cast("bigint"))
        out[f"s_{c}"] = F.sum((_whole(v, UNIT) * s).cast("decimal(20,0)"))
    out["q"] = F.sum((square * s).cast("decimal(20,0)"))
    out["qq"] = F.sum((square.cast("decimal(19,0)") * square.cast("decimal(19,0)") * s.cast("decimal(1,0)")).cast("decimal(38,0)"))
    if embedding:
        out["v"] = _added(_split(s))
    return _typed(scored.groupBy(*by, "Date").agg(*[c.alias(k) for k, c in out.items()]))


def _typed(state: DataFrame) -> DataFrame:
    wide = [c for c in state.columns if c in ("q", "qq") or c.startswith("s_")]
    return state.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("decimal(38,0)") for c in wide})


def merged(state: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sums of several batches as one row per day."""
    keys = [*by, "Date"]
    numbers = [c for c in state.columns if c in ("q", "qq") or c.startswith(("n_", "s_"))]
    out = [F.sum(c).alias(c) for c in numbers]
    if "v" in state.columns:
        out.append(_added(F.col("v")).alias("v"))
    return _typed(state.groupBy(*keys).agg(*out))


def _deviation() -> Column:
    """Sample deviation of the polarity: whole numbers to the last step, unless they outgrow 38 digits."""
    n = F.col("n_polarity").cast("decimal(20,0)")
    exact = F.try_subtract(F.try_multiply(n, F.col("qq")), F.try_multiply(F.col("q"), F.col("q"))).cast("double")
    d = F.col("n_polarity").cast("double")
    rough = (F.col("qq").cast("double") - F.col("q").cast("double") * F.col("q").cast("double") / d) * d
    spread = F.coalesce(exact, F.greatest(rough, F.lit(0.0)))
    return F.when(F.col("n_polarity") > 1, F.sqrt(spread / (d * (d - 1))) / SQUARED_UNIT)


def finished(state: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The published per-day columns from merged sums; days without rows are gone."""
    mean = lambda c: F.try_divide(F.col(f"s_{c}").cast("double"), F.col(f"n_{c}").cast("double")) / UNIT
    columns = {f"{c}_mean": mean(c) for c in [*ALL, *ACTIVE[:3]]}
    columns |= {
        "weighted_impact": mean("impact"),
        "sentiment_entropy": _deviation(),
        "article_count": F.when(F.col("n_polarity") > 0, F.col("n_polarity")).cast("double"),
    }
    if "v" in state.columns:
        half = (F.size("v") / 2).cast("int")
        parts = F.zip_with(F.slice("v", F.lit(1), half), F.slice("v", half + 1, half), lambda h, lo: (h + lo / LOW) / HIGH / F.col("n_rows"))
        columns["mean_embedding"] = parts
    rows = state.filter("n_rows > 0").withColumns({f"_{k}": c for k, c in columns.items()})
    return rows.select(*by, "Date", *[F.col(f"_{k}").alias(k) for k in columns])


def deltas(scores: DataFrame, after: int, through: int, embedding: bool = True) -> DataFrame:
    """(Date, batch, sums) of the batches in (after, through] of a score checkpoint.

    Only those batches' rows are read, and the failed rows (a partition of their own)
    that the batches recovered: those are taken back from the day they had counted for.
    """
    rows = scores.filter((F.col("updated_at") > after) & (F.col("updated_at") <= through))
    back = rows.filter("status = 'recovered'").select("text_hash", F.col("updated_at").alias("_batch"))
    failed = scores.filter((F.col("status") == "failed") & (F.col("updated_at") <= through))
    taken = failed.join(back, "text_hash").withColumn("updated_at", F.col("_batch")).drop("_batch")
    signed = rows.withColumn("_sign", F.lit(1)).unionByName(taken.withColumn("_sign", F.lit(-1)).select(*rows.columns, "_sign"))
    return sums(signed.withColumnRenamed("updated_at", "batch"), ["batch"], "_sign", embedding)
