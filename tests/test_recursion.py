import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from openbell.operators import indicators as ind
from openbell.operators.recursion import cell_rows, ewma_in_blocks, previous, recursive_means, with_recursive_in_blocks


def daily(spark, n=900, seed=3, symbols=("A", "B", None)):
    rng, data = random.Random(seed), []
    for s in symbols:
        price = 100.0
        for day in pd.date_range("1996-03-01", periods=n if s == "A" else n // 3):
            if rng.random() < 0.03:
                continue
            first, price = price, price * (1 + rng.uniform(-0.02, 0.02))
            flat = 200 < day.dayofyear < 230
            data.append((s, day.date(), first, max(first, price) * 1.003, min(first, price) * 0.997, 50.0 if flat else price, 10.0))
    return spark.createDataFrame(data, "symbol string, date date, open double, high double, low double, close double, volume double")


def table(df):
    return df.toPandas().sort_values(["symbol", "date"], na_position="last").reset_index(drop=True)


def close_to(got, want, columns):
    for c in columns:
        assert (got[c].isna() == want[c].isna()).all(), c
        assert ((got[c] - want[c]).abs().fillna(0) <= 1e-12 * want[c].abs().fillna(0).clip(lower=100)).all(), c


@pytest.mark.parametrize("block", [None, "month"])
def test_indicators_equal_the_grouped_ones(spark, block):
    df = daily(spark)
    unit = None if block is None else F.year("date") * 12 + F.month("date")
    got = with_recursive_in_blocks(df, block=unit)
    assert got.columns == ind.with_recursive(df).columns
    # a NULL symbol is a series like any other
    close_to(table(got), table(ind.with_recursive(df)), ind.RECURSIVE)


def test_means_with_gaps_late_starts_and_small_cells(spark):
    rng, data = random.Random(9), []
    for k in range(400):
        x = None if k < 30 or 150 < k < 200 or rng.random() < 0.2 else rng.uniform(-1, 1)
        data += [("A", k, x, "kept"), ("empty", k, None, "kept"), ("late", k, 5.0 if k == 399 else None, "kept")]
    data.append(("one", 0, float("nan"), "kept"))
    df = spark.createDataFrame(data, "symbol string, date int, v double, _n string")
    means = {"slow": ("v", 1 / 14, 14), "fast": ("v", 0.9, 1)}
    want = table(df)
    for name, (_, alpha, least) in means.items():
        want[name] = want.groupby("symbol")["v"].transform(
            lambda x, a=alpha, n=least: x.ewm(alpha=a, adjust=False, ignore_na=True, min_periods=n).mean()
        )
    for most in (1, 7, 64, 2048):
        got = recursive_means(df, means, block=F.floor(F.col("date") / 90), most=most)
        assert got.columns == ["symbol", "date", "v", "_n", "slow", "fast"]
        close_to(table(got), want, means)


def test_previous_row_over_blocks(spark):
    data = [("A", k, k) for k in range(0, 50, 3)] + [("B", 4, 7), ("B", 40, None), ("B", 41, 8)]
    df = spark.createDataFrame(data, "symbol string, date int, v int")
    got = table(previous(df, ["v"], block=F.floor(F.col("date") / 10)))
    want = table(df)
    shifted = want.groupby("symbol")["v"].shift()
    assert (got["_prev_v"].fillna(-1) == shifted.fillna(-1)).all()


def test_empty_table_and_wrong_alpha(spark):
    empty = daily(spark).limit(0)
    assert with_recursive_in_blocks(empty).count() == 0
    with pytest.raises(ValueError):
        recursive_means(empty, {"m": ("close", 1.0, 1)})


def test_cells_keep_weights_inside_doubles():
    for decay in (0.999, 13 / 14, 0.5, 0.01, 1e-9):
        assert decay ** -cell_rows([decay]) < 1e270


def test_a_long_series_is_split_over_tasks_and_stays_in_the_jvm(spark):
    n = 400_000  # one symbol
    df = spark.range(0, n, 1, 8).select(
        F.lit("A").alias("symbol"), F.col("id").alias("date"), F.abs(F.sin(F.col("id").cast("double"))).alias("v")
    )
    got = recursive_means(df, {"m": ("v", 1 / 14, 14)}, block=F.floor(F.col("date") / 4096))
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "InPandas" not in plan
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # it would merge partitions of so few bytes
    try:
        share = got.withColumn("p", F.spark_partition_id()).groupBy("p").count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert share < n / 2
    x = pd.Series([abs(v) for v in df.orderBy("date").toPandas()["v"]])
    want = x.ewm(alpha=1 / 14, adjust=False, min_periods=14).mean()
    close_to(table(got), pd.DataFrame({"m": want}), ["m"])


@pytest.mark.parametrize("span", [1.5, 5, 400])
def test_ewma_with_gaps_over_blocks(spark, span):
    rng, data = random.Random(4), []
    for k in range(1500):
        x = None if k < 20 or 100 < k < 130 or 300 < k < 900 or rng.random() < 0.2 else rng.uniform(-1, 1)
        data += [("A", k, x), ("whole", k, rng.uniform(0, 9)), (None, k, x), ("empty", k, None)]
    data.append(("one", 0, float("nan")))
    df = spark.createDataFrame(data, "symbol string, date int, v double")
    want = table(df)
    want["m"] = want.groupby("symbol", dropna=False)["v"].transform(lambda x: x.ewm(span=span, adjust=False).mean())
    for days in (7, 200, 10_000):
        got = ewma_in_blocks(df, "v", "m", span, block=F.floor(F.col("date") / days))
        assert got.columns == ["symbol", "date", "v", "m"]
        close_to(table(got), want, ["m"])


def test_ewma_of_an_empty_table_and_a_wrong_span(spark):
    empty = daily(spark).limit(0)
    assert ewma_in_blocks(empty, "close", "m").count() == 0
    with pytest.raises(ValueError):
        ewma_in_blocks(empty, "close", "m", span=1)
