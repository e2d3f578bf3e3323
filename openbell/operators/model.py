"""Train, search, evaluate and apply the realized-range model with Spark ML.

Gradient-boosted trees replace the boosting library a single machine would use;
they have no L1/L2 penalty and no native missing values, so missing inputs are
imputed and flagged. Metrics therefore differ from other boosters.
"""

from __future__ import annotations

import datetime as dt
import random
from collections.abc import Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from openbell.operators.contracts import require_columns
from openbell.operators.metrics import chronological_split, compare_predictors
from openbell.schemas import MODEL_META

# Search space per mode as (low, high), integers inclusive.
SPACE = {
    "mae": {
        "maxDepth": (3, 6), "stepSize": (0.01, 0.10), "subsamplingRate": (0.6, 1.0),
        "featureShare": (0.6, 1.0), "minInstancesPerNode": (1, 5), "gamma": (0.0, 0.5),
    },
    "aggressive": {
        "maxDepth": (5, 7), "stepSize": (0.02, 0.10), "subsamplingRate": (0.7, 1.0),
        "featureShare": (0.7, 1.0), "minInstancesPerNode": (1, 3), "gamma": (0.0, 0.0),
    },
}
LOSS = {"mae": "absolute", "aggressive": "squared"}
SCORE = {"mae": "mae", "aggressive": "rmse"}
COLLAPSE_SHARE = 1e-3
TRIALS = 50
MAX_ROUNDS = 5000
#: Rounds without a better holdout error after which a search fit ends, and the first block of rounds.
PATIENCE, FIRST_ROUNDS = 50, 64
SEARCH_EVERY_DAYS = 7
SEED = 42
TARGET = "target"


@dataclass(frozen=True)
class Trial:
    params: dict
    score: float | None
    best_iter: int
    collapsed: bool


def draw_params(mode: str, n: int, seed: int = SEED, space: dict | None = None) -> list[dict]:
    """n seeded draws from ``space`` (the mode's own if none is given); the step size is drawn on a log scale."""
    rng = random.Random(seed)
    draws = []
    for _ in range(n):
        p = {}
        for name, (low, high) in (space or SPACE[mode]).items():
            if isinstance(low, int):
                p[name] = rng.randint(low, high)
            elif name == "stepSize":
                p[name] = low * (high / low) ** rng.random()
            else:
                p[name] = rng.uniform(low, high)
        draws.append(p)
    return draws


def target_scale(data: DataFrame) -> tuple[int, float, float]:
    """(rows, mean, deviation) of the target: one row of statistics."""
    row = data.agg(
        F.count(TARGET).alias("n"), F.avg(TARGET).alias("mean"), F.stddev_samp(TARGET).alias("dev")
    ).first()
    return row["n"], row["mean"] or 0.0, row["dev"] or 1.0


def scaled(data: DataFrame, mean: float, dev: float) -> DataFrame:
    """Trees of an absolute loss step by multiples of the learning rate, so the
    target (about 0.01) must be brought to unit scale first."""
    return data.withColumn("_y", (F.col(TARGET) - mean) / dev)


def unscale(mean: float, dev: float) -> SQLTransformer:
    return SQLTransformer(
        statement=f"SELECT *, _prediction * {dev!r}D + ({mean!r}D) AS predicted_range FROM __THIS__"
    )


def regressor(mode: str, params: dict, rounds: int, n_rows: int) -> GBTRegressor:
    """``gamma`` bounds the summed gain of a split; Spark's threshold is per row."""
    share = params["featureShare"]
    return GBTRegressor(
        featuresCol="features", labelCol="_y", predictionCol="_prediction", seed=SEED,
        lossType=LOSS[mode], maxIter=rounds, maxDepth=params["maxDepth"],
        stepSize=params["stepSize"], subsamplingRate=params["subsamplingRate"],
        minInstancesPerNode=params["minInstancesPerNode"],
        minInfoGain=params["gamma"] / max(n_rows, 1),
        featureSubsetStrategy=str(share) if share < 1 else "all",
    )


def preparation(feature_names: Sequence[str], nullable: Sequence[str]) -> list:
    """Stages from raw columns to the feature vector. Names are fixed at fit time:
    extra columns are ignored, and the order is that of ``feature_names``."""
    casts = ", ".join(f"CAST({c} AS DOUBLE) AS _x_{c}" for c in feature_names)
    flags = "".join(f", CAST({c} IS NULL AS DOUBLE) AS _na_{c}" for c in nullable)
    inputs = [f"_x_{c}" for c in feature_names]
    return [
        SQLTransformer(statement=f"SELECT *, {casts}{flags} FROM __THIS__"),
        Imputer(inputCols=inputs, outputCols=[f"_i_{c}" for c in feature_names], strategy="median"),
        VectorAssembler(
            inputCols=[f"_i_{c}" for c in feature_names] + [f"_na_{c}" for c in nullable],
            outputCol="features",
        ),
    ]


def fit(
    mode: str, data: DataFrame, feature_names: Sequence[str], nullable: Sequence[str], params: dict, rounds: int
) -> PipelineModel:
    n, mean, dev = target_scale(data)
    stages = [
        *preparation(feature_names, nullable), regressor(mode, params, rounds, n), unscale(mean, dev)
    ]
    return Pipeline(stages=stages).fit(scaled(data, mean, dev))


def holdout_columns(mode: str, predicted: str = "predicted_range", target: str = TARGET) -> list[Column]:
    """Aggregates over a holdout: ``score`` and ``collapsed`` (the prediction hardly varies against the target)."""
    error = F.col(target) - F.col(predicted)
    score = F.avg(F.abs(error)) if SCORE[mode] == "mae" else F.sqrt(F.avg(error * error))
    spread = [F.coalesce(x, F.lit(0.0)) for x in (F.stddev_pop(predicted), F.stddev_samp(target))]
    return [score.alias("score"), (spread[0] < COLLAPSE_SHARE * spread[1]).alias("collapsed")]


def search(
    mode: str,
    train: DataFrame,
    validation: DataFrame,
    feature_names: Sequence[str],
    nullable: Sequence[str],
    trials: int = TRIALS,
    max_rounds: int = MAX_ROUNDS,
    parallelism: int = 1,
    seed: int = SEED,
    patience: int = PATIENCE,
    first_rounds: int = FIRST_ROUNDS,
    space: dict | None = None,
) -> list[Trial]:
    """Score seeded draws on one fixed chronological holdout.

    A fit grows in doubling blocks of rounds (boosting with one seed repeats its
    first rounds) until its lowest holdout error is ``patience`` rounds old; the
    trial is scored at that round. A model whose predictions hardly vary is
    collapsed and cannot win. Fits are independent Spark jobs, so ``parallelism``
    overlaps their small stages.
    """
    prepare = Pipeline(stages=preparation(feature_names, nullable)).fit(train)
    n, mean, dev = target_scale(train)
    both = train.withColumn("_holdout", F.lit(False)).unionByName(
        validation.withColumn("_holdout", F.lit(True))
    )
    ready = prepare.transform(scaled(both, mean, dev)).select(
        "features", TARGET, "_y", "_holdout"
    ).persist()
    held = ready.filter("_holdout")
    restored = unscale(mean, dev)
    learn = ready.filter("NOT _holdout")

    def run(params: dict) -> Trial:
        rounds = min(first_rounds, max_rounds)
        while True:
            curve = regressor(mode, params, rounds, n).fit(learn).evaluateEachIteration(held, LOSS[mode])
            best = best_round(curve, patience)
            if rounds - best >= patience or rounds == max_rounds:
                break
            rounds = min(2 * rounds, max_rounds)
        model = regressor(mode, params, best, n).fit(learn)
        row = restored.transform(model.transform(held)).agg(*holdout_columns(mode)).first()
        return Trial(params, None if row["collapsed"] else row["score"], model.getNumTrees, row["collapsed"])

    draws = draw_params(mode, trials, seed, space)
    try:
        if parallelism <= 1:
            return [run(p) for p in draws]
        with ThreadPool(parallelism) as pool:
            return pool.map(inheritable_thread_target(train.sparkSession)(run), draws)
    finally:
        ready.unpersist()


def best_round(curve: Sequence[float], patience: int = PATIENCE) -> int:
    """The round (from 1) of the lowest error before ``patience`` rounds pass without a lower one."""
    best = 0
    for k, error in enumerate(curve):
        if error < curve[best]:
            best = k
        elif k - best >= patience:
            break
    return best + 1


def best_trial(trials: Sequence[Trial]) -> Trial:
    alive = [t for t in trials if not t.collapsed]
    if not alive:
        raise RuntimeError("all trials collapsed to a constant prediction on the validation slice")
    return min(alive, key=lambda t: t.score)


def final_rounds(best_iter: int) -> int:
    return max(int(best_iter * 1.1), 10)


def predict(model: PipelineModel, features: DataFrame, feature_names: Sequence[str]) -> DataFrame:
    """Add ``predicted_range``; every missing input column is named at once."""
    require_columns(features, feature_names, "features")
    scored = model.transform(features)
    return scored.select(*features.columns, "predicted_range")


def evaluate(model: PipelineModel, data: DataFrame, feature_names: Sequence[str]) -> DataFrame:
    """Model, yesterday's range and 5-session mean on the same rows, one line each."""
    scored = predict(model, data, feature_names)
    named = {"model": "predicted_range", "persist": "prev_day_range", "rv_lag_5": "rv_lag_5"}
    present = {k: c for k, c in named.items() if c in scored.columns}
    return compare_predictors(scored, TARGET, present)


def importance(
    model: PipelineModel, feature_names: Sequence[str], nullable: Sequence[str]
) -> DataFrame:
    """(feature, importance), highest first, summing to 1; one row per feature."""
    spark = SparkSession.getActiveSession()
    names = [*feature_names, *[f"{c}_missing" for c in nullable]]
    values = model.stages[-2].featureImportances.toArray()
    total = float(values.sum()) or 1.0
    rows = [(n, float(v) / total) for n, v in zip(names, values)]
    return spark.createDataFrame(rows, "feature STRING, importance DOUBLE").orderBy(
        F.col("importance").desc(), "feature"
    )


def is_stale(last_search: dt.datetime | None, as_of: dt.datetime, days: int = SEARCH_EVERY_DAYS) -> bool:
    """Search again when none is recorded or it is ``days`` old."""
    return last_search is None or (as_of - last_search) >= dt.timedelta(days=days)


def search_due(last_search: Column, as_of: Column, days: int = SEARCH_EVERY_DAYS) -> Column:
    """``is_stale`` for columns of timestamps."""
    return last_search.isNull() | (as_of - last_search >= F.make_dt_interval(F.lit(days)))


def _metric_map(metrics: DataFrame) -> dict:
    """A handful of rows, one per predictor."""
    return {
        r["predictor"]: {k: r[k] for k in ("rmse", "mae", "r2", "pred_std", "coverage_at_mae")}
        for r in metrics.collect()
    }


def train_or_refit(
    data: DataFrame,
    feature_names: Sequence[str],
    as_of: dt.datetime,
    model_path: str,
    mode: str = "mae",
    meta: DataFrame | None = None,
    force_search: bool = False,
    nullable: Sequence[str] = ("vix_level",),
    trials: int = TRIALS,
    max_rounds: int = MAX_ROUNDS,
    parallelism: int = 1,
    space: dict | None = None,
) -> tuple[PipelineModel, DataFrame]:
    """Search when asked, stale or first; refit on all rows either way.

    The test metrics come from a model that never saw the test days, measured
    before the production refit. Without a search, parameters and metrics carry
    over from ``meta``. Returns the production model and its one-row metadata.
    """
    nullable = [c for c in nullable if c in feature_names]
    data = data.persist()
    last = meta.filter(F.col("mode") == mode).first() if meta is not None else None
    try:
        if force_search or last is None or is_stale(last["last_search"], as_of):
            split = chronological_split(data)
            train, validation = split.filter("split = 'train'"), split.filter("split = 'validation'")
            winner = best_trial(search(
                mode, train, validation, feature_names, nullable, trials, max_rounds, parallelism, space=space
            ))
            params, best_iter, searched = winner.params, winner.best_iter, as_of
            rounds = final_rounds(best_iter)
            on_train = fit(mode, train, feature_names, nullable, params, rounds)
            validated = _metric_map(evaluate(on_train, validation, feature_names))
            held_out = fit(mode, split.filter("split <> 'test'"), feature_names, nullable, params, rounds)
            tested = _metric_map(evaluate(held_out, split.filter("split = 'test'"), feature_names))
        else:
            params = {
                k: int(v) if isinstance(SPACE[mode][k][0], int) else v for k, v in last["best_params"].items()
            }
            best_iter, searched = last["best_iter"], last["last_search"]
            validated = {k: m.asDict() for k, m in (last["val_metrics"] or {}).items()}
            tested = {k: m.asDict() for k, m in (last["test_metrics"] or {}).items()}
        model = fit(mode, data, feature_names, nullable, params, final_rounds(best_iter))
        model.write().overwrite().save(model_path)
        ranked = {r["feature"]: r["importance"] for r in importance(model, feature_names, nullable).collect()}
        extent = data.agg(
            F.count("*").alias("n"), F.min("date").alias("first"), F.max("date").alias("last")
        ).first()
        row = {
            "mode": mode, "target": "same_day_realized_range", "feature_names": list(feature_names),
            "best_params": {k: float(v) for k, v in params.items()}, "best_iter": best_iter,
            "val_metrics": validated, "test_metrics": tested, "importance": ranked,
            "trained_at": as_of, "last_search": searched, "train_rows": extent["n"],
            "train_start": extent["first"], "train_end": extent["last"], "model_path": model_path,
        }
        return model, data.sparkSession.createDataFrame([row], MODEL_META)
    finally:
        data.unpersist()
