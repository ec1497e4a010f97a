"""Models of the forecast error with Spark ML."""

from __future__ import annotations

import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce
from itertools import product

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel
from pyspark.util import inheritable_thread_target

from .. import params as P
from . import aggregates as A


def train(df: DataFrame, param: str, settings: P.TreeSettings | None = None, min_child: int = 1, exclude=(), seed: int = 0) -> PipelineModel:
    """Fit boosted trees of the error. Rows are split over tasks and only node statistics are reduced.

    Column shares apply per node, and there is no L1 penalty: these two differ from the original trees.
    """
    p = P.parameter(param)
    s = settings or P.TREES[p.model]
    inputs = [c for c in P.FEATURES[p.model] if c not in exclude]
    assemble = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error")
    trees = GBTRegressor(
        labelCol=p.error,
        featuresCol="features",
        maxIter=s.trees,
        maxDepth=s.depth,
        stepSize=s.rate,
        subsamplingRate=s.row_share,
        featureSubsetStrategy=str(s.column_share),
        minInstancesPerNode=min_child,
        maxBins=s.bins,
        maxMemoryInMB=512,
        checkpointInterval=10,
        seed=seed,
    )
    fitted = Pipeline(stages=[assemble, trees]).fit(df.select(p.error, *inputs))
    # only complete rows are trained on; a row to predict may lack a feature
    fitted.stages[0].setHandleInvalid("keep")
    return fitted


def gathered(df: DataFrame, rows_per_task: int = 50_000) -> DataFrame:
    """Rows in no more tasks than their number asks for, after counting them.

    Every level of every tree is a job over all rows, so a small table in many tasks spends its time on starting them. A
    table of more rows keeps the tasks it has.
    """
    return df.coalesce(max(1, -(-df.count() // rows_per_task)))


def predict(df: DataFrame, model: PipelineModel, name: str = "prediction") -> DataFrame:
    """Add a model's prediction under a name."""
    return model.transform(df).withColumnRenamed("prediction", name).drop("features")


def compare(df: DataFrame, models: dict[str, PipelineModel]) -> DataFrame:
    """Predictions of several models side by side on the same rows."""
    return reduce(lambda acc, item: predict(acc, item[1], item[0]), models.items(), df)


def predict_bias(df: DataFrame, model: PipelineModel, param: str) -> DataFrame:
    """Bias per point and lead: observed at lead 1, predicted after it."""
    observed = F.col(P.parameter(param).bias1).cast("double")
    return predict(df, model).withColumn(
        "bias", F.when(F.col("leadtime") == 1, observed).otherwise(F.col("prediction"))
    ).drop("prediction")


def evaluate(df: DataFrame, param: str, models: dict[str, PipelineModel]) -> tuple[DataFrame, DataFrame]:
    """RMSE of the raw forecast and of each model: overall and by lead."""
    scored = compare(df, models)
    names = {n: n for n in models}
    return A.rmse_overall(scored, param, names), A.rmse_by_lead(scored, param, names)


def save(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


@dataclass(frozen=True)
class Trial:
    candidate: int
    settings: P.TreeSettings
    min_child: int


def draw_trials(n: int = P.SEARCH_TRIALS, space=None, trees: int = 100, seed: int = 10) -> list[Trial]:
    """Random settings from the search space; the same seed draws the same trials."""
    space = {**P.SEARCH_SPACE, **(space or {})}
    rng = random.Random(seed)
    trials = []
    for i in range(n):
        settings = P.TreeSettings(
            column_share=rng.uniform(*space["column_share"]),
            rate=rng.uniform(*space["rate"]),
            depth=rng.randint(*space["depth"]),
            trees=trees,
            l1=0.0,
            row_share=rng.uniform(*space["row_share"]),
        )
        trials.append(Trial(i, settings, rng.randint(*space["min_child"])))
    return trials


def search(df: DataFrame, param: str, trials: list[Trial], folds: list[int], at_once: int = 4) -> DataFrame:
    """Mean absolute error of every trial over the date folds, best first.

    ``df`` has a ``fold`` column; rows of fold -1 belong to no block and are always trained on. Every fit is a
    distributed job, ``at_once`` of them run beside each other; a fit leaves one row with its score and no model.
    """
    error = F.col(P.parameter(param).error)
    data = df.persist(StorageLevel.MEMORY_AND_DISK)

    def score(fit: tuple[Trial, int]) -> list[tuple]:
        trial, fold = fit
        model = train(data.where(F.col("fold") != fold), param, trial.settings, trial.min_child)
        test = predict(data.where(F.col("fold") == fold), model).withColumn("candidate", F.lit(trial.candidate))
        return [tuple(row) for row in A.mae_by_fold(test, error - F.col("prediction")).collect()]

    with ThreadPoolExecutor(at_once) as pool:
        scores = [row for rows in pool.map(inheritable_thread_target(df.sparkSession)(score), product(trials, folds)) for row in rows]
    data.unpersist()
    by_fold = df.sparkSession.createDataFrame(scores, "candidate int, fold int, mae double")
    settings = df.sparkSession.createDataFrame(
        [(t.candidate, t.settings.depth, t.settings.rate, t.settings.column_share, t.settings.row_share, t.min_child) for t in trials],
        "candidate int, depth int, rate double, column_share double, row_share double, min_child int",
    )
    return A.mae_summary(by_fold).join(F.broadcast(settings), "candidate").orderBy("mae_mean", "candidate")


def smaller(param: str, trees: int, depth: int) -> P.TreeSettings:
    """A parameter's settings with fewer and shallower trees."""
    return replace(P.TREES[P.parameter(param).model], trees=trees, depth=depth)
