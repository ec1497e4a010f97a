"""Scores and moments as states that are stored once and merged later.

A state holds what a slice of the rows adds to a score: numbers of rows, sums, extremes and a quantile sketch. States of
disjoint rows are merged by an aggregation, so any slice of lead, month and station rolls up from the stored table, and
new or late rows are merged without reading the old ones again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions import scalar as S
from . import quality as Q

#: Size of a quantile sketch; its quantiles are within RANK_ERROR of the wanted rank, as a share, with 99 % confidence.
SKETCH, RANK_ERROR = 400, 0.007
SLICE = ["leadtime", "month", "sid"]


def score_states(df: DataFrame, param: str) -> DataFrame:
    """States of the forecast error by lead, month of the run (yyyymm) and station.

    Rows without an error count for nothing; a slice without any has a state of zero rows.
    """
    error = S.nan_to_null(F.col(P.parameter(param).error).cast("double"))
    return df.withColumns({"month": S.yyyymm("fcdate"), "_error": error}).groupBy(*SLICE).agg(
        F.count("_error").alias("n"),
        F.coalesce(F.sum("_error"), F.lit(0.0)).alias("total"),
        F.coalesce(F.sum(F.col("_error") * F.col("_error")), F.lit(0.0)).alias("squares"),
        F.coalesce(F.sum(F.abs("_error")), F.lit(0.0)).alias("absolute"),
        F.min("_error").alias("low"),
        F.max("_error").alias("high"),
        F.kll_sketch_agg_double("_error", F.lit(SKETCH)).alias("sketch"),
    )


def merge_scores(states: DataFrame, keys: list[str]) -> DataFrame:
    """One state for each value of the keys; the keys are any of the columns that tell states apart."""
    sums = [F.sum(c).alias(c) for c in ("n", "total", "squares", "absolute")]
    return states.groupBy(*keys).agg(*sums, F.min("low").alias("low"), F.max("high").alias("high"), F.kll_merge_agg_double("sketch").alias("sketch"))


def scores(states: DataFrame, quantiles: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Scores of merged states: n, bias, mae, rmse, min_value, max_value, and quantiles as ``q25`` and so on.

    Sums are exact but for rounding, quantiles within RANK_ERROR. Without rows the scores are missing.
    """

    def mean(name: str) -> Column:
        return F.try_divide(F.col(name), F.col("n"))

    found = {"bias": mean("total"), "mae": mean("absolute"), "rmse": F.sqrt(mean("squares")), "min_value": F.col("low"), "max_value": F.col("high")}
    found |= {f"q{round(q * 100)}": F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(q))) for q in quantiles}
    return states.withColumns(found).drop("total", "squares", "absolute", "low", "high", "sketch")


def write_states(states: DataFrame, path: str) -> str:
    """Write states by month; months that are there already are replaced, others stay as they are."""
    states.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)
    return path


def moments(df: DataFrame, value: str, group: list[str]) -> DataFrame:
    """Number, mean and sum of squared deviations of the known values of each group."""
    clean = df.withColumn(value, S.nan_to_null(value))
    spread = F.coalesce(F.var_pop(value) * F.count(value), F.lit(0.0))
    return clean.groupBy(*group).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), spread.alias("spread"))


def merge_moments(states: DataFrame, group: list[str]) -> DataFrame:
    """Moments of the union of disjoint rows (Chan, Golub and LeVeque 1979).

    Squares are summed as deviations from one of the means, so values far from zero keep their digits.
    """
    about = states.groupBy(*[F.col(c).alias(f"_{c}") for c in group]).agg(F.min("mean").alias("about"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in group])
    shifted = states.join(about, same).select(*group, "n", "spread", (F.col("mean") - F.col("about")).alias("off"), "about")
    total = shifted.groupBy(*group).agg(
        F.sum("n").alias("n"),
        F.sum(F.coalesce(F.col("off") * F.col("n"), F.lit(0.0))).alias("first"),
        F.sum(F.col("spread") + F.coalesce(F.col("off") * F.col("off") * F.col("n"), F.lit(0.0))).alias("second"),
        F.min("about").alias("about"),
    )
    off = F.try_divide(F.col("first"), F.col("n"))
    return total.select(*group, "n", (F.col("about") + off).alias("mean"), F.greatest(F.lit(0.0), F.col("second") - F.coalesce(off * F.col("first"), F.lit(0.0))).alias("spread"))


def zscore_of(df: DataFrame, states: DataFrame, value: str, group: list[str], time: str, model: str) -> DataFrame:
    """``quality.zscore`` with kept moments in place of those of the rows themselves.

    Rows of a group without moments have no z-score and are no outliers.
    """
    std = F.sqrt(F.try_divide(F.col("spread"), F.col("n")))
    known = states.select(*group, "mean", std.alias("std"))
    return Q.zscore_with(df.withColumn(value, S.nan_to_null(value)), known, value, group, time, model)
