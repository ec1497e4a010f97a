"""Stacking and quality control of observations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions import scalar as S
from .joins import join_month_limits


def union_producers(frames: list[DataFrame]) -> DataFrame:
    """Stack observations by column name; a column a producer lacks is missing there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_crowd(obs: DataFrame, crowd: DataFrame | None, param: str) -> DataFrame:
    """Append crowd observations if there are any and the parameter takes them."""
    if crowd is None or not P.parameter(param).crowd:
        return obs
    return obs.unionByName(crowd, allowMissingColumns=True)


def coalesce_wind(df: DataFrame, potential: str = "wsp", plain: str = "ws") -> DataFrame:
    """Potential wind where it is reported, plain wind elsewhere."""
    return df.withColumn(potential, F.coalesce(S.nan_to_null(potential), S.nan_to_null(plain)))


def at_time(df: DataFrame, time: str, when: str) -> DataFrame:
    return df.where(F.col(time) == F.lit(when).cast("timestamp_ntz"))


def in_crowd_window(df: DataFrame, end: Column, minutes: int = P.CROWD_MINUTES) -> DataFrame:
    """Crowd reports of the last minutes up to a time, inside the domain's box."""
    start = end - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    return df.where(
        F.col("ts").between(start, end)
        & F.col("longitude").between(*P.CROWD_BOX["lon"])
        & F.col("latitude").between(*P.CROWD_BOX["lat"])
    )


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row per key in the given order.

    An aggregation rather than a ranking: every task reduces its rows to one per key before the
    shuffle, however many rows a key has.
    """
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("first")
    return df.groupBy(*keys).agg(first).select(*keys, "first.*").select(*df.columns)


def zscore(df: DataFrame, value: str, group: list[str], time: str, model: str) -> DataFrame:
    """z-score within groups, limits of the month, and whether a row is an outlier.

    The mean and population deviation are aggregated per group and joined back, so that no task has
    to hold a group; the result of the aggregation is small and AQE broadcasts it if it really is.
    Without spread z is missing and nothing is an outlier; missing values are no outliers either.
    """
    clean = df.withColumn(value, S.nan_to_null(value))
    stats = clean.groupBy(*group).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))
    return zscore_with(clean, stats, value, group, time, model)


def zscore_with(df: DataFrame, stats: DataFrame, value: str, group: list[str], time: str, model: str) -> DataFrame:
    """z-scores by the ``mean`` and ``std`` of each group."""
    scored = df.join(stats, group, "left").withColumn("z", F.try_divide(F.col(value) - F.col("mean"), F.col("std")))
    outlier = F.coalesce((F.col("z") > F.col("upper")) | (F.col("z") < F.col("lower")), F.lit(False))
    return join_month_limits(scored, time, model).withColumn("is_outlier", outlier)


def without_outliers(df: DataFrame, flagged: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows whose value is not among the outliers of their group; missing values stay."""
    outliers = flagged.where("is_outlier").select(*keys, value).distinct()
    return df.join(outliers, [*keys, value], "left_anti")


def producer_availability(df: DataFrame, value: str) -> DataFrame:
    """Per producer: rows, and whether every value is missing."""
    return df.groupBy("producer").agg(
        F.count(F.lit(1)).alias("n"),
        (F.count(S.nan_to_null(value)) == 0).alias("all_missing"),
    )


def observations_usable(df: DataFrame, value: str, producers: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """One row (of each run, if ``by`` names it): does every producer deliver at least one value?"""
    delivered = [
        F.coalesce(F.count(F.when(F.col("producer") == p, S.nan_to_null(value))) > 0, F.lit(False)) for p in producers
    ]
    return df.groupBy(*by).agg(reduce(lambda a, b: a & b, delivered).alias("ok"))


def sentinel_report(fields: DataFrame, names=tuple(P.GRID_FIELDS)) -> DataFrame:
    """How often each field holds the missing sentinel, in one pass over the grid."""
    counts = fields.agg(*[F.count_if(F.col(n) == P.MISSING).alias(n) for n in names])
    return counts.unpivot([], list(names), "field", "n_missing")


def require_no_sentinel(fields: DataFrame, names=tuple(P.GRID_FIELDS)) -> DataFrame:
    """Pass the fields on; a row with the sentinel in a checked field fails the job."""
    bad = reduce(lambda a, b: a | b, [F.col(n) == P.MISSING for n in names])
    message = F.lit("missing data in input fields")
    return fields.where(F.when(F.coalesce(bad, F.lit(False)), F.raise_error(message).cast("boolean")).otherwise(True))
