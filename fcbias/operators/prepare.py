"""Selecting, pivoting and preparing point forecasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions import scalar as S


def pivot_avg(narrow: DataFrame, value: str = "value", keys=()) -> DataFrame:
    """Narrow to wide: the mean per parameter and the number of narrow rows, in one aggregation.

    ``keys`` are further columns to group by, such as those that the archive is laid out by.
    """
    wanted = narrow.where(F.col("parameter").isin(list(P.NARROW_TO_WIDE)))
    means = [
        F.avg(F.when(F.col("parameter") == name, S.nan_to_null(value))).alias(wide)
        for name, wide in P.NARROW_TO_WIDE.items()
    ]
    return wanted.groupBy(*P.NARROW_KEYS, *keys).agg(*means, F.count(F.lit(1)).alias("rows_n"))


def thin_leads(df: DataFrame, first_hour: int = 0) -> DataFrame:
    """Keep every fourth run with its leads, and the runs two hours later with theirs."""
    phase = F.pmod(F.hour("fcdate") - first_hour, F.lit(P.RUN_STEP_HOURS))
    main = (phase == 0) & F.col("leadtime").isin(P.LEADS_MAIN)
    offset = (phase == P.RUN_OFFSET_HOURS) & F.col("leadtime").isin(P.LEADS_OFFSET)
    return df.where(main | offset)


def months_from(start: int, months: int) -> tuple[int, int]:
    """First and last yyyymm of a span of months."""
    last = (start // 100) * 12 + start % 100 - 1 + months - 1
    return start, last // 12 * 100 + last % 12 + 1


def select_months(df: DataFrame, start: int, months: int, column: str = "yyyymm") -> DataFrame:
    """Months by their number; on a partition column this prunes folders."""
    return df.where(F.col(column).between(*months_from(start, months)))


def without_leads(df: DataFrame, leads=(0, 1)) -> DataFrame:
    return df.where(~F.col("leadtime").isin(list(leads)))


def with_run_hours(df: DataFrame, hours=tuple(P.RUN_HOURS)) -> DataFrame:
    return df.where(F.hour("fcdate").isin(list(hours)))


def within_physical_range(df: DataFrame, param: str) -> DataFrame:
    """Drop observations at or above the limit; a missing one is left for ``complete_rows``."""
    p = P.parameter(param)
    if p.upper_limit is None:
        return df
    return df.where(F.col(p.obs).isNull() | (F.col(p.obs) < p.upper_limit))


def with_holdout(df: DataFrame, days=P.HOLDOUT_DAYS) -> DataFrame:
    """Mark rows of the test days by the day of the run; null days stay in training."""
    day = F.dayofmonth(S.origin_time("validdate", "leadtime"))
    return df.withColumn("is_test", F.coalesce(day.between(*days), F.lit(False)))


def split_by(df: DataFrame, mask: Column) -> tuple[DataFrame, DataFrame]:
    """Rows where the mask is true, and all others, also where it is null."""
    hit = F.coalesce(mask, F.lit(False))
    return df.where(hit), df.where(~hit)


def with_time_folds(df: DataFrame, ranges=tuple(P.FOLD_RANGES), time: str = "fcdate") -> DataFrame:
    """Number of the date range a run falls in; -1 in none."""
    fold = F.lit(-1)
    for number, (start, end) in reversed(list(enumerate(ranges))):
        inside = (F.col(time) >= F.lit(start).cast("timestamp_ntz")) & (F.col(time) < F.lit(end).cast("timestamp_ntz"))
        fold = F.when(inside, F.lit(number)).otherwise(fold)
    return df.withColumn("fold", fold)


def with_random_split(df: DataFrame, keys=("sid", "validdate", "leadtime"), share=P.VALIDATION_SHARE) -> DataFrame:
    """Mark the validation share by a digest of the row key."""
    return df.withColumn("is_validation", S.key_below(list(keys), share, P.SPLIT_SEED))


def complete_rows(df: DataFrame) -> DataFrame:
    return df.dropna("any")


def any_of(columns) -> Column:
    return F.coalesce(*columns).isNotNull()


def with_any(df: DataFrame, columns=tuple(P.OBS_COLUMNS)) -> DataFrame:
    """Keep rows with at least one of the observations."""
    return df.dropna("all", subset=list(columns))


def without_helpers(df: DataFrame) -> DataFrame:
    """Drop helper columns where they exist."""
    return df.drop("index", "rows_n", "t_weight", "rh_weight", "ws_weight")


def to_float32(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("float").alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def project_training(df: DataFrame, param: str, keep=()) -> DataFrame:
    """Columns of one parameter in fixed order, with calendar features.

    ``keep`` adds columns, such as the run time for tuning. The bias of an earlier model version is
    taken along where it is present.
    """
    p = P.parameter(param)
    old = P.OLD_BIAS.get(p.model)
    extra = [c for c in ([old] if old in df.columns else []) + list(keep)]
    return df.withColumns(S.time_features("validdate")).select(*P.training_columns(p.model), *extra)


def features(df: DataFrame, param: str, exclude=()) -> DataFrame:
    """The model's input columns in order."""
    return df.select(*[c for c in P.FEATURES[P.parameter(param).model] if c not in exclude])


def target_and_features(df: DataFrame, param: str) -> DataFrame:
    """Target and input columns; identifiers, observations and lead-0 bias stay out."""
    p = P.parameter(param)
    return df.select(F.col(p.error).alias("label"), *P.FEATURES[p.model])
