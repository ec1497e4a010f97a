"""Attaching observations, errors, lead biases and small tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import params as P
from ..functions import scalar as S
from ..session import sized


def join_obs(wide: DataFrame, obs: DataFrame) -> DataFrame:
    """Left join on station and valid time; several observations give several rows."""
    return wide.join(obs, ["sid", "validdate"], "left")


def with_errors(df: DataFrame) -> DataFrame:
    """Forecast minus observation for the four parameters, and the height difference."""
    errors = {p.error: F.col(p.fc) - F.col(p.obs) for p in P.PARAMETERS.values()}
    return df.withColumns({**errors, "elevd": F.col("model_elevation") - F.col("obs_elevation")})


def lead_biases(df: DataFrame, lead: int) -> DataFrame:
    """The errors of one lead under their bias names, keyed by station and run."""
    names = [F.col(p.error).alias(p.bias0 if lead == 0 else p.bias1) for p in P.PARAMETERS.values()]
    return df.where(F.col("leadtime") == lead).select("sid", "fcdate", *names)


def join_lead_bias(df: DataFrame, lead: int, source: DataFrame | None = None) -> DataFrame:
    """Attach the errors of lead 0 or 1 of the same station and run to all its leads."""
    return df.join(lead_biases(source if source is not None else df, lead), ["sid", "fcdate"], "left")


def lead_bias_window(df: DataFrame) -> DataFrame:
    """Both lead biases with one shuffle, for input with one row per station, run and lead.

    A window then holds one run of one station, so its size is bounded by the number of leads. Where
    rows may repeat, ``join_lead_bias`` is the operator to use: it multiplies rows as the join does.
    """
    run = Window.partitionBy("sid", "fcdate")

    def at(lead: int, error: str):
        return F.max(F.when(F.col("leadtime") == lead, F.col(error))).over(run)

    return df.withColumns(
        {p.bias0: at(0, p.error) for p in P.PARAMETERS.values()}
        | {p.bias1: at(1, p.error) for p in P.PARAMETERS.values()}
    )


def join_listed_obs(wide: DataFrame, days: DataFrame, reach_hours: int) -> DataFrame:
    """As ``join_obs`` with observations listed per station and day of the run, which are the only join keys.

    The lists hold what runs of that day reach within ``reach_hours``; a forecast beyond fails the job rather than
    going without its observations.
    """
    ahead = F.timestamp_diff("MICROSECOND", F.col("fcdate"), F.col("validdate"))
    beyond = (ahead < 0) | (ahead > reach_hours * 3_600_000_000)
    joined = wide.join(days, ["sid", "run_day"], "left")
    fields = [f.name for f in days.schema["seen"].dataType.elementType]
    named = [F.when(beyond, F.raise_error(F.lit("a forecast lies beyond the reach of the listed observations")))]
    same = F.filter("seen", lambda o: o["validdate"] == F.coalesce(*named, F.col("validdate")))
    values = F.transform(same, lambda o: F.struct(*[o[f].alias(f) for f in fields if f != "validdate"]))
    return joined.select(*wide.columns, F.inline_outer(values))


def lead_biases_of_run(df: DataFrame, keep: Column | None = None, by=("sid", "fcdate")) -> DataFrame:
    """Both lead biases with one shuffle, also where rows repeat: they multiply as with ``join_lead_bias``.

    The rows of lead 0 and of lead 1 become two lists beside the rows of their run and are opened out again. A list is as
    long as a station has observations of one hour. ``keep`` says which rows are wanted; all of them still give biases.
    ``by`` names station and run, and what the rows are already laid out by.
    """
    run = Window.partitionBy(*by)

    def rows_at(lead: int):
        names = [F.col(p.error).alias(p.bias0 if lead == 0 else p.bias1) for p in P.PARAMETERS.values()]
        return F.collect_list(F.when(F.col("leadtime") == lead, F.struct(*names))).over(run)

    listed = df.withColumns({"_lead0": rows_at(0), "_lead1": rows_at(1)})
    if keep is not None:
        listed = listed.where(keep)
    columns = [F.col(c) for c in df.columns]
    first = listed.select(*columns, "_lead1", F.inline_outer("_lead0"))
    names = [p.bias0 for p in P.PARAMETERS.values()]
    return first.select(*columns, *names, F.inline_outer("_lead1"))


# --- tables of fixed size -------------------------------------------------------------------------------


def zscore_limits(spark: SparkSession) -> DataFrame:
    """48 rows."""
    return spark.createDataFrame(P.ZSCORE_LIMITS, "model string, month int, lower double, upper double")


def temperature_limits(spark: SparkSession) -> DataFrame:
    """12 rows."""
    return spark.createDataFrame(P.TEMPERATURE_LIMITS, "month int, low double, high double")


def parameter_table(spark: SparkSession) -> DataFrame:
    """4 rows."""
    rows = [(p.name, p.model, p.obs_national, p.obs_foreign, p.bias1) for p in P.PARAMETERS.values()]
    return spark.createDataFrame(
        rows, "param string, model string, obs_national string, obs_foreign string, bias_column string"
    )


def join_month_limits(df: DataFrame, time: str, model: str) -> DataFrame:
    """Attach the z-score limits of the month; rows without a time have none."""
    limits = zscore_limits(df.sparkSession).where(F.col("model") == model).drop("model")
    return df.withColumn("month", F.month(time)).join(F.broadcast(limits), "month", "left")


def join_parameters(df: DataFrame) -> DataFrame:
    return df.join(F.broadcast(parameter_table(df.sparkSession)), "param", "left")


def join_correction(background: DataFrame, diff: DataFrame, value: str = "value") -> DataFrame:
    """Background minus increment per node and lead, and run if both have one; without an increment it stays as it is."""
    keys = ["cell", "leadtime", *(c for c in ("analysistime",) if c in background.columns and c in diff.columns)]
    joined = background.join(sized(diff.select(*keys, "diff")), keys, "left")
    return joined.withColumn("corrected", F.col(value) - F.coalesce("diff", F.lit(0.0)))


def product_table(df: DataFrame) -> DataFrame:
    """Attach product metadata and the step to rows of (param, analysistime, forecasttime).

    The metadata are a choice by the parameter, no join: with one parameter as a literal a join would have no key left.
    The gust product is the maximum of the hour that starts at its step.
    """
    step = S.step_hours("forecasttime", "analysistime")

    def of(place: int) -> Column:
        chosen = F.lit(None).cast("int")
        for product in P.PRODUCTS:
            chosen = F.when(F.col("param") == product[0], F.lit(product[place]).cast("int")).otherwise(chosen)
        return chosen

    found = {name: of(i) for i, name in enumerate(["category", "number", "level", "template", "statistic"], 1)}
    return df.withColumns({**found, "step": F.when(F.col("param") == "gust", step - 1).otherwise(step)})
