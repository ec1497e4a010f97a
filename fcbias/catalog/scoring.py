"""Summaries, scores and densities."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import prepare as R
from ..operators import states as ST
from ..plans import training as T
from ..session import new_folder
from ..sources.standins import FOLDS
from .registry import query
from .tables import _fold_case, errors, training


@query("min_max_report", "select leadtime, min(tero) as min_value, max(tero) as max_value, count(tero) as n from fc_err group by leadtime", "min_value max_value")
def min_max_report(t):
    return A.min_max(errors(t), "tero", ["leadtime"])


@query("any_nan_check", "select leadtime, bool_or(tero is null) as has_missing, bool_or(t2m is null) as has_missing_forecast from fc_err group by leadtime")
def any_nan_check(t):
    table = errors(t)
    return table.groupBy("leadtime").agg(
        F.bool_or(F.col("tero").isNull() | F.isnan("tero")).alias("has_missing"),
        F.bool_or(F.col("t2m").isNull() | F.isnan("t2m")).alias("has_missing_forecast"),
    )


@query("count_rows_stations", "select count(*) as n_rows, count(distinct sid) as n_stations, min(fcdate) as first_time, max(fcdate) as last_time from training")
def count_rows_stations(t):
    return A.extent(training(t))


@query("score_rollup", """
select leadtime, count(tero) as n, avg(tero) as bias, avg(abs(tero)) as mae, sqrt(avg(tero * tero)) as rmse, min(tero) as min_value, max(tero) as max_value
from training group by leadtime
""", "bias mae rmse min_value max_value")
def score_rollup(t):
    """Scores by lead from stored states, of which every second month came later than the others."""
    states, path = ST.score_states(training(t), "T2m"), new_folder(t.spark, "states")
    for rest in (0, 1):
        ST.write_states(states.where(F.col("month") % 2 == rest), path)
    table = t.spark.read.schema(states.schema).parquet(path)
    return ST.scores(ST.merge_scores(table, ["leadtime"]), ())


@query("rmse_overall", "select sqrt(avg(power(t2m - ta_pt1m_avg, 2))) as rmse_raw, count(*) as n from rows_t2m", "rmse_raw")
def rmse_overall(t):
    return A.rmse_overall(T.model_rows(training(t), "T2m"), "T2m")


@query("rmse_by_lead", "select leadtime, sqrt(avg(power(cast(wsero as double), 2))) as rmse_raw, count(*) as n from rows_ws group by leadtime", "rmse_raw")
def rmse_by_lead(t):
    return A.rmse_by_lead(T.model_rows(training(t), "WS").withColumn("wsero", F.col("wsero").cast("double")), "WS")


@query(
    "mae_by_fold",
    f"""
select candidate, avg(mae) as mae_mean, stddev_pop(mae) as mae_std, count(*) as folds from (
 select candidate, fold, avg(abs(cast(tero as double))) as mae from (select 0 as candidate, tero, case {_fold_case} else -1 end as fold from rows_t2m) x
 where fold >= 0 group by candidate, fold) y group by candidate
""",
    "mae_mean mae_std",
)
def mae_by_fold(t):
    """Scores of the raw forecast over the date folds."""
    rows = R.with_time_folds(T.model_rows(training(t), "T2m", keep=["fcdate"]), FOLDS).withColumn("candidate", F.lit(0))
    return A.mae_summary(A.mae_by_fold(rows, F.col("tero").cast("double")))


_BINS = """
(select *, least(59, cast(floor((x - x0) / (x1 - x0) * 60 + 1e-9) as int)) as bx, least(59, cast(floor((y - y0) / (y1 - y0) * 60 + 1e-9) as int)) as by_ from (
 select sid, fcdate, leadtime, x, y, min(x) over () as x0, max(x) over () as x1, min(y) over () as y0, max(y) over () as y1, count(*) over () as total
 from (select sid, fcdate, leadtime, ta_pt1m_avg as x, t2m as y from training where ta_pt1m_avg is not null) p) b)
"""
HIST_SQL = f"""
select bx, by_ as "by", count(*) as n, count(*) / any_value(total * ((x1 - x0) / 60) * ((y1 - y0) / 60)) as density from {_BINS} c group by bx, by_
"""
DENSITY_SQL = f"""
select sid, fcdate, leadtime, x, y, count(*) over (partition by bx, by_) / (total * ((x1 - x0) / 60) * ((y1 - y0) / 60)) as density from {_BINS} c
"""


def observed_and_forecast(t):
    table = training(t).where("ta_pt1m_avg is not null")
    return table.select("sid", "fcdate", "leadtime", F.col("ta_pt1m_avg").alias("x"), F.col("t2m").alias("y"))


@query("hist2d_density", HIST_SQL, "density")
def hist2d_density(t):
    return A.hist2d_density(observed_and_forecast(t), "x", "y")


@query("density_at_points", DENSITY_SQL, "x y density")
def density_at_points(t):
    return A.density_at_points(observed_and_forecast(t), "x", "y").drop("bx", "by")


@query("density_by_spline")
def density_by_spline(t):
    """Density by a spline through the bin centres; checked in the tests against B-splines."""
    return A.density_by_spline(observed_and_forecast(t), "x", "y")


@query("sort_by_density", f"select row_number() over (order by floor(density*1e9 + 0.5), sid, fcdate, leadtime) as place, sid, fcdate, leadtime, density from ({DENSITY_SQL}) d", "density")
def sort_by_density(t):
    """Densest points last, with the place of each."""
    points = A.density_at_points(observed_and_forecast(t), "x", "y").withColumn("key", F.floor(F.col("density") * 1e9 + 0.5))
    return A.with_place(points, ["key", "sid", "fcdate", "leadtime"]).select("place", "sid", "fcdate", "leadtime", "density")
