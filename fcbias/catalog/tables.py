"""Projections, filters, joins, scalars and whole training tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import params as P
from ..functions import geo as G
from ..functions import projection as PR
from ..functions import scalar as S
from ..operators import aggregates as A
from ..operators import joins as J
from ..operators import prepare as R
from ..operators import quality as Q
from ..plans import training as T
from ..sources import buckets, tables
from ..sources.standins import ANALYSIS, FOLDS
from .archive import training_archive, written
from .registry import query
from .views import barnes_sql, haversine_sql, time_sql, training_doubles, training_sql

WIDE = " ".join(P.NARROW_TO_WIDE.values())
ERRORS = "tero rhero wsero wgero elevd"
OBS = "obs_lat obs_lon obs_elevation rh_pt1m_avg ta_pt1m_avg ws_pt10m_avg wg_pt1h_max"
SITE = "lat lon model_elevation"
BIAS0, BIAS1 = "t0bias rh0bias ws0bias wg0bias", "t1bias rh1bias ws1bias wg1bias"


def training(t):
    """The stored training table, which its users read as often as they like."""
    return t.spark.read.parquet(training_archive(t)).drop("period")


def errors(t):
    return R.without_helpers(T.forecast_errors(t.fc_narrow(), t.obs()))


# --- pivot, joins, errors ---------------------------------------------------------------------------------------


@query("pivot_avg", "select * from fc_wide", f"{SITE} {WIDE}")
def pivot_avg(t):
    return R.pivot_avg(t.fc_narrow())


@query(
    "join_obs",
    """
select w.sid, w.validdate, w.fcdate, w.leadtime, w.t2m, o.producer, o.ta, o.rh, o.wsp, o.ws, o.wg
from fc_wide w left join obs_raw o on w.sid = o.sid and w.validdate = o.validdate
""",
    "t2m ta rh wsp ws wg",
)
def join_obs(t):
    """Against observations that repeat per station and hour, so rows multiply."""
    wide = R.pivot_avg(t.fc_narrow()).select("sid", "validdate", "fcdate", "leadtime", "t2m")
    return J.join_obs(wide, t.obs_raw().drop("obs_lat", "obs_lon", "obs_elevation"))


@query("forecast_error", "select * from fc_err", f"{SITE} {WIDE} {OBS} {ERRORS}")
def forecast_error(t):
    return errors(t)


def _lead_bias_sql(lead: int) -> str:
    names = ", ".join(f"a.{p.error} as {p.bias0 if lead == 0 else p.bias1}" for p in P.PARAMETERS.values())
    return f"""
select e.sid, e.fcdate, e.leadtime, e.validdate, {names} from fc_err e
left join (select * from fc_err where leadtime = {lead}) a on e.sid = a.sid and e.fcdate = a.fcdate
"""


@query("join_lead0_bias", _lead_bias_sql(0), BIAS0)
def join_lead0_bias(t):
    return J.join_lead_bias(errors(t), 0).select("sid", "fcdate", "leadtime", "validdate", *BIAS0.split())


@query("join_lead1_bias", _lead_bias_sql(1), BIAS1)
def join_lead1_bias(t):
    return J.join_lead_bias(errors(t), 1).select("sid", "fcdate", "leadtime", "validdate", *BIAS1.split())


@query("lead_bias_window", "select sid, fcdate, leadtime, t0bias, rh0bias, ws0bias, wg0bias, t1bias, rh1bias, ws1bias, wg1bias from training", f"{BIAS0} {BIAS1}")
def lead_bias_window(t):
    """Both lead biases with one shuffle; the check uses the joins."""
    table = R.with_any(J.lead_bias_window(errors(t)))
    return table.select("sid", "fcdate", "leadtime", *BIAS0.split(), *BIAS1.split())


@query("build_training_table", "select * from training", f"{SITE} {WIDE} {OBS} {ERRORS} {BIAS0} {BIAS1}")
def build_training_table(t):
    """One scan of each input; the check uses joins."""
    return T.build_training_table(t.fc_narrow(), t.obs())


# Buckets at least, and rows of ``fc_cell`` and of observations that one of them holds beyond that.
REACH_HOURS, BUCKETS, BUCKET_ROWS = 12, 8, 500_000


def bucketed(t, label: str, write):
    """Name of a bucketed table that this session has written once for a folder of test tables."""
    path = written(t, label, lambda path: write(f"fcbias_{path.rsplit('/', 1)[-1].replace('-', '_')}", path))
    return t.spark.table(f"fcbias_{path.rsplit('/', 1)[-1].replace('-', '_')}")


def bucketed_narrow(t):
    return bucketed(t, "buckets-narrow", lambda name, path: buckets.write_narrow(t.fc_narrow(), name, path, n_buckets(t)))


def n_buckets(t) -> int:
    """So many that what a task reads, a bucket of all half-years, does not grow with the tables."""
    return max(BUCKETS, -(-max(t.table("lineitem").count(), t.table("orders").count()) // BUCKET_ROWS))


@query("build_training_table_bucketed", "select * from training", f"{SITE} {WIDE} {OBS} {ERRORS} {BIAS0} {BIAS1}")
def build_training_table_bucketed(t):
    """Both inputs stored in buckets by station and day of the run: built without a shuffle."""
    days = bucketed(t, "buckets-obs", lambda name, path: buckets.write_observations(t.obs(), name, path, n_buckets(t), REACH_HOURS))
    return T.training_table_of_buckets(bucketed_narrow(t), days, REACH_HOURS)


REPEATED = f"sid, fcdate, leadtime, validdate, t2m, ta_pt1m_avg, {ERRORS}, {BIAS0}, {BIAS1}".replace(" ", ", ").replace(",,", ",")


@query("build_training_table_repeated", f"select {REPEATED} from training_repeated", f"t2m ta_pt1m_avg {ERRORS} {BIAS0} {BIAS1}")
def build_training_table_repeated(t):
    """Observations that repeat multiply the rows, by themselves and as lead biases."""
    renamed = {"rh": "rh_pt1m_avg", "ta": "ta_pt1m_avg", "wg": "wg_pt1h_max", "wsp": "ws_pt10m_avg"}
    obs = Q.coalesce_wind(t.obs_raw()).drop("ws", "producer").withColumnsRenamed(renamed)
    return T.build_training_table(t.fc_narrow(), obs).select(*REPEATED.split(", "))


@query("build_training_table_bucketed_repeated", f"select {REPEATED} from training_repeated where year(fcdate) = 1997", f"t2m ta_pt1m_avg {ERRORS} {BIAS0} {BIAS1}")
def build_training_table_bucketed_repeated(t):
    """Repeated observations from buckets; folders of two half-years are all that is read."""
    renamed = {"rh": "rh_pt1m_avg", "ta": "ta_pt1m_avg", "wg": "wg_pt1h_max", "wsp": "ws_pt10m_avg"}
    obs = Q.coalesce_wind(t.obs_raw()).drop("ws", "producer").withColumnsRenamed(renamed)
    days = bucketed(t, "buckets-raw", lambda name, path: buckets.write_observations(obs, name, path, n_buckets(t), REACH_HOURS))
    year = F.col("period").isin("1997q12", "1997q34")
    return T.training_table_of_buckets(bucketed_narrow(t).where(year), days.where(year), REACH_HOURS).select(*REPEATED.split(", "))


@query("dropna_all_subset", "select count(*) as n, count(ta_pt1m_avg) as n_ta, count(wg_pt1h_max) as n_wg from fc_err where coalesce(rh_pt1m_avg, ta_pt1m_avg, ws_pt10m_avg, wg_pt1h_max) is not null")
def dropna_all_subset(t):
    return R.with_any(errors(t)).agg(
        F.count(F.lit(1)).alias("n"), F.count("ta_pt1m_avg").alias("n_ta"), F.count("wg_pt1h_max").alias("n_wg")
    )


@query("drop_columns", "select * exclude (rows_n) from fc_wide", f"{SITE} {WIDE}")
def drop_columns(t):
    """Helpers that exist are dropped, the others are no error."""
    return R.without_helpers(R.pivot_avg(t.fc_narrow()))


@query(
    "join_month_limits",
    """
select event_id, ta, month(validdate) as month, lower, upper from obs_qc join (values
 (1,-6,2.5),(2,-6,2.5),(3,-5,2.5),(4,-4,3),(5,-4,4),(6,-4,5),(7,-4,5),(8,-4,5),(9,-4,3),(10,-5,2.5),(11,-6,2.5),(12,-6,2.5)
) l(month, lower, upper) on month(validdate) = l.month
""",
    "ta lower upper",
)
def join_month_limits(t):
    return J.join_month_limits(t.obs_qc(), "validdate", "T2m").select(
        "event_id", "ta", F.col("month").cast("bigint").alias("month"), "lower", "upper"
    )


@query(
    "join_param_metadata",
    """
select m.param, model, obs_national, obs_foreign, bias_column, count(*) as n, avg(value) as mean from
 (select 'temperature' as param, ta as value from obs_raw union all select 'humidity', rh from obs_raw
  union all select 'windspeed', coalesce(wsp, ws) from obs_raw union all select 'gust', wg from obs_raw) o
join (values ('temperature','T2m','TA_PT1M_AVG','TA_PT1M_AVG','t1bias'), ('humidity','RH','RH_PT1M_AVG','RH_PT1M_AVG','rh1bias'),
 ('windspeed','WS','WSP_PT10M_AVG','WS_PT10M_AVG','ws1bias'), ('gust','WG','WG_PT1H_MAX','WG_PT1H_MAX','wg1bias')
) m(param, model, obs_national, obs_foreign, bias_column) on o.param = m.param group by all
""",
    "mean",
)
def join_param_metadata(t):
    values = [("temperature", "ta"), ("humidity", "rh"), ("windspeed", "wsp"), ("gust", "wg")]
    pairs = [e for name, c in values for e in (F.lit(name), F.col(c))]
    long = Q.coalesce_wind(t.obs_raw()).select(F.stack(F.lit(4), *pairs).alias("param", "value"))
    return J.join_parameters(long.groupBy("param").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean")))


# --- feature tables ------------------------------------------------------------------------------------------------


def _feature_queries(model: str) -> None:
    suffix = "" if model == "T2m" else f"_{model.lower()}"

    @query(f"feature_projection_train{suffix}", training_sql(model, False), training_doubles(model))
    def projection(t):
        return R.project_training(training(t), model)

    columns = ", ".join(P.training_columns(model))
    rows = f"select {columns} from features_{model.lower()}"

    @query(f"feature_table_train{suffix}", rows, training_doubles(model))
    def feature_table(t):
        return T.feature_table_train(training(t), model)

    p = P.parameter(model)
    target = f"select {p.error} as label, {', '.join(P.FEATURES[model])} from rows_{model.lower()}"

    @query(f"target_and_features{suffix}", target, " ".join(["label", *P.FEATURES[model][1:]]))
    def target_features(t):
        return R.target_and_features(T.model_rows(training(t), model), model)


for _model in P.FEATURES:
    _feature_queries(_model)


@query("cast_float32", "select sid, fcdate, leadtime, cast(pmsl as float) as pmsl, cast(ta_pt1m_avg as float) as ta_pt1m_avg, cast(wsero as float) as wsero from training", "pmsl ta_pt1m_avg wsero")
def cast_float32(t):
    return R.to_float32(training(t).select("sid", "fcdate", "leadtime", "pmsl", "ta_pt1m_avg", "wsero"))


@query("filter_physical_range", "select sid, fcdate, leadtime, wg_pt1h_max from training where wg_pt1h_max < 60 or wg_pt1h_max is null", "wg_pt1h_max")
def filter_physical_range(t):
    return R.within_physical_range(training(t), "WG").select("sid", "fcdate", "leadtime", "wg_pt1h_max")


@query("filter_leads", "select leadtime, count(*) as n, avg(tero) as tero from training where leadtime not in (0, 1) group by leadtime", "tero")
def filter_leads(t):
    return R.without_leads(training(t)).groupBy("leadtime").agg(F.count(F.lit(1)).alias("n"), F.avg("tero").alias("tero"))


@query("filter_run_hours", "select sid, fcdate, leadtime, tero from training where hour(fcdate) in (0,4,8,12,16,20)", "tero")
def filter_run_hours(t):
    return R.with_run_hours(training(t)).select("sid", "fcdate", "leadtime", "tero")


HOLDOUT = "day(validdate - interval '1' hour * leadtime) between 25 and 30"


@query("holdout_by_origin_day", f"select sid, fcdate, leadtime, {HOLDOUT} as is_test from training")
def holdout_by_origin_day(t):
    return R.with_holdout(training(t)).select("sid", "fcdate", "leadtime", "is_test")


@query("split_complement", f"select '1' as part, count(*) as n, avg(rhero) as rhero from training where {HOLDOUT} union all select '2', count(*), avg(rhero) from training where not ({HOLDOUT})", "rhero")
def split_complement(t):
    test, train = R.split_by(R.with_holdout(training(t)), F.col("is_test"))
    both = test.withColumn("part", F.lit("1")).unionByName(train.withColumn("part", F.lit("2")))
    return both.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.avg("rhero").alias("rhero"))


@query(
    "union_periods",
    f"""
select case when {HOLDOUT} and year(fcdate) = 1997 then 'test' else 'train' end as part, year(fcdate) as year, count(*) as n, avg(tero) as tero
from training where year(fcdate) between 1996 and 1998 group by 1, 2
""",
    "tero",
)
def union_periods(t):
    """Three years stacked, the last days of the middle year's months held out."""
    periods = [f"{year}{half}" for year in (1996, 1997, 1998) for half in ("q12", "q34")]
    years = tables.read_periods(t.spark, training_archive(t), periods).drop("period")
    train, test = T.training_split(years, ["1997q12", "1997q34"])
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("part", F.year("fcdate").cast("bigint").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("tero").alias("tero")
    )


@query("dropna_any", "select sid, fcdate, leadtime, tero, t0bias, t1bias from training where tero is not null and t0bias is not null and t1bias is not null", "tero t0bias t1bias")
def dropna_any(t):
    return R.complete_rows(training(t).select("sid", "fcdate", "leadtime", "tero", "t0bias", "t1bias"))


_fold_case = " ".join(
    f"when fcdate >= timestamp '{a} 00:00:00' and fcdate < timestamp '{b} 00:00:00' then {i}" for i, (a, b) in enumerate(FOLDS)
)


@query("time_block_folds", f"select fold, count(*) as n, min(fcdate) as first_run, max(fcdate) as last_run from (select fcdate, case {_fold_case} else -1 end as fold from training) x group by fold")
def time_block_folds(t):
    folded = R.with_time_folds(training(t), FOLDS)
    return folded.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), F.min("fcdate").alias("first_run"), F.max("fcdate").alias("last_run")
    )


@query(
    "random_split",
    """
select sid, strftime(validdate, '%Y%m%d%H') as hour, leadtime,
 md5('42|' || sid || '|' || strftime(validdate, '%Y%m%d%H') || '|' || leadtime) < '19999999' as is_validation from training
""",
)
def random_split(t):
    keyed = training(t).select("sid", F.date_format("validdate", "yyyyMMddHH").alias("hour"), "leadtime")
    return R.with_random_split(keyed, ["sid", "hour", "leadtime"])


# --- scalars ----------------------------------------------------------------------------------------------------------


@query(
    "unit_conversion",
    """
select cell, leadtime, t2 - 273.15e0 as t2, rh * 100e0 as rh, ppa / 100e0 as ppa, round_even(nl/0.125e0, 0) as nl,
 ws * 100e0 / 9.81e0 as height, t2 - 273.15e0 + 273.15e0 as t2_back, rh * 100e0 / 100e0 as rh_back from grid_fc
""",
    "t2 rh ppa nl height t2_back rh_back",
)
def unit_conversion(t):
    """To model units and back; the cloud fractions hit exact halves."""
    names = ["t2", "rh", "ppa", "nl"]
    converted = t.grid_fc().select(
        "cell", "leadtime", *[S.to_model_units(n, n).alias(n) for n in names],
        S.geopotential_to_height(F.col("ws") * 100).alias("height"),
    )
    return converted.withColumns(
        {"t2_back": S.to_output_units("temperature", "t2"), "rh_back": S.to_output_units("humidity", "rh")}
    )


@query(
    "cyclic_encode",
    "select sid, fcdate, leadtime, " + ", ".join(f"{e} as {n}" for n, e in time_sql("validdate").items()) + " from fc_wide",
    " ".join(P.TIME_FEATURES),
)
def cyclic_encode(t):
    wide = R.pivot_avg(t.fc_narrow())
    return wide.select("sid", "fcdate", "leadtime", *[e.alias(n) for n, e in S.time_features("validdate").items()])


@query("epoch_to_utc", "select event_id, cast(epoch(date_trunc('second', ts)) as bigint) as seconds, date_trunc('second', ts) as utc from events")
def epoch_to_utc(t):
    """Unix seconds and the timestamp made of them again."""
    seconds = t.table("events").select("event_id", S.utc_to_epoch("ts").alias("seconds"))
    return seconds.withColumn("utc", S.epoch_to_utc("seconds"))


@query("valid_time", "select cell, leadtime, timestamp '2024-07-01 18:00:00' + interval '1' hour * (leadtime * 6) as forecasttime from grid_fc")
def valid_time(t):
    """Steps that cross midnight."""
    return t.grid_fc().select(
        "cell", "leadtime", S.valid_time(F.lit(20240701), F.lit(1800), F.col("leadtime") * 6).alias("forecasttime")
    )


@query("origin_time", "select sid, validdate, leadtime, fcdate as origin, day(fcdate) as day from fc_wide")
def origin_time(t):
    wide = R.pivot_avg(t.fc_narrow()).select("sid", "validdate", "leadtime", S.origin_time("validdate", "leadtime").alias("origin"))
    return wide.withColumn("day", F.dayofmonth("origin").cast("bigint"))


@query("step_hours", "select sid, fcdate, validdate, leadtime as step from fc_wide")
def step_hours(t):
    wide = R.pivot_avg(t.fc_narrow())
    return wide.select("sid", "fcdate", "validdate", S.step_hours("validdate", "fcdate").alias("step"))


@query(
    "clip_diff",
    """
select cell, leadtime, greatest(-10e0, least(10e0, t2 - 270e0)) as t_diff, greatest(-40e0, least(40e0, rh*200e0 - 100e0)) as rh_diff,
 case when cell % 97 <> 0 then greatest(-10e0, least(10e0, t2 - 270e0)) end as t_gap, ws * 10e0 as ws_diff from grid_fc
""",
    "t_diff rh_diff t_gap ws_diff",
)
def clip_diff(t):
    """Limits of the correction; a missing one stays missing, wind is not limited."""
    f = t.grid_fc()
    gap = F.when(F.col("cell") % 97 != 0, F.col("t2") - 270.0)
    return f.select(
        "cell", "leadtime",
        S.clip_diff("temperature", F.col("t2") - 270.0).alias("t_diff"),
        S.clip_diff("humidity", F.col("rh") * 200.0 - 100.0).alias("rh_diff"),
        S.clip_diff("temperature", gap).alias("t_gap"),
        S.clip_diff("windspeed", F.col("ws") * 10.0).alias("ws_diff"),
    )


_low, _high = P.TEMPERATURE_LIMITS[6][1:]


@query(
    "clip_qc",
    f"""
select cell, leadtime, greatest({_low}e0, least({_high}e0, t2)) as temperature, greatest(5e0, least(100e0, rh*120e0)) / 100e0 as humidity,
 greatest(0e0, least(38e0, ws*3e0 - 5e0)) as windspeed, greatest(0e0, least(50e0, wg*3e0 - 5e0)) as gust from grid_fc
""",
    "temperature humidity windspeed gust",
)
def clip_qc(t):
    """Limits of the output; the July limits of temperature come from the month table."""
    from ..plans.correction import apply_limits

    valid = F.lit(ANALYSIS).cast("timestamp_ntz") + S.hours("leadtime")
    fields = t.grid_fc().withColumn("month", F.month(valid))
    limited = fields.join(F.broadcast(J.temperature_limits(t.spark)), "month")
    return limited.select(
        "cell", "leadtime",
        apply_limits("temperature", S.kelvin_to_celsius("t2"), F.col("low"), F.col("high")).alias("temperature"),
        apply_limits("humidity", F.col("rh") * 120.0).alias("humidity"),
        apply_limits("windspeed", F.col("ws") * 3.0 - 5.0).alias("windspeed"),
        apply_limits("gust", F.col("wg") * 3.0 - 5.0).alias("gust"),
    )


@query("text_digits", "select p_partkey, regexp_extract(p_name || '_' || p_partkey || '.db', '(\\d+)', 1) as first_digits, len(regexp_extract_all(p_name || '_' || p_partkey || '_199704', '(\\d+)', 1)) as runs from part")
def text_digits(t):
    """First run of digits in names such as FC_199704.db, and how many there are."""
    name = F.concat_ws("_", "p_name", F.col("p_partkey").cast("string"))
    return t.table("part").select(
        "p_partkey",
        S.first_digits(F.concat(name, F.lit(".db"))).alias("first_digits"),
        F.size(S.all_digits(F.concat(name, F.lit("_199704")))).cast("bigint").alias("runs"),
    )


@query(
    "time_format",
    """
select event_id, strftime(ts, '%Y%m%d%H%M%S') as compact, strftime(ts, '%Y-%m-%dT%H:%M:%S') as iso,
 year(ts) as year, month(ts) as month, day(ts) as day, hour(ts) as hour from events
""",
)
def time_format(t):
    parts = {"year": F.year, "month": F.month, "day": F.dayofmonth, "hour": F.hour}
    return t.table("events").select(
        "event_id", S.compact_time("ts").alias("compact"), S.iso_time("ts").alias("iso"),
        *[f("ts").cast("bigint").alias(n) for n, f in parts.items()],
    )


# --- projections --------------------------------------------------------------------------------------------------------

# The checks work the constants out in SQL from the standard parallel and the radius.
_N = "sin(radians(63.3e0))"
_F = f"(6371229e0 * cos(radians(63.3e0)) * power(tan(pi()/4 + radians(63.3e0)/2), {_N}) / {_N})"


def _lcc_sql(lat: str, lon: str) -> tuple[str, str]:
    rho = f"({_F} / power(tan(pi()/4 + radians({lat})/2), {_N}))"
    rho0 = f"({_F} / power(tan(pi()/4 + radians(63.3e0)/2), {_N}))"
    theta = f"({_N} * radians({lon} - 15e0))"
    return f"{rho} * sin({theta})", f"{rho0} - {rho} * cos({theta})"


_x, _y = _lcc_sql("obs_lat", "obs_lon")


@query("lcc_project_points", f"select sid, ({_x}) / 1e3 as x_km, ({_y}) / 1e3 as y_km from stations", "x_km y_km")
def lcc_project_points(t):
    x, y = PR.Lambert().forward("obs_lat", "obs_lon")
    return t.stations().select("sid", (x / 1000).alias("x_km"), (y / 1000).alias("y_km"))


_x0, _y0 = _lcc_sql("50.319616e0", "0.27828e0")
_up = f"({_F} / power(tan(pi()/4 + radians(63.3e0)/2), {_N}) - y)"


@query(
    "lcc_grid_coords",
    f"""
select cell, j, i, degrees(2 * atan(power({_F} / sqrt(x*x + {_up}*{_up}), 1e0/{_N}))) - 90 as lat,
 degrees(atan2(x, {_up}) / {_N}) + 15 as lon from (select cell, j, i, i*2500e0 + ({_x0}) as x, j*2500e0 + ({_y0}) as y from grid) x
""",
    "lat lon",
)
def lcc_grid_coords(t):
    lat, lon = PR.grid_coordinates(PR.Lambert(), "i", "j", 2500.0, 2500.0, P.FIRST_LAT, P.FIRST_LON)
    return t.grid().select("cell", "j", "i", lat.alias("lat"), lon.alias("lon"))


_S = "(6371229e0 * (1 + sin(radians(60e0))))"


@query(
    "stere_grid_coords",
    f"""
select cell, j, i, 90 - degrees(2 * atan(sqrt(x*x + y*y) / {_S})) as lat, degrees(atan2(x, -y)) + 20 as lon from (
 select cell, j, i, i*2500e0 + {_S} * tan(pi()/4 - radians(51.3e0)/2) * sin(radians(2e0 - 20e0)) as x,
  j*2500e0 - {_S} * tan(pi()/4 - radians(51.3e0)/2) * cos(radians(2e0 - 20e0)) as y from grid) x
""",
    "lat lon",
)
def stere_grid_coords(t):
    lat, lon = PR.grid_coordinates(PR.PolarStereographic(60.0, 20.0), "i", "j", 2500.0, 2500.0, 51.3, 2.0)
    return t.grid().select("cell", "j", "i", lat.alias("lat"), lon.alias("lon"))


@query("haversine_distance", f"select station_id, {haversine_sql('latitude', 'longitude', '60.2e0', '24.9e0')} / 1e3 as km from obs_crowd", "km")
def haversine_distance(t):
    km = G.haversine("latitude", "longitude", F.lit(60.2), F.lit(24.9)) / 1000
    return t.obs_crowd().select("station_id", km.alias("km"))


_d = haversine_sql("latitude", "longitude", "60.2e0", "24.9e0")


@query("barnes_function", f"select station_id, {barnes_sql(_d + ' / 10', 'station_id % 300', '0.25e0')} as rho from obs_crowd", "rho")
def barnes_function(t):
    """The weight as a function, for distances scaled down so that none of them vanishes."""
    distance = G.haversine("latitude", "longitude", F.lit(60.2), F.lit(24.9)) / 10
    return t.obs_crowd().select("station_id", G.barnes(distance, (F.col("station_id") % 300).cast("double"), F.lit(0.25)).alias("rho"))


# --- order --------------------------------------------------------------------------------------------------------------


@query("sorted_leads", "select distinct leadtime from fc_wide order by leadtime")
def sorted_leads(t):
    return A.sorted_leads(t.fc_cell())


@query("head_sample", "select * from (select sid, fcdate, leadtime, t2m, tero from training order by sid, fcdate, leadtime limit 10) x", "t2m tero")
def head_sample(t):
    return A.head(training(t).select("sid", "fcdate", "leadtime", "t2m", "tero"), ["sid", "fcdate", "leadtime"], 10)


@query("order_by_lead", "select cell, leadtime, t2 from grid_fc where leadtime >= 1 order by leadtime, cell", "t2")
def order_by_lead(t):
    return A.by_lead(t.grid_fc().where("leadtime >= 1").select("cell", "leadtime", "t2"), ["cell"])
