"""Nearest nodes, neighbours, optimal interpolation and corrected grids."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from .. import params as P
from ..functions import geo as G
from ..functions import projection as PR
from ..functions import scalar as S
from ..operators import interpolation as I
from ..operators import joins as J
from ..operators import quality as Q
from ..operators import spatial as X
from ..plans import correction as C
from ..session import sized
from ..sources import bands
from ..sources.standins import ANALYSIS
from .archive import messages, written
from .registry import query
from .tables import _F, _N, _up, _x0, _y0
from .views import barnes_sql, haversine_sql, nearest_sql, time_sql

# --- inputs ----------------------------------------------------------------------------------------------------------


def station_points(t):
    return t.stations().select("sid", F.col("obs_lat").alias("lat"), F.col("obs_lon").alias("lon"), F.col("obs_elevation").alias("elev"))


def land_points(t):
    """Points of the interpolation with the land fraction of their nearest node."""
    points, grid = t.oi_points(), t.grid()
    return points.join(X.sample_static(X.nearest_cell(points, grid), grid, {"lc": "land"}), "sid")


def weighted(t, k=None):
    """Points near each node with their correlation; with k the best of them as lists."""
    if k is not None:
        return I.best_lists(land_points(t), t.grid(), k, t.oi_points())
    return I.barnes_weights(land_points(t), t.grid(), counted=t.oi_points())


def fields(t):
    """Grid fields in model units with their valid time."""
    valid = F.lit(ANALYSIS).cast("timestamp_ntz") + S.hours("leadtime")
    return C.model_units(t.grid_fc()).withColumn("forecasttime", valid)


def background(t, field):
    return fields(t).select("cell", "leadtime", "forecasttime", F.col(field).alias("value"))


# --- nearest ---------------------------------------------------------------------------------------------------------


@query("join_nearest_cell", "select sid, cell, distance from near_stations", "distance")
def join_nearest_cell(t):
    return X.nearest_cell(station_points(t), t.grid())


SIDE = 1_400_000.0
_SIDE = "(select ceil(sqrt(count(*))) from part)"
_ON_GRID = f"""
(select cell, degrees(2 * atan(power({_F} / sqrt(x*x + {_up}*{_up}), 1e0/{_N}))) - 90 as lat, degrees(atan2(x, {_up}) / {_N}) + 15 as lon, 0e0 as lc, 0e0 as topo
 from (select cell, (cell % side) * ({SIDE} / side) + ({_x0}) as x, floor(cell / side) * ({SIDE} / side) + ({_y0}) as y
  from (select side, unnest(range(0, cast(side * side as bigint))) as cell from (select cast({_SIDE} as bigint) as side) s) c) n)
"""


@query("nearest_on_grid", f"select sid, cast(cell as int) as cell, distance from ({nearest_sql('select sid, obs_lat as lat, obs_lon as lon from stations').replace('cross join grid g', f'cross join {_ON_GRID} g')}) x", "distance")
def nearest_on_grid(t):
    """Nearest node of a projected grid of as many nodes as parts; the northern stations lie outside of it."""
    side = math.ceil(math.sqrt(t.table("part").count()))
    grid = PR.ProjectedGrid(PR.Lambert(), side, side, SIDE / side, SIDE / side, P.FIRST_LAT, P.FIRST_LON)
    return X.nearest_on_grid(station_points(t), grid)


NAMES = ["t2", "ws", "wg", "rh", "wd", "nl", "ppa", "q2"]


@query("join_field_values", f"select n.sid, g.leadtime, {', '.join('g.' + c for c in NAMES)} from near_stations n join grid_fc g on g.cell = n.cell where g.leadtime >= 1", " ".join(NAMES))
def join_field_values(t):
    near = X.nearest_cell(station_points(t), t.grid())
    return X.sample_fields(near, t.grid_fc().where("leadtime >= 1"), NAMES)


@query(
    "sample_bands",
    """
select sid, param, timestamp '2024-07-01 00:00:00' as analysistime, timestamp '2024-07-01 00:00:00' + interval '1' hour * leadtime as forecasttime,
 leadtime, case when param = 't2' then t2 else ws end as value
from near_stations n join grid_fc g on g.cell = n.cell cross join (values ('t2'), ('ws')) p(param)
""",
    "value",
)
def sample_bands(t):
    """Two fields at the nodes of all stations from messages stored in bands of four rows."""
    both = messages(t, "t2").unionByName(messages(t, "ws"))
    path = written(t, "bands", lambda path: bands.write_bands(both, path, 4))
    near = X.nearest_cell(station_points(t), t.grid())
    nodes = near.select("sid", F.floor(F.col("cell") / 50).cast("int").alias("j"), (F.col("cell") % 50).cast("int").alias("i"))
    return bands.sample_bands(t.spark.read.parquet(path), nodes, ["t2", "ws"])


@query("union_lead_rows", "select leadtime, count(*) as n, avg(t2) as t2, avg(ws) as ws from near_stations n join grid_fc g on g.cell = n.cell where leadtime >= 1 group by leadtime", "t2 ws")
def union_lead_rows(t):
    """Rows of all leads from a long grid, by one join instead of one per lead."""
    long = t.grid_fc().where("leadtime >= 1").select(
        "cell", "leadtime", F.stack(F.lit(2), F.lit("t2"), F.col("t2"), F.lit("ws"), F.col("ws")).alias("param", "value")
    )
    near = X.nearest_cell(station_points(t), t.grid())
    rows = X.sample_fields(near, X.grid_fields_wide(long, ["t2", "ws"]), ["t2", "ws"])
    return rows.groupBy("leadtime").agg(F.count(F.lit(1)).alias("n"), F.avg("t2").alias("t2"), F.avg("ws").alias("ws"))


@query("sample_land_mask", "select sid, lc as land from near_stations", "land")
def sample_land_mask(t):
    return X.sample_static(X.nearest_cell(station_points(t), t.grid()), t.grid(), {"lc": "land"})


@query("elevation_difference", "select s.sid, n.topo - s.obs_elevation as elevd from stations s join near_stations n on s.sid = n.sid", "elevd")
def elevation_difference(t):
    points = station_points(t)
    heights = X.sample_static(X.nearest_cell(points, t.grid()), t.grid(), {"topo": "model_elevation"})
    return points.join(heights, "sid").select("sid", (F.col("model_elevation") - F.col("elev")).alias("elevd"))


@query("bias_broadcast", "select n.sid, g.leadtime, h.t2 - 273.15e0 - (n.sid % 30) as bias from near_stations n join grid_fc g on g.cell = n.cell join grid_fc h on h.cell = n.cell and h.leadtime = 1 where g.leadtime >= 1", "bias")
def bias_broadcast(t):
    """The bias at lead 1 on every lead of a station."""
    return served(t, "temperature", ["leadtime", "t1bias"]).select("sid", "leadtime", F.col("t1bias").cast("double").alias("bias")).withColumn("bias", F.round("bias", 3))


def served(t, param, names=None):
    points = station_points(t).withColumn("value", (F.col("sid") % 30).cast("double"))
    return C.feature_table_serve(points, X.nearest_cell(points, t.grid()), fields(t), t.grid(), param, names)


SERVED_SQL = f"""
select sid, cast(leadtime as int) as leadtime, cast(d10m as float) as d10m, cast(t2m as float) as t2m, cast(s10m as float) as s10m, cast(rh2m as float) as rh2m,
 cast(pmsl as float) as pmsl, cast(q2m as float) as q2m, cast(cclow as float) as cclow, cast(gmax as float) as gmax,
 cast(obs_lat as float) as obs_lat, cast(obs_lon as float) as obs_lon, cast(topo - obs_elevation as float) as elevd, cast(obs_elevation as float) as obs_elevation,
 cast(t2m1 - value as float) as t1bias, cast(rh2m1 - value as float) as rh1bias, cast(s10m1 - value as float) as ws1bias, cast(gmax1 - value as float) as wg1bias,
 {', '.join(f'cast({e} as float) as {n}' for n, e in time_sql('forecasttime').items())}
from (select f.*, s.sid, s.obs_lat, s.obs_lon, s.obs_elevation, n.topo, cast(s.sid % 30 as double) as value,
 h.t2m as t2m1, h.rh2m as rh2m1, h.s10m as s10m1, h.gmax as gmax1
 from stations s join near_stations n on s.sid = n.sid join fc_fields f on f.cell = n.cell
 join fc_fields h on h.cell = n.cell and h.leadtime = 1 where f.leadtime >= 1) x
"""


def _serve_queries(param: str) -> None:
    p = P.parameter(param)
    suffix = "" if param == "temperature" else f"_{p.model.lower()}"
    names = P.FEATURES[p.model]

    @query(f"feature_table_serve{suffix}", f"select sid, {', '.join(names)} from ({SERVED_SQL}) s", " ".join(names[1:]))
    def feature_table(t):
        return served(t, param)


for _param in P.PARAMETERS:
    _serve_queries(_param)


@query("feature_projection_serve", f"select sid, {', '.join(P.SERVED_WIND_FEATURES)} from ({SERVED_SQL}) s", " ".join(P.SERVED_WIND_FEATURES[1:]))
def feature_projection_serve(t):
    """Wind-speed features in their older serving order, with humidity and without cloud."""
    return served(t, "windspeed", P.SERVED_WIND_FEATURES)


# --- checks and fills on grids ---------------------------------------------------------------------------------------------


def with_gaps(t, every: int = 97):
    gap = lambda c: F.when(F.col("cell") % every == 0, F.lit(P.MISSING)).otherwise(F.col(c))
    return t.grid_fc().withColumns({"t2": gap("t2"), "nl": gap("nl")})


@query("missing_sentinel_guard", """
select field, count(*) filter (where value = 9999) as n_missing from (
 select unnest(['t2','ws','wg','rh','wd','nl','ppa','q2']) as field,
  unnest([case when cell % 97 = 0 then 9999e0 else t2 end, ws, wg, rh, wd, case when cell % 97 = 0 then 9999e0 else nl end, ppa, q2]) as value from grid_fc) x group by field
""")
def missing_sentinel_guard(t):
    return Q.sentinel_report(with_gaps(t))


@query("missing_fill_output", "select cell, leadtime, case when cell % 97 = 0 then 9999e0 else t2 end as t2, case when cell % 89 = 0 then 9999e0 else ws end as ws from grid_fc", "t2 ws")
def missing_fill_output(t):
    f = t.grid_fc()
    null = F.when(F.col("cell") % 97 != 0, F.col("t2"))
    nan = F.when(F.col("cell") % 89 == 0, F.lit(float("nan"))).otherwise(F.col("ws"))
    return f.select("cell", "leadtime", S.fill_missing(null).alias("t2"), S.fill_missing(nan).alias("ws"))


@query("zero_background", "select g.cell, g.leadtime, 0e0 as background, 0e0 + d.diff as increment from grid_fc g left join diff1 d on d.cell = g.cell where g.leadtime >= 1", "background increment")
def zero_background(t):
    """Biases are gridded onto zeros, so the analysis is the increment itself."""
    diff = I.oi_nearest1(weighted(t, 1))
    zero = t.grid_fc().where("leadtime >= 1").select("cell", "leadtime", F.lit(0.0).alias("background"))
    return zero.join(sized(diff), "cell", "left").withColumn("increment", F.col("background") + F.col("diff")).drop("diff")


@query("land_mask", "select cell, lc, case when lc = 0 then 1 else 0 end as sea from grid", "lc")
def land_mask(t):
    return t.grid().select("cell", "lc", F.when(F.col("lc") == 0, 1).otherwise(0).alias("sea"))


# --- neighbours and weights --------------------------------------------------------------------------------------------------


@query("join_neighbours_radius", "select cell, sid, distance / 1e3 as km from near_pairs", "km")
def join_neighbours_radius(t):
    near = X.neighbours(land_points(t), t.grid(), counted=t.oi_points())
    return near.select("cell", "sid", (F.col("distance") / 1000).alias("km"))


@query("barnes_weight", "select cell, sid, rho from near_weighted where rho > 0", "rho")
def barnes_weight(t):
    return weighted(t).select("cell", "sid", "rho")


@query("topk_neighbours", "select cell, sid, rank, rho from near_ranked where rank <= 20", "rho")
def topk_neighbours(t):
    top = I.best_points(land_points(t), t.grid(), counted=t.oi_points())
    return top.select("cell", "sid", F.col("rank").cast("bigint").alias("rank"), "rho")


@query("oi_nearest1", "select cell, diff from diff1", "diff")
def oi_nearest1(t):
    return I.oi_nearest1(weighted(t, 1))


_between = barnes_sql(haversine_sql("a.lat", "a.lon", "b.lat", "b.lon"), "a.elev - b.elev", "a.land - b.land")


@query("oi_pair2", f"""
select cell, case when rho2 is null then rho1*b1/1.1e0 else ((1.1e0*rho1 - r*rho2)*b1 + (1.1e0*rho2 - r*rho1)*b2) / (1.21e0 - r*r) end as diff from (
 select a.cell, a.rho as rho1, a.bias as b1, b.rho as rho2, b.bias as b2, {_between} as r
 from (select * from near_ranked where rank = 1) a left join (select * from near_ranked where rank = 2) b on a.cell = b.cell) x
""", "diff")
def oi_pair2(t):
    return I.oi_pair2(weighted(t, 2))


@query("oi_weights")
def oi_weights(t):
    """Weights of up to 20 points per node; checked in the tests against a dense solve."""
    return I.oi_weights(weighted(t, P.MAX_POINTS))


@query("oi_weights_residual", "select cell, count(*) as n, 0e0 as residual from near_ranked where rank <= 20 group by cell", "residual")
def oi_weights_residual(t):
    """Points per node, and how far their weights are from solving the node's equations."""
    packed = I.oi_weights(weighted(t, P.MAX_POINTS), packed=True)
    # at most 20 points a node, so at most 400 pairs, in the row of the node
    point = F.arrays_zip("sid", "weight", "rho", "lat", "lon", "elev", "land")
    pairs = packed.select("cell", point.alias("points")).select("cell", "points", F.inline("points"))
    pairs = pairs.select("cell", *[F.col(c).alias(f"{c}1") for c in ("sid", "rho", "lat", "lon", "elev", "land")], F.inline("points"))
    between = G.barnes(G.haversine("lat1", "lon1", "lat", "lon"), F.col("elev1") - F.col("elev"), F.col("land1") - F.col("land"))
    covariance = F.when(F.col("sid1") == F.col("sid"), F.lit(1 + P.VARIANCE_RATIO)).otherwise(between)
    rows = pairs.groupBy("cell", "sid1").agg(F.abs(F.sum(covariance * F.col("weight")) - F.max("rho1")).alias("residual"))
    return rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("residual").alias("residual"))


def ragged(t):
    """Biases of two runs in which every lead lacks other points."""
    runs = F.explode(F.array(F.lit(0), F.lit(1)))
    leads = t.oi_points().select("sid", "bias", F.explode(F.sequence(F.lit(1), F.lit(6))).alias("leadtime"))
    present = (F.col("sid") + F.col("run")) % 4 != F.col("leadtime") % 4
    start = F.lit(ANALYSIS).cast("timestamp_ntz") + S.hours(F.col("run") * 12)
    return leads.withColumn("run", runs).select(
        start.alias("analysistime"), "sid", "leadtime", F.when(present, F.col("bias") / (F.col("leadtime") + F.col("run"))).alias("bias")
    )


_RAGGED = f"""
(select analysistime, cell, leadtime, rho * fading / 1.1e0 as diff from (
 select *, row_number() over (partition by analysistime, cell, leadtime order by floor(rho*1e9 + 0.5) desc, sid) as best from (
  select w.cell, w.sid, w.rho, l.leadtime, timestamp '{ANALYSIS}' + interval '12' hour * r.run as analysistime, w.bias / (l.leadtime + r.run) as fading
  from near_weighted w cross join (select leadtime from leads where leadtime >= 1) l cross join (values (0), (1)) r(run)
  where w.rho > 0 and (w.sid + r.run) % 4 <> l.leadtime % 4
 ) x
) y where best = 1)
"""


@query("oi_ragged", f"select * from {_RAGGED} z", "diff")
def oi_ragged(t):
    """Every lead of every run uses the points that have a bias then."""
    return I.oi_analysis(land_points(t), ragged(t), t.grid(), k=1, counted=t.oi_points())


@query("correct_grid_runs", f"""
select f.cell, r.analysistime, f.leadtime, r.analysistime + interval '1' hour * f.leadtime as forecasttime,
 greatest(259e0, least(317e0, f.t2m - greatest(-10e0, least(10e0, coalesce(d.diff, 0))) + 273.15e0)) as value
from fc_fields f cross join (values (timestamp '{ANALYSIS}'), (timestamp '{ANALYSIS}' + interval '12' hour)) r(analysistime)
left join {_RAGGED} d on d.cell = f.cell and d.leadtime = f.leadtime and d.analysistime = r.analysistime where f.leadtime >= 1
""", "value")
def correct_grid_runs(t):
    """Two runs in one plan."""
    start = F.lit(ANALYSIS).cast("timestamp_ntz")
    runs = fields(t).select("cell", "leadtime", F.col("t2").alias("value"), F.explode(F.array(F.lit(0), F.lit(12))).alias("hour"))
    at = start + S.hours("hour")
    both = runs.select("cell", "leadtime", "value", at.alias("analysistime"), (at + S.hours("leadtime")).alias("forecasttime"))
    return C.correct_grid(both, land_points(t), ragged(t), t.grid(), "temperature", counted=t.oi_points(), k=1)


def lead_biases(t):
    """A bias per point and lead that fades with the lead."""
    return t.oi_points().select("sid", "bias", F.explode(F.sequence(F.lit(1), F.lit(6))).alias("leadtime")).select(
        "sid", "leadtime", (F.col("bias") / F.col("leadtime")).alias("bias")
    )


@query("oi_analysis")
def oi_analysis(t):
    return I.oi_analysis(land_points(t), lead_biases(t), t.grid(), counted=t.oi_points())


@query("join_correction", "select g.cell, g.leadtime, g.t2 - 273.15e0 - coalesce(d.diff, 0) as corrected from grid_fc g left join diff1 d on d.cell = g.cell and g.leadtime >= 1", "corrected")
def join_correction(t):
    diff = I.oi_nearest1(weighted(t, 1))
    per_lead = diff.withColumn("leadtime", F.explode(F.sequence(F.lit(1), F.lit(6))))
    return J.join_correction(background(t, "t2"), per_lead).select("cell", "leadtime", "corrected")


def _finished_sql(param: str) -> str:
    value = {"temperature": "t2m", "humidity": "rh2m", "windspeed": "s10m", "gust": "gmax"}[param]
    limit = P.DIFF_LIMITS.get(param)
    diff = "coalesce(d.diff / f.leadtime, 0)"
    raw = f"f.{value} - " + (f"greatest(-{limit}e0, least({limit}e0, {diff}))" if limit else diff)
    if param == "temperature":
        low, high = P.TEMPERATURE_LIMITS[6][1:]
        final = f"greatest({low}e0, least({high}e0, {raw} + 273.15e0))"
    else:
        low, high = P.OUTPUT_LIMITS[param]
        final = f"greatest({low}e0, least({high}e0, {raw}))" + (" / 100e0" if param == "humidity" else "")
    return f"select f.cell, f.leadtime, f.forecasttime, {final} as value from fc_fields f left join diff1 d on d.cell = f.cell where f.leadtime >= 1"


def finished(t, param):
    diff = I.oi_nearest1(weighted(t, 1))
    leads = diff.withColumn("leadtime", F.explode(F.sequence(F.lit(1), F.lit(6))))
    per_lead = leads.withColumn("diff", F.col("diff") / F.col("leadtime"))
    return C.finish_grid(background(t, P.parameter(param).field).where("leadtime >= 1"), per_lead, param)


def _finish_queries(param: str) -> None:
    @query(f"correct_grid_nearest1_{param}", _finished_sql(param), "value")
    def correct_grid_nearest1(t):
        return finished(t, param)


for _param in P.PARAMETERS:
    _finish_queries(_param)


@query("correct_grid")
def correct_grid(t):
    """Corrected temperature with the full interpolation."""
    return C.correct_grid(background(t, "t2"), land_points(t), lead_biases(t), t.grid(), "temperature", counted=t.oi_points())


@query("uncorrected_fallback", f"""
select f.cell, f.leadtime, f.forecasttime, f.t2m + 273.15e0 as value, 'wsp' as observed from fc_fields f where leadtime >= 1
union all select cell, leadtime, forecasttime, value, 'ta' from ({_finished_sql('temperature')}) x
""", "value")
def uncorrected_fallback(t):
    """One producer has no potential wind at all, so that run falls back; with temperature it does not."""
    raw, corrected = background(t, "t2"), finished(t, "temperature")

    def run(observed):
        usable = Q.observations_usable(t.obs_raw(), observed, ["national", "foreign"])
        return C.with_fallback(raw, corrected, usable, "temperature").withColumn("observed", F.lit(observed))

    return run("wsp").unionByName(run("ta"))


