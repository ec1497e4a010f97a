"""The operational run, with a simple fading bias that SQL can repeat, and with a model."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import params as P
from ..functions import scalar as S
from ..plans import correction as C
from ..plans import operational as O
from ..sources.standins import ANALYSIS
from .observations import BILINEAR_SQL
from .registry import query
from .views import RADIUS_SQL, barnes_sql, haversine_sql, nearest_sql

# value of a crowd report by parameter
CROWD = {"temperature": "ta_pt1m_avg", "humidity": "30e0 + station_id % 70"}


def latest(t, param):
    """The latest observation of every station, and the crowd, all at the time of the analysis."""
    p = P.parameter(param)
    value = F.col(p.obs)
    newest = t.obs().groupBy("sid").agg(F.max_by(F.struct("obs_lat", "obs_lon", "obs_elevation", value.alias("value")), "validdate").alias("o"))
    national = F.col("sid") % 3 != 0
    values = {"value": F.col("o.value")}
    if param == "windspeed":
        values = {"wsp": F.when(national, F.col("o.value")), "ws": F.when(~national, F.col("o.value"))}
    now = F.lit(ANALYSIS).cast("timestamp_ntz")
    conventional = newest.select(
        "sid", now.alias("obstime"), F.when(national, "national").otherwise("foreign").alias("producer"),
        F.col("o.obs_lat").alias("lat"), F.col("o.obs_lon").alias("lon"), F.col("o.obs_elevation").alias("elev"),
        *[c.alias(n) for n, c in values.items()],
    )
    sid = F.col("station_id") + 1000000
    crowd = t.obs_crowd().select(
        sid.alias("sid"), now.alias("obstime"), "arrival", F.col("latitude").alias("lat"), F.col("longitude").alias("lon"),
        (sid % 47 * 1000.0 + 250.0).alias("x"), (sid % 3 * 1000.0 + 600.0).alias("y"),
        F.expr(CROWD.get(param, "cast(null as double)").replace("e0", "D")).alias("value"),
    )
    return conventional, crowd


def fields(t):
    """Grid forecast in source units with its times."""
    run = F.lit(ANALYSIS).cast("timestamp_ntz")
    return t.grid_fc().withColumns({"analysistime": run, "forecasttime": run + S.hours("leadtime")})


def fading(param):
    """The observed bias, less with every lead."""
    bias = F.col(P.parameter(param).bias1).cast("double") / F.col("leadtime")
    return lambda features: features.select(*C.runs_of(features), "sid", "leadtime", bias.alias("bias"))


def run(t, param, predict, k=P.MAX_POINTS):
    conventional, crowd = latest(t, param)
    return O.operational_run(conventional, crowd, t.dem(), fields(t), t.grid(), param, predict, k)


def operational_sql(param: str, start: str = f"timestamp '{ANALYSIS}'", grid: str = "fc_fields", shift: str = "0e0", kept: str = "true") -> str:
    """One run from a time on: ``grid`` is its forecast, ``shift`` is added to its observations, ``kept`` are its sites."""
    p = P.parameter(param)
    limit = P.DIFF_LIMITS.get(param)
    lower, upper = next(limits[2:] for limits in P.ZSCORE_LIMITS if limits[:2] == (p.model, 7))
    points = f"select sid, obs_lat as lat, obs_lon as lon, obs_elevation as elev, {p.obs} as value from (select *, row_number() over (partition by sid order by validdate desc) as rn from obs) o where rn = 1"
    if p.crowd:
        place = "cast(((1000000 + station_id) % 47) as double) + 0.25e0 as fx, cast((1000000 + station_id) % 3 as double) + 0.6e0 as fy"
        heights = BILINEAR_SQL.format(points=f"(select 1000000 + station_id as sid, {place} from obs_crowd)")
        points += f" union all select c.sid, c.lat, c.lon, b.elevation, c.value from (select 1000000 + station_id as sid, latitude as lat, longitude as lon, {CROWD[param]} as value from crowd_first) c left join {heights} b on b.sid = c.sid"
    rho = barnes_sql("distance", "topo - elev", "lc - land")
    diff = "coalesce(d.diff / f.leadtime, 0)"
    if limit:
        diff = f"greatest(-{limit}e0, least({limit}e0, {diff}))"
    raw = f"f.{p.fc} - {diff}"
    if param == "temperature":
        low, high = P.TEMPERATURE_LIMITS[6][1:]
        final = f"greatest({low}e0, least({high}e0, {raw} + 273.15e0))"
    else:
        low, high = P.OUTPUT_LIMITS[param]
        final = f"greatest({low}e0, least({high}e0, {raw}))" + (" / 100e0" if param == "humidity" else "")
    _, category, number, level, template, statistic = next(row for row in P.PRODUCTS if row[0] == param)
    return f"""
with points as (select sid, lat, lon, elev, value + {shift} as value from ({points}) o where {kept}),
checked as (
 select * from (select *, (value - avg(value) over ()) / nullif(stddev_pop(value) over (), 0) as z from points) x
 where not coalesce(z > {upper}e0 or z < {lower}e0, false)
),
near as ({nearest_sql("select sid, lat, lon from checked")}),
biased as (
 select c.sid, c.lat, c.lon, c.elev, n.lc as land, cast(cast(h.{p.fc} - c.value as float) as double) as bias
 from checked c join near n on c.sid = n.sid join {grid} h on h.cell = n.cell and h.leadtime = 1 where c.value is not null
),
pairs as (
 select g.cell, g.topo, g.lc, b.*, {haversine_sql("b.lat", "b.lon", "g.lat", "g.lon")} as distance from grid g cross join biased b
),
ranked as (
 select *, row_number() over (partition by cell order by floor(rho*1e9 + 0.5) desc, sid) as rank
 from (select *, {rho} as rho from pairs where distance <= {RADIUS_SQL}) x where rho > 0
),
d as (select cell, rho*bias/1.1e0 as diff from ranked where rank = 1)
select '{param}' as param, f.leadtime, f.cell, f.forecasttime, {start} as analysistime, {final} as value,
 {category} as category, {number} as number, {level} as level, {template} as template, {"cast(null as int)" if statistic is None else statistic} as statistic,
 f.leadtime - {1 if param == "gust" else 0} as step
from {grid} f left join d on d.cell = f.cell where f.leadtime >= 1
"""


def _queries(param: str) -> None:
    @query(f"operational_nearest1_{param}", operational_sql(param), "value")
    def operational_nearest1(t):
        """From observations to products with the best point of every node."""
        return run(t, param, fading(param), k=1)


for _param in P.PARAMETERS:
    _queries(_param)


HOURS = 12


def archive(t):
    """Observations and forecasts of three runs of temperature: the second lacks sites, the third a producer."""
    hours = S.hours(F.col("run") * HOURS)
    number = F.explode(F.sequence(F.lit(0), F.lit(2)))

    def repeated(df):
        df = df.withColumn("run", number)
        return df.withColumn("analysistime", F.lit(ANALYSIS).cast("timestamp_ntz") + hours)

    def of_runs(obs):
        obs = repeated(obs).withColumns({"obstime": F.col("analysistime"), "value": F.col("value") + F.col("run") * 0.5})
        return obs.where("run != 1 or sid % 5 != 0")

    conventional, crowd = latest(t, "temperature")
    silent = F.when(~((F.col("run") == 2) & (F.col("producer") == "foreign")), F.col("value"))
    grids = repeated(t.grid_fc()).withColumns({"forecasttime": F.col("analysistime") + S.hours("leadtime"), "t2": F.col("t2") + F.col("run")})
    return of_runs(conventional).withColumn("value", silent).drop("run"), of_runs(crowd).drop("run"), grids.drop("run")


def _archive_sql() -> str:
    """Two single runs, and a third that is the forecast."""
    found = []
    for number, kept in ((0, "true"), (1, "sid % 5 <> 0")):
        hours = f"interval '{HOURS * number}' hour"
        grid = f"(select * replace (t2m + {number}e0 as t2m, forecasttime + {hours} as forecasttime) from fc_fields)"
        found.append(f"select * from ({operational_sql('temperature', f"timestamp '{ANALYSIS}' + {hours}", grid, f'{number}e0 * 0.5e0', kept)}) r{number}")
    _, category, number, level, template, statistic = next(row for row in P.PRODUCTS if row[0] == "temperature")
    hours = f"interval '{HOURS * 2}' hour"
    found.append(
        f"select 'temperature', leadtime, cell, forecasttime + {hours}, timestamp '{ANALYSIS}' + {hours}, t2m + 2e0 + 273.15e0,"
        f" {category}, {number}, {level}, {template}, {'cast(null as int)' if statistic is None else statistic}, leadtime from fc_fields where leadtime >= 1")
    return " union all ".join(found)


@query("operational_runs", _archive_sql(), "value")
def operational_runs(t):
    """Three runs of an archive in one plan, each by its own observations."""
    conventional, crowd, grids = archive(t)
    return O.operational_run(conventional, crowd, t.dem(), grids, t.grid(), "temperature", fading("temperature"), k=1)
