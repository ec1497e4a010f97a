"""Observations and their quality control."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import aggregates as A
from ..operators import quality as Q
from ..operators import states as ST
from ..plans import correction as C
from ..session import new_folder, stored
from ..sources.standins import SCHEMAS, crowd_feed
from ..streaming import crowd as SC
from .registry import query
from .views import nearest_sql

LIMITS_SQL = "(values (1,-6,2.5),(2,-6,2.5),(3,-5,2.5),(4,-4,3),(5,-4,4),(6,-4,5),(7,-4,5),(8,-4,5),(9,-4,3),(10,-5,2.5),(11,-6,2.5),(12,-6,2.5)) l(month, lower, upper)"


@query("rename_positional", "select sid as station_id, obs_lon as longitude, obs_lat as latitude, validdate as utctime, obs_elevation as elevation, ta as ta_pt1m_avg from obs_raw", "longitude latitude elevation ta_pt1m_avg")
def rename_positional(t):
    """Columns by name in the order of the observation table."""
    names = {"sid": "station_id", "obs_lon": "longitude", "obs_lat": "latitude", "validdate": "utctime", "obs_elevation": "elevation", "ta": "ta_pt1m_avg"}
    return t.obs_raw().select(*[F.col(a).alias(b) for a, b in names.items()])


@query("coalesce_wind", "select sid, validdate, producer, coalesce(wsp, ws) as wsp from obs_raw", "wsp")
def coalesce_wind(t):
    return Q.coalesce_wind(t.obs_raw()).select("sid", "validdate", "producer", "wsp")


@query("filter_time_slice", """
select 'conventional' as kind, count(*) as n, avg(ta) as mean from obs_qc where validdate = timestamp '2024-07-01 06:00:00'
union all select 'crowd', count(*), avg(value) from crowd_events
 where ts between (select max(ts) from events) - interval '10' minute and (select max(ts) from events)
 and longitude between 4 and 32 and latitude between 54 and 71.5
""", "mean")
def filter_time_slice(t):
    """One hour of conventional observations, and the last ten minutes of the crowd feed."""
    one_hour = Q.at_time(t.obs_qc(), "validdate", "2024-07-01 06:00:00").select("ta")
    feed = t.crowd_events()
    crowd = Q.in_crowd_window(feed, feed.agg(F.max("ts")).scalar())

    def summary(df, kind, value):
        return df.agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean")).withColumn("kind", F.lit(kind))

    return summary(one_hour, "conventional", "ta").unionByName(summary(crowd, "crowd", "value"))


@query("union_producers", """
select sid, validdate, producer, ta, wsp, cast(null as double) as ws from obs_raw where producer = 'national'
union all select sid, validdate, producer, ta, null, ws from obs_raw where producer = 'foreign'
""", "ta wsp ws")
def union_producers(t):
    """Producers with different wind columns."""
    raw = t.obs_raw()
    national = raw.where("producer = 'national'").select("sid", "validdate", "producer", "ta", "wsp")
    foreign = raw.where("producer = 'foreign'").select("sid", "validdate", "producer", "ta", "ws")
    return Q.union_producers([national, foreign])


@query("union_crowd", """
select 'temperature' as param, 'conventional' as kind, count(*) as n, avg(ta) as mean from obs_raw
union all select 'temperature', 'crowd', count(*), avg(ta_pt1m_avg) from obs_crowd
union all select 'windspeed', 'conventional', count(*), avg(ta) from obs_raw
""", "mean")
def union_crowd(t):
    """Appended for temperature, left out for wind."""
    conventional = t.obs_raw().select(F.col("ta").alias("value"), F.lit("conventional").alias("kind"))
    crowd = t.obs_crowd().select(F.col("ta_pt1m_avg").alias("value"), F.lit("crowd").alias("kind"))
    stacked = [
        Q.union_crowd(conventional, crowd, p).withColumn("param", F.lit(p)) for p in ("temperature", "windspeed")
    ]
    return Q.union_producers(stacked).groupBy("param", "kind").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"))


@query("dedup_keep_first", "select station_id, latitude, longitude, ta_pt1m_avg, arrival from crowd_first", "latitude longitude ta_pt1m_avg")
def dedup_keep_first(t):
    return Q.keep_first(t.obs_crowd(), ["latitude", "longitude"], ["arrival"])


ZSCORE_SQL = """
select event_id, sid, validdate, ta, mean, std, (ta - mean) / nullif(std, 0) as z, month, lower, upper,
 coalesce((ta - mean) / nullif(std, 0) > upper or (ta - mean) / nullif(std, 0) < lower, false) as is_outlier
from (select *, month(validdate) as month, avg(ta) over (partition by {group}) as mean, stddev_pop(ta) over (partition by {group}) as std from obs_qc) q
join {limits} using (month)
"""
BY_TIME = ZSCORE_SQL.format(group="validdate", limits=LIMITS_SQL)


def scored(t, group=("validdate",)):
    return Q.zscore(t.obs_qc(), "ta", list(group), "validdate", "T2m")


@query("zscore_by_time", f"select * from ({BY_TIME}) s", "ta mean std z lower upper")
def zscore_by_time(t):
    return scored(t).withColumn("month", F.col("month").cast("bigint"))


@query("zscore_global", f"select sid, validdate, event_id, ta from ({BY_TIME}) s where not is_outlier and validdate = timestamp '2024-03-01 06:00:00'", "ta")
def zscore_global(t):
    """The whole observation set of one hour, all producers together; outliers removed."""
    hour = Q.at_time(t.obs_qc(), "validdate", "2024-03-01 06:00:00")
    flagged = Q.zscore(hour, "ta", ["validdate"], "validdate", "T2m")
    return flagged.where(~F.col("is_outlier")).select("sid", "validdate", "event_id", "ta")


@query("zscore_merged", f"select * from ({BY_TIME}) s", "ta mean std z lower upper")
def zscore_merged(t):
    """Moments kept of the reports in time, with those of the late ones merged in: the z-scores of all together."""
    late = F.col("event_id") % 5 == 0
    kept = stored(ST.moments(t.obs_qc().where(~late), "ta", ["validdate"]), "moments")
    merged = ST.merge_moments(kept.unionByName(ST.moments(t.obs_qc().where(late), "ta", ["validdate"])), ["validdate"])
    scored = ST.zscore_of(t.obs_qc(), merged, "ta", ["validdate"], "validdate", "T2m")
    return scored.withColumn("month", F.col("month").cast("bigint"))


@query("anti_outliers", f"select event_id, sid, validdate, ta from ({BY_TIME}) s where not is_outlier", "ta")
def anti_outliers(t):
    """Values that are not in the list of outliers of their time."""
    return Q.without_outliers(t.obs_qc(), scored(t), ["validdate"], "ta")


@query("box_summary", f"""
select class, quantile_cont(ta, 0.25) as q1, quantile_cont(ta, 0.5) as median, quantile_cont(ta, 0.75) as q3,
 min(ta) as low, max(ta) as high, count(*) as n from (
 select 'original' as class, ta from ({BY_TIME}) s union all
 select case when is_outlier then 'outlier' else 'kept' end, ta from ({BY_TIME}) s) x where ta is not null group by class
""", "q1 median q3 low high")
def box_summary(t):
    """Original, removed and kept values."""
    classes = F.array(F.lit("original"), F.when(F.col("is_outlier"), F.lit("outlier")).otherwise(F.lit("kept")))
    return A.box_summary(scored(t).select("ta", F.explode(classes).alias("class")), "ta", ["class"])


@query("mean_std_population", "select validdate, avg(ta) as mean, stddev_pop(ta) as std from obs_qc group by validdate", "mean std")
def mean_std_population(t):
    return A.mean_std(t.obs_qc(), "ta", ["validdate"])


@query("all_null_check", """
select producer, count(*) as n, count(wsp) = 0 as all_missing from obs_raw group by producer
""")
def all_null_check(t):
    """The foreign producer has no potential wind at all."""
    return Q.producer_availability(t.obs_raw(), "wsp")


_site = "cast((sid % 47) as double) + 0.25e0 as fx, cast(sid % 3 as double) + 0.6e0 as fy"
BILINEAR_SQL = """
(select p.sid, sum((case when d.ix = floor(p.fx) then 1 - (p.fx - floor(p.fx)) else p.fx - floor(p.fx) end)
 * (case when d.iy = floor(p.fy) then 1 - (p.fy - floor(p.fy)) else p.fy - floor(p.fy) end) * d.z) as elevation
from {points} p join dem d on d.ix between floor(p.fx) and floor(p.fx) + 1 and d.iy between floor(p.fy) and floor(p.fy) + 1
group by p.sid)
"""


@query("join_bilinear_elevation", f"select sid, elevation from {BILINEAR_SQL.format(points=f'(select sid, {_site} from stations)')} b", "elevation")
def join_bilinear_elevation(t):
    from ..operators.spatial import bilinear

    points = t.stations().select(
        "sid", ((F.col("sid") % 47) * 1000.0 + 250.0).alias("x"), ((F.col("sid") % 3) * 1000.0 + 600.0).alias("y")
    )
    return bilinear(points, t.dem(), 1000.0, 1000.0)


# The stand-in observations are gathered by quarter into one observation time each.
QC_SQL = f"""
select q.sid, obstime, q.lat, q.lon, elev, value, g.lc as land from (
 select sid, obstime, lat, lon, elev, value from (
  select *, month(obstime) as month, (value - avg(value) over (partition by obstime)) / nullif(stddev_pop(value) over (partition by obstime), 0) as z from (
   select sid, date_trunc('quarter', validdate) as obstime, obs_lat as lat, obs_lon as lon, obs_elevation as elev, ta as value from obs_raw
   union all
   select c.sid, c.obstime, c.lat, c.lon, b.elevation, c.value from (
    select * from (select 1000000 + station_id as sid, timestamp '1995-01-01 00:00:00' + interval '3' month * cast(arrival % 26 as int) as obstime,
     latitude as lat, longitude as lon, ta_pt1m_avg as value,
     row_number() over (partition by arrival % 26, latitude, longitude order by arrival) as rn from obs_crowd) x where rn = 1) c
   left join {BILINEAR_SQL.format(points=f"(select 1000000 + station_id as sid, {_site.replace('sid', '(1000000 + station_id)')} from obs_crowd)")} b on b.sid = c.sid
  ) o
 ) s join {LIMITS_SQL} using (month) where not coalesce(z > upper or z < lower, false)
) q join ({nearest_sql("select distinct sid, lat, lon from (select sid, obs_lat as lat, obs_lon as lon from stations union all select 1000000 + station_id, latitude, longitude from obs_crowd)")}) g on g.sid = q.sid
"""


def qc_inputs(t):
    quarter = F.trunc(F.col("validdate").cast("date"), "quarter").cast("timestamp_ntz")
    conventional = t.obs_raw().select(
        "sid", quarter.alias("obstime"), F.col("obs_lat").alias("lat"), F.col("obs_lon").alias("lon"),
        F.col("obs_elevation").alias("elev"), F.col("ta").alias("value"),
    )
    start = F.lit("1995-01-01 00:00:00").cast("timestamp_ntz")
    sid = F.col("station_id") + 1000000
    crowd = t.obs_crowd().select(
        sid.alias("sid"),
        (start + F.make_ym_interval(F.lit(0), (F.col("arrival") % 26 * 3).cast("int"))).alias("obstime"),
        "arrival", F.col("latitude").alias("lat"), F.col("longitude").alias("lon"),
        (sid % 47 * 1000.0 + 250.0).alias("x"), (sid % 3 * 1000.0 + 600.0).alias("y"),
        F.col("ta_pt1m_avg").alias("value"),
    )
    return conventional, crowd


@query("observation_qc", QC_SQL, "lat lon elev value land")
def observation_qc(t):
    """Producers and crowd together: first per position, height, z-score, land fraction."""
    conventional, crowd = qc_inputs(t)
    return C.observation_qc(conventional, crowd, t.dem(), t.grid(), "temperature")


# --- stream -------------------------------------------------------------------------------------------------------------


_FIRST_SQL = """
select w.*, coalesce(n_stations, 0) as n_stations, height from (
 select window_start, window_start + interval '10' minute as window_end, latitude, longitude, ts, event_id, value from (
  select *, row_number() over (partition by window_start, latitude, longitude order by ts, event_id) as rn from (
   select *, time_bucket(interval '10' minute, ts, timestamp '1970-01-01 00:00:00') as window_start from crowd_events) b) r
 where rn = 1) w
left join (select floor(obs_lat) as lat_degree, floor(obs_lon) as lon_degree, count(*) as n_stations, avg(obs_elevation) as height from stations group by all) s
 on s.lat_degree = floor(latitude) and s.lon_degree = floor(longitude)
"""


def _utc(df):
    return df.withColumns({c: S.instant_to_utc(c) for c in ("window_start", "window_end", "ts")})


@query("crowd_window_table", _FIRST_SQL, "latitude longitude value height")
def crowd_window_table(t):
    """The first reports of all windows of a table, the open ones too, with the stations of their square."""
    return _utc(SC.beside_stations(SC.first_per_window(t.crowd_events()), SC.stations_by_degree(t.stations())))


@query("stream_crowd_window", f"select * from ({_FIRST_SQL}) f where window_end <= (select date_trunc('milliseconds', max(ts)) - interval '10' minute from crowd_events)", "latitude longitude value height")
def stream_crowd_window(t):
    """The feed read as a stream until its end: the windows that the watermark has closed, and no other rows."""
    events = t.spark.readStream.schema(SCHEMAS["events"]).option("pathGlobFilter", "events.parquet").parquet(t.folder)
    out, checkpoint = new_folder(t.spark, "stream-out"), new_folder(t.spark, "stream-checkpoint")
    first = SC.beside_stations(SC.first_per_window(crowd_feed(events)), SC.stations_by_degree(t.stations()))
    SC.run_once(first, out, checkpoint)
    return _utc(t.spark.read.schema(first.schema).parquet(out))
