"""Scans, sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions import scalar as S
from ..operators import joins as J
from ..operators import prepare as R
from ..plans import training as T
from ..session import new_folder
from ..sources import replace, sinks, tables
from ..sources.standins import ANALYSIS, StandIns
from .registry import query

_WRITTEN: dict[tuple[str, str, str], str] = {}


def written(t: StandIns, label: str, write) -> str:
    """Write an input once per session and folder of test tables; later calls find it there."""
    key = (t.spark.sparkContext.applicationId, t.folder, label)
    if key not in _WRITTEN:
        path = new_folder(t.spark, label)
        write(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def narrow_archive(t: StandIns) -> str:
    return written(t, "narrow", lambda path: sinks.write_narrow(t.fc_narrow(), path))


def training_table(t: StandIns) -> DataFrame:
    return T.build_training_table(t.fc_narrow(), t.obs())


def training_archive(t: StandIns) -> str:
    return written(t, "periods", lambda path: sinks.write_periods(training_table(t), path))


# --- narrow archive -----------------------------------------------------------------------------------------


def by_parameter(df: DataFrame) -> DataFrame:
    return df.groupBy("parameter", "leadtime").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("value").alias("mean"),
        F.min("fcdate").alias("first_run"),
        F.max("validdate").alias("last_time"),
    )


BY_PARAMETER = """
select parameter, leadtime, count(*) as n, avg(value) as mean, min(fcdate) as first_run, max(validdate) as last_time
from {source} group by parameter, leadtime
"""


@query("scan_narrow_filtered", BY_PARAMETER.format(source="fc_narrow where parameter in ('T2m', 'Gmax', 'RH2m')"), "mean")
def scan_narrow_filtered(t):
    """The filter and five of the ten columns reach the Parquet scan."""
    columns = ["parameter", "leadtime", "fcdate", "validdate", "value"]
    return by_parameter(tables.read_narrow(t.spark, narrow_archive(t), columns, ["T2m", "Gmax", "RH2m"]))


@query("scan_merge_files", BY_PARAMETER.format(source="fc_narrow"), "mean")
def scan_merge_files(t):
    """Files with 32 and 64 bit numbers, with timestamps and seconds; the folder of text files is left out."""
    damaged = written(
        t, "damaged",
        lambda path: t.table("region").select(F.col("r_name").alias("value")).write.option("compression", "none").text(path),
    )
    lead = F.col("leadtime")
    plain = written(t, "flat", lambda path: t.fc_narrow().where(lead < 2).write.parquet(path))
    long = {c: F.col(c).cast("bigint") for c in ("sid", "leadtime")}
    wide = written(t, "wide", lambda path: t.fc_narrow().where(lead.between(2, 3)).withColumns(long).write.parquet(path))
    seconds = {c: S.utc_to_epoch(c) for c in ("fcdate", "validdate")}
    old = written(t, "seconds", lambda path: t.fc_narrow().where(lead > 3).withColumns(seconds).write.parquet(path))
    return by_parameter(tables.merge_files(t.spark, plain, wide, old, damaged))


@query("sink_merged_narrow", BY_PARAMETER.format(source="fc_narrow"), "mean")
def sink_merged_narrow(t):
    return by_parameter(t.spark.read.parquet(narrow_archive(t)))


@query(
    "replace_month",
    """
select yyyymm, parameter, count(*) as n, avg(value) as mean, max(source) as source, max(delivery) as delivery from (
 select cast(year(fcdate)*100 + month(fcdate) as int) as yyyymm, parameter,
  case when year(fcdate)*100 + month(fcdate) in (199701, 199704) and parameter = 'T2m' then value + 1 else value end as value,
  case when year(fcdate)*100 + month(fcdate) in (199701, 199704) then 'corrected' else 'first' end as source,
  cast(case when year(fcdate)*100 + month(fcdate) in (199701, 199704) then 2 else 1 end as int) as delivery
 from fc_narrow) x group by 1, 2
""",
    "mean",
)
def replace_month(t):
    """Two months delivered again with other temperatures: their folders alone are written, the manifest says from what."""

    def write(path: str) -> None:
        rows = t.fc_narrow().withColumn("yyyymm", S.yyyymm("fcdate"))
        replace.replace_folders(rows, path, "yyyymm", "first")
        warmer = F.when(F.col("parameter") == "T2m", F.col("value") + 1).otherwise(F.col("value"))
        replace.replace_folders(rows.withColumn("value", warmer), path, "yyyymm", "corrected", [199701, 199704])

    path = written(t, "monthly", write)
    archive = t.spark.read.parquet(path)
    months = archive.groupBy("yyyymm", "parameter").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"))
    # one row per month
    listed = replace.manifest(t.spark, path, archive.schema["yyyymm"]).select("yyyymm", "source", "delivery")
    return months.join(F.broadcast(listed), "yyyymm")


@query(
    "select_months",
    """
select cast(year(fcdate)*100 + month(fcdate) as int) as yyyymm, parameter, count(*) as n, avg(value) as mean from fc_narrow
where year(fcdate)*100 + month(fcdate) between 199611 and 199704 group by 1, 2
""",
    "mean",
)
def select_months(t):
    """Six months from November 1996 on; other folders are not read."""
    months = R.select_months(t.spark.read.parquet(narrow_archive(t)), 199611, 6)
    return months.groupBy("yyyymm", "parameter").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"))


@query(
    "lead_thinning",
    """
select hour(fcdate) as run_hour, leadtime, parameter, count(*) as n from fc_narrow
where (hour(fcdate)%4 = 0 and leadtime in (0,1,2,4,6,8)) or (hour(fcdate)%4 = 2 and leadtime in (0,1,3,5,7,9))
group by 1, 2, 3
""",
)
def lead_thinning(t):
    thin = R.thin_leads(t.fc_narrow())
    return thin.groupBy(F.hour("fcdate").cast("bigint").alias("run_hour"), "leadtime", "parameter").agg(
        F.count(F.lit(1)).alias("n")
    )


# --- training table -----------------------------------------------------------------------------------------

TRAINING_SUMMARY = """
select {key}, leadtime, count(*) as n, avg(tero) as tero, avg(t1bias) as t1bias, avg(wgero) as wgero, avg(elevd) as elevd
from training {where} group by {by}
"""
PERIOD_SQL = "cast(year(fcdate) as varchar) || case when month(fcdate) <= 6 then 'q12' else 'q34' end"


def training_summary(df: DataFrame, *keys: str) -> DataFrame:
    means = [F.avg(c).alias(c) for c in ("tero", "t1bias", "wgero", "elevd")]
    return df.groupBy(*keys, "leadtime").agg(F.count(F.lit(1)).alias("n"), *means)


@query(
    "scan_periods",
    TRAINING_SUMMARY.format(key=f"{PERIOD_SQL} as period", by="1, 2", where=f"where {PERIOD_SQL} in ('1997q12', '1997q34', '1999q12')"),
    "tero t1bias wgero elevd",
)
def scan_periods(t):
    """Three half-years of the training table, found by folder."""
    return training_summary(tables.read_periods(t.spark, training_archive(t), ["1997q12", "1997q34", "1999q12"]), "period")


@query(
    "sink_training",
    TRAINING_SUMMARY.format(key="cast(year(fcdate) as int) as year, case when month(fcdate) <= 6 then 1 else 2 end as half", by="1, 2, 3", where=""),
    "tero t1bias wgero elevd",
)
def sink_training(t):
    path = written(t, "training", lambda path: sinks.write_training(training_table(t), path))
    return training_summary(t.spark.read.parquet(path), "year", "half")


# --- observations ----------------------------------------------------------------------------------------------


@query(
    "scan_obs_csv",
    """
select sid, sid as station_id, obs_lat, obs_lon, validdate, obs_elevation, rh as rh_pt1m_avg, ta as ta_pt1m_avg,
 coalesce(wsp, ws) as ws_pt10m_avg, wg as wg_pt1h_max from obs_raw
""",
    "obs_lat obs_lon obs_elevation rh_pt1m_avg ta_pt1m_avg ws_pt10m_avg wg_pt1h_max",
)
def scan_obs_csv(t):
    """Two producers' headerless text files, read as one table."""

    def lines(producer: str):
        return t.obs_raw().where(F.col("producer") == producer).select(
            "sid", F.col("sid").alias("station_id"), "obs_lat", "obs_lon", "validdate", "obs_elevation",
            "rh", "ta", F.coalesce("wsp", "ws").alias("wind"), "wg",
        )

    paths = [written(t, f"csv-{p}", lambda path, p=p: lines(p).write.csv(path)) for p in ("national", "foreign")]
    return tables.read_obs_csv(t.spark, *paths)


@query(
    "scan_obs_json",
    """
select sid as station_id, obs_lon as longitude, obs_lat as latitude, validdate as utctime, obs_elevation as elevation,
 ta as ta_pt1m_avg from obs_raw where producer = 'foreign'
""",
    "longitude latitude elevation ta_pt1m_avg",
)
def scan_obs_json(t):
    records = t.obs_raw().where("producer = 'foreign'").select(
        F.col("sid").alias("station_id"), F.col("obs_lon").alias("longitude"), F.col("obs_lat").alias("latitude"),
        F.col("validdate").alias("utctime"), F.col("obs_elevation").alias("elevation"), F.col("ta").alias("ta_pt1m_avg"),
    )
    path = written(t, "json", lambda path: records.write.json(path))
    return tables.read_obs_json(t.spark, path, "ta_pt1m_avg")


@query(
    "flatten_geojson",
    """
select station_id, longitude, latitude, timestamp '2024-07-01 00:50:00' + interval '1' minute * (arrival % 10) as utctime,
 ta_pt1m_avg as result from obs_crowd
""",
    "longitude latitude result",
)
def flatten_geojson(t):
    """Collections of up to a hundred features are written as text and flattened again."""
    start = F.lit("2024-07-01 00:50:00").cast("timestamp_ntz")
    time = start + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("arrival") % 10).cast("int"))
    feature = F.struct(
        F.struct(F.array(*[F.col(c).cast("string") for c in ("longitude", "latitude", "station_id")]).alias("coordinates")).alias("geometry"),
        F.struct(F.concat(S.iso_time(time), F.lit("Z")).alias("resultTime"), F.col("ta_pt1m_avg").alias("result")).alias("properties"),
    )
    documents = (
        t.obs_crowd()
        .groupBy(F.floor(F.col("arrival") / 100).alias("request"))
        .agg(F.collect_list(feature).alias("features"))
        .select(F.to_json(F.struct("features")).alias("value"))
    )
    path = written(t, "geojson", lambda path: documents.write.text(path))
    return tables.flatten_features(t.spark.read.text(path), "value").drop("place")


# --- grids -------------------------------------------------------------------------------------------------------


def messages(t: StandIns, field: str) -> DataFrame:
    """One message per lead and grid row; a node the grid lacks is NaN."""
    width = 50
    values = F.map_from_entries(F.collect_list(F.struct("i", field)))
    row = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.coalesce(F.try_element_at(F.col("by_i"), i), F.lit(float("nan"))))
    return (
        t.grid_fc()
        .groupBy("leadtime", "j")
        .agg(values.alias("by_i"))
        .select(
            F.lit(field).alias("param"),
            F.lit(20240701).alias("data_date"),
            F.lit(0).alias("data_time"),
            F.col("leadtime").alias("step"),
            F.col("j").alias("first_row"),
            F.lit(width).alias("ni"),
            row.alias("values"),
        )
    )


@query(
    "scan_grid_long",
    """
select 't2' as param, timestamp '2024-07-01 00:00:00' as analysistime,
 timestamp '2024-07-01 00:00:00' + interval '1' hour * leadtime as forecasttime, leadtime, j, i, t2 as value from grid_fc
""",
    "value",
)
def scan_grid_long(t):
    path = written(t, "messages", lambda path: messages(t, "t2").write.parquet(path))
    stored = t.spark.read.schema(tables.GRID_SCHEMA).parquet(path)
    return tables.grid_long(stored).where("value is not null")


@query(
    "static_field_first",
    """
select 'topography' as param, cell, topo as value from grid union all select 'landcover', cell, lc from grid
""",
    "value",
)
def static_field_first(t):
    """Static fields repeated hourly; the first message counts, the later ones differ."""
    hour = F.make_dt_interval(F.lit(0), F.col("k"))
    fields = F.stack(F.lit(2), F.lit("topography"), F.col("topo"), F.lit("landcover"), F.col("lc"))
    static = t.grid().select("cell", fields.alias("param", "value"))
    repeated = static.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(3))))
    stored = repeated.select(
        "param", "cell", (F.lit(ANALYSIS).cast("timestamp_ntz") + hour).alias("forecasttime"),
        (F.col("value") + F.col("k")).alias("value"),
    )
    return tables.first_message(stored).drop("forecasttime")


PRODUCT_SQL = """
select m.param, leadtime, category, number, level, template, statistic,
 leadtime - case when m.param = 'gust' then 1 else 0 end as step,
 timestamp '2024-07-01 00:00:00' + interval '1' hour * leadtime as forecasttime, count(*) as nodes
from grid_fc join (values ('humidity', 1, 193, 2, 70, null), ('temperature', 0, 193, 2, 70, null),
 ('windspeed', 2, 194, 10, 70, null), ('gust', 2, 195, 10, 72, 2)) m(param, category, number, level, template, statistic)
 on leadtime >= 1 group by all
"""


@query("product_table", PRODUCT_SQL)
def product_table(t):
    """Messages to be written: metadata and step per parameter and lead."""
    start = F.lit(ANALYSIS).cast("timestamp_ntz")
    per_lead = t.grid_fc().where("leadtime >= 1").groupBy("leadtime").agg(F.count(F.lit(1)).alias("nodes"))
    messages_out = per_lead.select(
        F.explode(F.array(*[F.lit(p) for p in P.PARAMETERS])).alias("param"),
        "leadtime", "nodes", start.alias("analysistime"), (start + S.hours("leadtime")).alias("forecasttime"),
    )
    return J.product_table(messages_out).drop("analysistime")


@query(
    "sink_product",
    """
select p.param, timestamp '2024-07-01 00:00:00' as analysistime, cell, leadtime,
 case p.param when 'temperature' then t2 when 'windspeed' then ws else wg end as value
from grid_fc cross join (values ('temperature'), ('windspeed'), ('gust')) p(param) where leadtime >= 1
""",
    "value",
)
def sink_product(t):
    fields = t.grid_fc().where("leadtime >= 1")
    long = fields.select(
        "cell", "leadtime",
        F.stack(F.lit(3), F.lit("temperature"), F.col("t2"), F.lit("windspeed"), F.col("ws"), F.lit("gust"), F.col("wg")).alias("param", "value"),
    ).withColumn("analysistime", F.lit(ANALYSIS).cast("timestamp_ntz"))
    path = written(t, "product", lambda path: sinks.write_product(long, path))
    schema = "cell int, leadtime int, value double, param string, analysistime timestamp_ntz"
    return t.spark.read.schema(schema).parquet(path)
