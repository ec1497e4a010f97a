"""Stand-ins for the inputs of the engine, derived from the test tables.

Each method returns a lazy DataFrame over the whole tables; ``FIXTURES.md`` gives the same views in
SQL. Timestamps are without time zone, so nothing depends on the session's zone.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of a table in one partition: a map-side aggregation of as many groups, of about 300 bytes each, stays in memory.
SPREAD_ROWS = 500_000


def spread(df: DataFrame, key: str, rows: int = SPREAD_ROWS) -> DataFrame:
    """Give a scan one partition per core, and no partition many more rows than ``rows``.

    A scan in enough splits passes unchanged. Files are small for their rows, so splits by bytes hold millions, whose groups
    an aggregation would spill. Hashing a key that hardly repeats is cheaper than dealing rows out in turn, for which Spark
    sorts them first.
    """
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))
    return df.repartition(parts, key) if df.rdd.getNumPartitions() < parts else df


def shifted_quarter(date: str) -> str:
    """SQL of the start of the quarter of a date, moved by the station's run offset."""
    return f"(cast(trunc(cast({date} as date), 'quarter') as timestamp_ntz) + interval '1' hour * (24 * day_off + hour_off))"


# columns of the test tables that the stand-ins read
SCHEMAS = {
    "supplier": "s_suppkey bigint",
    "lineitem": "l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_discount double,"
    " l_tax double, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_acctbal double",
    "part": "p_partkey bigint, p_name string, p_size int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
    "region": "r_name string",
}


class StandIns:
    """The views of one folder of test tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def n_stations(self) -> int:
        return self.table("supplier").count()

    @cached_property
    def n_rows(self) -> int:
        """Rows of the grid, which has 50 columns."""
        return -(-self.table("part").count() // 50)

    # --- stations and point forecasts ----------------------------------------------------------------

    def stations(self) -> DataFrame:
        return self.table("supplier").selectExpr(
            "cast(s_suppkey as int) as sid",
            "54 + (s_suppkey * 977 % 1750) / 100D as obs_lat",
            "4 + (s_suppkey * 1499 % 2800) / 100D as obs_lon",
            "cast(s_suppkey * 29 % 400 as double) as obs_elevation",
            "cast(s_suppkey * 31 % 400 as double) as model_elevation",
            "cast(s_suppkey * 7 % 31 as int) as day_off",
            "cast(s_suppkey * 5 % 24 as int) as hour_off",
        )

    def fc_cell(self) -> DataFrame:
        lines = self.table("lineitem").selectExpr(
            "cast(l_suppkey as int) as sid", "l_shipdate", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_partkey"
        )
        run = shifted_quarter("l_shipdate")
        return spread(lines, "l_partkey").join(self.stations(), "sid").selectExpr(
            "sid",
            "obs_lat as lat",
            "obs_lon as lon",
            "model_elevation",
            f"{run} as fcdate",
            f"{run} + interval '1' hour * (l_linenumber - 1) as validdate",
            "l_linenumber - 1 as leadtime",
            "l_quantity as q",
            "l_discount as d",
            "l_tax as x",
            "l_partkey as p",
        )

    def fc_narrow(self) -> DataFrame:
        """Narrow archive: one row per run, lead, station and parameter, from one scan."""
        return self.fc_cell().selectExpr(
            "sid", "lat", "lon", "model_elevation", "fcdate", "validdate", "leadtime",
            """stack(8,
                'T2m', 243.15D + q,
                'S10m', d * 150D,
                'D10m', cast(p % 360 as double),
                'RH2m', 2D * q,
                'Pmsl', 980D + x * 500D,
                'Q2m', x / 10D,
                'CClow', cast(p % 9 as double),
                'Gmax', d * 150D + x * 100D
            ) as (parameter, value)""",
        )

    # --- observations ------------------------------------------------------------------------------------

    def obs_raw(self) -> DataFrame:
        """Observations of both producers; a station may report an hour more than once."""
        orders = spread(self.table("orders"), "o_orderkey")
        located = orders.withColumn("sid", (F.col("o_custkey") % self.n_stations).cast("int")).join(self.stations(), "sid")
        silent, foreign = "o_orderkey % 11 = 0", "o_orderkey % 3 = 0"
        return located.selectExpr(
            "sid",
            f"if({foreign}, 'foreign', 'national') as producer",
            "obs_lat",
            "obs_lon",
            "obs_elevation",
            f"{shifted_quarter('o_orderdate')} + interval '1' hour * cast(o_orderkey % 7 as int) as validdate",
            f"if({silent} or o_orderstatus = 'P', null, o_totalprice / 10000D - 25D) as ta",
            f"if({silent}, null, 30D + cast(o_custkey % 70 as double)) as rh",
            f"if({silent} or {foreign}, null, o_totalprice / 50000D) as wsp",
            f"if({silent} or not {foreign}, null, o_totalprice / 50000D) as ws",
            f"if({silent} or o_orderstatus = 'O', null, o_totalprice / 9000D) as wg",
        )

    def obs(self) -> DataFrame:
        """One observation per station and hour."""
        aggregated = {
            "obs_elevation": "max(obs_elevation)",
            "obs_lat": "max(obs_lat)",
            "obs_lon": "max(obs_lon)",
            "rh_pt1m_avg": "avg(rh)",
            "ta_pt1m_avg": "avg(ta)",
            "ws_pt10m_avg": "avg(coalesce(wsp, ws))",
            "wg_pt1h_max": "max(wg)",
        }
        return self.obs_raw().groupBy("sid", "validdate").agg(*[F.expr(f"{e} as {n}") for n, e in aggregated.items()])

    def obs_crowd(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "cast(c_custkey as int) as station_id",
            "54 + (c_custkey * 71 % 175) / 10D as latitude",
            "4 + (c_custkey * 91 % 280) / 10D as longitude",
            "c_acctbal / 400D - 10D as ta_pt1m_avg",
            "c_custkey as arrival",
        )

    def obs_qc(self) -> DataFrame:
        """Dense observations with outliers in both tails and some missing values."""
        return self.table("events").selectExpr(
            "event_id",
            "cast(user_id as int) as sid",
            "timestamp_ntz '2024-01-01 00:00:00' + make_ym_interval(0, cast(user_id % 12 as int))"
            " + interval '1' hour * cast(6 * (event_id % 4) as int) as validdate",
            "case when event_id % 53 = 0 then null when event_type in ('click', 'view') then 20D - value / 10D"
            " else 20D + value / 20D end as ta",
        )

    def crowd_events(self) -> DataFrame:
        return crowd_feed(self.table("events"))

    # --- grid -----------------------------------------------------------------------------------------------

    def grid(self) -> DataFrame:
        return self.table("part").selectExpr(
            "cast(p_partkey as int) as cell",
            "cast(floor(p_partkey / 50) as int) as j",
            "cast(p_partkey % 50 as int) as i",
            f"54 + 17.5D * floor(p_partkey / 50) / {self.n_rows} as lat",
            "4 + 0.56D * (p_partkey % 50) as lon",
            "cast(p_partkey * 17 % 400 as double) as topo",
            "if(p_size > 25, 1D, 0D) as lc",
        )

    def grid_fc(self) -> DataFrame:
        """Grid fields in source units for leads 0..6, one column per field."""
        return (
            self.table("part")
            .selectExpr(
                "cast(p_partkey as int) as cell",
                "cast(floor(p_partkey / 50) as int) as j",
                "cast(p_partkey % 50 as int) as i",
                "explode(sequence(0, 6)) as leadtime",
            )
            .selectExpr(
                "cell",
                "j",
                "i",
                "leadtime",
                "243.15D + ((cell * 13 + leadtime * 7) % 500) / 10D as t2",
                "((cell * 11 + leadtime * 5) % 200) / 10D as ws",
                "((cell * 19 + leadtime * 3) % 300) / 10D as wg",
                "((cell * 7 + leadtime) % 101) / 100D as rh",
                "cast((cell * 23 + leadtime) % 360 as double) as wd",
                "((cell * 3 + leadtime) % 17) / 16D as nl",
                "98000D + ((cell * 29 + leadtime) % 6000) as ppa",
                "((cell * 5 + leadtime) % 100) / 10000D as q2",
            )
        )

    def dem(self) -> DataFrame:
        return self.table("part").selectExpr(
            "cast(p_partkey % 50 as int) as ix",
            "cast(floor(p_partkey / 50) as int) as iy",
            "cast(p_partkey * 41 % 600 as double) as z",
        )

    def oi_points(self) -> DataFrame:
        """Points with a lead-1 bias: stations and the first crowd report of every position."""
        from ..operators.quality import keep_first

        crowd = keep_first(self.obs_crowd(), ["latitude", "longitude"], ["arrival"])
        return (
            self.stations()
            .select(
                "sid",
                F.col("obs_lat").alias("lat"),
                F.col("obs_lon").alias("lon"),
                F.col("obs_elevation").alias("elev"),
                ((F.col("sid") % 21).cast("double") - 10.0).alias("bias"),
            )
            .unionByName(
                crowd.select(
                    (F.col("station_id") + 1000000).alias("sid"),
                    F.col("latitude").alias("lat"),
                    F.col("longitude").alias("lon"),
                    (F.col("station_id") * 41 % 400).cast("double").alias("elev"),
                    F.col("ta_pt1m_avg").alias("bias"),
                )
            )
        )


def crowd_feed(events: DataFrame) -> DataFrame:
    """Crowd reports of a table or stream of events; the time is a UTC instant, as streams need one."""
    return events.selectExpr(
        "event_id",
        "timestamp_micros(timestampdiff(microsecond, timestamp_ntz '1970-01-01 00:00:00', ts)) as ts",
        "54 + (user_id * 71 % 175) / 10D as latitude",
        "4 + (user_id * 91 % 280) / 10D as longitude",
        "value",
    )


# analysis time of the stand-in grid
ANALYSIS = "2024-07-01 00:00:00"
# tuning folds for the run dates of the stand-ins: start inclusive, end exclusive
FOLDS = [
    ("1996-01-01", "1996-12-31"),
    ("1997-01-01", "1997-12-31"),
    ("1998-01-01", "1998-12-31"),
    ("1999-01-01", "1999-06-30"),
]
