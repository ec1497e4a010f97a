"""Narrow archive and observations in one layout: by half-year and in buckets by station and day of the run.

Whatever is put together per station and run then meets without a shuffle. A bucket key is one day of one station, so a
station with a third of all rows still spreads over all buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalar as S

KEYS = ("sid", "run_day")


def _write(df: DataFrame, table: str, path: str, buckets: int) -> DataFrame:
    # dealt as the buckets are, so that each bucket of a half-year comes out as one file
    dealt = df.withColumn("period", S.half_year("run_day")).repartition(buckets, *KEYS)
    dealt.write.partitionBy("period").bucketBy(buckets, *KEYS).sortBy(*KEYS).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def write_narrow(narrow: DataFrame, table: str, path: str, buckets: int) -> DataFrame:
    """The narrow archive with ``run_day``, the day of ``fcdate``, as a bucketed table at a path.

    Rows without ``fcdate`` go by the day of ``validdate``; lead biases of such rows come from that day alone. A bucket of
    a half-year is one file, and a task reads the bucket of all half-years asked for, which sets how many to take.
    """
    return _write(narrow.withColumn("run_day", F.to_date(F.coalesce("fcdate", "validdate"))), table, path, buckets)


def write_observations(obs: DataFrame, table: str, path: str, buckets: int, reach_hours: int) -> DataFrame:
    """Observations as one row per station and day of run that reaches them, the rows of ``obs`` as a list.

    A run reaches ``reach_hours`` ahead, so an observation is listed under each day that a run reaching it may start on:
    one or two for reaches of less than a day. Observations without station or time match no forecast and are left out.
    A list is as long as a station has observations of that span.
    """
    first = F.to_date(F.col("validdate") - S.hours(F.lit(reach_hours)))
    copied = obs.where("sid is not null and validdate is not null").withColumn(
        "run_day", F.explode(F.sequence(first, F.to_date("validdate"))))
    values = F.struct(*[c for c in obs.columns if c != "sid"])
    days = copied.groupBy(*KEYS).agg(F.collect_list(values).alias("seen"))
    return _write(days, table, path, buckets)


def open_table(spark: SparkSession, table: str, path: str, schema: T.StructType, buckets: int) -> DataFrame:
    """A bucketed table of an earlier session under a name of this one; the files tell neither keys nor number of buckets."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    keys = ", ".join(KEYS)
    spark.sql(f"create table if not exists {table} ({columns}) using parquet partitioned by (period)"
              f" clustered by ({keys}) sorted by ({keys}) into {buckets} buckets location '{path}'")
    spark.sql(f"msck repair table {table}")
    return spark.table(table)
