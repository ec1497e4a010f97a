"""Stored layouts: folders replaced in place, buckets that meet without a shuffle."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from fcbias.catalog import QUERIES
from fcbias.catalog.tables import BUCKETS, bucketed_narrow
from fcbias.functions import scalar as S
from fcbias.plans import training as T
from fcbias.session import new_folder
from fcbias.sources import buckets, replace
from fcbias.sources.tables import NARROW_SCHEMA


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def files(path: str) -> dict:
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.fixture
def archive(spark, inputs):
    path = new_folder(spark, "archive")
    rows = inputs.fc_narrow().where("year(fcdate) = 1997").withColumn("yyyymm", S.yyyymm("fcdate"))
    replace.replace_folders(rows, path, "yyyymm", "first")
    return rows, path


def sums(spark, path):
    return {r[0]: r[1:] for r in replace.contents(spark.read.parquet(path), "yyyymm").collect()}


def test_a_month_again_rewrites_its_folder_alone(spark, archive):
    rows, path = archive
    before, held = files(path), sums(spark, path)
    delivered = replace.replace_folders(rows, path, "yyyymm", "again", [199701]).collect()
    assert [(r["yyyymm"], r["rows"], r["source"], r["delivery"]) for r in delivered] == [(199701, held[199701][0], "again", 2)]
    after = files(path)
    gone, new = set(before) - set(after), set(after) - set(before)
    assert gone and all("yyyymm=199701" in f for f in gone)
    assert all("yyyymm=199701" in f or replace.MANIFEST in f for f in new)
    assert all(before[f] == after[f] for f in set(before) & set(after))
    assert sums(spark, path) == held
    table = spark.read.parquet(path)
    listed = {r["yyyymm"]: (r["rows"], r["digest"]) for r in replace.manifest(spark, path, table.schema["yyyymm"]).collect()}
    assert listed == held and replace.unlisted_folders(table, path, "yyyymm").isEmpty()


def test_a_failed_delivery_leaves_the_archive(spark, archive):
    rows, path = archive
    before = files(path)
    broken = rows.withColumn("value", F.when(F.col("leadtime") == 3, F.raise_error(F.lit("broken"))).otherwise(F.col("value")))
    with pytest.raises(Exception, match="broken"):
        replace.replace_folders(broken, path, "yyyymm", "broken", [199701])
    with pytest.raises(ValueError, match="199713"):
        replace.replace_folders(rows, path, "yyyymm", "no such month", [199701, 199713])
    with pytest.raises(ValueError, match="without yyyymm"):
        replace.replace_folders(rows.withColumn("yyyymm", F.lit(None).cast("int")), path, "yyyymm", "no month", [199701])
    assert files(path) == before
    assert replace.replace_folders(rows.limit(0), path, "yyyymm", "empty").count() == 0
    assert files(path) == before


def test_an_archive_may_be_made_from_itself(spark, archive):
    rows, path = archive
    held = sums(spark, path)
    twice = spark.read.parquet(path).where("yyyymm = 199704")
    replace.replace_folders(twice.unionByName(twice), path, "yyyymm", "twice", [199704])
    now = sums(spark, path)
    assert now[199704] == (2 * held[199704][0], 2 * held[199704][1])
    assert {m: v for m, v in now.items() if m != 199704} == {m: v for m, v in held.items() if m != 199704}


def test_a_swap_that_was_cut_off_is_seen(spark, archive):
    rows, path = archive
    part = rows.where("yyyymm = 199707 and leadtime < 3")
    part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("yyyymm").parquet(path)
    assert [r["yyyymm"] for r in replace.unlisted_folders(spark.read.parquet(path), path, "yyyymm").collect()] == [199707]
    replace.replace_folders(rows, path, "yyyymm", "again", [199707])
    assert replace.unlisted_folders(spark.read.parquet(path), path, "yyyymm").isEmpty()


@pytest.mark.parametrize("name", ["build_training_table_bucketed", "build_training_table_bucketed_repeated"])
def test_training_table_of_buckets_needs_no_shuffle(spark, folder, name):
    text = plan(QUERIES[name](spark, folder))
    assert "hashpartitioning" not in text and "rangepartitioning" not in text and "Window" in text
    assert len(re.findall(r"FileScan parquet", text)) == 2 and text.count("Bucketed: true") == 2


def test_half_years_of_buckets_are_all_that_is_read(spark, folder):
    text = plan(QUERIES["build_training_table_bucketed_repeated"](spark, folder))
    assert len(re.findall(r"PartitionFilters: \[[^\]]*period", text)) == 2


def test_one_file_a_bucket_and_half_year(spark, inputs):
    table = bucketed_narrow(inputs)
    most = table.groupBy("period").agg(F.count_distinct(F.col("_metadata.file_path")).alias("n")).agg(F.max("n")).first()[0]
    assert most <= BUCKETS


def small(spark):
    """Two stations, runs close to midnight, repeated observations, and keys that are missing."""
    late, early = dt.datetime(2020, 6, 30, 20), dt.datetime(2020, 7, 1, 2)
    hour = dt.timedelta(hours=1)
    narrow = [(s, 60.0, 20.0, 5.0, run, run + k * hour, k, p, 280.0 + k + s)
              for s in (1, 2) for run in (late, early) for k in range(7) for p in ("T2m", "RH2m", "S10m", "Gmax", "Q2m", "D10m", "Pmsl", "CClow")]
    narrow += [(None, 60.0, 20.0, 5.0, late, late, 0, "T2m", 280.0), (1, 60.0, 20.0, 5.0, late, None, 9, "T2m", 280.0),
               (1, 60.0, 20.0, 5.0, None, late, 0, "T2m", 280.0)]
    obs = [(1, late + k * hour, 4.0, 60.0, 20.0, 50.0, 7.0 + k, 3.0, 6.0) for k in range(14)]
    obs += [(1, late, 4.0, 60.0, 20.0, 51.0, 8.0, 3.0, 6.0), (1, late + hour, 4.0, 60.0, 20.0, 51.0, None, 3.0, 6.0),
            (None, late, 4.0, 60.0, 20.0, 51.0, 8.0, 3.0, 6.0), (1, None, 4.0, 60.0, 20.0, 51.0, 8.0, 3.0, 6.0)]
    schema = "sid int, validdate timestamp_ntz, obs_elevation double, obs_lat double, obs_lon double, rh_pt1m_avg double, ta_pt1m_avg double, ws_pt10m_avg double, wg_pt1h_max double"
    return spark.createDataFrame(narrow, NARROW_SCHEMA), spark.createDataFrame(obs, schema)


def stored_in_buckets(spark, narrow, obs, reach):
    out = []
    for label, write in (("n", lambda *a: buckets.write_narrow(narrow, *a)), ("o", lambda *a: buckets.write_observations(obs, *a, reach))):
        path = new_folder(spark, f"small-{label}")
        name = "small_" + path.rsplit("-", 1)[-1]
        out.append((write(name, path, 4), name, path))
    return out


def ordered(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def test_runs_across_midnight_and_missing_keys_as_with_joins(spark):
    narrow, obs = small(spark)
    (n, *_), (o, *_) = stored_in_buckets(spark, narrow, obs, 12)
    expected = T.build_training_table(narrow, obs)
    assert expected.count() > 14 and ordered(T.training_table_of_buckets(n, o, 12)) == ordered(expected)
    assert T.training_table_of_buckets(n.limit(0), o, 12).count() == 0
    assert T.training_table_of_buckets(n, o.limit(0), 12).count() == 0


def test_a_forecast_beyond_the_reach_fails(spark):
    narrow, obs = small(spark)
    (n, *_), (o, *_) = stored_in_buckets(spark, narrow, obs, 3)
    with pytest.raises(Exception, match="beyond the reach"):
        T.training_table_of_buckets(n, o, 3).collect()


def test_buckets_open_again_under_another_name(spark):
    narrow, obs = small(spark)
    (n, name, path), (o, _, o_path) = stored_in_buckets(spark, narrow, obs, 12)
    again = buckets.open_table(spark, name + "_again", path, n.schema, 4)
    days = buckets.open_table(spark, name + "_days", o_path, o.schema, 4)
    table = T.training_table_of_buckets(again, days, 12)
    assert "hashpartitioning" not in plan(table)
    assert ordered(table) == ordered(T.build_training_table(narrow, obs))


def test_buckets_grow_with_the_tables(inputs, monkeypatch):
    from fcbias.catalog import tables

    assert tables.n_buckets(inputs) == BUCKETS
    monkeypatch.setattr(tables, "BUCKET_ROWS", 100)
    assert tables.n_buckets(inputs) >= 50


def test_inputs_are_spread_by_rows(spark):
    """Splits by bytes hold millions of rows of a small file; partitions do not, and a small table has one a core."""
    from fcbias.sources.standins import SPREAD_ROWS, spread

    cores, n = spark.sparkContext.defaultParallelism, 8_000_000
    large = spread(spark.range(0, n, 1, cores).toDF("key"), "key")
    held = [r["count"] for r in large.groupBy(F.spark_partition_id().alias("part")).count().collect()]
    assert sum(held) == n and max(held) < 1.1 * SPREAD_ROWS
    assert spread(spark.range(0, 1000, 1, 1), "id").rdd.getNumPartitions() == cores
