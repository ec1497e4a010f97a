"""Shapes of physical plans that decide how the jobs scale."""

import re

import pytest
from pyspark.sql import functions as F

from fcbias.catalog import ORACLES, QUERIES
from fcbias.catalog.archive import narrow_archive, training_archive
from fcbias.operators import prepare as R
from fcbias.sources import sinks, tables

# what comes before the last plan is done when the query is called: a stream, or minutes of fits
EAGER = {"stream_crowd_window"} | {name for name in ORACLES if name.startswith("published_fit_")}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(ORACLES) - EAGER) + ["oi_weights", "oi_analysis", "correct_grid"])
def test_no_join_of_all_pairs(spark, folder, name):
    text = plan(QUERIES[name](spark, folder))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_filter_and_columns_reach_the_scan(spark, inputs):
    text = plan(tables.read_narrow(spark, narrow_archive(inputs), ["leadtime", "value"], ["T2m"]))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(parameter,T2m\)", text)
    assert "ReadSchema: struct<leadtime:int,parameter:string,value:double>" in text


def test_months_and_periods_prune_folders(spark, inputs):
    months = plan(R.select_months(spark.read.parquet(narrow_archive(inputs)), 199611, 6))
    assert re.search(r"PartitionFilters: \[[^\]]*yyyymm", months)
    periods = plan(tables.read_periods(spark, training_archive(inputs), ["1997q12"]))
    assert re.search(r"PartitionFilters: \[[^\]]*period", periods)


def test_pivot_reads_once_and_combines_before_the_shuffle(spark, folder):
    text = plan(QUERIES["pivot_avg"](spark, folder))
    assert text.count("partial_avg") >= 8 and text.count("hashpartitioning(leadtime") == 1
    assert len(re.findall(r"FileScan.*lineitem", text)) == 1


def test_training_table_reads_each_input_once(spark, folder):
    text = plan(QUERIES["build_training_table"](spark, folder))
    assert len(re.findall(r"FileScan.*lineitem", text)) == 1 and len(re.findall(r"FileScan.*orders", text)) == 1


def test_top_neighbours_are_limited_before_the_shuffle(spark, folder):
    assert "WindowGroupLimit" in plan(QUERIES["topk_neighbours"](spark, folder))


def test_folders_come_out_in_few_files(spark, inputs, tmp_path):
    path = sinks.write_narrow(inputs.fc_narrow(), str(tmp_path / "narrow"))
    files = spark.read.parquet(path).select(F.input_file_name().alias("f"), "yyyymm").distinct()
    assert files.groupBy("yyyymm").count().agg(F.max("count")).first()[0] == 1
