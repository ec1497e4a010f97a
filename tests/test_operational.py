"""The operational run in small: products, fallback, missing data; and files of several kinds."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from fcbias.catalog import operational as O
from fcbias.operators import interpolation as I
from fcbias.operators import spatial as X
from fcbias.plans import correction as C
from fcbias.plans.operational import operational_run
from fcbias.plans.training import build_training_table
from fcbias.session import stored
from fcbias.sources import tables


def test_run_without_a_producer_is_the_forecast(spark, inputs):
    conventional, crowd = O.latest(inputs, "temperature")
    silent = conventional.withColumn("value", F.when(F.col("producer") == "national", F.col("value")))
    got = operational_run(silent, crowd, inputs.dem(), O.fields(inputs), inputs.grid(), "temperature", O.fading("temperature"), k=1)
    raw = inputs.grid_fc().select("cell", "leadtime", "t2")
    both = got.join(raw, ["cell", "leadtime"])
    assert both.count() == got.count() == 200 * 6
    assert both.where("abs(value - t2) > 1e-9").count() == 0


def test_runs_of_an_archive_are_single_runs(spark, inputs):
    """Twenty points a node: the rows of one call for three runs are those of three calls."""
    conventional, crowd, grids = O.archive(inputs)
    call = lambda *frames: operational_run(frames[0], frames[1], inputs.dem(), frames[2], inputs.grid(), "temperature", O.fading("temperature"))
    key = ["analysistime", "cell", "leadtime"]
    rows = lambda df: {tuple(r[c] for c in key): (round(r["value"], 6), r["step"]) for r in df.collect()}
    together = call(conventional, crowd, grids)
    assert together.count() == 3 * 200 * 6
    alone = {}
    for (start,) in grids.select("analysistime").distinct().collect():
        one = [df.where(F.col("analysistime") == start) for df in (conventional, crowd, grids)]
        alone |= rows(call(one[0].drop("analysistime"), one[1].drop("analysistime"), one[2]))
    assert rows(together) == alone


def test_fallback_of_runs(spark):
    """Two runs, of which one has no usable observations and a third none at all; no row is multiplied."""
    schema = "analysistime string, cell int, leadtime int, forecasttime string, value double"
    background = spark.createDataFrame([(r, 1, 1, "t", 10.0) for r in "abc"], schema)
    corrected = spark.createDataFrame([(r, 1, 1, "t", 7.0) for r in "abc"], schema)
    usable = spark.createDataFrame([("a", True), ("b", False)], "analysistime string, ok boolean")
    got = {r.analysistime: r.value for r in C.with_fallback(background, corrected, usable, "windspeed").collect()}
    assert got == {"a": 7.0, "b": 10.0, "c": 10.0}
    assert C.with_fallback(background, corrected, usable, "windspeed").count() == 3


def test_features_of_runs_do_not_mix(spark, inputs):
    conventional, crowd, grids = O.archive(inputs)
    points = C.observation_qc(conventional, crowd, inputs.dem(), inputs.grid(), "temperature").drop("obstime")
    near = X.nearest_cell(points.select("sid", "lat", "lon").distinct(), inputs.grid())
    both = C.feature_table_serve(points, near, C.model_units(grids), inputs.grid(), "temperature")
    for (start,) in grids.select("analysistime").distinct().collect():
        one = [df.where(F.col("analysistime") == start) for df in (points, grids)]
        alone = C.feature_table_serve(one[0], near, C.model_units(one[1]), inputs.grid(), "temperature")
        assert both.where(F.col("analysistime") == start).exceptAll(alone).isEmpty() and both.where(F.col("analysistime") == start).count() == alone.count() > 0


def test_full_interpolation_stays_near_the_best_point(spark, inputs):
    got = O.run(inputs, "windspeed", O.fading("windspeed"))
    assert got.count() == 200 * 6
    assert got.where("value is null or value < 0 or value > 38").count() == 0


def test_sentinel_stops_the_run(spark, inputs):
    bad = O.fields(inputs).withColumn("rh", F.when(F.col("cell") == 7, 9999.0).otherwise(F.col("rh")))
    with pytest.raises(Exception, match="missing data"):
        C.model_units(bad).select("cell", "t2").collect()
    with pytest.raises(Exception, match="missing data"):
        conventional, crowd = O.latest(inputs, "temperature")
        operational_run(conventional, crowd, inputs.dem(), bad, inputs.grid(), "temperature", O.fading("temperature"), k=1).collect()


def narrow(n=10, **kinds):
    time = pd.Timestamp("2022-07-01 03:00:00")
    df = pd.DataFrame({"sid": range(n), "lat": 60.0, "lon": 20.0, "model_elevation": 1.0, "fcdate": time, "validdate": time,
                       "leadtime": 2, "parameter": "T2m", "value": 280.0})
    return df.astype({"sid": "int32", "leadtime": "int32", **kinds})


def test_files_of_all_kinds_are_merged(spark, tmp_path):
    write = lambda df, name: df.to_parquet(tmp_path / name, coerce_timestamps="us")
    write(narrow(), "a.parquet")
    write(narrow(sid="int64", leadtime="int64"), "b.parquet")
    old = narrow()
    seconds = old.assign(**{c: (old[c].astype("datetime64[s]").astype("int64")) for c in ("fcdate", "validdate")})
    write(seconds, "c.parquet")
    (tmp_path / "d.parquet").write_text("not a table")
    got = tables.merge_files(spark, str(tmp_path))
    assert got.schema == tables.NARROW_SCHEMA
    assert got.count() == 30 and len(got.collect()) == 30
    assert got.select("validdate").distinct().count() == 1
    assert [r["file"].rsplit("/", 1)[1] for r in tables.skipped_files(spark, str(tmp_path)).collect()] == ["d.parquet"]


def test_other_types_are_an_error(spark, tmp_path):
    narrow(value="str").to_parquet(tmp_path / "a.parquet", coerce_timestamps="us")
    with pytest.raises(Exception):
        tables.merge_files(spark, str(tmp_path)).collect()


def test_only_unreadable_files(spark, tmp_path):
    (tmp_path / "d.parquet").write_text("not a table")
    assert tables.merge_files(spark, str(tmp_path)).collect() == []


def test_repeated_observations_multiply(spark, inputs):
    """Two observations at lead 0, two at lead 1: four rows of biases for each row."""
    obs = inputs.obs()
    once, twice = build_training_table(inputs.fc_narrow(), obs), build_training_table(inputs.fc_narrow(), obs.unionAll(obs))
    known = "size(array_compact(array(t0bias, rh0bias, ws0bias, wg0bias))) > 0 and size(array_compact(array(t1bias, rh1bias, ws1bias, wg1bias))) > 0"
    assert twice.where(known).count() == 8 * once.where(known).count() > 0


def test_grids_are_not_broadcast(spark, inputs, folder):
    """The file of a grid passes for a small table, its broadcast fills the driver."""
    from fcbias.catalog import QUERIES

    text = QUERIES["operational_nearest1_gust"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [cell" not in text and "SortMergeJoin [cell" in text


def test_stored_points_are_not_broadcast(spark, inputs):
    """So does the file of checked points, of which three runs have as many as a grid has nodes."""
    points = stored(C.observation_qc(*O.latest(inputs, "temperature"), inputs.dem(), inputs.grid(), "temperature").drop("obstime"), "points")
    near = X.nearest_cell(points.select("sid", "lat", "lon"), inputs.grid())
    features = C.feature_table_serve(points, near, C.model_units(O.fields(inputs)), inputs.grid(), "temperature")
    increments = I.oi_analysis(points, O.fading("temperature")(features), inputs.grid(), k=1)
    for df in (features, increments):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin [sid" not in text and "SortMergeJoin [sid" in text
    assert features.count() == points.count() * 6 and increments.count() > 0
