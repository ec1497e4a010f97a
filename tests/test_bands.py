"""Grid messages in bands: what points read, and what they get."""

import glob
import re

import pytest
from pyspark.sql import functions as F

from fcbias.session import new_folder
from fcbias.sources import bands
from fcbias.sources.tables import GRID_SCHEMA, grid_long

NI, NJ = 7, 23


def whole_fields(spark):
    """Two fields at two steps of two days; value = row, column, step and day in its digits; one node is NaN."""
    rows = []
    for p, add in (("t2", 0.0), ("ws", 0.5)):
        for date in (20240701, 20240702):
            for step in (0, 3):
                values = [j * 10000.0 + i * 100 + step * 10 + date % 10 + add for j in range(NJ) for i in range(NI)]
                values[2 * NI + 3] = float("nan")
                rows.append((p, date, 6, step, 0, NI, values))
    return spark.createDataFrame(rows, GRID_SCHEMA)


def at(spark, *places):
    return spark.createDataFrame([(n, j, i) for n, (j, i) in enumerate(places)], "sid int, j int, i int")


def by_long(messages, points):
    return sorted(map(repr, grid_long(messages).join(points, ["j", "i"]).select(
        "sid", "param", "analysistime", "forecasttime", "leadtime", "value").collect()))


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("band_rows", [1, 4, 5, 23, 100])
def test_values_are_those_of_the_long_grid(spark, band_rows):
    messages = whole_fields(spark)
    points = at(spark, (0, 0), (2, 3), (22, 6), (4, 1), (4, 1), (19, 0))
    stored = spark.read.parquet(bands.write_bands(messages, new_folder(spark, "bands"), band_rows))
    expected = by_long(messages, points)
    assert len(expected) == 6 * 8 and rows(bands.sample_bands(stored, points)) == expected
    some = bands.sample_bands(stored, points, ["ws"])
    assert rows(some) == [r for r in expected if "param='ws'" in r]


def test_messages_of_any_rows_are_cut(spark):
    """Pieces that start anywhere, one without values, one of no width."""
    pieces = [("t2", 20240701, 0, 1, first, NI, [float(j * 100 + i) for j in range(first, last) for i in range(NI)]) for first, last in ((0, 3), (3, 11), (11, 23))]
    pieces += [("t2", 20240701, 0, 1, 0, NI, None), ("t2", 20240701, 0, 1, 0, NI, []), ("t2", 20240701, 0, 1, 0, 0, [1.0]), ("t2", 20240701, 0, 1, 0, None, [1.0])]
    messages = spark.createDataFrame(pieces, GRID_SCHEMA)
    stored = spark.read.parquet(bands.write_bands(messages, new_folder(spark, "bands"), 4))
    points = at(spark, *[(j, i) for j in range(NJ) for i in range(NI)])
    got = bands.sample_bands(stored, points).join(points, "sid")
    assert got.count() == NI * NJ and got.where("value != j * 100 + i or value is null").count() == 0


def test_points_off_the_grid_or_without_place_have_no_rows(spark):
    stored = spark.read.parquet(bands.write_bands(whole_fields(spark), new_folder(spark, "bands"), 4))
    points = spark.createDataFrame([(1, -1, 0), (2, 0, -1), (3, NJ, 0), (4, 0, NI), (5, 1000, 2), (6, None, 1), (7, 1, None)], "sid int, j int, i int")
    assert bands.sample_bands(stored, points).count() == 0
    assert bands.sample_bands(stored, at(spark, (0, 0)).limit(0)).count() == 0


def test_other_bands_are_not_opened(spark):
    """Every folder but those of the points is damaged on purpose: only a scan that leaves them out can answer."""
    messages, path = whole_fields(spark), new_folder(spark, "bands")
    bands.write_bands(messages, path, 4)
    stored = spark.read.parquet(path)
    points = at(spark, (5, 1), (6, 2), (22, 0))
    wanted = rows(bands.sample_bands(stored, points))
    for file in glob.glob(f"{path}/**/*.parquet", recursive=True):
        if not re.search(r"rows_of_4=(4|20)/", file):
            with open(file, "wb") as f:
                f.write(b"damaged")
    for crc in glob.glob(f"{path}/**/.*.crc", recursive=True):
        if not re.search(r"rows_of_4=(4|20)/", crc):
            with open(crc, "wb") as f:
                f.write(b"damaged")
    assert len(wanted) == 3 * 8 and rows(bands.sample_bands(stored, points)) == wanted
    with pytest.raises(Exception):
        bands.sample_bands(stored, at(spark, (5, 1), (9, 1))).collect()


def test_plan_prunes_by_the_bands_of_the_points(spark):
    stored = spark.read.parquet(bands.write_bands(whole_fields(spark), new_folder(spark, "bands"), 4))
    text = bands.sample_bands(stored, at(spark, (5, 1)), ["t2"])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*dynamicpruning", text) and "CartesianProduct" not in text and "NestedLoop" not in text
    assert re.search(r"PushedFilters: \[[^\]]*param", text)
