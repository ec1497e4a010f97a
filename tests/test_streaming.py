"""The crowd feed as a stream: windows that close, rows that come late, a restart."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from fcbias.streaming import crowd as SC

SCHEMA = "event_id long, ts timestamp, latitude double, longitude double, value double"


@pytest.fixture
def feed(spark, tmp_path):
    """Writes files of reports (event_id, minute, latitude, value) and reads them as a stream, a file a batch."""
    folder = tmp_path / "in"
    folder.mkdir()

    def write(name, rows):
        start = pd.Timestamp("2024-01-01", tz="UTC")
        data = pd.DataFrame([(e, start + pd.Timedelta(minutes=m), lat, 10.5, float(v)) for e, m, lat, v in rows], columns=["event_id", "ts", "latitude", "longitude", "value"])
        data.to_parquet(folder / name, coerce_timestamps="us")

    def stream():
        return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder))

    return write, stream


def rows(spark, path):
    return sorted((r.event_id, r.latitude, r.value) for r in spark.read.parquet(path).collect())


FIRST = [(1, 3, 60.5, 1), (2, 1, 60.5, 2), (3, 12, 60.5, 3), (4, 25, 61.5, 4)]
LATER = [(5, 26, 61.5, 5), (6, 2, 60.5, 6), (7, 45, 60.5, 7), (8, 44, 60.5, 8), (9, 90, 60.5, 9)]


def test_late_rows_are_dropped_and_counted(spark, feed, tmp_path):
    write, stream = feed
    write("a.parquet", FIRST)
    first = SC.run_once(SC.first_per_window(stream()), str(tmp_path / "out"), str(tmp_path / "check"))
    assert (first.read, first.late) == (4, 0)
    # the watermark is at minute 15: the window that ends at 10 is closed
    assert rows(spark, str(tmp_path / "out")) == [(2, 60.5, 2.0)]
    write("b.parquet", LATER)
    second = SC.run_once(SC.first_per_window(stream()), str(tmp_path / "out"), str(tmp_path / "check"))
    assert (second.read, second.late) == (5, 1)
    # the window from minute 90 on is open still
    assert rows(spark, str(tmp_path / "out")) == [(2, 60.5, 2.0), (3, 60.5, 3.0), (4, 61.5, 4.0), (8, 60.5, 8.0)]


def test_a_restart_gives_what_one_run_gives(spark, feed, tmp_path):
    write, stream = feed
    write("a.parquet", FIRST)
    SC.run_once(SC.first_per_window(stream()), str(tmp_path / "twice"), str(tmp_path / "check"))
    write("b.parquet", LATER)
    SC.run_once(SC.first_per_window(stream()), str(tmp_path / "twice"), str(tmp_path / "check"))
    again = SC.run_once(SC.first_per_window(stream()), str(tmp_path / "twice"), str(tmp_path / "check"))
    assert again.read == 0
    SC.run_once(SC.first_per_window(stream()), str(tmp_path / "once"), str(tmp_path / "check-once"))
    assert rows(spark, str(tmp_path / "twice")) == rows(spark, str(tmp_path / "once"))


def test_reports_meet_the_stations_of_their_square(spark, feed, tmp_path):
    write, stream = feed
    write("a.parquet", [(1, 1, 60.5, 1), (2, 2, -0.5, 2), (3, 60, 60.5, 3)])
    stations = spark.createDataFrame([(60.1, 10.9, 100.0), (60.9, 10.0, 300.0), (-0.9, 10.2, 7.0), (0.5, 10.5, 9.0)], "obs_lat double, obs_lon double, obs_elevation double")
    joined = SC.beside_stations(SC.first_per_window(stream()), SC.stations_by_degree(stations))
    SC.run_once(joined, str(tmp_path / "out"), str(tmp_path / "check"))
    got = spark.read.parquet(str(tmp_path / "out")).select("event_id", "n_stations", "height").collect()
    assert sorted(map(tuple, got)) == [(1, 2, 200.0), (2, 1, 7.0)]
