"""The crowd feed as a stream: the first report of every position per ten-minute window."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P

WINDOW = f"{P.CROWD_MINUTES} minutes"


def first_per_window(feed: DataFrame) -> DataFrame:
    """First report per position and window, for a stream or a table.

    Ordered by time and id, so the result does not depend on arrival. On a stream the watermark
    closes windows and bounds the state to the open ones.
    """
    return (
        feed.withWatermark("ts", WINDOW)
        .groupBy(F.window("ts", WINDOW).alias("w"), "latitude", "longitude")
        .agg(F.min(F.struct("ts", "event_id", "value")).alias("first"))
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "latitude",
            "longitude",
            "first.ts",
            "first.event_id",
            "first.value",
        )
    )


def stations_by_degree(stations: DataFrame) -> DataFrame:
    """Number and mean height of the stations of each square of one degree: (lat_degree, lon_degree, n_stations, height)."""
    degree = [F.floor(f"obs_{c}").cast("int").alias(f"{c}_degree") for c in ("lat", "lon")]
    return stations.groupBy(*degree).agg(F.count(F.lit(1)).alias("n_stations"), F.avg("obs_elevation").alias("height"))


def beside_stations(reports: DataFrame, squares: DataFrame) -> DataFrame:
    """Reports of a stream or table with the stations of their square: a join of the stream with a static table."""
    placed = reports.withColumns({"lat_degree": F.floor("latitude").cast("int"), "lon_degree": F.floor("longitude").cast("int")})
    joined = placed.join(squares, ["lat_degree", "lon_degree"], "left").drop("lat_degree", "lon_degree")
    return joined.withColumn("n_stations", F.coalesce("n_stations", F.lit(0).cast("long")))


@dataclass(frozen=True)
class Summary:
    """Rows that a run of the stream read, and those it dropped because their window had closed before."""

    read: int
    late: int


def run_once(stream: DataFrame, output: str, checkpoint: str) -> Summary:
    """Process what is there and stop; a restart continues from the checkpoint, each row once."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    progress = query.recentProgress
    late = sum(s["numRowsDroppedByWatermark"] for p in progress for s in p["stateOperators"])
    return Summary(sum(p["numInputRows"] for p in progress), late)
