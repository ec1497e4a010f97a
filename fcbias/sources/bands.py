"""Grid messages stored in bands of rows, so that points read only the bands they lie in.

Folders are ``data_date`` and ``rows_of_N``, for bands of N rows, by the number of a band's first row; within a file,
messages are in the order of parameter and step, so that a filter on them passes over row groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S

BAND = "rows_of_"


def _rows(values: str = "values") -> Column:
    """Rows of the grid that a message holds."""
    return F.floor(F.size(values) / F.col("ni")).cast("int")


def write_bands(messages: DataFrame, path: str, band_rows: int, mode: str = "errorifexists") -> str:
    """Cut messages, whole fields or bands of any rows, at multiples of ``band_rows`` and write them by band.

    A message without values or without width holds nothing and is left out. Numbers of rows and columns start at zero.
    """
    filled = messages.where((F.col("ni") > 0) & (F.size("values") >= F.col("ni")))
    first = (F.col("first_row") - F.col("first_row") % band_rows).cast("int")
    starts = F.sequence(first, F.col("first_row") + _rows() - 1, F.lit(band_rows))
    band, folders = f"{BAND}{band_rows}", ["data_date", f"{BAND}{band_rows}"]
    cut = filled.withColumn(band, F.explode(starts))
    low = F.greatest(band, "first_row")
    high = F.least(F.col(band) + band_rows, F.col("first_row") + _rows())
    pieces = cut.withColumns({
        "values": F.slice("values", (low - F.col("first_row")) * F.col("ni") + 1, (high - low) * F.col("ni")),
        "first_row": low,
    })
    # a large band of a day is split by AQE, and each part is sorted by itself
    dealt = pieces.hint("rebalance", *folders).sortWithinPartitions(*folders, "param", "data_time", "step")
    dealt.write.mode(mode).partitionBy(*folders).parquet(path)
    return path


def sample_bands(stored: DataFrame, points: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Values of stored bands at points: (sid, param, analysistime, forecasttime, leadtime, value).

    ``points`` hold sid and the node's row ``j`` and column ``i``. The bands with points are known only when the job runs;
    they are broadcast, at most as many as the grid has bands, and other folders are then not opened. A point off the grid
    has no rows, one with a null place neither; a value that is NaN is null; repeated points give rows each.
    """
    band = next(c for c in stored.columns if c.startswith(BAND))
    band_rows = int(band.removeprefix(BAND))
    # the conditions also tell the planner that the bands of points are a selection worth pruning by
    placed = points.select("sid", "j", "i").where("j >= 0 and i >= 0")
    placed = placed.withColumn(band, (F.col("j") - F.col("j") % band_rows).cast("int"))
    bands = F.broadcast(placed.select(band).distinct())
    wanted = stored if names is None else stored.where(F.col("param").isin(list(names)))
    pieces = wanted.join(bands, band, "left_semi")
    row, inside = F.col("j") - F.col("first_row"), F.col("i") < F.col("ni")
    place = (row * F.col("ni") + F.col("i") + 1).cast("int")
    met = pieces.join(placed, band).where(inside & (row >= 0) & (row < _rows()))
    zero = F.lit(0)
    return met.select(
        "sid", "param",
        S.valid_time("data_date", "data_time", zero).alias("analysistime"),
        S.valid_time("data_date", "data_time", "step").alias("forecasttime"),
        F.col("step").alias("leadtime"),
        S.nan_to_null(F.try_element_at("values", place)).alias("value"),
    )
