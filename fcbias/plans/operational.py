"""Operational runs as one job: observations and grids in, product table out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..operators import joins as J
from ..operators import model as M
from ..operators import quality as Q
from ..operators import spatial as X
from ..session import stored
from . import correction as C

PRODUCERS = ("national", "foreign")


def by_model(model: M.PipelineModel, param: str) -> Callable[[DataFrame], DataFrame]:
    """Biases of a run predicted by a model."""
    return lambda features: C.predicted_biases(features, model, param)


def operational_run(conventional: DataFrame, crowd: DataFrame | None, dem: DataFrame | None, fields: DataFrame, grid: DataFrame,
                    param: str, predict: Callable[[DataFrame], DataFrame], k: int = P.MAX_POINTS) -> DataFrame:
    """Product rows (param, cell, analysistime, forecasttime, step, value, product metadata) of one run or of several.

    ``conventional`` and ``crowd`` are the latest observations as ``observation_qc`` takes them, each site once, the former
    with its ``producer``; ``fields`` is the grid forecast in source units with ``analysistime`` and ``forecasttime``, and
    ``predict`` turns features into (sid, leadtime, bias). A missing value in a field fails the run. Where a producer
    delivers no observation the product is the forecast itself.

    With ``analysistime`` in both tables of observations they are those of an archive of runs, each site once a run and
    at one place, and ``predict`` keeps that column: every run is checked, corrected or left alone by its own
    observations, and the result is the rows of as many single runs.

    Checked points and their biases are stored, since several later steps read them: a few rows a site and run.
    """
    p, run = P.parameter(param), C.runs_of(conventional)
    delivered = Q.coalesce_wind(conventional).withColumnRenamed("wsp", "value") if param == "windspeed" else conventional
    usable = Q.observations_usable(delivered, "value", list(PRODUCERS), tuple(run))
    fields = C.model_units(fields)
    points = stored(C.observation_qc(conventional, crowd, dem, grid, param).drop("obstime"), "points")
    places = points.select("sid", "lat", "lon", "elev", "land")
    places = places.distinct() if run else places
    features = C.feature_table_serve(points, X.nearest_cell(places, grid), fields, grid, param)
    biases = stored(predict(features), "biases")
    background = fields.select("cell", "analysistime", "leadtime", "forecasttime", F.col(p.field).alias("value"))
    final = C.correct_grid(background, places, biases, grid, param, k=k, usable=usable)
    return J.product_table(final.withColumn("param", F.lit(param)))
