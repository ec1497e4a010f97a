"""From grids and latest observations to corrected grids."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import params as P
from ..functions import scalar as S
from ..operators import interpolation as I
from ..operators import joins as J
from ..operators import model as M
from ..operators import prepare as R
from ..operators import quality as Q
from ..operators import spatial as X
from ..session import sized


def observation_qc(conventional: DataFrame, crowd: DataFrame | None, dem: DataFrame | None, grid: DataFrame, param: str,
                   dem_step: tuple[float, float] = (1000.0, 1000.0)) -> DataFrame:
    """Observations of any number of times, checked, with height and land fraction.

    ``conventional`` has (sid, obstime, lat, lon, elev, wsp and ws or value); ``crowd`` has
    (sid, obstime, arrival, lat, lon, x, y, value), x and y in the raster's projection. With ``analysistime`` in both
    they are of several runs, each checked by itself.
    """
    p, run = P.parameter(param), runs_of(conventional)
    if param == "windspeed":
        conventional = Q.coalesce_wind(conventional).withColumnRenamed("wsp", "value").drop("ws")
    columns = [*run, "sid", "obstime", "lat", "lon", "elev", "value"]
    obs = conventional.select(*columns)
    if crowd is not None and p.crowd:
        first = Q.keep_first(crowd, [*run, "obstime", "lat", "lon"], ["arrival"])
        # places are few compared with reports, so heights are looked up once per place; a site may move
        first = first.withColumn("place", F.xxhash64("x", "y"))
        places = first.select(F.col("place").alias("sid"), "x", "y").distinct()
        heights = X.bilinear(places, dem, *dem_step).select(F.col("sid").alias("place"), F.col("elevation").alias("elev"))
        obs = Q.union_crowd(obs, first.join(heights, "place", "left").select(*columns), param)
    checked = Q.zscore(obs, "value", [*run, "obstime"], "obstime", p.model).where(~F.col("is_outlier")).select(*columns)
    place = F.xxhash64("lat", "lon")
    checked = checked.withColumn("place", place)
    # the places of all observations, so that the check is not planned twice
    places = obs.select(place.alias("sid"), "lat", "lon").distinct()
    land = X.sample_static(X.nearest_cell(places, grid), grid, {"lc": "land"}).select(F.col("sid").alias("place"), "land")
    return checked.join(land, "place", "left").drop("place")


def runs_of(*frames: DataFrame) -> list[str]:
    """The column that tells runs apart, if all frames have it."""
    return [c for c in ("analysistime",) if all(c in df.columns for df in frames)]


def model_units(fields: DataFrame, checked=tuple(P.GRID_FIELDS)) -> DataFrame:
    """All grid fields in the units of the models. The missing sentinel in a checked field fails the job."""
    converted = {n: S.to_model_units(n, n) for n in P.GRID_FIELDS}
    return Q.require_no_sentinel(fields, checked).withColumns(converted)


def feature_table_serve(points: DataFrame, nearest: DataFrame, fields: DataFrame, grid: DataFrame, param: str, names=None) -> DataFrame:
    """Features at points for leads from 1 on, keyed by sid, and by run where the fields have ``analysistime``.

    ``points`` has (sid, lat, lon, elev, value), ``fields`` one column per field in model units and
    the valid time ``forecasttime``. Points with ``analysistime`` are those of one run; without it they serve all runs.
    """
    p, run = P.parameter(param), runs_of(fields)
    own = runs_of(points, fields)
    # fixed values: grid field to feature column
    renamed = {"t2": "t2m", "ws": "s10m", "wg": "gmax", "rh": "rh2m", "wd": "d10m", "nl": "cclow", "ppa": "pmsl", "q2": "q2m"}
    site = (
        nearest.select("sid", "cell")
        .join(sized(points.select(*own, "sid", F.col("lat").alias("obs_lat"), F.col("lon").alias("obs_lon"),
                                  F.col("elev").alias("obs_elevation"), "value")), "sid")
        .join(sized(grid.select("cell", "topo")), "cell")
    )
    sampled = site.join(
        sized(fields.where("leadtime >= 1").select(*run, "cell", "leadtime", "forecasttime", *[F.col(a).alias(b) for a, b in renamed.items()])),
        [*own, "cell"],
    )
    # one window holds the leads of one point of one run
    first_hour = Window.partitionBy(*run, "cell", "sid")
    bias = F.max(F.when(F.col("leadtime") == 1, F.col(p.fc))).over(first_hour) - F.col("value")
    table = sampled.withColumns(
        {"elevd": F.col("topo") - F.col("obs_elevation"), p.bias1: bias, **S.time_features("forecasttime")}
    )
    return R.to_float32(table.select(*run, "sid", *(names or P.FEATURES[p.model])))


def predicted_biases(features: DataFrame, model: PipelineModel, param: str) -> DataFrame:
    """(sid, leadtime, bias) of all points, by run if there are several. Missing features take the trees' other branch; without an observed bias
    lead 1 has none, and the interpolation leaves it out."""
    return M.predict_bias(features, model, param).select(*runs_of(features), "sid", "leadtime", "bias")


def apply_limits(param: str, value, low=None, high=None):
    """Corrected value in model units to the limited value in product units."""
    if param == "temperature":
        return S.clip(S.to_output_units(param, value), low, high)
    return S.to_output_units(param, S.clip(value, *P.OUTPUT_LIMITS[param]))


def finish_grid(background: DataFrame, diff: DataFrame, param: str, usable: DataFrame | None = None) -> DataFrame:
    """Increment to product: limit it, subtract it, convert, limit the result, fill missing.

    ``background`` has (cell, leadtime, forecasttime, value) in model units, and ``analysistime`` where there are several
    runs. With ``usable``, as ``with_fallback`` takes it, the forecast itself is the product where it is not true.
    """
    limited = diff.withColumn("diff", S.clip_diff(param, "diff"))
    corrected = J.join_correction(background, limited)
    if param == "temperature":
        limits = J.temperature_limits(background.sparkSession)
        corrected = corrected.withColumn("month", F.month("forecasttime")).join(F.broadcast(limits), "month", "left")
        final = apply_limits(param, F.col("corrected"), F.col("low"), F.col("high"))
    else:
        final = apply_limits(param, F.col("corrected"))
    product = S.fill_missing(final)
    if usable is not None:
        corrected, ok = _with_ok(corrected, usable)
        product = F.when(ok, product).otherwise(S.to_output_units(param, F.col("value")))
    return corrected.select("cell", *runs_of(background), "leadtime", "forecasttime", product.alias("value"))


def _with_ok(df: DataFrame, usable: DataFrame):
    """The rows, and whether the observations of their run could be used: a scalar, or by run (without a row: no)."""
    run = runs_of(df, usable)
    if not run:
        return df, usable.select("ok").scalar()
    return df.join(usable.select(*run, "ok"), run, "left"), F.coalesce(F.col("ok"), F.lit(False))


def correct_grid(background: DataFrame, points: DataFrame, biases: DataFrame, grid: DataFrame, param: str,
                 counted: DataFrame | None = None, k: int = P.MAX_POINTS, usable: DataFrame | None = None) -> DataFrame:
    """Corrected grids for leads from 1 on, from biases at points, at most ``k`` of them a node."""
    diff = I.oi_analysis(points, biases, grid, k, counted)
    return finish_grid(background.where("leadtime >= 1"), diff, param, usable)


def with_fallback(background: DataFrame, corrected: DataFrame, usable: DataFrame, param: str) -> DataFrame:
    """A corrected field that is there already, or the forecast itself if observations were not usable.

    ``usable`` is one row with ``ok``, or one for each run (a run without one has no observations); as a scalar it is a
    subquery, so with it false the plan still runs but its result is the forecast in product units. ``finish_grid``
    makes the same choice without a join.
    """
    run = runs_of(background)
    raw = background.where("leadtime >= 1").select(
        "cell", *run, "leadtime", "forecasttime", S.to_output_units(param, F.col("value")).alias("raw")
    )
    keys = ["cell", *runs_of(background, corrected), "leadtime"]
    joined, ok = _with_ok(raw.join(sized(corrected.select(*keys, "value")), keys, "left"), usable)
    return joined.select("cell", *run, "leadtime", "forecasttime", F.when(ok, F.col("value")).otherwise(F.col("raw")).alias("value"))
