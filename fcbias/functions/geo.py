"""Distances, correlation weights and the tiling that turns distance joins into equi-joins."""

from __future__ import annotations

import math
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params as P
from .scalar import col


def haversine(lat1, lon1, lat2, lon2, radius: float = P.EARTH_RADIUS) -> Column:
    """Great-circle distance in metres."""
    dlat = F.sin((F.radians(col(lat2)) - F.radians(col(lat1))) / 2)
    dlon = F.sin((F.radians(col(lon2)) - F.radians(col(lon1))) / 2)
    h = dlat * dlat + F.cos(F.radians(col(lat1))) * F.cos(F.radians(col(lat2))) * dlon * dlon
    return F.asin(F.sqrt(F.least(F.lit(1.0), h))) * F.lit(2 * radius)


def gauss(delta: Column, scale: float) -> Column:
    ratio = delta / F.lit(scale)
    return F.exp(ratio * ratio * F.lit(-0.5))


def barnes(distance: Column, dz: Column, dland: Column) -> Column:
    """Correlation of two points by distance, height difference and difference of land fraction."""
    return gauss(distance, P.BARNES_H) * gauss(dz, P.BARNES_V) * gauss(dland, P.BARNES_W)


def search_radius(min_rho: float = P.MIN_RHO, scale: float = P.BARNES_H) -> float:
    """Distance at which the horizontal weight falls to ``min_rho``."""
    return scale * math.sqrt(-2 * math.log(min_rho))


class Tiling:
    """Cuts the sphere into rows of some degrees of latitude and, per row, a whole number of columns.

    The columns of a row are wide enough that everything within ``reach`` metres of a point lies in
    the 3 x 3 tiles around it, at any latitude and across the date line. Near a pole a row is one
    tile. ``degrees`` is a number or the name of a column, so that one plan can hold several sizes.
    """

    def __init__(self, degrees: float | str):
        self.degrees = degrees
        self.height = degrees if isinstance(degrees, str) else f"{degrees}D"

    @classmethod
    def for_radius(cls, metres: float) -> Tiling:
        """Whole-degree rows if they suffice, so that the number of tiles is small and known."""
        need = math.degrees(metres / P.EARTH_RADIUS)
        return cls(1.0 if need <= 1.0 else need)

    @classmethod
    def fitting(cls, metres: float) -> Tiling:
        """Rows a little higher than the radius."""
        return cls(math.degrees(metres / P.EARTH_RADIUS) * 1.01)

    def columns_of(self, row: int) -> float:
        """Columns of a row before rounding down; the rule of ``_columns`` for planning and tests."""
        farthest = max(abs(row - 1), abs(row + 2)) * self.degrees
        if farthest + 2 * self.degrees >= 90:
            return 1.0
        return 360 / math.degrees(math.asin(math.sin(math.radians(self.degrees)) / math.cos(math.radians(farthest))))

    @property
    def rows(self) -> range:
        return range(math.floor(-90 / self.degrees), math.floor(90 / self.degrees) + 1)

    @property
    def max_tiles(self) -> int:
        """Upper bound of the number of tiles; independent of the data."""
        return sum(math.floor(self.columns_of(r)) for r in self.rows)

    def _row(self, lat: str) -> str:
        return f"cast(floor({lat} / {self.height}) as int)"

    def _columns(self, row: str) -> str:
        farthest = f"greatest(abs({row} - 1), abs({row} + 2)) * {self.height}"
        width = f"degrees(asin(sin(radians({self.height})) / cos(radians({farthest}))))"
        return f"if({farthest} + 2 * {self.height} >= 90, 1, cast(floor(360D / {width}) as int))"

    def _column(self, lon: str, n: str) -> str:
        return f"least(cast(floor(pmod({lon}, 360D) / 360D * {n}) as int), {n} - 1)"

    def own(self, df: DataFrame, lat: str, lon: str) -> DataFrame:
        """Add the tile (ty, tx) a point lies in."""
        return (
            df.withColumn("ty", F.expr(self._row(lat)))
            .withColumn("_n", F.expr(self._columns("ty")))
            .withColumn("tx", F.expr(self._column(lon, "_n")))
            .drop("_n")
        )

    def around(self, df: DataFrame, lat: str, lon: str) -> DataFrame:
        """One row per tile (ty, tx) of the 3 x 3 block around a point, each tile once."""
        return (
            df.withColumn("_dy", F.expr("explode(array(-1, 0, 1))"))
            .withColumn("ty", F.expr(f"{self._row(lat)} + _dy"))
            .withColumn("_n", F.expr(self._columns("ty")))
            .withColumn("_dx", F.expr("explode(array(-1, 0, 1))"))
            .where("_dx = 0 or _n > 1")
            .withColumn("tx", F.expr(f"pmod({self._column(lon, '_n')} + _dx, _n)"))
            .drop("_dy", "_dx", "_n")
        )

    @property
    def reach(self) -> float:
        return math.radians(self.degrees) * P.EARTH_RADIUS
