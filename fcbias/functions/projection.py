"""Map projections on a sphere as column expressions (Snyder 1987, USGS Professional Paper 1395)."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params as P
from .scalar import col

QUARTER = math.pi / 4


@dataclass(frozen=True)
class Lambert:
    """Lambert conformal conic; latitude of origin is the first standard parallel."""

    latin1: float = P.LATIN1
    latin2: float = P.LATIN2
    lov: float = P.LOV
    radius: float = P.EARTH_RADIUS

    @property
    def cone(self) -> float:
        a, b = math.radians(self.latin1), math.radians(self.latin2)
        if self.latin1 == self.latin2:
            return math.sin(a)
        spread = math.tan(QUARTER + b / 2) / math.tan(QUARTER + a / 2)
        return math.log(math.cos(a) / math.cos(b)) / math.log(spread)

    @property
    def scale(self) -> float:
        a = math.radians(self.latin1)
        return self.radius * math.cos(a) * math.tan(QUARTER + a / 2) ** self.cone / self.cone

    @property
    def rho0(self) -> float:
        return self.scale / math.tan(QUARTER + math.radians(self.latin1) / 2) ** self.cone

    def origin(self, lat: float, lon: float) -> tuple[float, float]:
        """Projected position of one fixed point, used as the false origin of a grid."""
        rho = self.scale / math.tan(QUARTER + math.radians(lat) / 2) ** self.cone
        theta = self.cone * math.radians(lon - self.lov)
        return rho * math.sin(theta), self.rho0 - rho * math.cos(theta)

    def forward(self, lat, lon) -> tuple[Column, Column]:
        rho = F.lit(self.scale) / F.pow(F.tan(F.radians(col(lat)) / 2 + F.lit(QUARTER)), F.lit(self.cone))
        theta = F.radians(col(lon) - F.lit(self.lov)) * F.lit(self.cone)
        return rho * F.sin(theta), F.lit(self.rho0) - rho * F.cos(theta)

    def inverse(self, x, y) -> tuple[Column, Column]:
        up = F.lit(self.rho0) - col(y)
        rho = F.sqrt(col(x) * col(x) + up * up)
        lat = F.degrees(F.atan(F.pow(F.lit(self.scale) / rho, F.lit(1 / self.cone))) * 2) - F.lit(90.0)
        lon = F.degrees(F.atan2(col(x), up) / F.lit(self.cone)) + F.lit(self.lov)
        return lat, lon


@dataclass(frozen=True)
class PolarStereographic:
    """North polar stereographic with a latitude of true scale."""

    lat_ts: float
    lov: float
    radius: float = P.EARTH_RADIUS

    @property
    def scale(self) -> float:
        return self.radius * (1 + math.sin(math.radians(self.lat_ts)))

    def origin(self, lat: float, lon: float) -> tuple[float, float]:
        rho = self.scale * math.tan(QUARTER - math.radians(lat) / 2)
        theta = math.radians(lon - self.lov)
        return rho * math.sin(theta), -rho * math.cos(theta)

    def forward(self, lat, lon) -> tuple[Column, Column]:
        rho = F.lit(self.scale) * F.tan(F.lit(QUARTER) - F.radians(col(lat)) / 2)
        theta = F.radians(col(lon) - F.lit(self.lov))
        return rho * F.sin(theta), -rho * F.cos(theta)

    def inverse(self, x, y) -> tuple[Column, Column]:
        rho = F.sqrt(col(x) * col(x) + col(y) * col(y))
        lat = F.lit(90.0) - F.degrees(F.atan(rho / F.lit(self.scale)) * 2)
        lon = F.degrees(F.atan2(col(x), -col(y))) + F.lit(self.lov)
        return lat, lon


def grid_coordinates(projection, i, j, dx, dy, first_lat: float, first_lon: float) -> tuple[Column, Column]:
    """Latitude and longitude of node (i, j) of a grid whose first node is given."""
    x0, y0 = projection.origin(first_lat, first_lon)
    return projection.inverse(col(i) * dx + F.lit(x0), col(j) * dy + F.lit(y0))


@dataclass(frozen=True)
class ProjectedGrid:
    """A regular grid of a projection: node (i, j) is cell ``j * ni + i``. Steps are in metres, the larger at most four
    times the smaller and at most 100 km, within which a projection bends less than a step."""

    projection: Lambert | PolarStereographic
    ni: int
    nj: int
    dx: float
    dy: float
    first_lat: float
    first_lon: float

    def __post_init__(self):
        small, large = sorted((self.dx, self.dy))
        if not 0 < small <= large <= min(4 * small, 100_000):
            raise ValueError("steps must be positive, of like size and at most 100 km")

    def coordinates(self, i, j) -> tuple[Column, Column]:
        return grid_coordinates(self.projection, i, j, self.dx, self.dy, self.first_lat, self.first_lon)

    def place(self, lat, lon) -> tuple[Column, Column]:
        """Position of a point in steps from the first node along i and along j."""
        x0, y0 = self.projection.origin(self.first_lat, self.first_lon)
        x, y = self.projection.forward(lat, lon)
        return (x - F.lit(x0)) / self.dx, (y - F.lit(y0)) / self.dy

    def nodes(self, spark: SparkSession) -> DataFrame:
        """All nodes: (cell, j, i, lat, lon)."""
        cells = spark.range(self.ni * self.nj).select(F.col("id").cast("int").alias("cell"))
        placed = cells.select("cell", F.floor(F.col("cell") / self.ni).cast("int").alias("j"), (F.col("cell") % self.ni).alias("i"))
        lat, lon = self.coordinates("i", "j")
        return placed.select("cell", "j", "i", lat.alias("lat"), lon.alias("lon"))
