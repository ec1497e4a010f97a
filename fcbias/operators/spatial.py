"""Nearest nodes, neighbours within a radius and interpolation from a raster.

Points are rows of (sid, lat, lon, ...), nodes are rows of (cell, lat, lon, ...) with ``cell`` a number
of 32 bits from zero on. Distance joins are equi-joins on tiles with the distance as a residual filter.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import params as P
from ..functions import geo as G
from ..functions.projection import ProjectedGrid
from ..session import sized, stored

# Tile sizes in degrees for the search of the nearest node, each at least five times the one before. At
# the last one the block around a point is the whole sphere.
NEAREST_LEVELS = (0.02, 0.1, 0.5, 2.5, 12.5, 62.5, 200.0)
# Place among them from which on a point counts as far from the grid: no node within half a degree at least. In a grid of
# MANY nodes and more a block of half a degree holds thousands, so points look in boxes from FAR_OF_MANY on.
FAR, FAR_OF_MANY, MANY = 3, 1, 200_000
# Sizes in degrees of the boxes in which far points look for their node.
BOXES = (2.5, 0.5, 0.1, 0.02)
# Rings around a node, down to a 128th of the radius; how many times the wanted points the first should hold, and from
# how many times of them in a tile of one degree on rings are worth their jobs.
RINGS, RING_FILL, RING_WORTH = 8, 4, 25
# Points and nodes of one tile that one task joins, and pairs that a task compares.
TASK_POINTS, TASK_NODES, TASK_PAIRS = 4096, 16384, 1 << 23


def nearest_cell(points: DataFrame, grid: DataFrame) -> DataFrame:
    """Nearest node of every point: (sid, cell, distance); equal centimetres go to the lowest cell.

    First the smallest tiles are found at which the 3 x 3 block around a point holds any node. That
    node is less than five tile heights away, so one level up the block is sure to hold the nearest
    one, and only its nodes are compared. Where tiles span a whole row, near the poles, the search
    goes two levels up. Points far from all nodes would meet whole grids in this way; they narrow the
    block down by boxes instead (``_far_candidates``). It is exact and joins on tiles throughout.
    """
    sizes = ", ".join(f"{degrees}D" for degrees in NEAREST_LEVELS)
    tiling = G.Tiling("degrees")
    tiles = ["level", "ty", "tx"]

    def at_all_levels(df: DataFrame) -> DataFrame:
        return df.select("*", F.expr(f"posexplode(array({sizes})) as (level, degrees)"))

    nodes = grid.select("cell", F.col("lat").alias("cell_lat"), F.col("lon").alias("cell_lon"))
    tiled = tiling.own(at_all_levels(nodes), "cell_lat", "cell_lon").drop("degrees")
    inhabited = tiled.select(*tiles).distinct()
    level = (
        tiling.around(at_all_levels(points.select("sid", "lat", "lon")), "lat", "lon")
        .join(sized(inhabited), tiles, "left_semi")
        .groupBy("sid", "lat", "lon")
        .agg(F.min("level").alias("smallest"))
        .withColumn("polar", F.expr(f"abs(lat) >= 90 - 6 * element_at(array({sizes}), smallest + 1)"))
        .withColumn("level", F.expr(f"least(smallest + if(polar, 2, 1), {len(NEAREST_LEVELS) - 1})"))
        .withColumn("degrees", F.expr(f"element_at(array({sizes}), level + 1)"))
    )
    far_from = FAR if nodes.count() < MANY else FAR_OF_MANY
    # a row a point; boxes are planned only where a point is far
    level = stored(level, "levels")
    centimetres = F.floor(G.haversine("lat", "lon", "cell_lat", "cell_lon") * 100 + 0.5)
    # distance and node in one number: its minimum is aggregated by hash, where a struct would be sorted
    packed = F.shiftleft(centimetres, 32) + F.col("cell")
    place = ["sid", "lat", "lon"]

    def block(of: DataFrame) -> DataFrame:
        return tiling.around(of.select(*place, "level", "degrees"), "lat", "lon")

    columns = [*place, "cell", "cell_lat", "cell_lon"]
    candidates = block(level.where(F.col("smallest") < far_from)).join(sized(tiled.where(f"level between 1 and {far_from + 1}")), tiles).select(*columns)
    distant = level.where(F.col("smallest") >= far_from)
    if not distant.isEmpty():
        far = _far_candidates(block(distant), tiled.where(F.col("level") > far_from), nodes)
        candidates = candidates.unionByName(far.select(*columns))
    return (
        candidates.groupBy("sid")
        .agg(F.min(packed).alias("best"))
        .select(
            "sid",
            F.expr("cast(best & 4294967295 as int)").alias("cell"),
            (F.shiftright("best", 32) / 100).alias("distance"),
        )
    )


def nearest_on_grid(points: DataFrame, grid: ProjectedGrid) -> DataFrame:
    """Nearest node of a regular projected grid, as ``nearest_cell`` gives it, by arithmetic.

    The projected point, rounded, is a node; the nearest on the sphere is that or one of the eight around it, whose
    positions are worked out in the same row: no join, no shuffle. Points more than half a step outside the grid are
    searched by tiles. Points without a position have no row.
    """
    along, up = grid.place("lat", "lon")
    placed = points.where("lat is not null and lon is not null").select("sid", "lat", "lon", along.alias("along"), up.alias("up"))
    inside = F.col("along").between(-0.5, grid.ni - 0.5) & F.col("up").between(-0.5, grid.nj - 0.5)
    inside = F.coalesce(inside, F.lit(False))
    packed = []
    for dj in (-1, 0, 1):
        for di in (-1, 0, 1):
            i, j = F.rint("along").cast("int") + di, F.rint("up").cast("int") + dj
            cell_lat, cell_lon = grid.coordinates(i, j)
            centimetres = F.floor(G.haversine("lat", "lon", cell_lat, cell_lon) * 100 + 0.5)
            number = F.shiftleft(centimetres, 32) + (j * grid.ni + i)
            packed.append(F.when(i.between(0, grid.ni - 1) & j.between(0, grid.nj - 1), number))
    near = placed.where(inside).select("sid", F.least(*packed).alias("best")).select(
        "sid", F.expr("cast(best & 4294967295 as int)").alias("cell"), (F.shiftright("best", 32) / 100).alias("distance"))
    outside = placed.where(~inside).select("sid", "lat", "lon")
    if outside.isEmpty():
        return near
    return near.unionByName(nearest_cell(outside, grid.nodes(points.sparkSession)))


def _far_candidates(block: DataFrame, tiled: DataFrame, nodes: DataFrame) -> DataFrame:
    """Nodes that can be nearest to points far from the grid, among those of the tiles of ``block``.

    The nodes are gathered in nested boxes of 2.5 degrees and less. The distance to a box's centre and its radius
    bound the distance to its nodes from both sides, so at each size only boxes that may hold the nearest node are
    opened: how many depends on the distance, hardly on how dense the grid is.
    """
    place, tiles = ["sid", "lat", "lon"], ["level", "ty", "tx"]

    def boxed(df: DataFrame, degrees: float, name: str) -> DataFrame:
        return df.withColumns({f"{name}{axis}": F.floor(F.col(f"cell_{c}") / degrees).cast("int") for axis, c in (("y", "lat"), ("x", "lon"))})

    def bounds(df: DataFrame, keys: list[str]) -> DataFrame:
        edges = df.groupBy(*keys).agg(*[f(f"cell_{c}").alias(f"{c}{n}") for c in ("lat", "lon") for n, f in ((0, F.min), (1, F.max))])
        half = (F.radians(F.col("lat1") - F.col("lat0")) + F.radians(F.col("lon1") - F.col("lon0"))) / 2
        return edges.select(
            *keys, ((F.col("lat0") + F.col("lat1")) / 2).alias("mid_lat"), ((F.col("lon0") + F.col("lon1")) / 2).alias("mid_lon"),
            # a metre more than needed, for the rounding of distances
            (half * P.EARTH_RADIUS + 1.0).alias("reach"),
        )

    def possible(candidates: DataFrame) -> DataFrame:
        measured = candidates.withColumn("middle", G.haversine("lat", "lon", "mid_lat", "mid_lon"))
        # a window holds the boxes of one point, at most as many as the sphere has at the first size
        surest = F.min(F.col("middle") + F.col("reach")).over(Window.partitionBy("sid"))
        kept = measured.withColumn("surest", surest).where(F.col("middle") - F.col("reach") <= F.col("surest"))
        return kept.select(*place, "by", "bx").distinct()

    # at most four tiles a box, three levels and 10,368 boxes: 124,416 rows of 48 bytes; some more with tiles of half a degree
    widest = bounds(boxed(tiled, BOXES[0], "b"), [*tiles, "by", "bx"])
    found = possible(sized(block).join(widest, tiles))
    for outer, inner in zip(BOXES, BOXES[1:]):
        opened = bounds(boxed(boxed(nodes, outer, "o"), inner, "b"), ["oy", "ox", "by", "bx"])
        found = possible(found.withColumnsRenamed({"by": "oy", "bx": "ox"}).join(sized(opened), ["oy", "ox"]))
    return found.join(sized(boxed(nodes, BOXES[-1], "b")), ["by", "bx"])


def sample_fields(nearest: DataFrame, fields: DataFrame, names: list[str]) -> DataFrame:
    """Fields at the nearest node of every point for all leads, one row per (sid, leadtime)."""
    return nearest.select("sid", "cell").join(sized(fields.select("cell", "leadtime", *names)), "cell").drop("cell")


def grid_fields_wide(long: DataFrame, names=tuple(P.GRID_FIELDS)) -> DataFrame:
    """Long grid (param, cell, leadtime, value) to one column per field."""
    values = [F.max(F.when(F.col("param") == n, F.col("value"))).alias(n) for n in names]
    return long.where(F.col("param").isin(list(names))).groupBy("cell", "leadtime").agg(*values)


def sample_static(nearest: DataFrame, grid: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Static fields of the nearest node, renamed."""
    chosen = [F.col(c).alias(name) for c, name in columns.items()]
    return nearest.select("sid", "cell").join(sized(grid.select("cell", *chosen)), "cell", "left").drop("cell")


def bilinear(points: DataFrame, raster: DataFrame, dx: float, dy: float, x0: float = 0.0, y0: float = 0.0) -> DataFrame:
    """Raster value at points (sid, x, y) from the four nodes around them; outside it is missing.

    A corner of weight zero need not exist, so that points on the last row or column have a value.
    """
    fx, fy = (F.col("x") - x0) / dx, (F.col("y") - y0) / dy
    base = points.select("sid", F.floor(fx).cast("int").alias("bx"), F.floor(fy).cast("int").alias("by"),
                         (fx - F.floor(fx)).alias("u"), (fy - F.floor(fy)).alias("v"))
    u, v = F.col("u"), F.col("v")
    corners = F.array(
        *[
            F.struct(
                (F.col("bx") + i).alias("ix"),
                (F.col("by") + j).alias("iy"),
                ((u if i else 1 - u) * (v if j else 1 - v)).alias("weight"),
            )
            for i in (0, 1)
            for j in (0, 1)
        ]
    )
    exploded = base.select("sid", F.inline(corners)).where("weight > 0")
    weighed = (
        exploded.join(sized(raster.select("ix", "iy", "z")), ["ix", "iy"], "left")
        .groupBy("sid")
        .agg(
            F.sum(F.col("weight") * F.col("z")).alias("total"),
            F.count_if(F.col("z").isNull()).alias("n_missing"),
        )
    )
    return weighed.select("sid", F.when(F.col("n_missing") == 0, F.col("total")).alias("elevation"))


def ring_radii(radius: float) -> list[float]:
    """Radii of the rings in which best points are searched, from the whole radius on, each half the one before."""
    return [radius / 2**i for i in range(RINGS)]


def crowded_tiles(points: DataFrame, k: int) -> DataFrame:
    """Tiles of one degree, at most 40,051, in which rings are worth their jobs."""
    return G.Tiling(1.0).own(points, "lat", "lon").groupBy("ty", "tx").agg(F.count(F.lit(1)).alias("n_points")).where(F.col("n_points") >= RING_WORTH * k)


def first_rings(points: DataFrame, grid: DataFrame, k: int, radius: float) -> DataFrame:
    """The nodes with the ``ring`` to begin with: the smallest that the density in the node's own tile fills with
    RING_FILL times k points, by tiles of one degree with RING_WORTH times k points, and by tiles of an eighth of a
    degree with k points in these.

    It only decides where the search begins. Tiles of a degree are 40,051 at most, whose counts are broadcast.
    """
    nodes = grid.withColumn("ring", F.lit(0))
    for degrees, fewest in ((1.0, RING_WORTH * k), (0.125, k)):
        tiling = G.Tiling(degrees)
        counts = tiling.own(points, "lat", "lon").groupBy("ty", "tx").agg(F.count(F.lit(1)).alias("n_points")).where(F.col("n_points") >= fewest)
        # a tile is about as wide as high, at any latitude
        per_disk = math.pi * (radius / tiling.reach) ** 2 / (RING_FILL * k)
        filled = F.coalesce(F.floor(F.log2(F.col("n_points") * per_disk) / 2).cast("int"), F.lit(0))
        ring = F.least(F.lit(RINGS - 1), filled)
        ring = ring if degrees == 1.0 else F.when(F.col("ring") > 0, ring)
        placed = tiling.own(nodes, "lat", "lon").join(F.broadcast(counts) if degrees == 1.0 else counts, ["ty", "tx"], "left")
        nodes = placed.withColumn("ring", F.greatest("ring", F.coalesce(ring, F.lit(0)))).drop("ty", "tx", "n_points")
    return nodes


def neighbours(points: DataFrame, grid: DataFrame, radius: float | None = None, counted: DataFrame | None = None) -> DataFrame:
    """All points within a radius of each node, with the distance in metres.

    Tiles are counted first. A tile with many points or nodes is cut into parts by hash, every part
    of its points meeting every part of its nodes in a task of its own, so that a crowded place is
    joined by many tasks. The pairs to compare, and not the few bytes that are shuffled for them, say
    how many tasks there are. The tile table has at most as many rows as the sphere has tiles. Where
    ``points`` is itself costly, ``counted`` may be any cheaper table of the same positions; it only
    decides into how many parts the work is cut. Radii below the search radius have tiles of their own size.
    """
    fine = radius is not None and radius < G.search_radius()
    radius = G.search_radius() if radius is None else radius
    tiling = G.Tiling.fitting(radius) if fine else G.Tiling.for_radius(radius)
    left = tiling.around(points, "lat", "lon")
    nodes = grid.selectExpr("cell", "lat as cell_lat", "lon as cell_lon", "topo as cell_elev", "lc as cell_land")
    right = tiling.own(nodes, "cell_lat", "cell_lon")
    tiles = stored(_tile_parts(tiling.around((points if counted is None else counted).select("lat", "lon"), "lat", "lon"), right), "tiles")
    tasks = max(1, math.ceil((tiles.agg(F.sum("pairs")).first()[0] or 0) / TASK_PAIRS))
    tiles = tiles.drop("pairs")
    # tiles of one degree or more are 40,051 at most, of 24 bytes each; smaller ones can be many
    tiles = tiles if fine else F.broadcast(tiles)
    key = ["ty", "tx", "point_part", "node_part"]
    left = (
        left.join(tiles, ["ty", "tx"])
        .withColumn("point_part", F.pmod(F.xxhash64("sid"), F.col("point_parts")).cast("int"))
        .withColumn("node_part", F.explode(F.sequence(F.lit(0), F.col("node_parts") - 1)))
        .drop("point_parts", "node_parts")
    )
    right = (
        right.join(tiles, ["ty", "tx"])
        .withColumn("node_part", F.pmod(F.xxhash64("cell"), F.col("node_parts")).cast("int"))
        .withColumn("point_part", F.explode(F.sequence(F.lit(0), F.col("point_parts") - 1)))
        .drop("point_parts", "node_parts")
    )
    # partitions of a given number are not put together by their bytes
    near = left.repartition(tasks, *key).join(sized(right.repartition(tasks, *key)), key)
    near = near.withColumn("distance", G.haversine("lat", "lon", "cell_lat", "cell_lon"))
    return near.where(F.col("distance") <= radius).drop(*key)


def _tile_parts(left: DataFrame, right: DataFrame) -> DataFrame:
    """Tiles that hold nodes, into how many parts each side is cut, and their ``pairs``; one part without points."""

    def counts(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("ty", "tx").agg(F.count(F.lit(1)).alias(name))

    def parts(name: str, per_task: int) -> Column:
        return F.greatest(F.ceil(F.col(name) / per_task), F.lit(1)).cast("int")

    both = counts(right, "n_nodes").join(counts(left, "n_points"), ["ty", "tx"], "left").withColumn("n_points", F.coalesce("n_points", F.lit(0)))
    return both.select("ty", "tx", parts("n_nodes", TASK_NODES).alias("node_parts"), parts("n_points", TASK_POINTS).alias("point_parts"),
                       (F.col("n_points") * F.col("n_nodes")).alias("pairs"))


def top_neighbours(weighted: DataFrame, k: int = P.MAX_POINTS, node: tuple[str, ...] = ("cell",)) -> DataFrame:
    """At most k points per node by descending weight ``rho``, then by id, with their ``rank``.

    Weights that agree to nine digits count as equal, so that the last bits of the arithmetic do not
    decide. Spark limits every task to k rows per node before the shuffle.
    """
    order = Window.partitionBy(*node).orderBy(F.floor(F.col("rho") * 1e9 + 0.5).desc(), "sid")
    return weighted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
