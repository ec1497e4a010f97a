"""The best points of each node as one row a node, found tile by tile.

Spark deals nodes and the points around them by tile; a task then goes through its nodes in boxes of a few hundred and looks at
the points close by first. Pairs of node and point are held a box at a time and are neither sorted nor shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params as P
from ..functions import geo as G
from ..session import sized

# Nodes and points of one tile that one group holds, and nodes of a box.
LIST_NODES, LIST_POINTS, BOX = 16384, 65536, 256
# Pairs in memory at once, and how many times the wanted points a box looks at first.
PAIRS, FIRST = 1_000_000, 4
NODE = ("cell", "cell_lat", "cell_lon", "cell_elev", "cell_land")


def near_lists(points: DataFrame, grid: DataFrame, k: int, radius: float | None = None, counted: DataFrame | None = None,
               by: tuple[str, ...] = ()) -> DataFrame:
    """Nodes with lists of their at most k best points by ``rho``, then by id: one list for each column of the points.

    A tile with many nodes is cut by hash, and so is one with many points: then a node has a row for each part of the
    points, marked ``split``, with the best of the part. ``by`` are columns that nodes and points must share.
    """
    radius = G.search_radius() if radius is None else radius
    # tiles of an eighth of a degree at least, so that a group has work to do
    tiling = G.Tiling.for_radius(radius) if radius >= G.search_radius() else G.Tiling(max(0.125, G.Tiling.fitting(radius).degrees))
    tile = ["ty", "tx", *by]
    nodes = grid.selectExpr("cell", "lat as cell_lat", "lon as cell_lon", "topo as cell_elev", "lc as cell_land", *by)
    right = tiling.own(nodes, "cell_lat", "cell_lon")
    left = tiling.around(points, "lat", "lon")

    def parts(df: DataFrame, per_task: int, name: str) -> DataFrame:
        return df.groupBy(*tile).agg(F.ceil(F.count(F.lit(1)) / per_task).cast("int").alias(name))

    around = tiling.around((points if counted is None or by else counted).select("lat", "lon", *by), "lat", "lon")
    cut = parts(right, LIST_NODES, "node_parts").join(parts(around, LIST_POINTS, "point_parts"), tile, "left")
    cut = cut.withColumn("point_parts", F.coalesce("point_parts", F.lit(1)))
    left = (
        sized(left).join(cut, tile)
        .withColumn("point_part", F.pmod(F.xxhash64("sid"), F.col("point_parts")).cast("int"))
        .withColumn("node_part", F.explode(F.sequence(F.lit(0), F.col("node_parts") - 1)))
        .drop("point_parts", "node_parts")
    )
    right = (
        right.join(cut, tile)
        .withColumn("node_part", F.pmod(F.xxhash64("cell"), F.col("node_parts")).cast("int"))
        .withColumn("point_part", F.explode(F.sequence(F.lit(0), F.col("point_parts") - 1)))
        .withColumn("split", F.col("point_parts") > 1)
        .drop("point_parts", "node_parts")
    )
    key = [*tile, "point_part", "node_part"]
    carried = [c for c in points.columns if c not in by]
    own = [*NODE, *by, "split"]
    fields = [right.schema[c] for c in own] + [T.StructField(c, T.ArrayType(points.schema[c].dataType)) for c in carried]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields] + [T.StructField("rho", T.ArrayType(T.DoubleType()))])

    def search(near: pa.Table, of: pa.Table) -> pa.Table:
        return _lists(of, near, own, carried, k, radius)

    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(search, schema)


def _lists(nodes: pa.Table, points: pa.Table, own: list[str], carried: list[str], k: int, radius: float) -> pa.Table:
    nodes = nodes.combine_chunks()
    # by id, so that the place of a point decides between equal weights
    points = points.take(pc.sort_indices(points, sort_keys=[("sid", "ascending")], null_placement="at_start"))
    complete = ["lat", "lon", "elev", "land"]
    for name in complete:
        points = points.filter(pc.is_valid(points.column(name)))
    points = points.combine_chunks()
    place = np.array([_doubles(points, c) for c in complete])
    node = np.array([_doubles(nodes, c) for c in NODE[1:]])
    known = np.ones(nodes.num_rows, bool)
    for name in NODE[1:]:
        known &= nodes.column(name).is_valid().to_numpy()
    found = np.full((nodes.num_rows, k), -1)
    weight = np.zeros((nodes.num_rows, k))
    if points.num_rows:
        for box in _boxes(node, np.flatnonzero(known & np.isfinite(node[0]) & np.isfinite(node[1]))):
            _search_box(node, place, box, k, radius, found, weight)
    real = found >= 0
    offsets = pa.array(np.concatenate([[0], np.cumsum(real.sum(1))]).astype(np.int32))
    chosen = pa.array(found[real])

    def listed(values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(offsets, values)

    columns = [nodes.column(c) for c in own]
    for name in carried:
        taken = points.column(name).take(chosen)
        columns.append(listed(taken.combine_chunks() if isinstance(taken, pa.ChunkedArray) else taken))
    return pa.Table.from_arrays([*columns, listed(pa.array(weight[real]))], [*own, *carried, "rho"])


def _doubles(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).cast(pa.float64()).to_numpy().astype(float)


def _boxes(node: np.ndarray, rows: np.ndarray) -> Iterator[np.ndarray]:
    """Rows halved along the longer side until at most BOX are left."""
    waiting = [rows] if len(rows) else []
    while waiting:
        some = waiting.pop()
        if len(some) <= BOX:
            yield some
            continue
        lat, lon = node[0, some], node[1, some]
        wide = (lon.max() - lon.min()) * np.cos(np.radians(lat.mean())) > lat.max() - lat.min()
        half = len(some) // 2
        order = np.argpartition(lon if wide else lat, half)
        waiting += [some[order[:half]], some[order[half:]]]


def _distance(lat1: np.ndarray, lon1: np.ndarray, lat2: np.ndarray, lon2: np.ndarray) -> np.ndarray:
    a1, a2 = np.radians(lat1), np.radians(lat2)
    h = np.sin((a2 - a1) / 2) ** 2 + np.cos(a1) * np.cos(a2) * np.sin((np.radians(lon2) - np.radians(lon1)) / 2) ** 2
    return np.arcsin(np.sqrt(np.minimum(1.0, h))) * (2 * P.EARTH_RADIUS)


def _gauss(delta: np.ndarray, scale: float) -> np.ndarray:
    return np.exp((delta / scale) ** 2 * -0.5)


def _search_box(node: np.ndarray, place: np.ndarray, box: np.ndarray, k: int, radius: float, found: np.ndarray, weight: np.ndarray) -> None:
    """Fill in the best points of the nodes of a box, and their weights.

    Points within ``reach`` of every node of the box are compared. A node is done when its k-th weight is larger than the
    horizontal factor at that reach, which no point beyond can have; for the others the reach is widened, up to the radius.
    """
    lat, lon = node[0, box], node[1, box]
    middle = lat[len(box) // 2], lon[len(box) // 2]
    inner = _distance(lat, lon, *middle).max() + 1.0
    away = _distance(*middle, place[0], place[1])
    away[np.isnan(away)] = np.inf
    near = np.flatnonzero(away <= inner + radius)
    if not len(near):
        return
    away = away[near]
    first = min(FIRST * k, len(near)) - 1
    reach = min(max(float(np.partition(away, first)[first]), 1000.0), radius)
    while len(box):
        last = reach >= radius
        some = near[away <= inner + reach] if not last else near
        done = np.zeros(len(box), bool)
        outside = -1 if last else np.floor(np.exp(-0.5 * ((reach - 1.0) / P.BARNES_H) ** 2) * 1e9 + 0.5)
        rows = max(1, PAIRS // max(1, len(some)))
        for low in range(0, len(box), rows):
            part = box[low : low + rows]
            best, rho, least = _best(node[:, part], place[:, some], k, radius)
            done[low : low + rows] = last | (least > outside)
            ended = done[low : low + rows]
            width = best.shape[1]
            found[part[ended], :width] = np.where(best[ended] >= 0, some[best[ended]], -1)
            weight[part[ended], :width] = rho[ended]
        box = box[~done]
        reach = min(reach * 1.6, radius)


def _best(node: np.ndarray, place: np.ndarray, k: int, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of each node's best points among some, their weights, and the k-th weight in steps of 1e-9, -1 without one."""
    n = place.shape[1]
    distance = _distance(place[0], place[1], node[0][:, None], node[1][:, None])
    rho = _gauss(distance, P.BARNES_H) * _gauss(node[2][:, None] - place[2], P.BARNES_V) * _gauss(node[3][:, None] - place[3], P.BARNES_W)
    # as in SQL, a weight that is not a number counts as larger than zero and comes with the last
    steps = np.nan_to_num(np.floor(rho * 1e9 + 0.5), nan=0.0).astype(np.int64)
    order = np.where((distance <= radius) & ~(rho <= 0), steps * n + np.arange(n - 1, -1, -1), -1)
    width = min(k, n)
    if width < n:
        best = np.argpartition(order, n - width, axis=1)[:, n - width :]
        best = np.take_along_axis(best, np.argsort(-np.take_along_axis(order, best, 1), axis=1), 1)
    else:
        best = np.argsort(-order, axis=1)
    chosen = np.take_along_axis(order, best, 1)
    least = np.where(chosen[:, -1] >= 0, chosen[:, -1] // n, -1) if width == k else np.full(len(chosen), -1)
    return np.where(chosen >= 0, best, -1), np.take_along_axis(rho, best, 1), least
