"""Optimal interpolation of biases from points to nodes (Gandin 1963, Barnes 1964, Daley 1991).

The background is zero and the error variance ratio a constant, so the weights depend only on which points have a bias.
The candidates of a node are found once for all leads of all runs, by widening rings, and the equations of its best
points are inverted once for a block of them. Where a lead or run lacks some of these points, the inverse is downdated by
the points that are missing and bordered by the next best ones (Schur complements).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params as P
from ..functions import geo as G
from ..session import sized, stored
from . import lists, spatial
from .aggregates import with_place

WEIGHT_SCHEMA = "cell int, sid array<int>, weight array<double>"
# Nodes per Arrow batch in the solver: a batch of systems of 20 equations takes a few megabytes.
NODES_PER_BATCH = 512
# Leads of runs that are solved together, and equations that are changed at a time.
SCENES, CHANGED = 64, 2048
# Columns of a grid that the search reads, in the order of ``lists.NODE``.
NODE_COLUMNS = ("cell", "lat", "lon", "topo", "lc")


def barnes_weights(points: DataFrame, grid: DataFrame, counted: DataFrame | None = None, radius: float | None = None,
                   best: int | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Points near each node with the correlation ``rho`` of node and point.

    Points are rows of (sid, lat, lon, elev, land); points without a bias are to be left out before. With ``best`` the
    pairs are not given as rows but only the best ones of each node as lists, as ``lists.near_lists`` finds them.
    """
    if best is not None:
        return lists.near_lists(points, grid, best, radius, counted, by)
    near = spatial.neighbours(points, grid, radius, counted)
    rho = G.barnes(F.col("distance"), F.col("cell_elev") - F.col("elev"), F.col("cell_land") - F.col("land"))
    return near.withColumn("rho", rho).where(F.col("rho") > 0)


def best_lists(points: DataFrame, grid: DataFrame, k: int = P.MAX_POINTS, counted: DataFrame | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """The rows of ``barnes_weights`` that ``top_neighbours`` keeps, as one row a node with a list for each column.

    A node begins with the ring that the density around it fills. It is done when its k-th weight is larger than the
    horizontal factor at the ring's edge, which no point outside can reach; else it goes on to the ring of twice the
    radius, up to the whole one. So crowded places meet the points close by only. Where no tile is dense enough for a
    ring, this is one search of the whole radius. Each ring stores a row a node. Nodes that share a number are searched
    over the whole radius and their points put together. ``by`` are columns that points and nodes must share.
    """
    radius, node = G.search_radius(), ["cell", *by]
    places = points if counted is None else counted
    if not grid.groupBy(*node).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        rows = list_rows(barnes_weights(points, grid, counted, best=k, by=by))
        top = spatial.top_neighbours(rows, k, tuple(node))
        names = ["rank", *(c for c in top.columns if c not in ("rank", *lists.NODE, *by))]
        packed = top.groupBy(*node).agg(F.array_sort(F.collect_list(F.struct(*names))).alias("points"))
        return packed.select(*node, *[F.col(f"points.{c}").alias(c) for c in names[1:]])
    if k * spatial.RING_WORTH * 9 < lists.LIST_POINTS and spatial.crowded_tiles(places, k).isEmpty():
        return barnes_weights(points, grid, counted, best=k, by=by).where(F.size("rho") > 0)
    points = stored(points, "points")
    started = spatial.first_rings(places, grid, k, radius)
    present = sorted((r.ring for r in started.select("ring").distinct().collect()), reverse=True)  # RINGS rows at most
    found, waiting = None, None
    for ring, edge in reversed(list(enumerate(spatial.ring_radii(radius)))):
        nodes = started.select(*NODE_COLUMNS, *by, "ring").where(F.col("ring") == ring).drop("ring") if ring in present or not (ring or present) else None
        nodes = waiting if nodes is None else nodes if waiting is None else nodes.unionByName(waiting)
        if nodes is None:
            continue
        best = stored(barnes_weights(points, nodes, counted, edge if ring else None, k, by), "ring")
        if not best.where("split").isEmpty():
            best = best.where("not split").unionByName(_of_parts(best.where("split"), k, by))
        if ring:
            outside = int(np.floor(np.exp(-0.5 * (edge / P.BARNES_H) ** 2) * 1e9 + 0.5))
            least = F.floor(F.try_element_at("rho", F.lit(k)) * 1e9 + 0.5)
            done = F.coalesce(least > outside, F.lit(False))
            left = best.where(~done).select("cell", *[F.col(c).alias(n) for c, n in zip(lists.NODE[1:], NODE_COLUMNS[1:])], *by)
            waiting = None if left.isEmpty() else left
            best = best.where(done)
        found = best if found is None else found.unionByName(best)
    return found.where(F.size("rho") > 0)


def _of_parts(found: DataFrame, k: int, by: tuple[str, ...]) -> DataFrame:
    """The best points of each node from its lists of the parts of a crowded tile, k points a part."""
    node = [*lists.NODE, *by, "split"]
    names = [c for c in found.columns if c not in node]
    parts = found.withColumn("points", F.arrays_zip(*names)).groupBy(*node).agg(F.flatten(F.collect_list("points")).alias("points"))
    ordered = F.transform("points", lambda p: F.struct((-F.floor(p["rho"] * 1e9 + 0.5)).alias("_order"), p["sid"].alias("_sid"), p.alias("_p")))
    parts = parts.withColumn("points", F.slice(F.array_sort(ordered), 1, k))
    return parts.select(*node, *[F.col(f"points._p.{c}").alias(c) for c in names])


def list_rows(found: DataFrame, k: int | None = None) -> DataFrame:
    """Lists as rows, with their ``rank`` from 1 on and no more than k a node."""
    names = [f.name for f in found.schema if isinstance(f.dataType, T.ArrayType)]
    points = found.where(F.size("rho") > 0).withColumn("rank", F.sequence(F.lit(1), F.size("rho")))
    zipped = F.arrays_zip(*names, "rank")
    zipped = zipped if k is None else F.slice(zipped, 1, k)
    return points.select(*[c for c in found.columns if c not in (*names, "split")], F.inline(zipped))


def best_points(points: DataFrame, grid: DataFrame, k: int = P.MAX_POINTS, counted: DataFrame | None = None) -> DataFrame:
    """The rows of ``barnes_weights`` that ``top_neighbours`` keeps, searched as ``best_lists`` does."""
    nodes = grid.select("cell", *[F.col(n).alias(c) for c, n in zip(lists.NODE[1:], NODE_COLUMNS[1:])])
    rows = list_rows(best_lists(points, grid, k, counted)).drop("rank")
    if "cell_lat" not in rows.columns:
        rows = rows.join(sized(nodes.dropDuplicates(["cell"])), "cell")
    near = rows.withColumn("distance", G.haversine("lat", "lon", "cell_lat", "cell_lon"))
    return spatial.top_neighbours(near, k)


def _best(weighted: DataFrame, k: int, node: tuple[str, ...] = ("cell",)) -> DataFrame:
    """The k best points of each node as rows, from all pairs or from lists of at least as many."""
    return list_rows(weighted, k) if _listed(weighted) else spatial.top_neighbours(weighted, k, node)


def _listed(weighted: DataFrame) -> bool:
    return isinstance(weighted.schema["rho"].dataType, T.ArrayType)


def oi_nearest1(weighted: DataFrame) -> DataFrame:
    """Increment with the best point alone, from pairs or lists."""
    one = _best(weighted, 1)
    return one.select("cell", (F.col("rho") * F.col("bias") / (1 + P.VARIANCE_RATIO)).alias("diff"))


def oi_pair2(weighted: DataFrame) -> DataFrame:
    """Increment with the two best points by the closed inverse of the 2 x 2 system."""
    two = _best(weighted, 2)

    def at(rank: int, name: str):
        return F.max(F.when(F.col("rank") == rank, F.col(name))).alias(f"{name}{rank}")

    names = ["rho", "bias", "lat", "lon", "elev", "land"]
    pair = two.groupBy("cell").agg(*[at(r, n) for r in (1, 2) for n in names])
    between = G.barnes(
        G.haversine("lat1", "lon1", "lat2", "lon2"), F.col("elev1") - F.col("elev2"), F.col("land1") - F.col("land2")
    )
    a = F.lit(1 + P.VARIANCE_RATIO)
    both = pair.withColumn("r", between)
    rho1, rho2, b1, b2, r = (F.col(c) for c in ("rho1", "rho2", "bias1", "bias2", "r"))
    joint = ((a * rho1 - r * rho2) * b1 + (a * rho2 - r * rho1) * b2) / (a * a - r * r)
    return both.select("cell", F.when(rho2.isNull(), rho1 * b1 / a).otherwise(joint).alias("diff"))


def oi_weights(weighted: DataFrame, k: int = P.MAX_POINTS, packed: bool = False) -> DataFrame:
    """Weight of each of at most k points at each node: (cell, sid, weight), by ``set`` too if there is one.

    The points of a node are packed into one row, at most k of them, so the solver sees batches of
    nodes and no group can outgrow a task. ``weighted`` are pairs, or lists of k points at least. With ``packed`` the
    result stays one row a node, with lists of sid, weight and the columns that the solver read.
    """
    node, names = [c for c in ("set", "cell") if c in weighted.columns], ["sid", "rho", "lat", "lon", "elev", "land"]
    if _listed(weighted):
        rows = weighted.select(*node, *[F.slice(c, 1, k).alias(c) for c in names])
    else:
        members = F.array_sort(F.collect_list(F.struct("rank", *names))).alias("points")
        rows = spatial.top_neighbours(weighted, k, tuple(node)).groupBy(*node).agg(members).select(*node, *[F.col(f"points.{c}").alias(c) for c in names])
    schema = "set long, " * ("set" in node) + WEIGHT_SCHEMA
    if packed:
        schema += "".join(f", {c} array<double>" for c in names[1:])
    solved = rows.mapInPandas(lambda batches: _solve_batches(batches, names[1:] if packed else []), schema)
    return solved if packed else solved.select(*node, F.inline(F.arrays_zip("sid", "weight")))


def _solve_batches(batches: Iterator[pd.DataFrame], kept: list[str]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for start in range(0, len(batch), NODES_PER_BATCH):
            yield _solve(batch.iloc[start : start + NODES_PER_BATCH], kept)


def _solve(nodes: pd.DataFrame, kept: list[str]) -> pd.DataFrame:
    """Solve (P_oo + ratio I) w = rho for a batch of nodes, padded to the longest one.

    Padding points are uncorrelated with everything, so their rows are an identity and weigh nothing.
    """
    sizes = nodes["sid"].map(len).to_numpy()
    valid = np.arange(sizes.max()) < sizes[:, None]

    def padded(name: str) -> np.ndarray:
        out = np.zeros(valid.shape)
        out[valid] = np.concatenate(nodes[name].to_numpy())
        return out

    covariance = _covariance(*(padded(c) for c in ("lat", "lon", "elev", "land")), valid)
    weights = np.linalg.solve(covariance, padded("rho")[:, :, None])[:, :, 0]
    return pd.DataFrame(
        {
            **{c: nodes[c].to_numpy() for c in ("set", "cell") if c in nodes},
            "sid": nodes["sid"].to_numpy(),
            "weight": [w[:n] for w, n in zip(weights, sizes)],
            **{c: nodes[c].to_numpy() for c in kept},
        }
    )


def _covariance(lat: np.ndarray, lon: np.ndarray, elev: np.ndarray, land: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """Covariances of the points of each node, with the error variance on the diagonal; none with padding points."""
    lat, lon = np.radians(lat), np.radians(lon)
    between = lambda v: v[:, :, None] - v[:, None, :]
    h = np.sin(between(lat) / 2) ** 2 + np.cos(lat)[:, :, None] * np.cos(lat)[:, None, :] * np.sin(between(lon) / 2) ** 2
    distance = 2 * P.EARTH_RADIUS * np.arcsin(np.sqrt(np.minimum(1.0, h)))
    exponent = (distance / P.BARNES_H) ** 2 + (between(elev) / P.BARNES_V) ** 2 + (between(land) / P.BARNES_W) ** 2
    covariance = np.exp(-0.5 * exponent) * (valid[:, :, None] & valid[:, None, :])
    diagonal = np.arange(valid.shape[1])
    covariance[:, diagonal, diagonal] = 1 + P.VARIANCE_RATIO
    return covariance


def _scene(biases: DataFrame) -> list[str]:
    """What tells fields of biases apart: the lead, and the run where there are several."""
    return [c for c in ("analysistime", "leadtime") if c in biases.columns]


def apply_weights(weights: DataFrame, biases: DataFrame) -> DataFrame:
    """Increment per node and lead (and run): the weighted sum of the biases (sid, leadtime, bias).

    The leads of a point travel as one array, so the weights are shuffled once and not once per lead.
    """
    scene, point = _scene(biases), [c for c in ("set", "sid") if c in weights.columns]
    per_point = biases.groupBy(*point).agg(F.collect_list(F.struct(*scene, "bias")).alias("by_lead"))
    return (
        weights.join(per_point, point)
        .select("cell", "weight", F.inline("by_lead"))
        .groupBy("cell", *scene)
        .agg(F.sum(F.col("weight") * F.col("bias")).alias("diff"))
    )


def with_sets(biases: DataFrame) -> DataFrame:
    """Known biases with a number for the set of points that have one at the same lead of the same run."""
    known = biases.where(F.col("bias").isNotNull() & ~F.isnan("bias"))
    scene = _scene(biases)
    sets = known.groupBy(*scene).agg(
        F.xxhash64(F.bit_xor(F.xxhash64("sid")), F.sum(F.pmod(F.xxhash64("sid", F.lit(1)), F.lit(1 << 31))), F.count("*")).alias("set")
    )
    return known.join(F.broadcast(sets), scene)


def _by_sets(points: DataFrame, known: DataFrame, short: DataFrame, grid: DataFrame, k: int) -> DataFrame:
    """Increments of the nodes and scenes of ``short``, with a search and a solve of its own for every set of points.

    The scenes of a set are numbered anew so that a block holds scenes of one set only: its points have a bias in all.
    """
    scene = _scene(known)
    known = with_sets(known)
    sets = stored(known.select(*scene, "set").distinct(), "sets")  # a row a scene
    ranks = with_place(sets.select("set").distinct(), ["set"]).withColumnRenamed("place", "of_set")
    within = F.row_number().over(Window.partitionBy("set").orderBy(*scene)) - 1
    numbered = sets.withColumn("within", within).join(ranks, "set")
    most = sets.groupBy("set").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    number = F.col("of_set") * (-(-most // SCENES) * SCENES) + F.col("within")
    numbered = stored(numbered.select(*scene, number.cast("long").alias("number")), "numbered")
    block = F.floor(F.col("number") / SCENES).alias("block")
    pairs = short.join(F.broadcast(numbered), scene).select("cell", block).distinct()
    nodes = stored(grid.select(*NODE_COLUMNS).join(sized(pairs), "cell"), "short-nodes")
    solved = _solved(points, known.drop("set").join(F.broadcast(numbered), scene), nodes, k, k, None)
    return solved.join(F.broadcast(numbered), "number").select("cell", *scene, "diff")


def _solved(points: DataFrame, known: DataFrame, nodes: DataFrame, k: int, listed: int, counted: DataFrame | None) -> DataFrame:
    """Increments (cell, number, diff, short, full) at nodes by ``block`` from known biases by ``number`` of their scene.

    The biases of a block travel with the points, so what the search finds of a node is solved where it is found.
    """
    by_point = known.groupBy("sid", F.floor(F.col("number") / SCENES).alias("block")).agg(
        F.collect_list(F.struct((F.col("number") % SCENES).cast("int").alias("at"), "bias")).alias("known"))
    placed = sized(points.select("sid", "lat", "lon", "elev", "land")).join(by_point, "sid")
    placed = placed.select("sid", "lat", "lon", "elev", "land", "block", F.col("known.at").alias("at"), F.col("known.bias").alias("bias"))
    best = best_lists(placed, nodes, listed, counted, by=("block",))
    size = F.size("rho")
    packed = best.select("cell", "block", "rho", "lat", "lon", "elev", "land", F.array_repeat(size.cast("long"), size).alias("listed"), "at", "bias")
    # 64 scenes of 41 points are about 20 KB a node; the solver goes through them NODES_PER_BATCH at a time
    return packed.mapInArrow(lambda batches: _increments(batches, k, listed), "cell int, number long, diff double, short boolean, full boolean")


def oi_analysis(points: DataFrame, biases: DataFrame, grid: DataFrame, k: int = P.MAX_POINTS, counted: DataFrame | None = None) -> DataFrame:
    """Increments (cell, leadtime, diff) on the grid from biases at points; nodes out of reach have no row.

    Every lead uses the points that have a bias then, and no others. With a column ``analysistime`` the biases are of
    several runs, and so are the increments. A node's list holds 2 k + 1 points where some are missing at times; should a
    lead lack so many that it runs out, that lead of that node is searched and solved by itself.
    """
    known = biases.where(F.col("bias").isNotNull() & ~F.isnan("bias"))
    scene = _scene(known)
    number = (F.col("place") - 1).alias("number")
    scenes = with_place(known.select(*scene).distinct(), scene).select(*scene, number)
    sizes = known.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.struct(*scene)).alias("scenes"), F.count_distinct("sid").alias("sids")).first()
    of_scenes, complete = sizes.scenes, sizes.n == sizes.scenes * sizes.sids
    listed = k if complete else 2 * k + 1
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.lit((of_scenes - 1) // SCENES if of_scenes else 0).cast("long"))).alias("block")
    nodes = grid.select(*NODE_COLUMNS, blocks)
    points = stored(points, "places")
    solved = _solved(points, known.join(F.broadcast(scenes), scene), nodes, k, listed, counted)
    if complete:
        return solved.join(F.broadcast(scenes), "number").select("cell", *scene, "diff")
    solved = stored(solved, "increments")
    named = solved.join(F.broadcast(scenes), "number")
    whole = named.where(~F.col("short")).select("cell", *scene, "diff")
    # of a node with a full list also the scenes in which none of its listed points is present
    silent = solved.where("full").groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") < of_scenes)
    silent = silent.select("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(of_scenes - 1).cast("long"))).alias("number"))
    silent = silent.join(sized(solved), ["cell", "number"], "left_anti").join(F.broadcast(scenes), "number").select("cell", *scene)
    short = stored(named.where("short").select("cell", *scene).unionByName(silent), "short")
    if short.isEmpty():
        return whole
    again = _by_sets(points, known.join(short.select(*scene).distinct(), scene, "left_semi"), short, grid, k)
    return whole.unionByName(again.join(sized(short), ["cell", *scene], "left_semi").select("cell", *scene, "diff"))


def _increments(batches: Iterator[pa.RecordBatch], k: int, most: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, NODES_PER_BATCH):
            yield _analysed(batch.slice(start, NODES_PER_BATCH), k, most)


def _analysed(nodes: pa.RecordBatch, k: int, most: int) -> pa.RecordBatch:
    """Increment of each node and scene in which one of its listed points has a bias.

    The points of a node come in the order of their weights. Its first k give the stored inverse; padding points are
    uncorrelated with everything and weigh nothing. ``short`` marks a scene whose present points among ``most`` listed
    ones are fewer than k.
    """
    sizes = nodes.column("rho").value_lengths().to_numpy()
    width = max(k, int(sizes.max(initial=0)))
    real = np.arange(width) < sizes[:, None]

    def padded(name: str) -> np.ndarray:
        out = np.zeros(real.shape)
        out[real] = nodes.column(name).flatten().to_numpy(zero_copy_only=False)
        return out

    lists = nodes.column("at").flatten()
    point = np.repeat(np.flatnonzero(real.ravel()), lists.value_lengths().to_numpy())
    row, column = point // width, point % width
    scene, inverse = np.unique(row * SCENES + lists.flatten().to_numpy(), return_inverse=True)
    owner = scene // SCENES
    present = ~real[owner]
    present[inverse, column] = True
    bias = np.zeros(present.shape)
    bias[inverse, column] = nodes.column("bias").flatten().flatten().to_numpy()

    rho = padded("rho")
    covariance = _covariance(*(padded(c) for c in ("lat", "lon", "elev", "land")), real)
    stored_inverse = np.linalg.inv(covariance[:, :k, :k])
    lacking = k - present[:, :k].sum(1)
    spare = present[:, k:] & real[owner][:, k:]
    added = np.minimum(lacking, spare.sum(1))
    diff = np.zeros(len(scene))
    for missing, more in {*zip(lacking.tolist(), added.tolist())}:
        same = np.flatnonzero((lacking == missing) & (added == more))
        for low in range(0, len(same), CHANGED):
            some = same[low : low + CHANGED]
            at = owner[some]
            first = np.argsort(~present[some, :k], axis=1, kind="stable")
            stay, gone = first[:, : k - missing], first[:, k - missing :]
            new = k + np.argsort(~spare[some], axis=1, kind="stable")[:, :more]

            def of(matrix: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
                return matrix[at[:, None, None], rows[:, :, None], columns[:, None, :]]

            inverse_of_rest = of(stored_inverse, stay, stay)
            if missing:
                across = of(stored_inverse, stay, gone)
                inverse_of_rest = inverse_of_rest - across @ np.linalg.solve(of(stored_inverse, gone, gone), across.transpose(0, 2, 1))
            weight = (inverse_of_rest @ rho[at[:, None], stay][:, :, None])[:, :, 0]
            if more:
                border = of(covariance, stay, new)
                carried = inverse_of_rest @ border
                corner = of(covariance, new, new) - border.transpose(0, 2, 1) @ carried
                rest = rho[at[:, None], new] - (border.transpose(0, 2, 1) @ weight[:, :, None])[:, :, 0]
                extra = np.linalg.solve(corner, rest[:, :, None])
                weight = weight - (carried @ extra)[:, :, 0]
                diff[some] += (extra[:, :, 0] * bias[some[:, None], new]).sum(1)
            diff[some] += (weight * bias[some[:, None], stay]).sum(1)
    full = padded("listed").max(axis=1, initial=0) >= most
    block = nodes.column("block").to_numpy()
    return pa.RecordBatch.from_arrays(
        [nodes.column("cell").cast(pa.int32()).take(pa.array(owner)), pa.array(block[owner] * SCENES + scene % SCENES), pa.array(diff), pa.array((added < lacking) & full[owner]), pa.array(full[owner])],
        ["cell", "number", "diff", "short", "full"])
