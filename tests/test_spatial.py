"""Joins on tiles against brute force, and weights against a dense solve."""

import numpy as np
import pandas as pd
import pytest

from fcbias import params as P
from fcbias.functions import projection as PR
from fcbias.functions.geo import Tiling, search_radius
from pyspark.sql import functions as F

from fcbias.operators import interpolation as I
from fcbias.operators import spatial as X


def great_circle(lat1, lon1, lat2, lon2):
    a, b, c, d = (np.radians(np.asarray(v, dtype=float)) for v in (lat1, lon1, lat2, lon2))
    h = np.sin((c - a) / 2) ** 2 + np.cos(a) * np.cos(c) * np.sin((d - b) / 2) ** 2
    return 2 * P.EARTH_RADIUS * np.arcsin(np.sqrt(np.minimum(1, h)))


def frame(rng, n, lat, lon, key):
    return pd.DataFrame({key: np.arange(n), "lat": rng.uniform(*lat, n), "lon": rng.uniform(*lon, n)})


def nodes_of(df):
    rng = np.random.default_rng(5)
    return df.assign(topo=rng.uniform(0, 500, len(df)), lc=rng.integers(0, 2, len(df)).astype(float))


def points_of(df):
    rng = np.random.default_rng(6)
    return df.assign(
        elev=rng.uniform(0, 500, len(df)), land=rng.integers(0, 2, len(df)).astype(float), bias=rng.normal(0, 2, len(df))
    )


REGIONS = {
    "north": ((54, 71.5), (4, 32)),
    "date line": ((-20, 20), (170, 190)),
    "pole": ((80, 90), (-180, 180)),
    "south pole": ((-90, -85), (-180, 180)),
    "sphere": ((-90, 90), (-180, 180)),
}


@pytest.mark.parametrize("region", REGIONS)
@pytest.mark.parametrize("n_nodes", [3, 2000])
def test_nearest(spark, region, n_nodes):
    rng = np.random.default_rng(1)
    lat, lon = REGIONS[region]
    points, nodes = frame(rng, 150, lat, lon, "sid"), frame(rng, n_nodes, lat, lon, "cell")
    got = X.nearest_cell(spark.createDataFrame(points), spark.createDataFrame(nodes)).toPandas().set_index("sid")
    distance = great_circle(points.lat.values[:, None], points.lon.values[:, None], nodes.lat.values, nodes.lon.values)
    assert len(got) == len(points)
    chosen = got.loc[points.sid, "cell"].to_numpy()
    assert np.allclose(distance[np.arange(len(points)), chosen], distance.min(axis=1), atol=0.02)


def test_nearest_far_outside_the_grid(spark):
    points = pd.DataFrame({"sid": [1, 2], "lat": [-60.0, 10.0], "lon": [-170.0, 100.0]})
    nodes = pd.DataFrame({"cell": [0, 1], "lat": [60.0, 61.0], "lon": [20.0, 21.0]})
    got = X.nearest_cell(spark.createDataFrame(points), spark.createDataFrame(nodes)).toPandas()
    assert len(got) == 2


def test_ties_go_to_the_lowest_cell(spark):
    points = pd.DataFrame({"sid": [1], "lat": [60.0], "lon": [20.0]})
    nodes = pd.DataFrame({"cell": [9, 4, 7], "lat": [60.0] * 3, "lon": [20.1, 19.9, 20.1]})
    assert X.nearest_cell(spark.createDataFrame(points), spark.createDataFrame(nodes)).first()["cell"] == 4


@pytest.mark.parametrize("region", REGIONS)
def test_neighbours(spark, region):
    rng = np.random.default_rng(2)
    lat, lon = REGIONS[region]
    n = 3000 if region == "sphere" else 400
    points, nodes = points_of(frame(rng, n, lat, lon, "sid")), nodes_of(frame(rng, 500, lat, lon, "cell"))
    got = X.neighbours(spark.createDataFrame(points), spark.createDataFrame(nodes)).select("cell", "sid").toPandas()
    distance = great_circle(nodes.lat.values[:, None], nodes.lon.values[:, None], points.lat.values, points.lon.values)
    want = set(zip(*np.nonzero(distance <= search_radius())))
    found = list(zip(got.cell, got.sid))
    assert len(found) == len(set(found)) and set(found) == want


def test_neighbours_of_a_crowded_tile(spark, monkeypatch):
    """A third of all points in one place, cut into many parts, loses and repeats nothing."""
    monkeypatch.setattr(X, "TASK_POINTS", 16)
    monkeypatch.setattr(X, "TASK_NODES", 8)
    rng = np.random.default_rng(3)
    spread, crowd = frame(rng, 400, (58, 66), (10, 30), "sid"), frame(rng, 200, (60.1, 60.2), (24.8, 25.0), "sid")
    points = points_of(pd.concat([spread, crowd.assign(sid=crowd.sid + 1000)], ignore_index=True))
    nodes = nodes_of(frame(rng, 300, (58, 66), (10, 30), "cell"))
    got = X.neighbours(spark.createDataFrame(points), spark.createDataFrame(nodes)).select("cell", "sid").toPandas()
    distance = great_circle(nodes.lat.values[:, None], nodes.lon.values[:, None], points.lat.values, points.lon.values)
    cells, at = np.nonzero(distance <= search_radius())
    assert sorted(zip(got.cell, got.sid)) == sorted(zip(cells, points.sid.values[at]))


def test_pairs_are_dealt_by_their_number(spark, monkeypatch):
    """Pairs of many points and nodes are made by many tasks, however few bytes the points and nodes take."""
    monkeypatch.setattr(X, "TASK_PAIRS", 1000, raising=False)
    rng = np.random.default_rng(3)
    points, nodes = points_of(frame(rng, 400, (58, 66), (10, 30), "sid")), nodes_of(frame(rng, 300, (58, 66), (10, 30), "cell"))
    # a partition each, as a small file is read
    near = X.neighbours(*[spark.createDataFrame(df).coalesce(1) for df in (points, nodes)])
    tasks = near.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n")).collect()
    distance = great_circle(nodes.lat.values[:, None], nodes.lon.values[:, None], points.lat.values, points.lon.values)
    total = (distance <= search_radius()).sum()
    assert sum(t.n for t in tasks) == total and len(tasks) >= 4 and max(t.n for t in tasks) < total / 3


@pytest.mark.parametrize("degrees", [*X.NEAREST_LEVELS, 1.0])
def test_tile_counts_are_not_on_an_edge(degrees):
    """No row's number of columns hangs on the last bits of a sine, so all machines agree on it."""
    tiling = Tiling(degrees)
    for row in tiling.rows:
        n = tiling.columns_of(row)
        assert n == 1.0 or (n >= 3 and abs(n - round(n)) > 1e-9 * n)


def test_tile_table_is_bounded():
    assert Tiling.for_radius(search_radius()).max_tiles <= 40_051


@pytest.fixture(scope="module")
def scene(spark):
    rng = np.random.default_rng(4)
    points = points_of(frame(rng, 300, (59, 62), (20, 26), "sid"))
    nodes = nodes_of(frame(rng, 80, (58, 63), (18, 28), "cell"))
    return points, nodes


def rho(lat1, lon1, z1, w1, lat2, lon2, z2, w2):
    d = great_circle(lat1, lon1, lat2, lon2)
    return np.exp(-0.5 * (d / 30000) ** 2) * np.exp(-0.5 * ((z1 - z2) / 200) ** 2) * np.exp(-0.5 * ((w1 - w2) / 0.5) ** 2)


def dense_increment(points, node, k):
    d = great_circle(node.lat, node.lon, points.lat, points.lon)
    r = rho(node.lat, node.lon, node.topo, node.lc, points.lat, points.lon, points.elev, points.land)
    near = points.assign(r=r, key=-np.floor(r * 1e9 + 0.5))[d <= search_radius()]
    near = near[near.r > 0].sort_values(["key", "sid"]).head(k)
    if near.empty:
        return None
    p = {c: near[c].to_numpy() for c in ("lat", "lon", "elev", "land")}
    a = [p[c][:, None] for c in ("lat", "lon", "elev", "land")]
    b = [p[c][None, :] for c in ("lat", "lon", "elev", "land")]
    weights = np.linalg.solve(rho(*a, *b) + 0.1 * np.eye(len(near)), near.r.to_numpy())
    return float(weights @ near.bias.to_numpy())


@pytest.mark.parametrize("k", [1, 2, 20])
def test_increments_equal_a_dense_solve(spark, scene, k):
    points, nodes = scene
    p, g = spark.createDataFrame(points), spark.createDataFrame(nodes)
    biases = p.selectExpr("sid", "1 as leadtime", "bias").unionByName(p.selectExpr("sid", "3 as leadtime", "bias * 0.5 as bias"))
    got = I.oi_analysis(p, biases, g, k).toPandas().set_index(["cell", "leadtime"])["diff"]
    checked = 0
    for node in nodes.itertuples():
        want = dense_increment(points, node, k)
        if want is None:
            assert (node.cell, 1) not in got.index
            continue
        assert got[node.cell, 1] == pytest.approx(want, abs=1e-9)
        assert got[node.cell, 3] == pytest.approx(want / 2, abs=1e-9)
        checked += 1
    assert checked > 40


def test_closed_forms_equal_the_solver(spark, scene):
    points, nodes = scene
    p, g = spark.createDataFrame(points), spark.createDataFrame(nodes)
    weighted = I.barnes_weights(p, g)
    biases = p.selectExpr("sid", "1 as leadtime", "bias")
    for k, closed in ((1, I.oi_nearest1(weighted)), (2, I.oi_pair2(weighted))):
        solved = I.apply_weights(I.oi_weights(weighted, k), biases).toPandas().set_index("cell")["diff"]
        direct = closed.toPandas().set_index("cell")["diff"]
        pd.testing.assert_series_equal(solved.sort_index(), direct.sort_index(), check_exact=False, rtol=1e-9, check_index_type=False)


def test_partitioning_does_not_matter(spark, scene):
    points, nodes = scene
    a = I.oi_weights(I.barnes_weights(spark.createDataFrame(points), spark.createDataFrame(nodes)))
    shuffled = points.sample(frac=1, random_state=0)
    b = I.oi_weights(I.barnes_weights(spark.createDataFrame(shuffled).repartition(5), spark.createDataFrame(nodes).repartition(3)))
    sort = lambda df: df.toPandas().sort_values(["cell", "sid"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(sort(a), sort(b), rtol=1e-9)


def test_lone_point_on_a_node(spark):
    p = spark.createDataFrame([(1, 60.0, 25.0, 10.0, 1.0, 2.2)], "sid int, lat double, lon double, elev double, land double, bias double")
    g = spark.createDataFrame([(0, 60.0, 25.0, 10.0, 1.0)], "cell int, lat double, lon double, topo double, lc double")
    diff = I.oi_analysis(p, p.selectExpr("sid", "1 as leadtime", "bias"), g).first()["diff"]
    assert diff == pytest.approx(2.0)


def test_point_without_bias_is_not_chosen(spark):
    schema = "sid int, lat double, lon double, elev double, land double, bias double"
    p = spark.createDataFrame([(1, 60.0, 25.0, 0.0, 1.0, None), (2, 60.1, 25.0, 0.0, 1.0, 3.0)], schema)
    g = spark.createDataFrame([(0, 60.0, 25.0, 0.0, 1.0)], "cell int, lat double, lon double, topo double, lc double")
    biases = p.selectExpr("sid", "1 as leadtime", "bias")
    only = I.oi_analysis(p.where("sid = 2"), biases, g, 1).first()["diff"]
    assert I.oi_analysis(p, biases, g, 1).first()["diff"] == pytest.approx(only)


def test_bilinear(spark):
    raster = spark.createDataFrame([(i, j, 10.0 * i + j) for i in range(5) for j in range(4)], "ix int, iy int, z double")
    rows = [(1, 1500.0, 500.0), (2, 4000.0, 3000.0), (3, 4000.1, 0.0), (4, -1.0, 0.0), (5, 0.0, 0.0)]
    got = {r["sid"]: r["elevation"] for r in X.bilinear(spark.createDataFrame(rows, "sid int, x double, y double"), raster, 1000.0, 1000.0).collect()}
    assert got[1] == pytest.approx(15.5) and got[2] == pytest.approx(43.0) and got[5] == pytest.approx(0.0)
    assert got[3] is None and got[4] is None


def test_leads_with_different_points_and_runs(spark):
    g = spark.createDataFrame([(0, 60.0, 20.0, 0.0, 1.0)], "cell int, lat double, lon double, topo double, lc double")
    points = [(1, 60.0, 20.02, 0.0, 1.0), (2, 60.02, 20.0, 0.0, 1.0)]
    p = spark.createDataFrame(points, "sid int, lat double, lon double, elev double, land double")
    rows = [("a", 1, 1, 2.0), ("a", 2, 1, 1.0), ("a", 1, 2, 2.0), ("a", 1, 3, 2.0), ("a", 2, 3, None), ("b", 2, 1, 4.0), ("b", 2, 2, float("nan"))]
    biases = spark.createDataFrame(rows, "analysistime string, sid int, leadtime int, bias double")

    def increments(df):
        return {(r.analysistime, r.leadtime): r["diff"] for r in I.oi_analysis(p, df, g).collect()}

    both = increments(biases)
    alone = I.oi_analysis(p.where("sid = 1"), biases.where("analysistime = 'a' and sid = 1").drop("analysistime"), g).collect()
    lone = {r.leadtime: r["diff"] for r in alone}
    assert both["a", 2] == pytest.approx(lone[2]) and both["a", 3] == pytest.approx(lone[3])
    assert both["a", 1] != pytest.approx(lone[1])
    assert ("b", 2) not in both
    for run in "ab":
        one = increments(biases.where(f"analysistime = '{run}'"))
        assert one == pytest.approx({k: v for k, v in both.items() if k[0] == run})


def test_far_points_do_not_meet_whole_grids(spark):
    """Four times the nodes, about the same number of candidates, and still the nearest one."""
    rng = np.random.default_rng(7)
    points = frame(rng, 20, (28, 30), (0, 30), "sid")
    candidates = []
    for side in (100, 200):
        lat, lon = np.meshgrid(np.linspace(55, 65, side), np.linspace(10, 20, side))
        nodes = pd.DataFrame({"cell": np.arange(side * side), "lat": lat.ravel(), "lon": lon.ravel()})
        distance = great_circle(points.lat.values[:, None], points.lon.values[:, None], nodes.lat.values, nodes.lon.values)
        p, n = spark.createDataFrame(points), spark.createDataFrame(nodes)
        got = X.nearest_cell(p, n).toPandas().set_index("sid")
        assert np.allclose(got.loc[points.sid, "distance"], distance.min(axis=1), atol=0.02)
        tiled = n.selectExpr("0 as level", "0 as ty", "0 as tx", "cell", "lat as cell_lat", "lon as cell_lon")
        block = p.selectExpr("*", "0 as level", "0 as ty", "0 as tx")
        candidates.append(X._far_candidates(block, tiled, tiled.select("cell", "cell_lat", "cell_lon")).count())
    assert candidates[1] < 2 * candidates[0] + 20 and max(candidates) < 20 * 100


@pytest.mark.parametrize(("k", "share"), [(20, 0.25), (20, 0.8), (3, 0.6), (1, 0.5)])
def test_leads_that_lack_points_equal_a_dense_solve(spark, scene, k, share):
    """Downdated and bordered inverses, lists that run out, and leads of which a node has hardly a point."""
    points, nodes = scene
    rng = np.random.default_rng(k)
    runs, leads = ["a", "b", "c"], [1, 2, 3]
    rows = [(r, int(s), lead, float(b) * lead) for r in runs for lead in leads for s, b in zip(points.sid, points.bias) if rng.random() > share]
    biases = spark.createDataFrame(rows, "analysistime string, sid int, leadtime int, bias double")
    got = I.oi_analysis(spark.createDataFrame(points), biases, spark.createDataFrame(nodes), k).collect()
    found = {(r.analysistime, r.leadtime, r.cell): r["diff"] for r in got}
    assert len(found) == len(got)
    checked = 0
    for run in runs:
        for lead in leads:
            own = {s: b for r, s, at, b in rows if (r, at) == (run, lead)}
            there = points[points.sid.isin(list(own))].assign(bias=lambda p: p.sid.map(own))  # noqa: B023
            for node in nodes.itertuples():
                want = dense_increment(there, node, k)
                assert ((run, lead, node.cell) in found) == (want is not None)
                if want is not None:
                    assert found[run, lead, node.cell] == pytest.approx(want, abs=1e-9)
                    checked += 1
    assert checked > 300


def test_pairs_are_formed_once_however_many_runs(spark, scene, monkeypatch):
    points, nodes = (spark.createDataFrame(x) for x in scene)
    calls = []
    formed = I.barnes_weights
    monkeypatch.setattr(I, "barnes_weights", lambda *a, **b: calls.append(1) or formed(*a, **b))
    biases = points.select("sid", "bias", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("leadtime"), F.explode(F.sequence(F.lit(1), F.lit(4))).alias("analysistime"))
    present = biases.where("(sid + leadtime * 3 + analysistime) % 7 != 0")
    assert I.oi_analysis(points, present, nodes).select("analysistime", "leadtime").distinct().count() == 20
    assert len(calls) == 1


def city(rng, n):
    """Points and nodes of a town of a fifth of a degree amid wide country."""
    dense, wide = frame(rng, n, (60.1, 60.3), (24.8, 25.2), "sid"), frame(rng, 150, (58, 63), (20, 30), "sid")
    points = points_of(pd.concat([dense, wide.assign(sid=wide.sid + n)], ignore_index=True))
    town, country = frame(rng, 60, (60.15, 60.25), (24.9, 25.1), "cell"), frame(rng, 60, (58, 63), (20, 30), "cell")
    return points, nodes_of(pd.concat([town, country.assign(cell=country.cell + 60)], ignore_index=True))


def test_rings_find_the_best_points_of_a_dense_city(spark, monkeypatch):
    """The same rows as the whole radius gives; pairs by the density close by, not by all points of the town."""
    points, nodes = (spark.createDataFrame(x) for x in city(np.random.default_rng(9), 20_000))
    key = ["cell", "sid", "rank"]
    whole = I.barnes_weights(points, nodes)
    want = X.top_neighbours(whole).select(*key).collect()
    formed, pairs = I.barnes_weights, []

    def counted(*args, **named):
        found = formed(*args, **named)
        pairs.append(found.count())
        return found

    monkeypatch.setattr(I, "barnes_weights", counted)
    got = I.best_points(points, nodes).select(*key).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert len(pairs) > 2 and sum(pairs) < whole.count() / 5


@pytest.mark.parametrize("edge", X.ring_radii(search_radius())[1:])
def test_rings_lose_no_neighbour(spark, edge):
    """Tiles of the size of a ring, with parts counted without a broadcast."""
    points, nodes = city(np.random.default_rng(10), 900)
    got = X.neighbours(spark.createDataFrame(points), spark.createDataFrame(nodes), edge).select("cell", "sid").collect()
    distance = great_circle(nodes.lat.values[:, None], nodes.lon.values[:, None], points.lat.values, points.lon.values)
    cells, at = np.nonzero(distance <= edge)
    assert sorted(map(tuple, got)) == sorted(zip(nodes.cell.values[cells].tolist(), points.sid.values[at].tolist()))


@pytest.mark.parametrize("edge", X.ring_radii(search_radius())[1:])
def test_tile_counts_of_rings_are_not_on_an_edge(edge):
    tiling = Tiling.fitting(edge)  # many more rows than above, so some come nearer; a sine is right to 1e-15
    for row in tiling.rows:
        n = tiling.columns_of(row)
        assert n == 1.0 or (n >= 3 and abs(n - round(n)) > 1e-12 * n)


@pytest.mark.parametrize("projection", [PR.Lambert(), PR.PolarStereographic(60.0, 20.0)])
@pytest.mark.parametrize("step", [(40_000.0, 40_000.0), (2500.0, 7000.0)])
def test_nearest_on_a_projected_grid(spark, projection, step):
    """Points inside, on the edge, far outside and without a position; the same cells as all distances give."""
    grid = PR.ProjectedGrid(projection, 30, 25, *step, 55.0, 10.0)
    nodes = grid.nodes(spark).toPandas()
    rng = np.random.default_rng(5)
    low, high = nodes.min(), nodes.max()
    spread = [frame(rng, 300, (low.lat, high.lat), (low.lon, high.lon), "sid"), frame(rng, 40, (40, 75), (-20, 60), "sid")]
    edge = nodes[(nodes.i % 29 == 0) | (nodes.j % 24 == 0)].assign(sid=lambda n: n.cell)[["sid", "lat", "lon"]]
    points = pd.concat([*spread, edge, edge.assign(lat=edge.lat + 0.004)], ignore_index=True).assign(sid=lambda p: range(len(p)))
    got = X.nearest_on_grid(spark.createDataFrame(points), grid).toPandas().set_index("sid")
    distance = np.floor(great_circle(points.lat.values[:, None], points.lon.values[:, None], nodes.lat.values, nodes.lon.values) * 100 + 0.5)
    assert len(got) == len(points) and (got.index.nunique() == len(points))
    assert np.abs(got.loc[points.sid, "distance"].values * 100 - distance.min(1)).max() <= 1
    clear = np.sort(distance, 1)[:, 1] - distance.min(1) > 2
    assert (got.loc[points.sid, "cell"].values == nodes.cell.values[distance.argmin(1)])[clear].all() and clear.sum() > 300
    nowhere = spark.createDataFrame([(1, None, 3.0)], "sid int, lat double, lon double")
    assert X.nearest_on_grid(nowhere, grid).collect() == []


def test_nearest_on_a_grid_has_no_shuffle(spark):
    grid = PR.ProjectedGrid(PR.Lambert(), 30, 25, 40_000.0, 40_000.0, 55.0, 10.0)
    points = spark.createDataFrame([(1, 57.0, 15.0)], "sid int, lat double, lon double")
    text = X.nearest_on_grid(points, grid)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Join" not in text


def test_unlike_steps_are_refused():
    with pytest.raises(ValueError):
        PR.ProjectedGrid(PR.Lambert(), 30, 25, 1000.0, 40_000.0, 55.0, 10.0)


def test_lists_hold_what_all_pairs_give(spark, monkeypatch):
    """Crowded tiles cut into parts, equal places, boxes of few nodes and nodes that share a number."""
    from fcbias.operators import lists

    monkeypatch.setattr(lists, "LIST_POINTS", 200)
    monkeypatch.setattr(lists, "LIST_NODES", 16)
    monkeypatch.setattr(lists, "BOX", 8)
    points, nodes = city(np.random.default_rng(12), 3000)
    points = pd.concat([points, points.head(300).assign(sid=lambda p: p.sid + 100_000)], ignore_index=True)
    key = ["cell", "sid", "rank"]
    for grid in (nodes, pd.concat([nodes, nodes.head(7)], ignore_index=True)):
        p, g = spark.createDataFrame(points), spark.createDataFrame(grid)
        want = X.top_neighbours(I.barnes_weights(p, g), 5).select(*key).collect()
        got = I.list_rows(I.best_lists(p, g, 5)).select(*key).collect()
        assert len(want) > 400 and [r[:2] for r in sorted(map(tuple, got))] == [r[:2] for r in sorted(map(tuple, want))]
        assert sorted((r.cell, r["rank"]) for r in got) == sorted((r.cell, r["rank"]) for r in want)


def test_best_points_form_no_rows_of_pairs(spark, folder):
    """No sort, window or shuffle meets a pair of node and point: the search is one group a tile."""
    from fcbias.catalog import QUERIES

    for name in ("oi_nearest1", "oi_pair2", "oi_weights", "zero_background"):
        text = QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
        assert "FlatMapCoGroupsInArrow" in text and "WindowGroupLimit" not in text


def test_scenes_without_listed_points_are_searched_by_their_own(spark):
    """Stations at one place that all lack the same scenes: the list runs out, and the next place is found."""
    g = spark.createDataFrame([(0, 60.0, 20.0, 0.0, 1.0)], "cell int, lat double, lon double, topo double, lc double")
    rows = [(s, 60.0, 20.01, 0.0, 1.0) for s in range(8)] + [(9, 60.1, 20.1, 0.0, 1.0)]
    p = spark.createDataFrame(rows, "sid int, lat double, lon double, elev double, land double")
    biases = spark.createDataFrame([(s, 1, 2.0) for s in range(8)] + [(9, lead, 4.0) for lead in (1, 2)], "sid int, leadtime int, bias double")
    got = {r.leadtime: r["diff"] for r in I.oi_analysis(p, biases, g, 1).collect()}
    alone = I.oi_analysis(p.where("sid = 9"), biases.where("sid = 9"), g, 1).collect()
    assert got[2] == pytest.approx({r.leadtime: r["diff"] for r in alone}[2]) and got[1] != pytest.approx(got[2])


def test_nearest_in_boxes_equals_all_distances(spark, monkeypatch):
    """A grid that counts as one of many nodes: rows close together, columns far apart, points between them."""
    monkeypatch.setattr(X, "MANY", 1)
    rng = np.random.default_rng(13)
    lat, lon = np.meshgrid(np.linspace(59, 62, 300), np.linspace(10, 20, 12))
    nodes = pd.DataFrame({"cell": np.arange(lat.size), "lat": lat.ravel(), "lon": lon.ravel()})
    points = frame(rng, 150, (58.5, 62.5), (9, 21), "sid")
    distance = great_circle(points.lat.values[:, None], points.lon.values[:, None], nodes.lat.values, nodes.lon.values)
    got = X.nearest_cell(spark.createDataFrame(points), spark.createDataFrame(nodes)).toPandas().set_index("sid")
    assert len(got) == 150 and np.allclose(got.loc[points.sid, "distance"], distance.min(axis=1), atol=0.02)
