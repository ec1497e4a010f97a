"""Approximate nearest neighbours by inner product on robust-pruned directed graphs, one per shard of the vectors.

Distinct vectors are dealt to shards of bounded size by a hash, so copies, however many, are one node. In a shard, nodes
are inserted in batches: a greedy beam search from the entry points proposes neighbours, and relaxed distance pruning
keeps those that no kept neighbour is much closer to, which leaves short and long edges; reverse edges are added and
pruned alike. Every query then runs a beam search in every shard, and the shards' best are merged. Largest inner product
becomes smallest distance by a further coordinate that brings all vectors to the same length.

A task streams the rows of a shard: its vectors first, from which it builds the graph, then the queries in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import kept

SHARD = 8192
DEGREE, ROOM = 32, 48
BUILD_BEAM, SEARCH_BEAM = 64, 128
#: Squared, as the distances are.
RELAX = 1.2**2
ENTRIES = 8
AT_ONCE = 256
#: Nodes expanded in one step of a search.
WIDE = 4


class Graph:
    """A directed graph over the rows of ``points``, all of one length; ``edges`` has -1 where a node has no more."""

    def __init__(self, points: np.ndarray, seed: int = 1):
        self.points = np.ascontiguousarray(points, np.float32)
        n = len(points)
        self.edges = np.full((n, ROOM), -1, np.int32)
        order = np.random.default_rng(seed).permutation(n)
        middle = self.points.mean(0)
        first = int((self.points @ middle).argmax())
        order = np.concatenate([[first], order[order != first]])
        self.entries = order[:ENTRIES].astype(np.int32)
        self.length = float((self.points[0].astype(np.float64) ** 2).sum()) if n else 0.0
        done = min(n, BUILD_BEAM)
        start = order[:done].astype(np.int32)
        self._connect(start, np.tile(start, (done, 1)))
        while done < n:
            batch = order[done : done + min(AT_ONCE, max(32, done // 2))].astype(np.int32)
            found, _ = self.search(self.points[batch], BUILD_BEAM)
            self._connect(batch, found)
            done += len(batch)

    def _connect(self, nodes: np.ndarray, candidates: np.ndarray) -> None:
        chosen = self._pruned(nodes, candidates)
        self.edges[nodes, : chosen.shape[1]] = chosen
        source = np.repeat(nodes, chosen.shape[1])
        target = chosen.ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        ends, at, count = np.unique(target, return_index=True, return_counts=True)
        # nodes that many point to are dealt with apart, so that the rows below stay narrow
        for low, high in ((0, 16), (16, 64), (64, 1 << 30)):
            own = np.flatnonzero((count > low) & (count <= high))
            for i in range(0, len(own), AT_ONCE):
                self._add(ends[own[i : i + AT_ONCE]], source, at[own[i : i + AT_ONCE]], count[own[i : i + AT_ONCE]])

    def _add(self, ends: np.ndarray, source: np.ndarray, at: np.ndarray, count: np.ndarray) -> None:
        step = np.arange(count.max())
        there = step < count[:, None]
        new = np.where(there, source[np.where(there, at[:, None] + step, 0)], -1)
        both = np.concatenate([self.edges[ends], new], 1)
        both = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), 1)
        fits = (both >= 0).sum(1) <= ROOM
        self.edges[ends[fits]] = both[fits, :ROOM]
        if not fits.all():
            row = self._pruned(ends[~fits], both[~fits])
            self.edges[ends[~fits]] = -1
            self.edges[ends[~fits], : row.shape[1]] = row

    def _pruned(self, nodes: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        """Up to DEGREE of the candidates of each node: nearest first, without those that a chosen one is nearer to."""
        width = candidates.shape[1]
        own = self.points[nodes]
        others = self.points[np.maximum(candidates, 0)]
        like = np.einsum("bd,bcd->bc", own, others)
        bad = (candidates < 0) | (candidates == nodes[:, None])
        order = np.argsort(np.where(bad, np.inf, -like), axis=1, kind="stable")
        candidates, like, bad = (np.take_along_axis(x, order, 1) for x in (candidates, like, bad))
        others = np.take_along_axis(others, order[:, :, None], 1)
        far = 2 * self.length - 2 * like
        between = 2 * self.length - 2 * (others @ others.transpose(0, 2, 1))
        alive = ~bad
        out = np.full((len(nodes), min(DEGREE, width)), -1, np.int32)
        rows = np.arange(len(nodes))
        for k in range(out.shape[1]):
            best = alive.argmax(1)
            some = alive[rows, best]
            if not some.any():
                break
            out[some, k] = candidates[some, best[some]]
            alive &= ~(some[:, None] & (RELAX * between[rows, best] <= far))
            alive[rows[some], best[some]] = False
            alive &= candidates != np.where(some, candidates[rows, best], -2)[:, None]
        return out

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The beam of each query after the greedy search: nodes (-1: none) and inner products."""
        b, n = len(queries), len(self.points)
        seen = np.zeros((b, n + 1), bool)
        seen[:, n] = True
        nodes = np.full((b, beam), n, np.int32)
        like = np.full((b, beam), -np.inf, np.float32)
        entries = self.entries[: min(beam, len(self.entries))]
        nodes[:, : len(entries)] = entries
        like[:, : len(entries)] = queries @ self.points[entries].T
        seen[:, entries] = True
        fresh = nodes < n
        active = np.arange(b)
        while len(active):
            open_like = np.where(fresh[active], like[active], -np.inf)
            best = np.argpartition(-open_like, min(WIDE, beam) - 1, axis=1)[:, :WIDE]
            good = np.take_along_axis(open_like, best, 1) > -np.inf
            going = good.any(1)
            active, best, good = active[going], best[going], good[going]
            if not len(active):
                break
            rows = active[:, None]
            fresh[rows, best] = False
            near = np.where(good[:, :, None], self.edges[np.minimum(nodes[rows, best], n - 1)], -1).reshape(len(active), -1)
            near = np.where(near < 0, n, near)
            new = ~seen[rows, near]
            seen[rows, near] = True
            # the same node may come from two of the expanded ones
            order = np.argsort(near, axis=1)
            near, new = np.take_along_axis(near, order, 1), np.take_along_axis(new, order, 1)
            new[:, 1:] &= near[:, 1:] != near[:, :-1]
            r, c = np.nonzero(new)
            value = np.full(near.shape, -np.inf, np.float32)
            value[r, c] = np.einsum("id,id->i", queries[active[r]], self.points[near[r, c]])
            all_like = np.concatenate([like[active], value], 1)
            all_nodes = np.concatenate([nodes[active], np.where(new, near, n)], 1)
            all_fresh = np.concatenate([fresh[active], new], 1)
            top = np.argpartition(-all_like, beam - 1, axis=1)[:, :beam]
            like[active] = np.take_along_axis(all_like, top, 1)
            nodes[active] = np.take_along_axis(all_nodes, top, 1)
            fresh[active] = np.take_along_axis(all_fresh, top, 1) & (like[active] > -np.inf)
        return np.where(like > -np.inf, nodes, -1).astype(np.int32), like


def _usable(vectors: DataFrame) -> DataFrame:
    """Rows with an id and a finite, non-zero vector of the most frequent length; two hashes name the vector."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(~bad & F.exists("embedding", lambda x: x != 0))
    lengths = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    rows = rows.filter(F.size("embedding") == (lengths[0].d if lengths else 0))
    return rows.select("vec_id", "embedding", F.xxhash64("embedding").alias("one"), F.xxhash64(F.lit(7), "embedding").alias("two"))


def _double(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _answers(graph: Graph, points: np.ndarray, ids: list[np.ndarray], queries: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each query the ``wanted`` best ids of the shard: (query row, id, inner product in double precision)."""
    extended = np.concatenate([queries, np.zeros((len(queries), 1))], 1).astype(np.float32)
    found, _ = graph.search(extended, SEARCH_BEAM)
    row, column = np.nonzero(found >= 0)
    node = found[row, column]
    score = (queries[row] * points[node]).sum(1)
    order = np.lexsort((node, -score, row))
    row, node, score = row[order], node[order], score[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    row, node, score = row[rank < wanted], node[rank < wanted], score[rank < wanted]
    count = np.array([len(ids[i]) for i in node], int)
    row, score = np.repeat(row, count), np.repeat(score, count)
    vec = np.concatenate([ids[i] for i in node]) if len(node) else np.zeros(0, np.int64)
    order = np.lexsort((vec, -score, row))
    row, vec, score = row[order], vec[order], score[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    return row[rank < wanted], vec[rank < wanted], score[rank < wanted]


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, shard: int = SHARD) -> DataFrame:
    """The k nearest vectors found for each query by largest inner product: query_id, rank (from 1), vec_id, score.

    Both tables hold vec_id and embedding. A query's own id is no answer to it; equal scores go to the smaller id; with
    fewer candidates all are given. Vectors that are null, zero, of another length than most, or hold null or non-finite
    components take no part, nor do null ids. Ids are unique; an exact repeat of a row counts once. Copies of a vector are
    one node whose smallest k + 1 ids can be answers: no query needs more. Other columns are ignored.
    """
    wanted = k + 1
    usable = _usable(vectors)
    by_vector = Window.partitionBy("one", "two").orderBy("vec_id")
    ranked = usable.distinct().withColumn("place", F.row_number().over(by_vector)).filter(F.col("place") <= wanted)
    nodes = ranked.groupBy("one", "two").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.first("embedding").alias("embedding"))
    nodes = kept(nodes, "neighbours-nodes")
    norm = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x)
    total = nodes.agg(F.count("*").alias("n"), F.max(norm).alias("top")).first()
    shards, top = max(1, -(-total.n // shard)), total.top or 0.0
    asked = _usable(queries).select("vec_id", "embedding", "one", "two").distinct()
    distinct = asked.groupBy("one", "two").agg(F.first("embedding").alias("embedding"))
    here = nodes.select(F.pmod(F.xxhash64("one", "two"), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("kind"), "one", "two", "ids", "embedding")
    there = distinct.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"), "one", "two", F.lit(None).cast("array<bigint>").alias("ids"), "embedding")
    rows = here.unionByName(there).repartitionByRange(shards, "shard").sortWithinPartitions("shard", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts, ids = None, [], []
        ready: tuple | None = None
        for batch in batches:
            shard_of, kind = batch.column("shard").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero(np.concatenate([[True], (shard_of[1:] != shard_of[:-1]) | (kind[1:] != kind[:-1]), [True]]))
            for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                part = batch.slice(low, high - low)
                if current != shard_of[low]:
                    current, parts, ids, ready = shard_of[low], [], [], None
                if kind[low] == 0:
                    parts.append(_double(part.column("embedding")))
                    lists = part.column("ids")
                    ids += np.split(lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy())[:-1])
                    continue
                if not parts:
                    continue
                if ready is None:
                    points = np.concatenate(parts)
                    lift = np.sqrt(np.maximum(top - (points**2).sum(1), 0))
                    ready = (Graph(np.concatenate([points, lift[:, None]], 1)), points)
                for i in range(0, part.num_rows, AT_ONCE):
                    some = part.slice(i, AT_ONCE)
                    row, vec, score = _answers(*ready, ids, _double(some.column("embedding")), wanted)
                    yield pa.RecordBatch.from_arrays(
                        [some.column("one").take(pa.array(row)), some.column("two").take(pa.array(row)), pa.array(vec, pa.int64()), pa.array(score, pa.float64())],
                        ["one", "two", "vec_id", "score"])

    found = rows.mapInArrow(run, "one long, two long, vec_id long, score double")
    by_score = [F.col("score").desc(), F.col("vec_id")]
    best = found.withColumn("place", F.row_number().over(Window.partitionBy("one", "two").orderBy(*by_score))).filter(F.col("place") <= wanted)
    answers = asked.select(F.col("vec_id").alias("query_id"), "one", "two").join(best.drop("place"), ["one", "two"]).filter("query_id != vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*by_score))
    return answers.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
