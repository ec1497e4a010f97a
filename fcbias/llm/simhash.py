"""SimHash near duplicates: 64-bit fingerprints, all pairs within two bits by tiles, groups of linked documents.

Equal fingerprints are one class from the start, so copies are compared once. Two fingerprints that differ in two bits
differ by two at most in their population counts, and so do the counts of their four quarters together. Classes are put
into tiles by these counts: a tile holds the classes of one pair of half counts, or of a run of quarter counts among them
where there are many, and is cut by hash where one profile alone has more than a tile holds. Two tiles meet in one row
if their counts allow a link; numpy compares them by exclusive-or and bit counts. A meeting gives a spanning forest of
its links and not the links themselves, so a group in which all are linked with all makes no pairs.

The comparison is exact and so grows with the square of the classes, divided by about 60 for the pairs whose counts rule
a link out. What is sent grows with it only where a profile fills several tiles.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .jaccard import connected
from .shared import kept

SHINGLE = 3
SEED = 42
#: Fingerprints are linked that differ in so many bits at most.
RADIUS = 2
#: Fingerprints of a tile at most, 64 KB.
TILE = 8192
#: Words hashed at a time, and pairs compared at a time: they bound a task's memory, also within one long text.
BLOCK = 1 << 16
PAIRS = 1 << 20

QUARTERS = ["q1", "q2", "q3", "q4"]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _shingle_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, last: np.ndarray) -> np.ndarray:
    """XXH64 of the words from each word to its ``last`` one, lower-cased in A-Z and joined by one space."""
    raw = _LOWER[data[start[0] : end[-1]]].tobytes()
    joined = b" ".join([raw[a:b] for a, b in zip((start - start[0]).tolist(), (end - start[0]).tolist())])
    place = np.concatenate([[0], np.cumsum(end - start + 1)])
    chosen = np.flatnonzero(last >= 0)
    low, high = place[chosen].tolist(), (place[last[chosen] + 1] - 1).tolist()
    digest = partial(xxhash.xxh64_intdigest, seed=SEED)
    return np.fromiter((digest(joined[a:b]) for a, b in zip(low, high)), np.uint64, len(low))


def fingerprints(column: pa.Array) -> np.ndarray:
    """Fingerprint of each text: bit i is set if it is set in over half the hashes of its shingles, repeats included.

    A text of fewer than three words is one shingle; without words the fingerprint is zero.
    """
    data, offsets = T.flat(column)
    start, end, first = T.words(data, offsets)
    row = T.owners(first)
    ones = np.zeros((len(first) - 1, 64), np.int64)
    for low in range(0, len(start), BLOCK):
        high = min(low + BLOCK, len(start))
        reach = min(high + SHINGLE - 1, len(start))
        at = np.arange(low, reach)
        begins, ends = first[row[low:reach]], first[row[low:reach] + 1]
        # the last word of the shingle from each word, -1 where none begins
        last = np.where(at + SHINGLE <= ends, at + SHINGLE - 1, np.where((ends - begins < SHINGLE) & (at == begins), ends - 1, -1))
        last[high - low :] = -1
        found = _shingle_hashes(data, start[low:reach], end[low:reach], np.where(last >= 0, last - low, -1))
        if not len(found):
            continue
        bits = np.unpackbits(found.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        of = row[low:reach][last >= 0]
        cuts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        ones[of[cuts]] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int64)
    n = np.diff(first)
    shingles = np.where(n >= SHINGLE, n - SHINGLE + 1, np.minimum(n, 1))
    return np.packbits(2 * ones > shingles[:, None], axis=1, bitorder="little").view("<u8").reshape(-1).astype(np.uint64)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in T.pieces(batch):
            found = fingerprints(part.column("text")).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found)], ["doc_id", "fingerprint"])


def plan_tiles(profiles: list[tuple], tile: int) -> list[tuple]:
    """(q1, q2, q3, q4, group, parts) of each profile (q1, q2, q3, q4, n).

    A group holds profiles of the same half counts, in order, up to ``tile`` classes; a profile with more is a group of
    its own in several parts.
    """
    out, group, half, filled = [], -1, None, 0
    for q1, q2, q3, q4, n in sorted(profiles, key=lambda p: (p[0] + p[1], p[2] + p[3], p[0], p[2])):
        if (q1 + q2, q3 + q4) != half or filled + n > tile:
            group, half, filled = group + 1, (q1 + q2, q3 + q4), 0
        filled += n
        out.append((q1, q2, q3, q4, group, max(1, -(-n // tile))))
    return out


def _tiles(classes: DataFrame, tile: int) -> tuple[DataFrame, DataFrame]:
    """Tiles (group, part, held) and the groups with the range of their counts.

    There are 17^4 = 83,521 profiles at most, which bounds what the driver and the broadcast hold.
    """
    counted = classes.withColumns({q: F.bit_count(F.shiftrightunsigned("fingerprint", 16 * i).bitwiseAND(F.lit(65535).cast("long"))) for i, q in enumerate(QUARTERS)})
    profiles = counted.groupBy(*QUARTERS).agg(F.count("*").alias("n")).collect()
    schema = ", ".join(f"{q} int" for q in QUARTERS) + ", group int, parts int"
    planned = classes.sparkSession.createDataFrame(plan_tiles([tuple(p) for p in profiles], tile), schema)
    tiles = (
        counted.join(F.broadcast(planned), QUARTERS)
        .groupBy("group", F.pmod(F.xxhash64("fingerprint"), F.col("parts")).alias("part"))
        .agg(F.collect_list("fingerprint").alias("held"))
    )
    edges = [f(q).alias(f"{q}_{name}") for q in QUARTERS for name, f in (("low", F.min), ("high", F.max))]
    halves = [F.min(F.col("q1") + F.col("q2")).alias("left"), F.min(F.col("q3") + F.col("q4")).alias("right")]
    return tiles, planned.groupBy("group").agg(F.max("parts").alias("parts"), *halves, *edges)


def meetings(groups: DataFrame) -> DataFrame:
    """Pairs of tiles (group, part, other, other_part) whose counts allow a link, each once."""
    steps = [(x, y) for x in range(-RADIUS, RADIUS + 1) for y in range(-RADIUS, RADIUS + 1) if abs(x) + abs(y) <= RADIUS]
    around = F.explode(F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in steps])).alias("step")
    one = groups.select("*", around).withColumns({"near_left": F.col("left") + F.col("step.x"), "near_right": F.col("right") + F.col("step.y")})
    two = groups.select(*[F.col(c).alias(f"other_{c}") for c in groups.columns])
    near = (one["near_left"] == two["other_left"]) & (one["near_right"] == two["other_right"]) & (one["group"] <= two["other_group"])
    gaps = [F.greatest(F.lit(0), F.col(f"{q}_low") - F.col(f"other_{q}_high"), F.col(f"other_{q}_low") - F.col(f"{q}_high")) for q in QUARTERS]
    met = one.join(two, near).filter(sum(gaps[1:], gaps[0]) <= RADIUS)
    numbered = met.select(
        "group", F.col("other_group").alias("other"), "other_parts",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1)).alias("part"))
    numbered = numbered.withColumn("other_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("other_parts").cast("long") - 1)))
    return numbered.filter("group < other or part <= other_part").select("group", "part", "other", "other_part")


def _linked(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in a and in b of all pairs within the radius, some pairs at a time.

    Both are taken in the order of the count of their first quarter, so that only runs whose counts are near meet.
    """
    quarter = np.uint64(65535)
    order_a, order_b = np.argsort(np.bitwise_count(a & quarter), kind="stable"), np.argsort(np.bitwise_count(b & quarter), kind="stable")
    count_a, count_b = (np.bitwise_count(x & quarter).astype(int) for x in (a[order_a], b[order_b]))
    for count in np.unique(count_a):
        left = order_a[count_a == count]
        right = order_b[np.searchsorted(count_b, count - RADIUS) : np.searchsorted(count_b, count + RADIUS, "right")]
        step = max(1, PAIRS // max(1, len(right)))
        for low in range(0, len(left) if len(right) else 0, step):
            some = left[low : low + step]
            i, j = np.nonzero(np.bitwise_count(a[some][:, None] ^ b[right]) <= RADIUS)
            yield some[i], right[j]


def _merged(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels of nodes after the links (i, j): the smallest place in each one's component."""
    while True:
        x, y = label[i], label[j]
        apart = x != y
        if not apart.any():
            return label
        i, j, x, y = i[apart], j[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each meeting a forest (centre, key) that connects whatever its links connect."""
    for batch in batches:
        for row in range(batch.num_rows):
            a, b = (batch.column(c)[row].values.to_numpy(zero_copy_only=False).view(np.uint64) for c in ("held", "other_held"))
            same = all(batch.column(c)[row] == batch.column(f"other{d}")[row] for c, d in (("group", ""), ("part", "_part")))
            both = a if same else np.concatenate([a, b])
            label = np.arange(len(both))
            for i, j in _linked(a, b):
                label = _merged(label, i, j if same else j + len(a))
            joined = np.flatnonzero(label != np.arange(len(both)))
            ends = [pa.array(both[x].view(np.int64)) for x in (label[joined], joined)]
            yield pa.RecordBatch.from_arrays(ends, ["centre", "key"])


def links(classes: DataFrame, tile: int = TILE) -> DataFrame:
    """Edges (centre, key) between fingerprints that connect all that links within the radius connect."""
    tiles, groups = _tiles(classes, tile)
    tiles = kept(tiles, "simhash-tiles")
    other = tiles.select(F.col("group").alias("other"), F.col("part").alias("other_part"), F.col("held").alias("other_held"))
    met = meetings(groups).join(tiles, ["group", "part"]).join(other, ["other", "other_part"])
    # tiles in the middle of the range meet most others: their meetings are dealt over all tasks
    return met.repartition("group", "part", "other", "other_part").mapInArrow(_compare, "centre long, key long").distinct()


def components(docs: DataFrame) -> DataFrame:
    """Groups of near copies: doc_id, fingerprint (16 hexadecimal digits), component_id and n_copies; one row per input row.

    Fingerprints that differ in two bits at most are linked; component_id is the smallest doc_id that links reach, itself
    included. Null and empty texts have fingerprint zero and are linked like any other. n_copies counts the rows of the
    same fingerprint, repeated rows included. Null ids take part but never name a component unless no other id is
    there. Ids are integers; columns other than doc_id and text are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = kept(docs.mapInArrow(_read, "doc_id long, fingerprint long"), "simhash-rows")
    classes = kept(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first"), F.count("*").alias("n_copies")), "simhash-classes")
    edges = kept(links(classes), "simhash-links")
    if not edges.isEmpty():
        labels = connected(edges)
        group = labels.join(classes, labels["key"] == classes["fingerprint"]).groupBy("label").agg(F.min("first").alias("component"))
        named = labels.join(group, "label").select(F.col("key").alias("fingerprint"), "component")
        classes = classes.join(named, "fingerprint", "left").withColumn("first", F.coalesce("component", "first")).drop("component")
    return rows.join(classes, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.coalesce("first", "doc_id").alias("component_id"), "n_copies")
