"""N-gram Jaccard join by universe partition and pigeonhole, with groups of linked documents.

Documents are sets of hashed word shingles. Sets of Jaccard 0.8 or more differ in at most a quarter of the smaller one's
size, so by bands of that size a bound H on the differences is known. The universe of shingles is cut into segments, and
a set's signatures are hashes of its part of each segment:

* with H + 1 + e segments, e of which each set may leave out, two linked sets agree in at least e + 1 segments. A set
  leaves out its e costliest, in an order that depends on a segment's content only (empty ones first, then by how
  frequent its rarest shingle is); so the cheapest segment in which both agree is left out by neither.
* small sets have few shingles a segment, so they use H // 2 + 1 larger segments: in one of them the sets differ by at
  most one shingle, and both hold the one-deletion neighbourhood beside the segment itself.

Shingle frequencies come from a count sketch over all documents. Equal sets are one class from the start, so copies send
nothing twice. Signatures travel packed, about ten bytes each. In a bucket of classes that share a signature, first each
is verified against one centre. Then every two classes of a bucket that are not yet connected are compared: as pairs in
small buckets, block by block in large ones. So every link that could join two components is looked at. Verification
compares the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .shared import kept

SHINGLE = 5
#: Linked if 100 * intersection >= PERCENT * union.
PERCENT = 80
SKETCH_BITS = 17
#: Bands whose sets may differ in so many shingles at most use one-deletion neighbourhoods.
DELETION_BOUND = 7
BLOCK = 1 << 19
GROUP = 1 << 20
#: Signatures that one task sorts at most; groups with more of them hold a frequent one and are dealt by signature and class.
TASK_SIGNS = 4 << 20
#: Numbers of such groups that are sent to every task at most.
BROADCAST_GROUPS = 100_000
#: Ids that are sent to every scan of the documents at most; 16 bytes each.
BROADCAST_IDS = 1_000_000
#: Members that are compared with one copy of a centre.
MEMBERS = 500
#: Buckets with more classes are compared in blocks of sets instead of as pairs.
SMALL_BUCKET = 16
BLOCK_SETS = 512
COLUMNS = 4096


def _bands() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each band: largest size, bound on differences, segments, segments to leave out (-1: neighbourhoods)."""
    top, bound, segments, skip = [], [], [], []
    low = 1
    while low < 1 << 30:
        high = low * 100 // PERCENT
        # sizes a <= b <= a / t differ in at most (a + b) (1 - t) / (1 + t) <= a (1 - t) / t shingles
        h = high * (100 - PERCENT) // PERCENT
        extra = -(-(h + 1) // 5) + 2
        small = h <= DELETION_BOUND
        top.append(high)
        bound.append(h)
        segments.append(h // 2 + 1 if small else h + 1 + extra)
        skip.append(-1 if small else extra)
        low = high + 1
    return np.array(top), np.array(bound), np.array(segments), np.array(skip)


TOP, BOUND, SEGMENTS, SKIP = _bands()


def shingle_sets(column: pa.Array, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashed shingles of each text, distinct and ascending, text by text; and where each text's begin.

    Words are lower-cased in A-Z. A text of fewer words is one shingle, one without words has none.
    """
    data, offsets = T.flat(column)
    start, end, first = T.words(data, offsets)
    codes = T.word_codes(data, start, end, T.LOWERED)
    n = np.diff(first)
    full = T.chains(codes, shingle)
    row = T.owners(first)[: len(full)]
    whole = np.arange(len(full)) + shingle <= first[row + 1]
    tokens, rows = [full[whole]], [row[whole]]
    for short in range(1, shingle):
        at = np.flatnonzero(n == short)
        if len(at):
            tokens.append(T.chains(codes[(first[at][:, None] + np.arange(short)).ravel()], short)[::short])
            rows.append(at)
    token, row = np.concatenate(tokens), np.concatenate(rows)
    order = np.lexsort((token, row))
    token, row = token[order], row[order]
    fresh = np.ones(len(token), bool)
    fresh[1:] = (token[1:] != token[:-1]) | (row[1:] != row[:-1])
    return token[fresh], np.searchsorted(row[fresh], np.arange(len(n) + 1))


def class_keys(token: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One 64-bit key of each set."""
    sums = np.zeros(len(token) + 1, np.uint64)
    np.cumsum(T.mix(token ^ np.uint64(0xA5A5A5A5A5A5A5A5)), out=sums[1:])
    n = np.diff(first).astype(np.uint64)
    return T.mix(sums[first[1:]] - sums[first[:-1]] + n * np.uint64(0x9E3779B97F4A7C15))


def _classes(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, n, key) of each row, and a row with a sketch of shingle counts of each task."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, np.int64)
        names = ["doc_id", "digest", "n", "key", "sketch"]
        for batch in batches:
            for part in T.pieces(batch):
                token, first = shingle_sets(part.column("text"))
                sketch += np.bincount((token >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(sketch))
                key = class_keys(token, first).view(np.int64)
                columns = [part.column("doc_id"), part.column("digest"), pa.array(np.diff(first), pa.int64()), pa.array(key), pa.nulls(len(key), pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names)
        nothing = [pa.nulls(1, pa.int64())] * 4
        yield pa.RecordBatch.from_arrays([*nothing, pa.array([np.minimum(sketch, 2**31 - 1).astype(np.int32).tobytes()])], names)

    return docs.mapInArrow(read, "doc_id long, digest long, n long, key long, sketch binary")


def _sketch(read: DataFrame) -> np.ndarray:
    """The tasks' sketches added up, in a few tasks first; of fixed size."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            for sketch in batch.column(0):
                total += np.frombuffer(sketch.as_py(), np.int32)
        yield pa.RecordBatch.from_arrays([pa.array([np.minimum(total, 2**31 - 1).astype(np.int32).tobytes()])], ["sketch"])

    total = np.zeros(1 << SKETCH_BITS, np.int64)
    for row in read.filter("sketch is not null").select("sketch").coalesce(8).mapInArrow(add, "sketch binary").collect():
        total += np.frombuffer(row.sketch, np.int32)
    return total


def signatures(token: np.ndarray, first: np.ndarray, band: np.ndarray, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of the sets in the scheme of the given bands (-1: none): hash and row."""
    n = np.diff(first)
    m = np.where(band >= 0, SEGMENTS[band], 0)
    row = np.repeat(np.arange(len(n)), n)
    used = m[row] > 0
    row, token = row[used], token[used]
    base = np.concatenate([[0], np.cumsum(m)])
    # hashes ascend, so the segment, a part of their range, does too
    segment = base[row] + (((token >> np.uint64(32)) * m[row].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
    spread = T.mix(token)
    cuts = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]])) if len(segment) else np.zeros(0, np.int64)
    at = segment[cuts]
    content = np.zeros(base[-1], np.uint64)
    cost = np.full(base[-1], np.iinfo(np.int64).max)
    if len(cuts):
        content[at] = np.add.reduceat(spread, cuts)
        cost[at] = np.minimum.reduceat(sketch[(token >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)], cuts)
    owner = np.repeat(np.arange(len(n)), m)
    place = np.arange(base[-1]) - base[owner]
    name = T.mix((band[owner] + 1).astype(np.uint64) * np.uint64(1 << 40) + place.astype(np.uint64))
    skip = SKIP[band[owner]]
    # exact segments: all but the costliest; the order depends on content and place alone
    exact = np.flatnonzero(skip >= 0)
    order = exact[np.lexsort((place[exact], content[exact], -cost[exact], owner[exact]))]
    rank = np.arange(len(order)) - np.searchsorted(owner[order], owner[order])
    chosen = order[rank >= skip[order]]
    near = np.flatnonzero(skip < 0)
    whole = np.concatenate([chosen, near])
    deleted = np.flatnonzero(skip[segment] < 0) if len(segment) else np.zeros(0, np.int64)
    without = content[segment[deleted]] - spread[deleted]
    found = np.concatenate([T.mix(content[whole] ^ name[whole]), T.mix(without ^ name[segment[deleted]])])
    return found, np.concatenate([owner[whole], row[deleted]])


MET = "bucket long, centre long, key long"


def _unpacked(table: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Signature and class of each entry of packed rows."""

    def joined(name: str, kind) -> np.ndarray:
        return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)

    return joined("signs", np.uint64), np.repeat(joined("keys", np.uint64), joined("counts", np.uint32))


def _met_by_rows(signed: DataFrame) -> DataFrame:
    """Buckets of packed signatures, one row for each signature and class: no task holds all classes of a signature."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                sign, key = _unpacked(batch.slice(i, 1))
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (sign, key)], ["sign", "key"])

    rows = kept(signed.mapInArrow(unpack, "sign long, key long").distinct(), "jaccard-rows")
    shared = rows.groupBy("sign").agg(F.min("key").alias("centre"), F.bit_xor(F.xxhash64("key")).alias("bucket"), F.count("*").alias("n"))
    return rows.join(shared.filter("n > 1"), "sign").select("bucket", "centre", "key")


def _buckets(docs: DataFrame, sketch: np.ndarray, groups: int) -> DataFrame:
    """Classes that share a signature: (bucket, centre, key), where centre is one of the bucket's keys.

    Signatures are packed by the range of their hash. Their number in each range is counted before anything is grouped: a
    range with too many for a task, as a signature of very many classes makes it, is met row by row (``_met_by_rows``).
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            sign, key = (np.concatenate(x) for x in zip(*held))
            held.clear()
            to = ((sign >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)
            order = np.lexsort((sign, key, to))
            to, key, sign = to[order], key[order], sign[order]
            fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (sign[1:] != sign[:-1])])
            to, key, sign = to[fresh], key[fresh], sign[fresh]
            new = np.concatenate([[True], to[1:] != to[:-1]])
            run = new | np.concatenate([[True], key[1:] != key[:-1]])
            cuts, runs = np.append(np.flatnonzero(new), len(to)), np.append(np.flatnonzero(run), len(to))
            run_cuts = np.searchsorted(runs, cuts)
            return pa.RecordBatch.from_arrays(
                [pa.array(to[cuts[:-1]], pa.int32()), pa.array(np.diff(cuts), pa.int64()), T.binaries(sign, cuts), T.binaries(key[runs[:-1]], run_cuts), T.binaries(np.diff(runs).astype(np.uint32), run_cuts)],
                ["group", "number", "signs", "keys", "counts"])

        size = 0
        for batch in batches:
            for part in T.pieces(batch):
                token, first = shingle_sets(part.column("text"))
                key, n = class_keys(token, first), np.diff(first)
                # a set as the smaller of a pair signs in its own band, as the larger in the band below
                own = np.searchsorted(TOP, n)
                once = np.zeros(len(n), bool)
                once[np.unique(key, return_index=True)[1]] = True
                once &= n > 0
                below = np.where(own > 0, TOP[np.maximum(own - 1, 0)], 0) * 100 // PERCENT
                for band in (np.where(once & (BOUND[own] > 0), own, -1), np.where(once & (own > 0) & (n <= below) & (BOUND[np.maximum(own - 1, 0)] > 0), own - 1, -1)):
                    sign, row = signatures(token, first, band, sketch)
                    if len(sign):
                        held.append((sign, key[row]))
                        size += len(sign)
                if size >= BLOCK:
                    yield flush()
                    size = 0
        if size:
            yield flush()

    def meet(table: pa.Table) -> pa.Table:
        sign, key = _unpacked(table)
        order = np.argsort(sign)
        same = sign[order[1:]] == sign[order[:-1]]
        many = np.zeros(len(sign), bool)
        many[order[1:][same]] = True
        many[order[:-1][same]] = True
        sign, key = sign[many], key[many]
        order = np.lexsort((key, sign))
        sign, key = sign[order], key[order]
        fresh = np.ones(len(sign), bool)
        fresh[1:] = (sign[1:] != sign[:-1]) | (key[1:] != key[:-1])
        sign, key = sign[fresh], key[fresh]
        cuts = np.flatnonzero(np.concatenate([[True], sign[1:] != sign[:-1]])) if len(sign) else np.zeros(0, np.int64)
        size = np.diff(np.append(cuts, len(sign)))
        # of buckets with the same classes one is enough
        lists = np.add.reduceat(T.mix(key), cuts) + size.astype(np.uint64) if len(cuts) else np.zeros(0, np.uint64)
        take = np.zeros(len(cuts), bool)
        take[np.unique(lists, return_index=True)[1]] = True
        take &= size > 1
        stay = np.repeat(take, size)
        T.give_back()
        centre = np.repeat(key[cuts], size) if len(cuts) else key
        bucket = np.repeat(lists, size)
        return pa.table([pa.array(x[stay].view(np.int64), pa.int64()) for x in (bucket, centre, key)], ["bucket", "centre", "key"])

    signed = kept(docs.select("text").mapInArrow(emit, "group int, number long, signs binary, keys binary, counts binary"), "jaccard-signs")
    crowded = kept(signed.groupBy("group").agg(F.sum("number").alias("number")).filter(F.col("number") > TASK_SIGNS).select("group"), "jaccard-crowded")
    number = crowded.count()
    if not number:
        return signed.groupBy("group").applyInArrow(meet, MET)
    crowded = F.broadcast(crowded) if number <= BROADCAST_GROUPS else crowded
    rest = signed.join(crowded, "group", "left_anti").groupBy("group").applyInArrow(meet, MET)
    return rest.unionByName(_met_by_rows(signed.join(crowded, "group", "left_semi")))


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Of distinct pairs of classes (centre, key) those whose sets are linked.

    A centre is laid beside at most about MEMBERS members in a task, read as a stream: centre first, then its members.
    """
    counts = pairs.groupBy("centre").agg(F.count("*").alias("members"))
    dealt = pairs.join(counts, "centre").select("centre", "key", F.pmod(F.xxhash64("key"), F.ceil(F.col("members") / MEMBERS)).alias("part"))
    heads = dealt.select("centre", "part").distinct().select("centre", "part", F.col("centre").alias("key"), F.lit(0).alias("member"))
    sides = heads.unionByName(dealt.select("centre", "part", "key", F.lit(1).alias("member")))
    laid = sides.join(texts, "key").repartition("centre", "part").sortWithinPartitions("centre", "part", "member")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, held = None, np.zeros(0, np.uint64)
        for batch in batches:
            for part in T.pieces(batch):
                token, first = shingle_sets(part.column("text"))
                centres, members, keys = part.column("centre").to_pylist(), part.column("member").to_pylist(), part.column("key").to_pylist()
                linked = []
                for i in range(len(keys)):
                    own = token[first[i] : first[i + 1]]
                    if not members[i]:
                        centre, held = centres[i], own.copy()
                        continue
                    assert centre == centres[i]
                    both = 0
                    if 100 * min(len(own), len(held)) >= PERCENT * max(len(own), len(held)):
                        at = np.searchsorted(held, own)
                        at[at == len(held)] = 0
                        both = int((held[at] == own).sum())
                    if 100 * both >= PERCENT * (len(own) + len(held) - both):
                        linked.append((centre, keys[i]))
                yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in linked], pa.int64()) for j in (0, 1)], ["centre", "key"])

    return laid.select("centre", "member", "key", "text").mapInArrow(compare, "centre long, key long")


def connected(edges: DataFrame) -> DataFrame:
    """(key, label) of all ends of the edges (centre, key): the smallest key that can be reached.

    Every key takes its smallest neighbour's name, or its own, and the edges are drawn again between names, until none
    is left between two of them; then the names are followed back. As keys are hashes, each round leaves a fraction of
    the edges of the one before.
    """
    both = edges.select(F.col("centre").alias("a"), F.col("key").alias("b")).unionAll(edges.select("key", "centre"))
    both = kept(both.distinct(), "jaccard-edges")
    levels = []
    while not levels or not both.isEmpty():
        named = kept(both.groupBy(F.col("a").alias("key")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "jaccard-labels")
        levels.append(named)
        one, two = named.select(F.col("key").alias("a"), F.col("label").alias("x")), named.select(F.col("key").alias("b"), F.col("label").alias("y"))
        drawn = both.join(one, "a").join(two, "b").filter("x != y").select(F.col("x").alias("a"), F.col("y").alias("b"))
        both = kept(drawn.distinct(), "jaccard-edges")
    labels = levels.pop()
    while levels:
        named, last = levels.pop(), labels.select(F.col("key").alias("at"), F.col("label").alias("root"))
        labels = named.join(last, named["label"] == last["at"], "left").select("key", F.coalesce("root", "label").alias("label"))
    return kept(labels, "jaccard-labels")


def _mixed(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Members (bucket, key, part, size) of buckets that hold classes of several components, with the component."""
    named = members.select("bucket", "key", F.col("key").alias("part"))
    if labels is not None:
        named = members.select("bucket", "key").join(labels, "key", "left").select("bucket", "key", F.coalesce("label", "key").alias("part"))
    mixed = named.groupBy("bucket").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count("*").alias("size"))
    return named.join(mixed.filter("low != high").select("bucket", "size"), "bucket")


def _pairs(named: DataFrame) -> DataFrame:
    """Pairs of classes of different components in small buckets."""
    small = named.filter(F.col("size") <= SMALL_BUCKET)
    a, b = small.alias("a"), small.alias("b")
    pairs = a.join(b, (F.col("a.bucket") == F.col("b.bucket")) & (F.col("a.part") < F.col("b.part")))
    return pairs.select(F.least("a.key", "b.key").alias("centre"), F.greatest("a.key", "b.key").alias("key")).distinct()


def _shared_shingles(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of two blocks, by products of 0/1 matrices over some shingles at a time."""
    out = np.zeros((len(a), len(b)), np.float32)
    common = np.intersect1d(np.concatenate(a), np.concatenate(b))
    for low in range(0, len(common), COLUMNS):
        columns = common[low : low + COLUMNS]
        sides = []
        for sets in (a, b):
            side = np.zeros((len(sets), len(columns)), np.float32)
            for i, own in enumerate(sets):
                at = np.minimum(np.searchsorted(columns, own), len(columns) - 1)
                side[i, at[columns[at] == own]] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T
    return out


def _verified_in_blocks(named: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (centre, key) between classes of different components in large buckets.

    Large buckets that share classes make a family. A family's classes are dealt to blocks of about BLOCK_SETS and each
    two blocks meet in a task, which compares their sets at once; no row is made for a pair. Of several links between the
    same two components one is given.
    """
    large = named.filter(F.col("size") > SMALL_BUCKET)
    centres = large.groupBy("bucket").agg(F.min("key").alias("centre"))
    edges = large.join(centres, "bucket").filter("key != centre").select("centre", "key").distinct()
    family = connected(edges).withColumnRenamed("label", "family")
    sizes = family.groupBy("family").agg(F.ceil(F.count("*") / BLOCK_SETS).alias("blocks"))
    parts = large.select("key", "part").distinct()
    dealt = family.join(sizes, "family").join(parts, "key").withColumn("own", F.pmod(F.xxhash64("key"), "blocks"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.select("family", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "own", "key", "part")

    def compare(table: pa.Table) -> pa.Table:
        keys, parts = table.column("key").to_numpy(), table.column("part").to_numpy()
        sets: list[np.ndarray] = []
        for batch in table.combine_chunks().to_batches():
            for part in T.pieces(batch):
                token, first = shingle_sets(part.column("text"))
                sets += [token[low:high].copy() for low, high in zip(first[:-1], first[1:])]
        size = np.array([len(x) for x in sets])
        first = table.column("own").to_numpy() == table.column("one")[0].as_py()
        a = np.flatnonzero(first)
        b = np.flatnonzero(~first) if table.column("one")[0] != table.column("two")[0] else a
        links: dict[tuple[int, int], tuple[int, int]] = {}
        if len(a) and len(b):
            both = _shared_shingles([sets[i] for i in a], [sets[i] for i in b])
            linked = (100 * both >= PERCENT * (size[a][:, None] + size[b] - both)) & (parts[a][:, None] != parts[b])
            for i, j in zip(*np.nonzero(linked)):
                i, j = sorted((a[i], b[j]), key=lambda x: parts[x])
                links.setdefault((parts[i], parts[j]), (keys[i], keys[j]))
        return pa.table([pa.array([x[k] for x in links.values()], pa.int64()) for k in (0, 1)], ["centre", "key"])

    return dealt.join(texts, "key").groupBy("family", "one", "two").applyInArrow(compare, "centre long, key long")


def links(docs: DataFrame, classes: DataFrame, sketch: np.ndarray, shingles: int) -> DataFrame | None:
    """Components (key, label) of the classes that are linked with another one; None if there are none."""
    signs = max(1, int(0.6 * shingles))
    members = kept(_buckets(docs, sketch, -(-signs // GROUP)).distinct(), "jaccard-buckets")
    wanted = members.select("key").distinct().join(classes.groupBy("key").agg(F.min_by(F.struct("doc_id", "digest"), F.struct("doc_id", "digest")).alias("doc")), "key")
    wanted = kept(wanted.select("key", F.col("doc.doc_id").alias("want_id"), F.col("doc.digest").alias("want_digest")), "jaccard-wanted")
    number = wanted.count()
    if not number:
        return None
    near = F.broadcast(wanted) if number <= BROADCAST_IDS else wanted
    same = docs["doc_id"].eqNullSafe(near["want_id"]) & (docs["digest"] == near["want_digest"])
    texts = kept(docs.join(near, same).select("key", "text").dropDuplicates(["key"]), "jaccard-texts")

    stars = members.filter("key != centre").select("centre", "key").distinct()
    edges = kept(_verified(stars, texts), "jaccard-links")
    labels = None if edges.isEmpty() else connected(edges)
    named = kept(_mixed(members, labels), "jaccard-mixed")
    if named.isEmpty():
        return labels
    more = kept(_verified(_pairs(named).join(stars, ["centre", "key"], "left_anti"), texts).unionAll(_verified_in_blocks(named, texts)), "jaccard-links")
    return labels if more.isEmpty() else connected(edges.unionAll(more))


def components(docs: DataFrame) -> DataFrame:
    """Groups of near-duplicate documents: doc_id, digest (of the text), n_shingles, component_id, n_copies and
    component_key; one row per input row.

    Two documents are linked when 100 * intersection >= 80 * union of their sets of 5-word shingles; component_id is the
    smallest doc_id that can be reached by links, itself included. Documents of fewer words are one shingle; null and
    empty ones have none and are linked with nothing, not even their like (n_copies 0). n_copies counts the rows with the
    same set. Null ids take part but never name a component, unless no other id is there. component_key tells components apart
    also where an id has several texts or is null; it is null without shingles. Ids are integers; columns other than
    doc_id and text are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("digest"))
    read = kept(_classes(docs), "jaccard-classes")
    rows = read.filter("sketch is null")
    classes = rows.filter("n > 0").select("doc_id", "digest", "key")
    shingles = rows.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    labels = links(docs, classes, _sketch(read), shingles) if shingles else None
    firsts = classes.groupBy("key").agg(F.min("doc_id").alias("first"), F.count("*").alias("n_copies")).withColumn("label", F.col("key"))
    if labels is not None:
        group = labels.join(firsts.drop("label"), "key").groupBy("label").agg(F.min("first").alias("component"))
        named = labels.join(group, "label").select("key", "component", F.col("label").alias("name"))
        firsts = firsts.join(named, "key", "left").select(
            "key", F.coalesce("component", "first").alias("first"), "n_copies", F.coalesce("name", "label").alias("label"))
    return rows.join(firsts.withColumnRenamed("key", "own"), (rows["key"] == F.col("own")) & (rows["n"] > 0), "left").select(
        "doc_id", "digest", F.col("n").alias("n_shingles"), F.coalesce("first", "doc_id").alias("component_id"),
        F.coalesce("n_copies", F.lit(0)).alias("n_copies"), F.col("label").alias("component_key"))
