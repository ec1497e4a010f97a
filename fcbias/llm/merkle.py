"""A Merkle manifest of a table, and the climb from every leaf to the root as a recursive query.

A leaf is the digest of a row's fields. The leaves of a group (a language), in their order, are the leaves of a tree in
which every eight consecutive nodes become the digest of their digests, until one is left; those of all groups, ordered
by group, are the leaves of one upper tree in the same way. Digests are SHA-256, and a node digests the lowercase hex
text of its children.

The built levels are kept as rows, one for each node with the digests of its children and its place above. The climb is
one recursive query: each leaf starts with its own (or a doubted) digest, meets the node above it, gives the siblings it
finds there and folds its digest, until no node is above. The upper nodes of a tree are met by all its leaves, so these
rows are repeated for every block of 4,096 leaves, and no join key holds more rows than that.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.aggregates import with_place
from .shared import kept

#: Children of a node are 2^STEP.
STEP = 3
#: Levels inside a block of leaves.
INSIDE = 4
BLOCK = 1 << STEP * INSIDE
RECURSION_LIMIT = "spark.sql.cteRecursionRowLimit"


@dataclass
class Manifest:
    """Stored tables of a manifest.

    ``leaves`` has id, tree, position, size (of the tree), leaf (32 bytes) and the columns carried along; ``trees`` has
    tree, the group, size and subroot (hex); ``nodes`` the rows that the climb meets. ``root`` (hex) is None for a table
    without rows.
    """

    leaves: DataFrame
    trees: DataFrame
    nodes: DataFrame | None
    root: str | None


def digest_of(*fields: str | Column) -> Column:
    """Hex SHA-256 of fields: each is `-` if null, else its bytes in UTF-8, a colon and the value as text."""
    parts = []
    for field in fields:
        value = (F.col(field) if isinstance(field, str) else field).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _text(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def _levels(leaves: DataFrame, largest: int) -> list[DataFrame]:
    """Nodes (tree, size, place, digest, run) of each level above leaves (tree, size, place, digest), level by level.

    ``run`` holds the children's digests. A tree has nodes in a level only while several are left below.
    """
    levels, below, width = [], leaves, 1
    while width < largest:
        above = F.shiftright("place", STEP)
        children = F.array_sort(F.collect_list(F.struct("place", "digest")))
        runs = below.filter(F.col("size") > width).groupBy("tree", "size", above.alias("place")).agg(children.alias("children"))
        joined = runs.select("tree", "size", "place", F.array_join(F.transform("children", lambda c: _text(c["digest"])), "").alias("text"))
        below = kept(joined.select("tree", "size", "place", F.unhex(F.sha2("text", 256)).alias("digest"), F.unhex("text").alias("run")), "merkle-level")
        levels.append(below)
        width <<= STEP
    return levels


def _roots(leaves: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(tree, digest) of the last node of each tree."""
    roots = leaves.filter("size = 1").select("tree", "digest")
    for k, level in enumerate(levels):
        low = 1 << STEP * k
        roots = roots.unionAll(level.filter((F.col("size") > low) & (F.col("size") <= low << STEP)).select("tree", "digest"))
    return roots


def _height(size: Column) -> Column:
    """Levels above the leaves of a tree of so many."""
    return F.size(F.filter(F.array(*[F.lit(1 << STEP * k) for k in range(21)]), lambda power: power < size))


def _met(trees: DataFrame, levels: list[DataFrame], upper: list[DataFrame]) -> DataFrame:
    """Nodes by where a leaf meets them: (tree, block, step, inside, place, run).

    ``inside`` is the node's number within its block; from the top of a block on it is 0 and ``place``, the child's
    place in the run, is that of the whole block.
    """
    blocks = trees.select("tree", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.shiftright(F.col("size") - 1, STEP * INSIDE))).alias("block"))
    seven = F.lit(7).cast("long")
    found = []
    for k, level in enumerate(levels, 1):
        if k <= INSIDE:
            bits = STEP * (INSIDE - k)
            found.append(level.select(
                "tree", F.shiftright("place", bits).alias("block"), F.lit(k).alias("step"),
                F.col("place").bitwiseAND(F.lit((1 << bits) - 1).cast("long")).alias("inside"), F.lit(None).cast("long").alias("place"), "run"))
        else:
            at = blocks.withColumn("at", F.shiftright("block", STEP * (k - INSIDE)))
            child = F.shiftright("block", STEP * (k - 1 - INSIDE)).bitwiseAND(seven)
            above = level.select("tree", F.col("place").alias("at"), "run")
            found.append(at.join(above, ["tree", "at"]).select("tree", "block", F.lit(k).alias("step"), F.lit(0).cast("long").alias("inside"), child.alias("place"), "run"))
    for k, level in enumerate(upper, 1):
        at = blocks.withColumn("at", F.shiftright("tree", STEP * k))
        child = F.shiftright("tree", STEP * (k - 1)).bitwiseAND(seven)
        above = level.select(F.col("place").alias("at"), "run")
        found.append(at.join(above, "at").select("tree", "block", (_height(F.col("size")) + k).alias("step"), F.lit(0).cast("long").alias("inside"), child.alias("place"), "run"))
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out


def build(rows: DataFrame, group: str, order: list[str]) -> Manifest:
    """Manifest of rows that have a ``leaf`` (32 bytes), a group and columns that order them within it, null first.

    Rows that tie in the order are told apart by their leaf; exact repeats are leaves of their own. Other columns are
    carried along; names that the manifest itself uses (id, tree, position, size) must not be among them.
    """
    # the digests are stored before the sort, which reads its input twice
    rows = kept(rows.withColumn("repeat", F.monotonically_increasing_id()), "merkle-rows")
    numbered = with_place(rows, [group, *order, "leaf", "repeat"]).drop("repeat").withColumnRenamed("place", "id")
    groups = numbered.groupBy(group).agg(F.min("id").alias("first"), F.count("*").alias("size"))
    groups = kept(with_place(groups, [group]).withColumn("tree", F.col("place") - 1).drop("place"), "merkle-groups")
    same = numbered[group].eqNullSafe(groups[group])
    leaves = numbered.join(groups.select(group, "first", "size", "tree"), same).drop(groups[group])
    leaves = kept(leaves.withColumn("position", F.col("id") - F.col("first")).drop("first"), "merkle-leaves")
    sizes = groups.agg(F.max("size").alias("largest"), F.count("*").alias("trees")).first()
    if not sizes.trees:
        return Manifest(leaves, groups.select("tree", group, "size", F.lit("").alias("subroot")), None, None)
    bottom = leaves.select("tree", "size", F.col("position").alias("place"), F.col("leaf").alias("digest"))
    levels = _levels(bottom, sizes.largest)
    roots = kept(_roots(bottom, levels), "merkle-subroots")
    top = roots.select(F.lit(0).cast("long").alias("tree"), F.lit(sizes.trees).cast("long").alias("size"), F.col("tree").alias("place"), "digest")
    upper = _levels(top, sizes.trees)
    root = _roots(top, upper).select(_text(F.col("digest")).alias("root")).first().root
    trees = kept(groups.join(roots, "tree").select("tree", group, "size", _text(F.col("digest")).alias("subroot")), "merkle-trees")
    nodes = kept(_met(trees, levels, upper), "merkle-nodes") if levels or upper else None
    return Manifest(leaves, trees, nodes, root)


CLIMB = f"""
with recursive climb(id, tree, block, inside, step, folded, siblings) as (
    select id, tree, block, inside, 0, folded, cast('' as binary) from {{start}}
    union all
    select id, tree, block, inside, step, unhex(sha2(concat(lower(hex(left)), lower(hex(folded)), lower(hex(right))), 256)), concat(left, right)
    from (
        select c.id, c.tree, c.block, c.inside, n.step, c.folded, substring(n.run, 1, 32 * at) as left, substring(n.run, 32 * at + 33) as right
        from climb c join (select *, tree as node_tree from {{nodes}}) n
            on n.node_tree = c.tree and n.block = c.block and n.step = c.step + 1 and n.inside = shiftright(c.inside, {STEP} * (c.step + 1))
        cross join lateral (select cast(coalesce(n.place, shiftright(c.inside, {STEP} * c.step) & 7) as int) as at)
    ) met
)
select id, step, folded, siblings from climb
"""


def climb(manifest: Manifest, doubted: str = "leaf") -> DataFrame:
    """(id, proof, folded), both of 32 bytes: the digest of a leaf's siblings up to the root, and the root that its
    doubted digest (a column of the leaves) leads to with them.

    The recursive query has a row of each leaf and level, so Spark's limit on its rows is lifted while it runs.
    """
    spark = manifest.leaves.sparkSession
    mask = F.lit(BLOCK - 1).cast("long")
    start = manifest.leaves.select(
        "id", "tree", F.shiftright("position", STEP * INSIDE).alias("block"), F.col("position").bitwiseAND(mask).alias("inside"), F.col(doubted).alias("folded"))
    if manifest.nodes is None:
        return start.select("id", F.unhex(F.sha2(F.lit(""), 256)).alias("proof"), "folded")
    limit = spark.conf.get(RECURSION_LIMIT)
    spark.conf.set(RECURSION_LIMIT, "-1")
    try:
        climbed = spark.sql(CLIMB, start=start, nodes=manifest.nodes)
        steps = F.array_sort(F.collect_list(F.struct("step", "siblings")))
        path = climbed.groupBy("id").agg(steps.alias("steps"), F.max_by("folded", "step").alias("folded"))
        proof = F.sha2(F.array_join(F.transform("steps", lambda s: _text(s["siblings"])), ""), 256)
        return kept(path.select("id", F.unhex(proof).alias("proof"), "folded"), "merkle-climb")
    finally:
        spark.conf.set(RECURSION_LIMIT, limit)


def audit(manifest: Manifest, doubted: str = "leaf") -> DataFrame:
    """The leaves with subroot, root, proof_sha256, folded_root and verified: whether the doubted digest leads to the
    root. Digests are hex."""
    found = manifest.leaves.join(climb(manifest, doubted), "id").join(manifest.trees.select("tree", "subroot"), "tree")
    found = found.withColumns({"leaf": _text(F.col("leaf")), "proof_sha256": _text(F.col("proof")), "folded_root": _text(F.col("folded"))}).drop("proof", "folded")
    return found.withColumn("root", F.lit(manifest.root).cast("string")).withColumn("verified", F.col("folded_root") == F.col("root"))
