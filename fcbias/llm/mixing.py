"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame operations.

Every source's words, in an order of its documents that a hash fixes, are cut into blocks of equally many words. Slot i
of the schedule belongs to the source in whose share of the cumulative weights the point frac(i * golden ratio) falls;
the r-th slot of a source takes its block r modulo the number of its blocks, so sources stay mixed along the whole
schedule and wrap evenly. The last slot of a source is cut so that it takes its target and not a word more.

Running sums and ranks go over buckets first and inside them second, so that no source is ever numbered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import kept

WORD = r"[^\x20\x09-\x0D]+"
GOLDEN = 0.6180339887498949
#: Rows that one bucket of documents, and one chunk of slots, has on average.
BUCKET_ROWS = 20_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """Words to take of each source, from (source, source_size): ``share`` of all words by weight, none above its cap.

    Weights repeat over the sources in the order of code points, null last. What a cap (``most`` times the source's size)
    leaves over goes to the others by weight, until none is above: with the sources in the order of cap by weight there
    is one level at which a source gets its weight times the level or its cap. One row per source is ordered here.
    """
    placed = sizes.withColumn("at", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    placed = placed.select(
        "source", "source_size", "at",
        F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("at") % len(weights) + 1).cast("int")).alias("weight"),
        (F.col("source_size") * float(most)).alias("cap"),
    )
    everything = Window.partitionBy()
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "at").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.select(
        "*",
        (F.sum("source_size").over(everything) * float(share)).alias("asked"),
        F.coalesce(F.sum("cap").over(by_level), F.lit(0.0)).alias("capped"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_level), F.lit(0.0))).alias("open"),
    )
    level = (F.col("asked") - F.col("capped")) / F.col("open")
    # beyond the right source the levels fall, as they hold for capped what is not
    found = F.max(F.when(F.col("cap") / F.col("weight") >= level, level)).over(everything)
    return placed.withColumn("level", found).select(
        "source", "source_size", "at",
        F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("weight") * F.col("level"))).alias("target"),
    )


def _laid(docs: DataFrame, seed: int, rows: int) -> DataFrame:
    """Each document's place in the words of its source: (source, doc_id, size, row, begin)."""
    buckets = max(1, -(-rows // BUCKET_ROWS))
    docs = docs.withColumn("row", F.xxhash64(F.lit(seed), "doc_id", "digest"))
    docs = docs.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)))
    sums = docs.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source", "bucket").orderBy("row", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    docs = docs.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = docs.join(sums, docs["source"].eqNullSafe(sums["s"]) & (docs["bucket"] == sums["b"]))
    return joined.select("source", "doc_id", "digest", "size", (F.col("base") + F.col("inner")).alias("begin"))


def schedule(plan: DataFrame, slots: int) -> DataFrame:
    """Slots of the mix: (slot, at, rank) for sources (at, needed), each with exactly its number of slots.

    Points fill the slots; slots beyond what a source needs are left out, and the few that a source lacks, as rounding of
    the points may leave it short, follow at the end.
    """
    spark = plan.sparkSession
    total = F.sum("needed").over(Window.partitionBy())
    ends = F.sum("needed").over(Window.orderBy("at"))
    shares = plan.filter("needed > 0").select("at", "needed", ((ends - F.col("needed")) / total).alias("low"), (ends / total).alias("high"))
    # a few cells of the unit interval per source make the look-up an equi-join; cells follow the number of sources
    cells = 1024
    cut = shares.select("at", "needed", "low", "high", F.explode(F.sequence(F.floor(F.col("low") * cells), F.floor(F.col("high") * cells))).alias("cell"))
    points = spark.range(slots).select("id", (F.col("id") * GOLDEN % 1.0).alias("point"))
    points = points.withColumn("cell", F.floor(F.col("point") * cells))
    hit = points.join(cut, "cell").filter("point >= low and point < high").select("id", "at", "needed")
    chunk = F.floor(F.col("id") / BUCKET_ROWS)
    hit = hit.withColumn("chunk", chunk)
    counts = hit.groupBy("at", "chunk").agg(F.count("*").alias("n"))
    counts = counts.withColumn("base", F.coalesce(F.sum("n").over(Window.partitionBy("at").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inner = F.row_number().over(Window.partitionBy("at", "chunk").orderBy("id")) - 1
    ranked = hit.withColumn("inner", inner).join(counts.select("at", "chunk", "base"), ["at", "chunk"])
    ranked = ranked.select(F.col("id").alias("slot"), "at", (F.col("base") + F.col("inner")).alias("rank"), "needed").filter("rank < needed")
    had = counts.groupBy("at").agg(F.sum("n").alias("had"))
    lacking = plan.filter("needed > 0").join(had, "at", "left").withColumn("had", F.coalesce("had", F.lit(0))).filter("had < needed")
    late = lacking.select("at", F.explode(F.sequence("had", F.col("needed") - 1)).alias("rank"))
    return ranked.select("slot", "at", "rank").unionByName(late.select((F.lit(slots) + F.col("rank") * 1024 + F.col("at")).alias("slot"), "at", "rank"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, block: int = 1024, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """Mix sources: (per document: doc_id, source, size, source_size, target, taken; schedule: slot, source, rank, block).

    Sizes are in words. A null text has size 0 and a null source is a source of its own, the last. Documents of size 0
    take 0. Rows that repeat a doc_id are told apart by a digest of their text; exact repeats of a row are documents of
    their own, with a row each. An empty table gives empty results. Other columns are ignored.
    """
    sized = docs.select("doc_id", "source", F.xxhash64(F.coalesce("text", F.lit(""))).alias("digest"), n_words(F.col("text")).alias("size"))
    # read the texts once: all that follows needs their sizes only
    sized = sized.groupBy("doc_id", "source", "digest", "size").agg(F.count("*").alias("copies"))
    sized = sized.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    sized = kept(sized.select("doc_id", "source", F.xxhash64("digest", "copy").alias("digest"), "size"), "mix-sizes")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    totals = sources.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum("source_size"), F.lit(0))).first()
    plan = targets(sources.select("source", "source_size"), weights, share, most)
    blocks = F.ceil(F.col("source_size") / block)
    whole = F.round("target").cast("long")
    # one block may be shorter, the last; a round through all blocks takes the whole source
    turns = F.floor(whole / F.greatest(F.col("source_size"), F.lit(1)))
    rest = whole - turns * F.col("source_size")
    plan = plan.select(
        "*", blocks.alias("blocks"), (turns * blocks + F.ceil(rest / block)).cast("long").alias("needed"),
        turns.alias("turns"), rest.alias("rest"),
    )
    slots = int(totals[1] * share / block) + 1 if totals[1] else 0
    slots = schedule(plan, slots)
    named = slots.join(plan.select("at", "source", "blocks"), "at").select("slot", "source", "at", "rank", (F.col("rank") % F.col("blocks")).alias("block"))
    uses = named.groupBy("at", "block").agg(F.count("*").alias("times"), F.max("rank").alias("last"))
    laid = _laid(sized, seed, totals[0])
    keys = plan.select(F.col("source").alias("s"), "at", "source_size", "target", "turns", "rest", "needed")
    laid = laid.join(keys, laid["source"].eqNullSafe(keys["s"])).drop("s")
    parts = laid.filter("size > 0").select(
        "doc_id", "digest", "source", "at", "begin", "size", "rest", "needed",
        F.explode(F.sequence(F.floor(F.col("begin") / block), F.floor((F.col("begin") + F.col("size") - 1) / block))).alias("block"),
    )
    used = parts.join(uses, ["at", "block"])
    low, high = F.greatest("begin", F.col("block") * block), F.least(F.col("begin") + F.col("size"), (F.col("block") + 1) * block)
    # the last slot ends where the target does
    cut = F.when((F.col("last") == F.col("needed") - 1) & (F.col("rest") > 0), F.greatest(F.lit(0), high - F.greatest(low, F.col("rest")))).otherwise(0)
    taken = used.groupBy("doc_id", "digest", "source").agg(F.sum((high - low) * F.col("times") - cut).alias("taken"))
    d, t = laid.alias("d"), taken.alias("t")
    same = F.col("d.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("d.digest") == F.col("t.digest")) & F.col("d.source").eqNullSafe(F.col("t.source"))
    out = d.join(t, same, "left").select("d.doc_id", "d.source", "d.size", "d.source_size", "d.target", F.coalesce("t.taken", F.lit(0)).cast("long").alias("taken"))
    return out, named.select("slot", "source", "rank", "block")
