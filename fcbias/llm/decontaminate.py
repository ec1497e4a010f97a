"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions only.

A window of a benchmark item occurs in a document only if all its words do. Ordered by rarity in the documents, a
window's necessary prefix is therefore its rarest word alone: document words are joined with the rarest words of the
windows. Where a word stands in the document and in the window gives the place where the window would begin; it must lie
inside the document (position and length), and then the words there are compared one by one.

Windows travel to the documents by broadcast while they are few; beyond that bound both sides are shuffled by word and
the candidates are joined back to the documents' words. No text is shuffled on the first way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Windows that are sent to every executor at most; each holds ten words and the ids of its items.
BROADCAST_WINDOWS = 100_000


def words_of(text: Column) -> Column:
    """Words of letters, digits and characters beyond ASCII, A-Z as a-z; none in a null or empty text."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BETWEEN), "")


def windows_of(benchmark: DataFrame, window: int, unnamed: bool = False) -> DataFrame:
    """Distinct windows: (words, items), items as strings. An item shorter than a window is one; one without words none.

    With ``unnamed`` rows without id give windows too, which add no item.
    """
    named = benchmark if unnamed else benchmark.filter("item_id is not null")
    items = named.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("all"))
    items = items.filter(F.size("all") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("all") - window + 1))
    cut = items.select("item", F.explode(starts).alias("start"), "all")
    return cut.groupBy(F.slice("all", F.col("start"), F.lit(window)).alias("words")).agg(F.sort_array(F.collect_set("item")).alias("items"))


def _rarest(windows: DataFrame, tokens: DataFrame, few: bool) -> DataFrame:
    """Windows with their rarest word and its place in them; those with a word that no document has are gone."""
    vocabulary = windows.select(F.explode("words").alias("word")).distinct()
    counts = tokens.join(F.broadcast(vocabulary) if few else vocabulary, "word").groupBy("word").agg(F.count("*").alias("n"))
    spread = windows.withColumn("id", F.xxhash64("words")).select("id", "words", "items", F.posexplode("words").alias("place", "word"))
    best = spread.join(counts, "word", "left").groupBy("words").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "place")).alias("best"), F.first("items").alias("items"))
    return best.filter("best.n > 0").select(F.col("best.word").alias("rare"), F.col("best.place").alias("place"), F.col("words").alias("window"), "items")


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, unnamed: bool = False) -> DataFrame:
    """Words of each document inside occurrences of benchmark windows.

    Returns doc_id, digest (of the text), n_words, n_hit, items (sorted strings) and contaminated. Null and empty texts
    have no words. Rows are told apart by id and text: exact repeats of a row give one. Benchmark rows without words are
    passed over, repeated ones count once; without any, nothing is hit. Those without id count only with ``unnamed``, and
    then for n_hit and contaminated, as they have no name for items. Other columns are ignored.
    """
    windows = windows_of(benchmark, window, unnamed)
    number = windows.count()
    few = number <= BROADCAST_WINDOWS
    keyed = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("digest"), words_of(F.col("text")).alias("words"))
    rare = _rarest(windows, keyed.select(F.explode("words").alias("word")), few)
    # a last entry without a word keeps documents without hits, and carries their number of words
    marked = F.concat("words", F.array(F.lit(None).cast("string")))
    start, length = F.col("pos") - F.col("place"), F.size("window")
    fits = (start >= 0) & (start + length <= F.size("words"))
    same = F.slice("words", start + 1, length) == F.col("window")
    n_words, hit = F.max(F.when(F.col("word").isNull(), F.col("pos"))), F.struct(start.alias("start"), (start + length).alias("stop"))
    if few:
        placed = keyed.select("doc_id", "digest", "words", F.posexplode(marked).alias("pos", "word"))
        found = placed.join(F.broadcast(rare), F.col("word") == F.col("rare"), "left").filter(F.col("word").isNull() | (F.col("rare").isNotNull() & fits & same))
    else:
        placed = keyed.select("doc_id", "digest", F.posexplode("words").alias("pos", "word"))
        near = placed.join(rare, F.col("word") == F.col("rare")).select("doc_id", "digest", "pos", "word", "place", "window", "items")
        ends = keyed.select("doc_id", "digest", F.size("words").alias("pos"), F.lit(None).cast("string").alias("word"))
        k, n = keyed.alias("k"), near.alias("n")
        checked = n.join(k, F.col("k.doc_id").eqNullSafe(F.col("n.doc_id")) & (F.col("k.digest") == F.col("n.digest"))).select("n.*", "k.words").filter(fits & same).drop("words")
        found = checked.unionByName(ends, allowMissingColumns=True)
    per_doc = found.groupBy("doc_id", "digest").agg(
        n_words.cast("long").alias("n_words"),
        F.array_sort(F.collect_set(F.when(F.col("window").isNotNull(), hit))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    covered = F.aggregate(
        "hits", F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("n")),
        lambda seen, x: F.struct(
            F.greatest(seen["upto"], x["stop"]).alias("upto"),
            (seen["n"] + F.greatest(F.lit(0), x["stop"] - F.greatest(seen["upto"], x["start"]))).alias("n"),
        ),
        lambda seen: seen["n"],
    )
    return per_doc.select("doc_id", "digest", "n_words", covered.alias("n_hit"), "items", (F.size("hits") > 0).alias("contaminated"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, least_share: float = 0.0, unnamed: bool = False) -> DataFrame:
    """The documents that hold no benchmark window, or at most ``least_share`` of whose words lie in windows."""
    judged = contaminated(docs, benchmark, window, unnamed).filter("contaminated").filter(F.col("n_hit") > F.col("n_words") * least_share)
    bad = judged.select(F.col("doc_id").alias("b_id"), F.col("digest").alias("b_digest"))
    mine = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["b_id"]) & (mine == bad["b_digest"]), "left_anti")
