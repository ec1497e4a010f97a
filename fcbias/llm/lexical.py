"""Ranked lexical search by scanning the documents: no index of them is made.

The terms of all items go into one Aho-Corasick automaton that is sent to every task. Terms carry a blank at both ends,
and so does every run of term characters of a text, so a match is a whole term and each place ends one match at most. A
first scan counts documents, terms and in how many documents each term occurs; a second one counts the terms of each
document again, maps them to the items that hold them, and keeps the best documents of each item in each task.

The items are dealt to several automata if their terms take more than ITEM_BYTES, and the documents are scanned for each;
so what is broadcast has that bound, or the size of one item.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import text as T
from .shared import kept

TERM = r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"
#: Bytes of the terms of one automaton, with a surcharge for each entry.
ITEM_BYTES = 64 << 20
ENTRY_BYTES = 64
#: Bytes of text matched at a time, and scores and postings worked on at a time; they bound a task's memory.
SLICE = 1 << 20
CELLS = 1 << 21
#: The best documents of an item are chosen in so many parts first.
PARTS = 64

#: Every byte in lower case, and a blank where no term goes on.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = 32


def _automaton(terms: list[str]) -> ahocorasick.Automaton:
    """Automaton over bytes as Latin-1 text; a match gives the place of the blank behind it and the term's number."""
    found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for i, term in enumerate(terms):
        found.add_word(f" {term} ".encode().decode("latin-1"), i)
    found.make_automaton()
    return found


def term_counts(column: pa.Array, automaton: ahocorasick.Automaton, terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and count of the automaton's terms in each text, by row and term; and each text's number of terms."""
    data, offsets = T.flat(column)
    folded = _FOLD[data].tobytes()
    guarded = b" ".join([b"", *[folded[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())], b""])
    begin = offsets + np.arange(len(offsets)) + 1
    blank = np.frombuffer(guarded, np.uint8) == 32
    starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    n = np.diff(np.searchsorted(starts, begin))
    codes, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if terms and len(starts):
        matches = automaton.iter("")
        for low in range(0, len(guarded), SLICE):
            matches.set(guarded[low : low + SLICE].decode("latin-1"))  # goes on where the last slice ended
            pairs = np.fromiter(chain.from_iterable(matches), np.int64).reshape(-1, 2)
            row = np.searchsorted(begin, pairs[:, 0] - 1, "right") - 1
            code, count = np.unique(row * terms + pairs[:, 1], return_counts=True)
            codes.append(code)
            counts.append(count)
    code, place = np.unique(np.concatenate(codes), return_inverse=True)
    tf = np.zeros(len(code), np.int64)
    np.add.at(tf, place, np.concatenate(counts))
    return code // max(1, terms), code % max(1, terms), tf, n


def _statistics(docs: DataFrame, terms: list[str]) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms of all documents, and the documents that hold each term."""
    sent = docs.sparkSession.sparkContext.broadcast(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, size = _automaton(sent.value), len(sent.value)
        total = np.zeros(size + 2, np.int64)
        for batch in batches:
            for part in T.pieces(batch):
                _, term, _, n = term_counts(part.column("text"), automaton, size)
                total[:size] += np.bincount(term, minlength=size)
                total[size:] += (n > 0).sum(), n.sum()
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["what", "number"])

    found = docs.select("text").mapInArrow(count, "what long, number long").groupBy("what").agg(F.sum("number").alias("number"))
    total = np.zeros(len(terms) + 2, np.int64)
    for row in found.collect():  # one row for each term of the automaton at most
        total[row.what] = row.number
    return int(total[-2]), int(total[-1]), total[:-2]


def term_weights(df: np.ndarray, documents: int) -> np.ndarray:
    """Weight of each term: floor(1000 ln((2 N + 2) / (2 df + 1)))."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(x) + 1))) for x in df], np.int64)


class _Best:
    """The k best (score, id) of each item seen so far: highest score, then lowest id, null last."""

    def __init__(self, items: int, k: int):
        self.k, self.low = k, np.ones(items, np.int64)
        self.item, self.score, self.doc = (np.zeros(0, np.int64) for _ in range(3))
        self.missing = np.zeros(0, bool)

    def add(self, scores: np.ndarray, doc: np.ndarray, missing: np.ndarray) -> None:
        """Scores of some documents for all items, row by row."""
        row, item = np.nonzero(scores >= self.low)
        if not len(row):
            return
        item, score = np.concatenate([self.item, item]), np.concatenate([self.score, scores[row, item]])
        doc, missing = np.concatenate([self.doc, doc[row]]), np.concatenate([self.missing, missing[row]])
        order = np.lexsort((doc, missing, -score, item))
        rank = np.arange(len(order)) - np.searchsorted(item[order], item[order])
        order, rank = order[rank < self.k], rank[rank < self.k]
        self.item, self.score, self.doc, self.missing = item[order], score[order], doc[order], missing[order]
        full = rank == self.k - 1
        self.low[self.item[full]] = self.score[full]


def _ranked(docs: DataFrame, terms: list[str], postings: tuple[np.ndarray, ...], items: int, weights: np.ndarray, documents: int, length: int, k: int) -> DataFrame:
    """(item, doc_id, score) of the k best documents of each item in each task."""
    sent = docs.sparkSession.sparkContext.broadcast((terms, postings, weights))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, (first, holder, times), weight = sent.value
        automaton, best = _automaton(words), _Best(items, k)
        for batch in batches:
            for part in T.pieces(batch):
                row, term, tf, n = term_counts(part.column("text"), automaton, len(words))
                ids = part.column("doc_id")
                doc, missing = T.longs(ids, 0), ids.is_null().to_numpy(zero_copy_only=False)
                m = np.array([75 + 25 * int(x) * documents // length for x in n], np.int64)
                gain = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[row]))
                held = first[term + 1] - first[term]
                # some documents at a time: as many as their scores and their terms' postings allow
                upto = np.concatenate([[0], np.cumsum(np.bincount(row, held, len(n)).astype(np.int64) + items)])
                low = 0
                while low < len(n):
                    high = max(low + 1, int(np.searchsorted(upto, upto[low] + CELLS, "right")) - 1)
                    a, b = np.searchsorted(row, [low, high])
                    each = held[a:b]
                    at = np.arange(int(each.sum())) + np.repeat(first[term[a:b]] - (np.cumsum(each) - each), each)
                    scores = np.zeros((high - low) * items, np.int64)
                    np.add.at(scores, np.repeat(row[a:b] - low, each) * items + holder[at], np.repeat(gain[a:b], each) * times[at])
                    best.add(scores.reshape(-1, items), doc[low:high], missing[low:high])
                    low = high
        ids = pa.array(best.doc, pa.int64(), mask=best.missing)
        yield pa.RecordBatch.from_arrays([pa.array(best.item), ids, pa.array(best.score)], ["item", "doc_id", "score"])

    return docs.mapInArrow(score, "item long, doc_id long, score long")


def _shares(entries: DataFrame, limit: int) -> int:
    """Into how many shares the items are dealt so that none is larger than the limit, unless it is one item."""
    sizes = entries.groupBy("item_id").agg(F.sum(F.octet_length("term") + ENTRY_BYTES).alias("bytes"))
    shares = 1
    while True:
        dealt = sizes.groupBy(F.pmod(F.xxhash64("item_id"), F.lit(shares))).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("items"))
        if dealt.filter((F.col("bytes") > limit) & (F.col("items") > 1)).isEmpty():
            return shares
        shares *= 2


def search(docs: DataFrame, items: DataFrame, k: int = 20, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """The k highest-scoring documents of each item: item_id, rank (from 1), doc_id and score (above 0).

    Terms are runs of ASCII letters, digits and all characters beyond ASCII, A-Z lower-cased; null texts have none.
    Equal scores go by ascending doc_id, null last. A repeated document is ranked once for each of its rows. Texts of
    one item_id (also of a null one) are one item, of which a repeated text counts once; items without terms, or whose
    terms no document holds, have no rows. Ids of documents are integers, those of items of any type that can be grouped; other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = items.select("item_id", "text").distinct().select("item_id", F.explode(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(1))).alias("term"))
    entries = kept(found.groupBy("item_id", "term").agg(F.count("*").alias("times")), "search-entries")
    schema = StructType([*entries.select("item_id").schema.fields]).add("rank", "integer").add("doc_id", "long").add("score", "long")
    best = spark.createDataFrame([], schema)
    shares = _shares(entries, item_bytes)
    for share in range(shares):
        rows = entries.filter(F.pmod(F.xxhash64("item_id"), F.lit(shares)) == share).collect()
        if not rows:
            continue
        ids = list(dict.fromkeys(r.item_id for r in rows))
        number = {x: i for i, x in enumerate(ids)}
        terms = sorted({r.term for r in rows})
        at = {x: i for i, x in enumerate(terms)}
        held = np.array(sorted((at[r.term], number[r.item_id], r.times) for r in rows), np.int64)
        first = np.searchsorted(held[:, 0], np.arange(len(terms) + 1))
        documents, length, df = _statistics(docs, terms)
        if not documents:
            break
        ranked = _ranked(docs, terms, (first, held[:, 1], held[:, 2]), len(ids), term_weights(df, documents), documents, length, k)
        named = spark.createDataFrame(list(enumerate(ids)), StructType().add("item", "long").add(schema["item_id"]))
        order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
        part = F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))
        for rank, keys in (("within", ["item", "part"]), ("rank", ["item"])):
            ranked = ranked.withColumn("part", part).withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(rank) <= k)
        best = best.unionAll(ranked.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score"))
    return best
