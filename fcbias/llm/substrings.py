"""Removal of repeated passages by suffixes partitioned by their prefixes.

A suffix is the text from one word on; only its first ``window`` words matter, as a node of the suffix tree that deep
already is a repeat. Suffixes are dealt to groups by a prefix of variable length: two words where few suffixes begin
with them, the whole depth where they are many, so that every group fits a task. Inside a group, suffixes that agree to
full depth (by a 64-bit hash, beside the hashes that chose the group) hang below one deep node; all but its first
occurrence are marked. Longer repeats are runs of marked suffixes.

Each task first joins equal suffixes of its own block of texts and sends one of them, so no passage, however frequent,
sends more suffixes to its group than there are blocks. Suffixes travel as packed arrays of about ten bytes each; texts
are shuffled once, compressed, to meet their marks in buckets of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aggregates import with_place
from . import text as T
from .shared import kept

#: Suffixes of one block of a map task, and of one group.
BLOCK = 1 << 20
GROUP = 1 << 21
#: Bytes of texts that meet their marks in one task at a time.
BUCKET_BYTES = 16 << 20
SHORT_PREFIX = 2
PREFIX_BITS = 12
LAST_ID = (1 << 63) - 1
PACKED = "docs binary, counts binary, low binary, middle binary, high binary"
MARKED = f"bucket int, {PACKED}"
EMITTED = f"group int, hashes binary, {MARKED}"


def _suffixes(part: pa.RecordBatch, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all suffixes with ``window`` words: row, place, bucket of the short prefix, hash to full depth."""
    data, offsets = T.flat(part.column("text"))
    start, end, first = T.words(data, offsets)
    codes = T.word_codes(data, start, end)
    deep = T.chains(codes, window)
    row = T.owners(first)[: len(deep)]
    place = np.arange(len(deep)) - first[row]
    whole = np.arange(len(deep)) + window <= first[row + 1]
    bucket = (T.chains(codes, SHORT_PREFIX)[: len(deep)] >> np.uint64(64 - PREFIX_BITS)).astype(np.int64)
    return row[whole], place[whole], bucket[whole], deep[whole]


def prefix_counts(docs: DataFrame, window: int) -> tuple[np.ndarray, int]:
    """How many suffixes of all documents begin with each hashed short prefix (a table of fixed size); bytes of texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((1 << PREFIX_BITS) + 1, np.int64)
        for batch in batches:
            for part in T.pieces(batch):
                n[:-1] += np.bincount(_suffixes(part, window)[2], minlength=len(n) - 1)
                n[-1] += part.column("text").nbytes
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(n[used], pa.int64())], ["bucket", "n"])

    rows = docs.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros((1 << PREFIX_BITS) + 1, np.int64)
    for r in rows:
        out[r.bucket] = r.n
    return out[:-1], int(out[-1])


def groups(counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """First group of each short prefix, how many groups it is split into by longer prefixes, and the number of groups."""
    splits = np.maximum(1, -(-counts // size))
    first = np.zeros(len(counts), np.int64)
    at, room = 0, size
    for b in range(len(counts)):
        if splits[b] > 1:
            if room < size:
                at += 1
            first[b] = at
            at, room = at + splits[b], size
        else:
            if counts[b] > room:
                at, room = at + 1, size
            first[b] = at
            room -= counts[b]
    return first, splits, int(at + 1)


def _firsts(deep: np.ndarray, doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of equal suffixes, the first by document and place; and those that begin later. Both as positions."""
    order = np.argsort(deep)
    same = deep[order[1:]] == deep[order[:-1]]
    if not same.any():
        return np.arange(len(deep)), np.zeros(0, np.int64)
    many = np.zeros(len(deep), bool)
    many[order[1:][same]] = True
    many[order[:-1][same]] = True
    at = np.flatnonzero(many)
    at = at[np.lexsort((place[at], doc[at], deep[at]))]
    head = np.concatenate([[True], deep[at[1:]] != deep[at[:-1]]])
    first = at[head][np.cumsum(head) - 1]
    later = at[(doc[at] != doc[first]) | (place[at] != place[first])]
    many[at[head]] = False
    return np.flatnonzero(~many), later


def _packed(key: np.ndarray, doc: np.ndarray, place: np.ndarray, hashes: np.ndarray | None = None) -> list[pa.Array]:
    """One row per key, which must come in runs: key, hashes if any, documents with their counts, places by byte."""
    new = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
    cuts = np.append(np.flatnonzero(new), len(key))
    runs = np.append(np.flatnonzero(new | np.concatenate([[True], doc[1:] != doc[:-1]]) if len(key) else new), len(key))
    run_cuts = np.searchsorted(runs, cuts)
    place = place.astype(np.uint32)
    return [
        pa.array(key[cuts[:-1]], pa.int32()),
        *([] if hashes is None else [T.binaries(hashes, cuts)]),
        T.binaries(doc[runs[:-1]].astype(np.int64), run_cuts),
        T.binaries(np.diff(runs).astype(np.uint32), run_cuts),
        T.binaries(place.astype(np.uint8), cuts),
        T.binaries((place >> np.uint32(8)).astype(np.uint8), cuts),
        T.binaries((place >> np.uint32(16)).astype(np.uint16), cuts),
    ]


def _joined(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)


def _unpacked(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Documents and places of all rows."""
    place = _joined(table, "low", np.uint8).astype(np.int32)
    place |= _joined(table, "middle", np.uint8).astype(np.int32) << 8
    place |= _joined(table, "high", np.uint16).astype(np.int32) << 16
    return np.repeat(_joined(table, "docs", np.int64), _joined(table, "counts", np.uint32)), place


def _bucket(doc: np.ndarray, buckets: int) -> np.ndarray:
    return (T.mix(doc.astype(np.uint64)) % np.uint64(buckets)).astype(np.int32)


def _marks(doc: np.ndarray, place: np.ndarray, buckets: int) -> list[pa.Array]:
    bucket = _bucket(doc, buckets)
    order = np.lexsort((place, doc, bucket))
    return _packed(bucket[order], doc[order], place[order])


def repeated_starts(docs: DataFrame, window: int, counts: np.ndarray, buckets: int, group: int = GROUP) -> DataFrame:
    """Marks of suffixes that begin earlier too, packed by bucket of their documents. Null ids count as last."""
    first, splits, number = groups(counts, group)
    names = [f.split()[0] for f in EMITTED.split(", ")]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            doc, place, prefix, deep = (np.concatenate(x) for x in zip(*held))
            held.clear()
            keep, later = _firsts(deep, doc, place)
            to = first[prefix[keep]] + (deep[keep] >> np.uint64(8)).astype(np.int64) % splits[prefix[keep]]
            order = np.argsort(to.astype(np.uint16 if number < 1 << 16 else np.int64), kind="stable")
            to, keep = to[order], keep[order]
            group, hashes, *packed = _packed(to, doc[keep], place[keep], deep[keep])
            yield pa.RecordBatch.from_arrays([group, hashes, pa.nulls(len(group), pa.int32()), *packed], names)
            # marks of this block go along to some group, which hands them on
            bucket, *packed = _marks(doc[later], place[later], buckets)
            some = pa.array(bucket.to_numpy() % number, pa.int32())
            yield pa.RecordBatch.from_arrays([some, pa.nulls(len(some), pa.binary()), bucket, *packed], names)

        for batch in batches:
            for part in T.pieces(batch):
                row, place, prefix, deep = _suffixes(part, window)
                if len(row):
                    held.append((T.longs(part.column("doc_id"), LAST_ID)[row], place.astype(np.int32), prefix.astype(np.int16), deep))
                    size += len(row)
                if size >= BLOCK:
                    yield from flush()
                    size = 0
        if size:
            yield from flush()

    def reduce(table: pa.Table) -> pa.Table:
        packed = table.column("hashes").is_valid()
        passed = table.filter(pa.compute.invert(packed)).drop_columns(["group", "hashes"])
        table = table.filter(packed)
        doc, place = _unpacked(table)
        _, later = _firsts(_joined(table, "hashes", np.uint64), doc, place)
        return pa.concat_tables([pa.table(_marks(doc[later], place[later], buckets), passed.schema.names), passed])

    return docs.select("doc_id", "text").mapInArrow(emit, EMITTED).groupBy("group").applyInArrow(reduce, MARKED)


def _texts(docs: DataFrame, buckets: int) -> DataFrame:
    """The documents by bucket, several compressed into one value: (bucket, texts)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for part in T.pieces(batch, limit=4 * T.PIECE_BYTES):
                doc = T.longs(part.column("doc_id"), LAST_ID)
                bucket = _bucket(doc, buckets)
                order = np.argsort(bucket, kind="stable")
                part, doc, bucket = part.take(pa.array(order)), doc[order], bucket[order]
                data, offsets = T.flat(part.column("text"))
                empty = part.column("doc_id").is_null().to_numpy(zero_copy_only=False)
                cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
                packed = []
                for low, high in zip(cuts[:-1], cuts[1:]):
                    head = np.concatenate([[high - low], doc[low:high], empty[low:high], np.diff(offsets[low : high + 1])]).astype(np.int64)
                    packed.append(press.compress(head.tobytes() + data[offsets[low] : offsets[high]].tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(bucket[cuts[:-1]], pa.int32()), pa.array(packed, pa.binary())], ["bucket", "texts"])

    return docs.select("doc_id", "text").mapInArrow(pack, "bucket int, texts binary")


def without_repeats(docs: DataFrame, window: int = 20) -> DataFrame:
    """Remove every word that a repeated window covers: doc_id, kept (text), n_words, n_removed.

    A window is ``window`` consecutive words of one document; it is repeated if its words also start earlier, in a
    document of a smaller id or before it in the same one. Ids are integers, null the last; rows of one id (or of none)
    with different texts are documents of their own, in the order of a digest of their texts. Null and empty texts have
    no words. An exact repeat of a row is the same document, given back once for each row: a window does not start
    earlier than itself. Kept words are joined by one space; columns other than doc_id and text are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    named = _numbered(docs)
    if named is None:
        return _without_repeats(docs, window)
    same = docs["doc_id"].eqNullSafe(named["doc_id"]) & (F.xxhash64(docs["text"]) == named["digest"])
    docs = kept(docs.join(named, same).select(F.col("place").alias("doc_id"), "text"), "substring-numbered")
    found = _without_repeats(docs, window).withColumnRenamed("doc_id", "place")
    return found.join(named, "place").select("doc_id", "kept", "n_words", "n_removed")


def _numbered(docs: DataFrame) -> DataFrame | None:
    """(doc_id, digest, place) of each document in order, where an id, or no id, stands for several texts; else None."""
    known = docs.select("doc_id", F.xxhash64("text").alias("digest"))
    if known.groupBy("doc_id").agg(F.min("digest").alias("low"), F.max("digest").alias("high")).filter("low != high").isEmpty():
        return None
    known = known.distinct().withColumn("last", F.col("doc_id").isNull())
    return kept(with_place(known, ["last", "doc_id", "digest"]).drop("last"), "substring-places")


def _without_repeats(docs: DataFrame, window: int) -> DataFrame:
    """``without_repeats`` of documents whose ids tell their texts apart."""
    counts, size = prefix_counts(docs, window)
    buckets = max(1, -(-size // BUCKET_BYTES))
    marks = repeated_starts(docs, window, counts, buckets)

    def clean(texts: pa.Table, marks: pa.Table) -> pa.Table:
        doc, place = _unpacked(marks)
        order = np.argsort(doc, kind="stable")
        doc, place = doc[order], place[order]
        ids, kept, sizes, gone = [], [], [], []
        for packed in texts.column("texts"):
            data = zstandard.decompress(packed.as_py())
            n = int(np.frombuffer(data, np.int64, 1)[0])
            head = np.frombuffer(data, np.int64, 3 * n, 8).reshape(3, n)
            at = 8 + 24 * n
            low, high = np.searchsorted(doc, head[0]), np.searchsorted(doc, head[0], "right")
            for i in range(n):
                words = data[at : at + int(head[2, i])].split()
                at += int(head[2, i])
                sizes.append(len(words))
                removed = 0
                if low[i] < high[i]:
                    start = place[low[i] : high[i]]
                    start = start[start + window <= len(words)]
                    steps = np.bincount(start, minlength=len(words) + 1) - np.bincount(start + window, minlength=len(words) + 1)
                    stays = np.cumsum(steps[:-1]) == 0
                    removed = len(words) - int(stays.sum())
                    words = compress(words, stays.tolist())
                ids.append(None if head[1, i] else int(head[0, i]))
                kept.append(b" ".join(words))
                gone.append(removed)
        return pa.table(
            [pa.array(ids, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64())],
            ["doc_id", "kept", "n_words", "n_removed"])

    meeting = _texts(docs, buckets).groupBy("bucket").cogroup(marks.groupBy("bucket"))
    return meeting.applyInArrow(clean, "doc_id long, kept string, n_words long, n_removed long")
