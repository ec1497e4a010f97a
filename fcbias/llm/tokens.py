"""Token counts by a two-tier lookup inside the map tasks; nothing is shuffled.

Byte-level BPE encodes each pre-token on its own, so a text's count is the sum over its pre-tokens. The first tier is a
broadcast table of the lengths of frequent pre-tokens, the second a bounded cache in each Python worker whose misses are
encoded. The table only saves work: it comes from a bounded sample of texts and has no part in any result.
"""

from __future__ import annotations

import os
import uuid
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the pre-token pattern of the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PIECES = regex.compile(PATTERN)
#: Outside these blocks two Unicode versions may class a character differently; such texts go to the tokenizer whole.
_BEYOND = regex.compile(r"[^\t\n\r\x20-\x7e¡-ɏ‐-‧‰-⁞€]")
#: Longer pre-tokens are encoded but not remembered.
LONGEST_KEPT = 64


class Lengths(dict):
    """Lengths in tokens, by pre-token; unknown ones are encoded, and remembered up to a bound."""

    def __init__(self, path: str, table: dict[str, int], cache_size: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__(table)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.table, self.room, self.cache_size = table, cache_size, cache_size
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def encoded(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def __missing__(self, piece: str) -> int:
        n = self.encoded(piece)
        if len(piece) <= LONGEST_KEPT:
            if not self.room:
                self.clear()
                self.update(self.table)
                self.room = self.cache_size
            self[piece] = n
            self.room -= 1
        return n

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if _BEYOND.search(text) or any(s in text for s in self.specials):
            return self.encoded(text)
        return sum(map(self.__getitem__, _PIECES.findall(text)))


_WORKER: dict[tuple, Lengths] = {}


def _lengths(path: str, table, cache_size: int, job: str) -> Lengths:
    key = (path, cache_size, job)
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = Lengths(path, table.value, cache_size)
    return _WORKER[key]


def frequent_lengths(docs: DataFrame, path: str, sample_rows: int, size: int) -> dict[str, int]:
    """Lengths of the most frequent pre-tokens of about ``sample_rows`` texts; that bound is also the driver's."""
    total = docs.count()
    if not total:
        return {}
    share = min(1.0, sample_rows / total)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found.update(p for p in _PIECES.findall(text or "") if len(p) <= LONGEST_KEPT)
            if len(found) > 8 * size:
                found = Counter(dict(found.most_common(size)))
        top = [x for x in found.most_common(size) if x[1] > 1]
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], ["piece", "n"])

    best: Counter[str] = Counter()
    merged = docs.select("text").sample(share, seed=1).mapInArrow(counted, "piece string, n long").toArrow()
    for piece, n in zip(merged.column(0).to_pylist(), merged.column(1).to_pylist()):
        best[piece] += n
    lengths = Lengths(path, {}, 0)
    return {p: lengths.encoded(p) for p, _ in best.most_common(size)}


def token_counts(docs: DataFrame, path: str, sample_rows: int = 1000, table_size: int = 1 << 16, cache_size: int = 1 << 19) -> DataFrame:
    """Tokens of each whole text, as the tokenizer file gives them, without added special tokens.

    Returns doc_id, n_bytes, n_tokens, one row per input row. Null and empty texts have 0 of both; a special token's
    string inside a text is one token; repeated rows are counted each; columns other than doc_id and text are ignored.
    ``path`` must be readable by the executors, as installed packages are.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    job = uuid.uuid4().hex
    table = spark.sparkContext.broadcast(frequent_lengths(docs, path, sample_rows, table_size))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = _lengths(path, table, cache_size, job)
        for batch in batches:
            texts = batch.column(1)
            n = [lengths.count(t.as_py()) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    sized = docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return sized.mapInArrow(count, f"doc_id {dict(docs.dtypes)['doc_id']}, n_bytes long, n_tokens long")
