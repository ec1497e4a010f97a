"""Quality classifier: supervised subword embeddings.

A document is the average of learned vectors of its words, word pairs and the character n-grams inside its words, all
hashed into one table; a softmax over that average gives the classes. Vectors and output weights are fitted in numpy by stochastic
gradient descent on a bounded sample of labelled rows. As the output is linear in the average, a fitted table is folded
to one number per bucket, so that scoring a document takes one look-up per feature, in whole texts of any length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as S

from . import text as T

GRAMS = (3, 4)
REPEATED = np.uint64(0x5BD1E9955BD1E995)


@dataclass
class SubwordModel:
    """``folded`` holds each bucket's share of the log-odds of class 1."""

    folded: np.ndarray
    bias: float

    def scores(self, column: pa.Array) -> np.ndarray:
        features, first = subwords(column, len(self.folded))
        n = np.diff(first)
        sums = np.zeros(len(n))
        some = np.flatnonzero(n)
        if len(some):
            sums[some] = np.add.reduceat(self.folded[features], first[some], dtype=np.float64)
        z = np.clip(sums / np.maximum(n, 1) + self.bias, -30, 30)
        return 1 / (1 + np.exp(-z))


def subwords(column: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and n-grams of each text, text by text, and where each text's begin."""
    data, offsets = T.flat(column)
    start, end, first = T.words(data, offsets)
    codes = T.word_codes(data, start, end)
    shift = np.uint64(64 - int(np.log2(buckets)))
    found, owner_starts = [codes >> shift], [first]
    if len(codes) > 1:
        # word pairs; a word after itself is one feature for all words
        same = codes[1:] == codes[:-1]
        pairs = T.chains(codes, 2)
        pairs[same] = REPEATED
        inner = np.ones(len(pairs), bool)
        inner[first[1:-1][(first[1:-1] > 0) & (first[1:-1] < len(codes))] - 1] = False
        at = np.flatnonzero(inner)
        found.append(pairs[at] >> shift)
        owner_starts.append(np.searchsorted(at, first))
    inside = ~T.BLANKS[data]
    for n in GRAMS:
        # n-grams that lie in one word, with the blank before or after it standing for the word's edge
        if len(data) < n:
            continue
        grams = np.zeros(len(data) - n + 1, np.uint64)
        factor = 1
        for j in range(n):
            shown = np.where(inside[j : j + len(grams)], T.EXACT[data[j : j + len(grams)]], np.uint64(1))
            grams += shown * np.uint64(factor)
            factor = factor * 0xD1342543DE82EF95 % (1 << 64)
        whole = np.ones(len(grams), bool)
        for j in range(1, n - 1):
            whole &= inside[j : j + len(grams)]
        edges = offsets[1:-1]
        for j in range(1, n):
            at = edges - j
            whole[at[(at >= 0) & (at < len(whole))]] = False
        at = np.flatnonzero(whole)
        found.append(T.mix(grams[at] + np.uint64(n)) >> shift)
        owner_starts.append(np.searchsorted(at, offsets))
    counts = sum(np.diff(s) for s in owner_starts)
    total = np.concatenate([[0], np.cumsum(counts)])
    out = np.empty(total[-1], np.int32)
    at = total[:-1].copy()
    for values, s in zip(found, owner_starts):
        k = np.diff(s)
        place = np.repeat(at - s[:-1], k) + np.arange(len(values))
        out[place] = values
        at += k
    return out, total


def fit(texts: list[str], labels: list[int], buckets: int = 1 << 18, width: int = 8, epochs: int = 6, rate: float = 4.0, seed: int = 7) -> SubwordModel:
    """Stochastic gradient descent over the sample, classes weighted alike. One class or none gives its share."""
    y = np.asarray(labels, int)
    if len(set(y.tolist())) < 2:
        share = float(y.mean()) if len(y) else 0.5
        return SubwordModel(np.zeros(buckets, np.float32), float(np.log((share + 0.01) / (1.01 - share))))
    rng = np.random.default_rng(seed)
    vectors = (rng.random((buckets, width)) - 0.5) / width
    output, bias = rng.normal(0, 0.1, (2, width)), np.zeros(2)
    weight = len(y) / (2 * np.bincount(y, minlength=2))
    bags = []
    for low in range(0, len(y), 64):  # the features of a few texts at a time, else the sample's would fill the driver
        features, first = subwords(pa.array(texts[low : low + 64], pa.string()), buckets)
        for i in range(len(first) - 1):
            own, n = np.unique(features[first[i] : first[i + 1]], return_counts=True)
            bags.append((own, (n / max(1, n.sum())).astype(np.float32)[:, None]))
    steps = epochs * len(y)
    for step, i in enumerate(np.concatenate([rng.permutation(len(y)) for _ in range(epochs)])):
        own, share = bags[i]
        mean = (vectors[own] * share).sum(0)
        z = output @ mean + bias
        p = np.exp(z - z.max())
        error = p / p.sum()
        error[y[i]] -= 1
        # labels are noisy at the margin: a long step on one document is cut
        error *= min(weight[y[i]], 4.0) * rate * (1 - step / steps)
        gradient = error @ output
        output -= 0.1 * np.outer(error, mean)
        bias -= 0.001 * error
        vectors[own] -= share * len(own) ** 0.5 * np.clip(gradient, -2, 2)
    return SubwordModel((vectors @ (output[1] - output[0])).astype(np.float32), float(bias[1] - bias[0]))


def fit_quality(sample: DataFrame, **settings) -> SubwordModel:
    """Fit on a bounded sample (doc_id, text, label), which goes to the driver in the order of its ids."""
    rows = sample.toPandas().sort_values("doc_id")
    return fit([t or "" for t in rows["text"]], rows["label"].tolist(), **settings)


def score(docs: DataFrame, model, column: str = "score") -> DataFrame:
    """Add the model's score of each whole text (double, 0 to 1). Null and empty texts get the score of no features.

    Other columns are kept; a column that already has the name is replaced. Repeated rows are scored each.
    """
    docs = docs.drop(column)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.pieces(batch):
                yield part.append_column(column, pa.array(shared.value.scores(part.column("text")), pa.float64()))

    return docs.mapInArrow(run, S.StructType([*docs.schema.fields, S.StructField(column, S.DoubleType())]))
