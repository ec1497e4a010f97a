"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

Each word enters as a hashed word vector beside the average of the hashed vectors of its character trigrams. Overlapping
windows cover all words of a text; a text's score is that of its most toxic window, so one insult in a very long text
counts as much as in a short one. Labels are of whole texts: in training, too, a text stands for its highest window.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import text as T

#: Bytes between words: ASCII other than letters and digits.
MARKS = np.zeros(256, bool)
MARKS[:128] = [not chr(i).isalnum() for i in range(128)]
WINDOW, STRIDE = 32, 24
WINDOWS_AT_ONCE = 2048


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Words:
    """The distinct words of some texts, and for each text the number of each of its words."""

    word: np.ndarray
    gram: np.ndarray
    gram_first: np.ndarray
    number: np.ndarray
    first: np.ndarray


def read_words(column: pa.Array, word_buckets: int, gram_buckets: int) -> Words:
    """Words and character trigrams, edges included, as buckets; characters are bytes with A-Z as a-z."""
    data, offsets = T.flat(column)
    start, end, first = T.words(data, offsets, MARKS)
    codes, at, number = np.unique(T.word_codes(data, start, end, T.LOWERED), return_index=True, return_inverse=True)
    start, length = start[at], end[at] - start[at]
    # letters of the distinct words, each word between two edges
    gram_first = np.concatenate([[0], np.cumsum(length + 2)])
    letters = np.full(gram_first[-1] + 2, 0, np.uint64)
    place = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    letters[np.repeat(gram_first[:-1] + 1, length) + place] = T.LOWERED[data[np.repeat(start, length) + place]]
    trigrams = T.mix(letters[:-2] + letters[1:-1] * np.uint64(0x9E3779B97F4A7C15) + letters[2:] * np.uint64(0xC2B2AE3D27D4EB4F))
    own = np.ones(gram_first[-1], bool)
    for j in (1, 2):  # not across two words
        own[gram_first[1:] - j] = False
    grams = (trigrams[: len(own)][own] % np.uint64(gram_buckets)).astype(np.int64)
    return Words((codes % np.uint64(word_buckets)).astype(np.int64), grams, np.concatenate([[0], np.cumsum(length)]), number.astype(np.int64), first)


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word and length of all windows, and the text of each. The last window of a text ends with it."""
    n = np.diff(first)
    count = np.where(n == 0, 0, np.maximum(1, -(-(n - WINDOW) // STRIDE) + 1))
    text = np.repeat(np.arange(len(n)), count)
    place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    begin = np.minimum(place * STRIDE, np.maximum(n[text] - WINDOW, 0))
    return first[text] + begin, np.minimum(n[text], WINDOW), text


@dataclass
class ToxicityModel:
    word_buckets: int = 1 << 14
    gram_buckets: int = 1 << 14
    width: int = 6
    hidden: int = 8
    seed: int = 11
    p: dict[str, np.ndarray] = field(default_factory=dict)
    shift: float = 0.0

    def __post_init__(self):
        if self.p:
            return
        rng = np.random.default_rng(self.seed)
        w, h = self.width, self.hidden
        shapes = {"word": (self.word_buckets, w, 0.1), "gram": (self.gram_buckets, w, 0.1), "look": (2 * h, h, 0.3), "gaze": (h, 1, 0.3), "out": (2 * h, 1, 0.3)}
        for d in "fb":
            shapes |= {"in" + d: (2 * w, 3 * h, 0.3), "re" + d: (h, 3 * h, 0.3), "bias" + d: (1, 3 * h, 0.0)}
        self.p = {k: (rng.normal(0, 1, (a, b)) * s).astype(np.float32) for k, (a, b, s) in shapes.items()}
        self.p["base"] = np.full((1, 1), -1.0, np.float32)

    def vectors(self, words: Words) -> np.ndarray:
        """Input of each distinct word; one more row of zeros stands for no word."""
        out = np.zeros((len(words.word) + 1, 2 * self.width), np.float32)
        if len(words.word):
            out[:-1, : self.width] = self.p["word"][words.word]
            n = np.diff(words.gram_first)[:, None]
            out[:-1, self.width :] = np.add.reduceat(self.p["gram"][words.gram], words.gram_first[:-1]) / n
        return out

    def run(self, gates: dict[str, np.ndarray], at: np.ndarray, there: np.ndarray, keep: list | None = None):
        """Log-odds of windows: at, there (windows x steps) say which row of the gates each step has, and if it has one."""
        b, steps = at.shape
        h = self.hidden
        states = np.empty((steps, b, 2 * h), np.float32)
        for d, order, own in (("f", range(steps), slice(0, h)), ("b", range(steps - 1, -1, -1), slice(h, 2 * h))):
            state, re = np.zeros((b, h), np.float32), self.p["re" + d]
            for t in order:
                x, back = gates[d][at[:, t]], state @ re
                zr = _sigmoid(x[:, : 2 * h] + back[:, : 2 * h])
                z, r = zr[:, :h], zr[:, h:]
                new = np.tanh(x[:, 2 * h :] + r * back[:, 2 * h :])
                after = (new + z * (state - new)) * there[:, t, None]
                if keep is not None:
                    keep.append((d, t, state, back, z, r, new))
                state = after
                states[t, :, own] = state
        look = np.tanh(states @ self.p["look"])
        weight = (look @ self.p["gaze"])[:, :, 0] + np.where(there.T, 0, -1e9)
        weight = np.exp(weight - weight.max(0))
        weight /= weight.sum(0)
        pooled = np.einsum("tb,tbh->bh", weight, states)
        return (pooled @ self.p["out"])[:, 0] + self.p["base"][0, 0], (states, look, weight, pooled)

    def gates(self, x: np.ndarray) -> dict[str, np.ndarray]:
        return {d: x @ self.p["in" + d] + self.p["bias" + d] for d in "fb"}

    def layout(self, words: Words, begin: np.ndarray, size: np.ndarray):
        step = np.arange(WINDOW)
        there = step < size[:, None]
        at = np.where(there, begin[:, None] + step, 0)
        return np.where(there, words.number[at], len(words.word)), there

    def window_scores(self, words: Words) -> tuple[np.ndarray, tuple]:
        begin, size, text = windows(words.first)
        gates = self.gates(self.vectors(words))
        out = np.empty(len(begin), np.float32)
        for i in range(0, len(begin), WINDOWS_AT_ONCE):
            part = slice(i, i + WINDOWS_AT_ONCE)
            out[part] = self.run(gates, *self.layout(words, begin[part], size[part]))[0]
        return out, (begin, size, text)

    def scores(self, column: pa.Array) -> np.ndarray:
        words = read_words(column, self.word_buckets, self.gram_buckets)
        found, (_, _, text) = self.window_scores(words)
        best = np.full(len(column), -30.0)
        np.maximum.at(best, text, found.astype(np.float64))
        return 1 / (1 + np.exp(-np.clip(best + self.shift, -30, 30)))

    def gradients(self, words: Words, begin: np.ndarray, size: np.ndarray, label: np.ndarray, weight: np.ndarray) -> dict:
        """Back-propagation through the chosen windows."""
        p, h, w = self.p, self.hidden, self.width
        at, there = self.layout(words, begin, size)
        x = self.vectors(words)
        kept: list = []
        logit, (states, look, attention, pooled) = self.run(self.gates(x), at, there, kept)
        error = ((_sigmoid(logit) - label) * weight / len(label)).astype(np.float32)[:, None]
        g = {"out": pooled.T @ error, "base": error.sum(keepdims=True)}
        d_pooled = error @ p["out"].T
        d_states = attention[:, :, None] * d_pooled
        d_attention = np.einsum("bh,tbh->tb", d_pooled, states)
        d_gaze = attention * (d_attention - (attention * d_attention).sum(0))
        g["gaze"] = np.einsum("tbh,tb->h", look, d_gaze)[:, None]
        d_look = d_gaze[:, :, None] * p["gaze"][:, 0] * (1 - look**2)
        g["look"] = np.einsum("tbi,tbj->ij", states, d_look)
        d_states += d_look @ p["look"].T
        d_x = np.zeros_like(x)
        d_state = None
        for d in "fb":
            g |= {"in" + d: np.zeros_like(p["in" + d]), "re" + d: np.zeros_like(p["re" + d]), "bias" + d: np.zeros_like(p["bias" + d])}
        for d, t, before, back, z, r, new in reversed(kept):
            own = slice(0, h) if d == "f" else slice(h, 2 * h)
            if t == (WINDOW - 1 if d == "f" else 0):
                d_state = np.zeros((len(label), h), np.float32)
            dh = (d_state + d_states[t, :, own]) * there[:, t, None]
            d_new = dh * (1 - z) * (1 - new**2)
            d_z = dh * (before - new) * z * (1 - z)
            d_r = d_new * back[:, 2 * h :] * r * (1 - r)
            d_gate = np.concatenate([d_z, d_r, d_new], 1)
            d_back = np.concatenate([d_z, d_r, d_new * r], 1)
            g["re" + d] += before.T @ d_back
            g["in" + d] += x[at[:, t]].T @ d_gate
            g["bias" + d] += d_gate.sum(0, keepdims=True)
            d_state = dh * z + d_back @ p["re" + d].T
            np.add.at(d_x, at[:, t], d_gate @ p["in" + d].T)
        used = np.flatnonzero(np.abs(d_x[:-1]).sum(1))
        g["word"] = (words.word[used], d_x[used, :w])
        n = np.diff(words.gram_first)[used]
        rows = np.concatenate([words.gram[words.gram_first[i] : words.gram_first[i + 1]] for i in used] or [np.zeros(0, np.int64)])
        g["gram"] = (rows, np.repeat(d_x[used, w:] / n[:, None], n, axis=0))
        return g


def fit(texts: list[str], labels: list[int], passes: int = 18, batch: int = 32, rate: float = 0.08, **settings) -> ToxicityModel:
    """Adagrad over batches of texts, each standing for its highest window; small samples are passed over more often.

    With texts of one class only, or none, the model always answers that class, or 0.
    """
    model = ToxicityModel(**settings)
    y = np.asarray(labels, np.float32)
    if len(set(y.tolist())) < 2:
        model.p["out"][:] = 0
        model.p["base"][:] = 3.0 if len(y) and y[0] else -3.0
        return model
    rng = np.random.default_rng(model.seed)
    weight = len(y) / (2 * np.bincount(y.astype(int), minlength=2))
    memory = {k: np.full_like(v, 1e-4) for k, v in model.p.items()}
    column = pa.array(texts, pa.string())
    lengths = np.array([len(t) for t in texts])
    for epoch in range(passes):
        pace = rate * (1 - 0.9 * epoch / passes)
        # short texts first: there the label says most about its windows
        order = np.argsort(lengths + (rng.random(len(y)) * 800 if not epoch else 0), kind="stable") if epoch < 1 else rng.permutation(len(y))
        for i in range(0, len(y), batch):
            rows = order[i : i + batch]
            words = read_words(column.take(pa.array(rows)), model.word_buckets, model.gram_buckets)
            found, (begin, size, text) = model.window_scores(words)
            if not len(found):
                continue
            best = np.lexsort((-found, text))
            best = best[np.concatenate([[True], np.diff(text[best]) > 0])]
            label = y[rows[text[best]]]
            for k, grad in model.gradients(words, begin[best], size[best], label, weight[label.astype(int)]).items():
                if isinstance(grad, tuple):
                    row, inverse = np.unique(grad[0], return_inverse=True)
                    sums = np.zeros((len(row), grad[1].shape[1]), np.float32)
                    np.add.at(sums, inverse, grad[1])
                    memory[k][row] += sums**2
                    model.p[k][row] -= pace * sums / np.sqrt(memory[k][row])
                else:
                    grad = np.clip(grad, -1, 1)
                    memory[k] += grad**2
                    model.p[k] -= pace * grad / np.sqrt(memory[k])
    return model


def fit_toxicity(sample: DataFrame, **settings) -> ToxicityModel:
    """Fit on a bounded sample (doc_id, text, label), which goes to the driver in the order of its ids."""
    rows = sample.toPandas().sort_values("doc_id")
    return fit([t or "" for t in rows["text"]], rows["label"].tolist(), **settings)
