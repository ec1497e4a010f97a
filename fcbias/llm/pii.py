"""Personal data by a semi-Markov conditional random field over whole spans.

Base spans come from fixed patterns, each read in one pass so that long texts take time in proportion. The field adds
spans. It works on islands, runs of blank-free chunks that hold a digit, ``@`` or ``+``; elsewhere no entity can be. An
island is cut into atoms (letters, digits, single marks), and dynamic programming over spans of at most ``LONGEST``
atoms chooses boundaries and kinds together. Features see a whole candidate: its shape, digits, check digit, octets and
neighbours. Candidates are made for ``BLOCK`` atoms at a time and the program runs on across blocks, so that islands are
never cut. The field is fitted by likelihood on a bounded sample of islands; its labels are the base spans and variants
of them (a phone without country code, a card written with dots), which is where it goes beyond the patterns.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce
from itertools import chain, pairwise
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from .shared import kept

KINDS = ("email", "ip", "card", "phone")
LONGEST = 24
BLOCK = 1024
RUN, SLICE = 256, 4096
BUCKETS = 1 << 12
Span = tuple[str, int, int]

_RUN = re.compile(r"[A-Za-z0-9._%+@-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@+]")
_CHUNK = re.compile(r"\S+")
_ATOM = re.compile(r"[A-Za-z]+|[0-9]+|.", re.S)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by kind and start; the leftmost of each kind that do not overlap."""
    found: list[Span] = []
    if "@" in text:
        for run in _RUN.finditer(text):
            part, shift, begin = run.group(), run.start(), 0
            at = part.find("@")
            while at >= 0:
                domain = _DOMAIN.match(part, at + 1) if at > begin else None
                if domain:
                    found.append(("email", shift + begin, shift + domain.end()))
                begin = domain.end() if domain else at + 1
                at = part.find("@", begin)
    for run in _DOTTED.finditer(text):
        if run.group().count(".") >= 3:
            parts, begin = run.group().split("."), run.start()
            for i in range(0, len(parts) - 3, 4):
                end = begin + sum(map(len, parts[i : i + 4])) + 3
                if all(map(_octet, parts[i : i + 4])):
                    found.append(("ip", begin, end))
                begin = end + 1
    for match in _CARD.finditer(text):
        digits = re.sub("[ -]", "", match.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *match.span()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in match.group()) <= 15:
                found.append(("phone", *match.span()))
    return found


def islands(text: str) -> Iterator[tuple[int, int]]:
    """Where runs of chunks with a digit, @ or + begin and end; one blank between two chunks does not part them."""
    begin = end = -1
    for chunk in _CHUNK.finditer(text):
        if not _TRIGGER.search(chunk.group()):
            continue
        if begin >= 0 and chunk.start() == end + 1 and text[end] == " ":
            end = chunk.end()
            continue
        if begin >= 0:
            yield begin, end
        begin, end = chunk.span()
    if begin >= 0:
        yield begin, end


def short_islands(text: str) -> Iterator[tuple[int, int]]:
    """Islands for the fit, parted at the first blank after ``RUN`` characters, and chunks in slices of ``SLICE``."""
    for begin, end in islands(text):
        while begin < end:
            stop = text.find(" ", begin + RUN, end)
            stop = end if stop < 0 else stop
            yield from ((i, min(i + SLICE, stop)) for i in range(begin, stop, SLICE))
            begin = stop + 1


def _kind_of(char: str) -> str:
    return "9" if char.isdigit() else "a" if char.isalpha() else char


def _features(island: str, begin: int, end: int, atoms: list[str]) -> list[int]:
    span = island[begin:end]
    digits = "".join(c for c in span if c in "0123456789")
    n = len(digits)
    shape = "".join(f"9{len(a)}" if a[0] in "0123456789" else "a" if a[0].isalpha() else a[0] for a in atoms)
    left = _kind_of(island[begin - 1]) if begin else "^"
    right = _kind_of(island[end]) if end < len(island) else "$"
    dots, ats = span.count("."), span.count("@")
    letters = any(c.isalpha() for c in span)
    octets = dots == 3 and not letters and all(p.isdigit() and _octet(p) for p in span.split("."))
    domain = span.rpartition("@")[2]
    marks = "".join(sorted({c for c in span if not c.isalnum()}))
    check = 13 <= n <= 19 and not letters and luhn(digits)
    names = (
        "one",
        f"shape {shape}",
        f"digits {min(n, 25)} {letters}",
        f"marks {marks} {letters}",
        f"marks {marks} {min(n, 25)} {letters}",
        f"ends {_kind_of(span[0])} {_kind_of(span[-1])}",
        f"octets {octets}",
        f"check {check} {13 <= n <= 19} {letters}",
        f"ats {ats} {'.' in domain} {domain[-1:].isalnum()}",
        f"left {left} {ats} {octets} {check}",
        f"right {right} {ats} {octets} {check}",
        f"plus {span[0] == '+'} {9 <= n <= 15} {letters}",
    )
    return [crc32(x.encode()) % BUCKETS for x in names]


@dataclass
class Lattice:
    """Candidate spans of an island: first and last atom, features, and the places of the atoms."""

    places: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    features: np.ndarray

    @staticmethod
    def places_of(island: str) -> np.ndarray:
        return np.fromiter(chain([0], (a.end() for a in _ATOM.finditer(island))), np.int64)

    @staticmethod
    def of(island: str, places: np.ndarray | None = None, low: int = 0, high: int | None = None) -> Lattice:
        """The candidates that begin at the atoms from ``low`` to before ``high``, in this order."""
        places = Lattice.places_of(island) if places is None else places
        high = len(places) - 1 if high is None else high
        near = places[low : high + LONGEST].tolist()
        atoms = [island[b:e] for b, e in pairwise(near)]
        begin, end, features = [], [], []
        for i, first in enumerate(atoms[: high - low]):
            if first.isspace():
                continue
            for j in range(i + 1, min(len(atoms), i + LONGEST) + 1):
                if atoms[j - 1].isspace() or not _TRIGGER.search(island, near[i], near[j]):
                    continue
                begin.append(low + i)
                end.append(low + j)
                features.append(_features(island, near[i], near[j], atoms[i:j]))
        return Lattice(places, np.array(begin, int), np.array(end, int), np.array(features, int).reshape(len(begin), -1 if begin else 0))


def _log_sum(x: np.ndarray, axis: int = 0) -> np.ndarray:
    top = x.max(axis)
    return top + np.log(np.exp(x - np.expand_dims(top, axis)).sum(axis))


@dataclass
class Field:
    """Weights by feature and kind, and of a kind after another; kind 0 is a single atom outside all entities."""

    weights: np.ndarray
    steps: np.ndarray

    def sums(self, lattice: Lattice, scores: np.ndarray, backward: bool = False) -> np.ndarray:
        """Log sums over the segmentations up to each place (or from it on), by the kind of the segment there."""
        n, kinds = len(lattice.places) - 1, len(KINDS) + 1
        out = np.full((n + 1, kinds), -np.inf)
        steps = self.steps.T if backward else self.steps
        near, far = (lattice.begin, lattice.end) if backward else (lattice.end, lattice.begin)
        order = np.argsort(near, kind="stable")
        cuts = np.searchsorted(near[order], np.arange(n + 2))
        joined = np.zeros((n + 1, kinds))
        edge = n if backward else 0
        for place in range(n - 1, -1, -1) if backward else range(1, n + 1):
            last = place + 1 if backward else place - 1
            out[place, 0] = joined[last, 0] if last != edge else 0.0
            own = order[cuts[place] : cuts[place + 1]]
            if len(own):
                out[place, 1:] = _log_sum(np.where((far[own] == edge)[:, None], 0.0, joined[far[own], 1:]) + scores[own])
            joined[place] = _log_sum(out[place][:, None] + steps)
        return out

    def best(self, island: str) -> list[Span]:
        """Spans of the best segmentation of the whole island, however long it is."""
        places = Lattice.places_of(island)
        n, kinds, ring = len(places) - 1, len(KINDS) + 1, LONGEST + 1
        value = np.full((ring, kinds), -np.inf)
        length = np.zeros((n + 1, kinds), np.int8)
        before = np.zeros((n + 1, kinds), np.int8)
        for low in range(0, n, BLOCK):
            high = min(n, low + BLOCK)
            lattice = Lattice.of(island, places, low, high)
            scores = self.weights[lattice.features].sum(1)
            cuts = np.searchsorted(lattice.begin, np.arange(low, high + 1))
            for at in range(low, high):
                sums = value[at % ring][:, None] + self.steps if at else np.zeros((1, kinds))
                last, reach = sums.argmax(0), sums.max(0)
                value[at % ring] = -np.inf
                value[(at + 1) % ring, 0], length[at + 1, 0], before[at + 1, 0] = reach[0], 1, last[0]
                own = slice(cuts[at - low], cuts[at - low + 1])
                ends = lattice.end[own]
                total = reach[1:] + scores[own]
                better = total > value[ends % ring, 1:]
                value[ends % ring, 1:] = np.where(better, total, value[ends % ring, 1:])
                length[ends, 1:] = np.where(better, (ends - at)[:, None], length[ends, 1:])
                before[ends, 1:] = np.where(better, last[1:], before[ends, 1:])
        found, place, k = [], n, int(value[n % ring].argmax())
        while place > 0:
            begin = place - int(length[place, k])
            if k:
                found.append((KINDS[k - 1], int(places[begin]), int(places[place])))
            place, k = begin, int(before[place, k])
        return found[::-1]


def fit(examples: list[tuple[str, list[Span]]], epochs: int = 6, rate: float = 0.3, decay: float = 1e-4) -> Field:
    """Gradient steps on the log-likelihood of the labelled islands; without examples nothing is ever added."""
    kinds = len(KINDS) + 1
    field = Field(np.zeros((BUCKETS, kinds - 1)), np.zeros((kinds, kinds)))
    field.weights[crc32(b"one") % BUCKETS] = -2.0
    prepared = []
    for island, spans in examples:
        lattice = Lattice.of(island)
        place = {p: i for i, p in enumerate(lattice.places.tolist())}
        gold, last, path = {(place[b], place[e]): KINDS.index(k) for k, b, e in spans}, 0, []
        for (b, e), k in sorted(gold.items()):
            path += [0] * (b - last) + [k + 1]
            last = e
        path += [0] * (len(lattice.places) - 1 - last)
        prepared.append((lattice, gold, path))
    for epoch in range(epochs):
        pace = rate / (1 + epoch)
        for lattice, gold, path in prepared:
            if not len(lattice.begin):
                continue
            scores = field.weights[lattice.features].sum(1)
            ahead, behind = field.sums(lattice, scores), field.sums(lattice, scores, True)
            n = len(lattice.places) - 1
            total = _log_sum(ahead[n])
            reach = np.zeros((n + 1, kinds))
            leave = np.zeros((n + 1, kinds))
            for p in range(1, n):
                reach[p] = _log_sum(ahead[p][:, None] + field.steps)
                leave[p] = _log_sum(behind[p][:, None] + field.steps.T)
            share = np.exp(np.clip(reach[lattice.begin, 1:] + scores + leave[lattice.end, 1:] - total, -50, 0))
            for s, (b, e) in enumerate(zip(lattice.begin.tolist(), lattice.end.tolist())):
                if (b, e) in gold:
                    share[s, gold[b, e]] -= 1
            seen = np.zeros_like(field.steps)
            for p in range(1, n):
                seen += np.exp(np.clip(ahead[p][:, None] + field.steps + behind[p][None, :] - total, -50, 0))
            for a, b in zip(path, path[1:]):
                seen[a, b] -= 1
            busy = np.flatnonzero(np.abs(share).max(1) > 1e-4)
            np.subtract.at(field.weights, lattice.features[busy], pace * share[busy][:, None, :])
            field.steps -= 0.02 * pace * seen
        field.weights *= 1 - decay
    return field


def _without_overlap(spans: list[Span]) -> list[Span]:
    kept: list[Span] = []
    for span in spans:
        if all(span[2] <= k[1] or span[1] >= k[2] for k in kept):
            kept.append(span)
    return sorted(kept, key=lambda s: s[1])


def examples_of(text: str) -> list[tuple[str, list[Span]]]:
    """Islands with the base spans that lie in them, and for some a variant that the patterns do not read."""
    spans = _without_overlap(base_spans(text))
    out = []
    for begin, end in short_islands(text):
        island = text[begin:end]
        if len(island) > 200:
            continue
        own = [(k, b - begin, e - begin) for k, b, e in spans if b >= begin and e <= end]
        out.append((island, own))
        if len(own) == 1:
            kind, b, e = own[0]
            old = island[b:e]
            new = re.sub(r"^\+[0-9]+ (?=\()", "", old) if kind == "phone" else re.sub(r"(?<=[0-9]{4})(?=[0-9]{4})", ".", re.sub("[ -]", "", old)) if kind == "card" else old
            if new != old:
                out.append((island[:b] + new + island[e:], [(kind, b, b + len(new))]))
    return out


def _first(found: set[tuple[str, int, str, str]], examples: int) -> list[tuple[str, int, str, str]]:
    """The first ``examples`` of each kind by digest, island and spans."""
    number: Counter[str] = Counter()
    out = []
    for row in sorted(found):
        number[row[0]] += 1
        if number[row[0]] <= examples:
            out.append(row)
    return out


def fit_field(docs: DataFrame, examples: int = 600, **settings) -> Field:
    """Fit on the first ``examples`` distinct islands of each kind and of none, in the order of a digest of the island.

    All documents are read. A task passes on its own first ones only, so neither partitions nor the order of rows matter.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: set[tuple[str, int, str, str]] = set()
        for batch in batches:
            for text in batch.column(0):
                text = text.as_py()
                if text and _TRIGGER.search(text):
                    for island, spans in examples_of(text):
                        found.add((spans[0][0] if spans else "", crc32(island.encode()), island, ",".join(f"{k}:{b}:{e}" for k, b, e in spans)))
                    if len(found) > 20 * examples:
                        found = set(_first(found, examples))
        rows = _first(found, examples)
        columns = zip(*rows) if rows else ([], [], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string(), pa.string()))], ["kind", "digest", "island", "spans"])

    rows = kept(docs.select("text").mapInArrow(read, "kind string, digest long, island string, spans string"), "personal-data-examples").distinct()
    first = [rows.filter(F.col("kind") == k).orderBy("digest", "island", "spans").limit(examples) for k in ("", *KINDS)]
    chosen = reduce(DataFrame.unionAll, first).collect()
    chosen = sorted((r.digest, r.island, r.spans) for r in chosen)
    return fit([(island, [(k, int(b), int(e)) for k, b, e in (x.split(":") for x in spans.split(",") if x)]) for _, island, spans in chosen], **settings)


def all_spans(text: str, field: Field, decode=None) -> tuple[list[Span], list[Span]]:
    """Base spans, and base spans with those that the field adds where no base span is; by kind and start."""
    if not text or not _TRIGGER.search(text):
        return [], []
    base = base_spans(text)
    taken: list[list[int]] = []
    for b, e in sorted((b, e) for _, b, e in base):
        if taken and b < taken[-1][1]:
            taken[-1][1] = max(e, taken[-1][1])
        else:
            taken.append([b, e])
    added = []
    at = 0
    for begin, end in islands(text):
        for kind, b, e in (decode or field.best)(text[begin:end]):
            while at < len(taken) and taken[at][1] <= begin + b:
                at += 1
            if at == len(taken) or begin + e <= taken[at][0]:
                added.append((kind, begin + b, begin + e))
    return base, sorted(base + added, key=lambda s: (KINDS.index(s[0]), s[1]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{b}:{e}" for k, b, e in spans)


def masked(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind; overlapping spans become one, of the first one's kind."""
    out, at = [], 0
    for kind, b, e in sorted(spans, key=lambda s: (s[1], -s[2])):
        if b >= at:
            out += [text[at:b], f"<{kind.upper()}>"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def _decoder(field: Field):
    remembered = lru_cache(50_000)(field.best)
    return lambda island: remembered(island) if len(island) < 200 else field.best(island)


def find(docs: DataFrame, field: Field) -> DataFrame:
    """Spans of each document: doc_id, n_<kind> of the base spans, n_added, base (text) and spans (text).

    Positions are code points, ends exclusive. Null and empty texts have none. One row per input row, repeated rows too;
    columns other than doc_id and text are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = _decoder(shared.value)
        for batch in batches:
            rows = [all_spans(t.as_py(), shared.value, decode) for t in batch.column(1)]
            counts = [pa.array([sum(s[0] == k for s in base) for base, _ in rows], pa.int64()) for k in KINDS]
            more = pa.array([len(spans) - len(base) for base, spans in rows], pa.int64())
            base = [joined(base) for base, _ in rows]
            digest = pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, more, digest, pa.array([joined(s) for _, s in rows], pa.string())], [*names])

    names = ["doc_id", *(f"n_{k}" for k in KINDS), "n_added", "base_sha256", "spans"]
    columns = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {columns}, n_added long, base_sha256 string, spans string")


def redact(docs: DataFrame, field: Field) -> DataFrame:
    """The documents with every span in ``text`` replaced by its kind; null texts stay null, other columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = _decoder(shared.value)
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = [t and masked(t, all_spans(t, shared.value, decode)[1]) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(run, S.StructType(docs.schema.fields))
