"""Ranked search against a plain count of all terms, and what the automaton must not match."""

import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from fcbias.llm import lexical, queries

from .test_operators import documents, docs, nothing  # noqa: F401

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(value: str | None) -> list[str]:
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in value or ""))


def expected(rows: list[tuple], items: list[tuple], k: int) -> list[tuple]:
    counts = [(r[0], Counter(terms(r[1]))) for r in rows]
    n_docs, length = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = defaultdict(Counter)
    for item, value in set(items):
        wanted[item].update(terms(value))
    out = []
    for item, own in wanted.items():
        scored = []
        for doc, c in counts:
            m = 75 + 25 * sum(c.values()) * n_docs // length if n_docs else 0
            score = 0
            for t, times in own.items():
                if c[t]:
                    score += times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -low) for rank, (low, _, _, doc) in enumerate(sorted(scored)[:k], 1)]
    return out


def items(rows: list[tuple]) -> list[tuple]:
    rng = random.Random(3)
    texts = [r[1] for r in rows if r[1]]
    made = [(i, " ".join(rng.choice(texts).split()[:30] + ["One", "one-two", "ß"])) for i in range(25)]
    return [*made, (30, None), (31, ""), (32, "... --"), (None, "one A"), (None, "é ü"), made[3], made[3], (4, "the2 changed"), (33, "nowheretobefound"), (34, "x " * 50 + "Ü")]


@pytest.mark.parametrize("item_bytes", [1, 6000, lexical.ITEM_BYTES])
@pytest.mark.parametrize("k", [1, 7])
def test_search_by_brute_force(spark, docs, monkeypatch, item_bytes, k):  # noqa: F811
    """All items in one automaton, or each in its own; few cells and short slices at a time."""
    monkeypatch.setattr(lexical, "SLICE", 700)
    monkeypatch.setattr(lexical, "CELLS", 300)
    own = items(documents())[-12:] if item_bytes == 1 else items(documents())
    benchmark = spark.createDataFrame([(*x, 1, "s", 2) for x in own], "item_id long, text string, doc_id int, score string, rank int")
    got = lexical.search(docs, benchmark, k, item_bytes)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected(documents(), own, k), key=str)


def test_empty_tables_and_names_as_ids(spark, docs, nothing):  # noqa: F811
    benchmark = spark.createDataFrame([("b", "the one"), ("a", "one")], "item_id string, text string")
    got = lexical.search(docs, benchmark, 3)
    assert sorted(map(tuple, got.collect())) == sorted(expected(documents(), [("b", "the one"), ("a", "one")], 3))
    assert lexical.search(nothing, benchmark).count() == 0
    assert lexical.search(docs, benchmark.limit(0)).count() == 0
    blank = spark.createDataFrame([(1, None), (2, " ")], "doc_id long, text string")
    assert lexical.search(blank, benchmark).count() == 0


@pytest.mark.parametrize("size", [1, 2, 3, 5, 1 << 20])
def test_whole_terms_only(monkeypatch, size):
    """No match inside a longer term, across texts or where a slice ends."""
    monkeypatch.setattr(lexical, "SLICE", size)
    words = ["a", "ab", "b", "ba", "é", "éa"]
    texts = ["a", "b", "ab ba", "aba", None, "", "éa-é,Éa", "A.b  a\tab", "xab", "a" * 20 + " a", "b"]
    row, term, tf, n = lexical.term_counts(pa.array(texts), lexical._automaton(words), len(words))
    got = [Counter() for _ in texts]
    for r, t, c in zip(row, term, tf):
        got[r][words[t]] += int(c)
    assert got == [Counter(t for t in terms(x) if t in words) for x in texts]
    assert n.tolist() == [len(terms(x)) for x in texts]


def test_weights():
    assert lexical.term_weights(np.array([0, 1, 5]), 5).tolist() == [math.floor(1000 * math.log(x)) for x in (12, 4, 12 / 11)]


def test_query_and_its_sql(spark, tmp_path):
    spark.createDataFrame([r[:2] for r in documents()], "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items(documents()), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted(map(tuple, queries.QUERIES["op11_ranked_search"](spark, str(tmp_path)).collect()), key=str)
    assert got == sorted(expected(documents(), items(documents()), 20), key=str)
    with duckdb.connect() as connection:
        for name in ("documents", "benchmark"):
            connection.sql(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
        assert sorted(connection.sql(queries.ORACLES["op11_ranked_search"]).fetchall(), key=str) == got
