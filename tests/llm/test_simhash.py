"""SimHash groups against brute force, and the tiles that no link may fall between."""

import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from fcbias.llm import queries, simhash

from .test_operators import documents, docs, nothing  # noqa: F401


def fingerprint(value: str | None) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), value or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints: list[int]) -> dict[int, int]:
    """Fingerprint to a name of its component."""
    name = {x: x for x in prints}

    def root(x: int) -> int:
        while name[x] != x:
            x = name[x]
        return x

    for a, b in combinations(sorted(name), 2):
        if (a ^ b).bit_count() <= 2:
            name[root(a)] = root(b)
    return {x: root(x) for x in name}


def test_groups_by_brute_force(docs, nothing):  # noqa: F811
    rows = documents()
    prints = {r[1]: fingerprint(r[1]) for r in rows}
    group = groups(list(prints.values()))
    first: dict[int, int] = {}
    for r in rows:
        if r[0] is not None:
            first[group[prints[r[1]]]] = min(r[0], first.get(group[prints[r[1]]], r[0]))
    got = simhash.components(docs)
    assert got.dtypes == [("doc_id", "bigint"), ("fingerprint", "string"), ("component_id", "bigint"), ("n_copies", "bigint")]
    same = [prints[r[1]] for r in rows]
    want = [(r[0], f"{prints[r[1]]:016x}", first[group[prints[r[1]]]], same.count(prints[r[1]])) for r in rows]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert simhash.components(nothing).count() == 0


def test_only_rows_without_id(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (None, None)], "doc_id long, text string")  # noqa: F811
    assert sorted((r.fingerprint == "0" * 16, r.component_id) for r in simhash.components(docs).collect()) == [(False, None), (True, None)]


@pytest.mark.parametrize("seed", range(3))
def test_fingerprints_of_blocks(monkeypatch, seed):
    """A text may be longer than a block of words, and a block may end in any place of a text."""
    monkeypatch.setattr(simhash, "BLOCK", 7)
    rng = random.Random(seed)
    texts = [" \n".join(rng.choice(["A", "b", "ÄÖ", "word", "x y"]) for _ in range(rng.randrange(0, 20))) for _ in range(40)] + [None]
    assert simhash.fingerprints(pa.array(texts)).tolist() == [fingerprint(x) for x in texts]


@pytest.mark.parametrize("tile", [3, 40, 8192])
def test_no_link_falls_between_tiles(spark, tile):
    """Random fingerprints, chains of near ones, and many of one profile: in tiles of any size the groups are the same."""
    rng = random.Random(tile)
    prints = {0, 2**64 - 1, 2**63}
    for _ in range(40):
        x = rng.getrandbits(64)
        prints.add(x)
        for _ in range(rng.randrange(8)):
            for _ in range(rng.randrange(1, 4)):
                x ^= 1 << rng.randrange(64)
            prints.add(x)
    prints |= {1 << i for i in range(64)}
    signed = np.array(sorted(prints), np.uint64).view(np.int64).tolist()
    edges = simhash.links(spark.createDataFrame([(x,) for x in signed], "fingerprint long"), tile).collect()
    name = {x: x for x in prints}

    def root(x: int) -> int:
        while name[x] != x:
            x = name[x]
        return x

    for e in edges:
        a, b = (x % 2**64 for x in e)
        assert (a != b) and root(a) in prints
        name[root(a)] = root(b)
    want = groups(list(prints))
    assert {frozenset(y for y in prints if root(y) == root(x)) for x in prints} == {frozenset(y for y in prints if want[y] == want[x]) for x in prints}


def test_all_linked_with_all_gives_few_edges(spark):
    """Bits set one at a time: any two differ in two bits. The rows grow with the fingerprints, not with their pairs."""
    signed = [1 << i for i in range(63)]
    edges = simhash.links(spark.createDataFrame([(x,) for x in signed], "fingerprint long"), 8).count()
    assert edges <= 13 * len(signed) < len(signed) * (len(signed) - 1) // 2


def test_query(spark, folder):
    got = queries.QUERIES["op13_simhash"](spark, folder)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    prints = {d: fingerprint(t) for d, t in texts.items()}
    group = groups(list(prints.values()))
    want = {(d, f"{prints[d]:016x}", min(e for e in prints if group[prints[e]] == group[prints[d]])) for d in prints}
    assert set(map(tuple, got.collect())) == want
