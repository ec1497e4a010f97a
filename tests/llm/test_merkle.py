"""The manifest against a tree built in Python: all shapes of trees, nulls, ties, repeated rows and tampered leaves."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from fcbias.llm import merkle, queries



def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(*fields) -> str:
    return digest("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def levels(nodes: list[str]) -> list[list[str]]:
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest("".join(out[-1][i : i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def siblings(tree: list[list[str]], p: int) -> list[tuple[list[str], list[str]]]:
    """Left and right siblings of each level from a leaf to the top."""
    found = []
    for level in tree[:-1]:
        run = level[p // 8 * 8 : p // 8 * 8 + 8]
        found.append((run[: p % 8], run[p % 8 + 1 :]))
        p //= 8
    return found


def expected(rows: list[tuple]) -> list[tuple]:
    """Of rows (group, order, leaf, doubted): leaf, subroot, root, proof, folded root and verified."""
    order = {g: i for i, g in enumerate(sorted({r[0] for r in rows}, key=lambda g: (g is not None, (g or "").encode())))}
    trees = {}
    for g in order:
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        trees[g] = own, levels([r[2] for r in own])
    upper = levels([trees[g][1][-1][0] for g in order])
    out = []
    for g, (own, tree) in trees.items():
        for p, r in enumerate(own):
            path = siblings(tree, p) + siblings(upper, order[g])
            folded = r[3]
            for left, right in path:
                folded = digest("".join(left) + folded + "".join(right))
            proof = digest("".join(x for left, right in path for x in left + right))
            out.append((r[2], tree[-1][0], upper[-1][0], proof, folded, folded == upper[-1][0]))
    return out


def audited(spark, rows: list[tuple], parts: int = 5) -> list[tuple]:
    df = spark.createDataFrame(rows, "lang string, doc_id long, leaf string, doubted string, digest int").repartition(parts).withColumns({c: F.unhex(c) for c in ("leaf", "doubted")})
    found = merkle.audit(merkle.build(df, "lang", ["doc_id"]), "doubted")
    return sorted(map(tuple, found.select("leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()))


@pytest.mark.parametrize("sizes", [[1], [8], [9], [1, 1], [65, 1, 7], [1] * 9, [3, 1, 64, 17, 2, 1, 1, 8, 30, 5]])
def test_trees_of_all_shapes(spark, sizes):
    rng = random.Random(len(sizes))
    rows = []
    for g, n in enumerate(sizes):
        for i in range(n):
            own = digest(f"{g} {i}")
            rows.append((None if g == 3 else f"ß{g}" if g % 2 else f"z{g}", i, own, own if rng.random() < 0.7 else digest("x"), 5))
    assert audited(spark, rows) == sorted(expected(rows))


def test_more_than_a_block_of_leaves(spark):
    """A tree of two blocks beside many small ones, ids that are null or tie, and exact repeats."""
    rows = [("en", i // 3, digest(str(i // 2)), digest(str(i // 2)), 5) for i in range(merkle.BLOCK + 700)]
    rows += [(f"g{i}", None if i % 5 == 0 else i, digest(f"g{i}"), digest(f"h{i}"), 5) for i in range(70)]
    rows += [(None, None, digest("n"), digest("n"), 5)] * 3
    assert audited(spark, rows) == sorted(expected(rows))


def test_nothing(spark):
    assert audited(spark, []) == []


def test_fields(spark):
    """Null, empty and non-ASCII values, as bytes of UTF-8."""
    rows = [(None, "s", 12, "aÄ "), (7, None, None, ""), (-1, "", 0, None)]
    df = spark.createDataFrame(rows, "doc_id long, source string, n_chars long, text string")
    assert [r[0] for r in df.select(merkle.digest_of(*df.columns)).collect()] == [leaf(*r) for r in rows]


def test_row_limit_is_put_back(spark, folder):
    before = spark.conf.get(merkle.RECURSION_LIMIT)
    queries.QUERIES["op12_merkle_manifest"](spark, folder)
    assert spark.conf.get(merkle.RECURSION_LIMIT) == before


def test_query_by_brute_force_and_sql(spark, tmp_path):
    """Nulls in every column, repeated rows and one long text; the same rows by the SQL check."""
    rows = [(i, f"T{i} text ÄÖ", None if i % 6 == 0 else f"l{i % 3}", f"s{i % 2}", i) for i in range(70)]
    rows += [(3, None, "l0", None, None), (None, "Abc", None, "s", 4), (None, "", "l1", "s", 4), rows[5], rows[5], (99, "Long " * 40_000, "l1", "s", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op12_merkle_manifest"](spark, str(tmp_path))
    made = []
    for doc_id, text, lang, source, n_chars in rows:
        tampered = doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        changed = "".join(c.lower() if "A" <= c <= "Z" else c for c in text) if tampered else text
        made.append((lang, doc_id, leaf(doc_id, source, lang, n_chars, text), leaf(doc_id, source, lang, n_chars, changed)))
    assert sorted(tuple(r)[1:] for r in got.collect()) == sorted(expected(made))
    import duckdb

    with duckdb.connect() as connection:
        connection.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
        want = connection.sql(queries.ORACLES["op12_merkle_manifest"]).fetchall()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
