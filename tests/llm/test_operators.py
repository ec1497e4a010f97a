"""The language-model operators against brute force, and on rows that are null, empty, long, tied or repeated."""

from __future__ import annotations

import hashlib
import random
import re
from itertools import pairwise

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from fcbias.llm import decontaminate, jaccard, mixing, neighbours, pii, quality, queries, shared, substrings, text, tokens, toxicity, urls

from ..compare import canonical, reference_rows

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, key int, score string, bucket int"
WORDS = "the of and to in is it on as with by from at this that be are was or an".split()


def passage(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randrange(60)) for _ in range(n))


def documents(seed: int = 1) -> list[tuple]:
    """Copies, near copies, shared passages, null and empty texts and ids, repeated rows, one very long text."""
    rng = random.Random(seed)
    texts = [passage(rng, rng.randrange(1, 120)) for _ in range(60)]
    shared_part = passage(rng, 40)
    for i in range(0, 30, 3):
        texts.append(texts[i])
        words = texts[i].split()
        words[rng.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
        texts.append(passage(rng, 10) + " " + shared_part + "\t" + passage(rng, 8))
    texts += ["", None, " \n ", "One", "one", "a b c", "A b C", "x " * 300, "é\u00a0ü ß " * 30, passage(rng, 6000), "y" * 100_000]
    rows = [(i, t, None, None if i % 7 == 0 else f"s{i % 4}", 1, "d", 2, "x", 3) for i, t in enumerate(texts)]
    return [*rows, (None, texts[0], "en", "s1", 1, None, None, None, None), rows[5], rows[5]]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def split(value: str | None, lower: bool = False) -> list[str]:
    value = value or ""
    if lower:
        value = re.sub("[A-Z]", lambda m: m.group().lower(), value)
    return re.findall(r"[^\x20\x09-\x0D]+", value)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows_as_sql(spark, folder, name):
    df = queries.QUERIES[name](spark, folder)
    got, want = canonical(df.columns, df.collect()), canonical(*reference_rows(folder, queries.ORACLES[name]))
    assert got == want


@pytest.mark.parametrize("task_signs", [jaccard.TASK_SIGNS, 0])
def test_components_by_brute_force(docs, nothing, monkeypatch, task_signs):
    monkeypatch.setattr(jaccard, "TASK_SIGNS", task_signs)
    rows = documents()
    sets = []
    for r in rows:
        w = split(r[1], True)
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    ids = [float("inf") if r[0] is None else r[0] for r in rows]
    low = {g: min(ids[k] for k in range(len(rows)) if group[k] == g) for g in set(group)}
    want = sorted((ids[i], len(sets[i]), low[group[i]]) for i in range(len(rows)))
    inf = float("inf")
    got = sorted((inf if r.doc_id is None else r.doc_id, r.n_shingles, inf if r.component_id is None else r.component_id) for r in jaccard.components(docs).collect())
    assert got == want
    assert jaccard.components(nothing).collect() == []


def test_every_linked_pair_shares_a_signature():
    rng = np.random.default_rng(3)
    sketch = rng.integers(0, 50, 1 << jaccard.SKETCH_BITS)
    for size in (4, 7, 10, 14, 19, 28, 37, 60, 150, 700):
        for _ in range(20):
            a = rng.integers(0, 2**63, size, dtype=np.uint64)
            other = int(size * rng.uniform(1, 1.25))
            same = int(np.ceil(0.8 / 1.8 * (size + other)))
            if same > min(size, other):
                continue
            b = np.concatenate([a[:same], rng.integers(0, 2**63, other - same, dtype=np.uint64)])
            if 100 * same < 80 * (size + other - same):
                continue
            token = np.concatenate([np.sort(a), np.sort(b)])
            first = np.array([0, size, size + other])
            small = np.searchsorted(jaccard.TOP, min(size, other))
            if jaccard.BOUND[small] == 0:
                continue
            sign, row = jaccard.signatures(token, first, np.array([small, small]), sketch)
            assert set(sign[row == 0].tolist()) & set(sign[row == 1].tolist()), size


def test_crowded_signatures_meet_as_others_do(spark, folder, monkeypatch):
    docs = shared.table(spark, folder, "documents").withColumn("digest", F.xxhash64("text"))
    sketch = np.zeros(1 << jaccard.SKETCH_BITS, np.int64)

    def groups(task_signs: int, broadcast: int) -> list[tuple[int, ...]]:
        monkeypatch.setattr(jaccard, "TASK_SIGNS", task_signs)
        monkeypatch.setattr(jaccard, "BROADCAST_GROUPS", broadcast)
        met = jaccard._buckets(docs, sketch, 7)
        assert met.filter("centre = key").select("bucket").distinct().count() == met.select("bucket").distinct().count()
        return sorted({tuple(sorted(r.members)) for r in met.groupBy("bucket").agg(F.collect_set("key").alias("members")).collect()})

    want = groups(1 << 40, 0)
    assert want
    assert groups(0, 100) == groups(0, 0) == want


@pytest.mark.parametrize("task_signs", [jaccard.TASK_SIGNS, 0])
def test_large_buckets_are_compared_in_blocks(spark, monkeypatch, task_signs):
    monkeypatch.setattr(jaccard, "TASK_SIGNS", task_signs)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(90)]
    rows = []
    for i in range(120):
        words = list(base)
        for _ in range(rng.randrange(1, 5)):
            words[rng.randrange(len(words))] = f"v{rng.random()}"
        rows.append((i, " ".join(words)))
    got = {r.doc_id: r.component_id for r in jaccard.components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (r[1].split() for r in rows)]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((group[i], group[j]))
                group = [a if g == b else g for g in group]
    assert got == dict(enumerate(group))


def test_urls(spark):
    rows = [(1, "HTTP://A.B.Net/x?q=1"), (2, "http://example.net/en/1"), (3, "http://m.example.com/de/"), (4, "http://x.org/fr/a#b"), (5, "http://xnet/"),
            (6, "http://a.net"), (7, None), (8, ""), (9, "a.net/"), (10, "http://net/"), (10, "http://net/"), (11, "http://example.net/en"), (12, "x://h?p=/y")]
    frame = spark.createDataFrame([(*r, "h") for r in rows], "page_id long, url string, suffix string")
    got = sorted((r.page_id, r.host, r.path, r.rule) for r in urls.filter_urls(frame, sample_rows=50).collect())
    assert got == sorted([(1, "a.b.net", "/x", "net/"), (2, "example.net", "/en/1", "example.net/en/"), (3, "m.example.com", "/de/", "example.com/de/"), (4, "x.org", "/fr/a", "org/fr/"),
                          (5, "xnet", "/", None), (6, "a.net", "", None), (7, "", "", None), (8, "", "", None), (9, "", "", None), (10, "net", "/", "net/"), (10, "net", "/", "net/"),
                          (11, "example.net", "/en", "net/"), (12, "h", "", None)])
    assert {r.verdict for r in urls.filter_urls(frame.filter("page_id in (7, 8)")).collect()} == {"allow"}
    assert urls.filter_urls(frame.limit(0)).collect() == []


@pytest.mark.parametrize("lexical", [True, False])
def test_trees_judge_unlabelled_hosts_by_the_url(spark, monkeypatch, lexical):
    """Hosts of one suffix, half of them blocked: only the look of the URLs tells what the hosts without a rule are."""
    plain, odd = (lambda i: f"/news/story/{'abcdefgh'[i % 8]}rticle"), (lambda i: f"/{i * 7919}/{i * 104729}?a={i}&b={i * 31}&c={i * 17}")
    rules = tuple(urls.Rule(f"h{i}.site/", "block" if i % 2 else "allow") for i in range(20))
    pages = [(f"http://h{h}.site{(odd if h % 2 else plain)(i)}", None) for h in range(20) for i in range(1, 16)]
    pages += [(f"http://u{h}.site{(odd if h % 2 else plain)(i)}", "block" if h % 2 else "allow") for h in range(10) for i in range(20, 40)]
    frame = spark.createDataFrame([(n, u, v) for n, (u, v) in enumerate(pages)], "page_id long, url string, truth string")
    if not lexical:
        monkeypatch.setattr(urls, "FEATURES", [f for f in urls.FEATURES if f.endswith(("_rate", "_known"))])
    got = urls.filter_urls(frame, rules).join(frame.filter("truth is not null").select("page_id", "truth"), "page_id")
    right = got.filter("verdict = truth").count() / got.count()
    assert right >= 0.95 if lexical else right <= 0.6


def test_suffix_rates_leave_out_the_own_host(spark, monkeypatch):
    rows = [("a.x.org", 1.0)] * 3 + [("b.x.org", 0.0)] + [("c.org", 1.0)] * 2
    known = urls.lexical(spark.createDataFrame([(h, f"http://{h}/", "/", y) for h, y in rows], "host string, url string, path string, label double"))
    pages = urls.lexical(spark.createDataFrame([(h, f"http://{h}/", "/") for h in ("a.x.org", "b.x.org", "c.org", "new.x.org", "other", "")], "host string, url string, path string"))
    for most in (100, 0):
        monkeypatch.setattr(urls, "BROADCAST_ROWS", most)
        got = {r.host: (r.suffix_rate, r.domain_rate) for r in urls.with_suffix_rates(pages, urls.label_counts(known)).collect()}
        assert got == {"a.x.org": (3 / 5, 1 / 3), "b.x.org": (6 / 7, 4 / 5), "c.org": (4 / 6, 1 / 2), "new.x.org": (6 / 8, 4 / 6), "other": (1 / 2, 1 / 2), "": (1 / 2, 1 / 2)}


def test_small_shards_are_searched_by_their_graph(spark, monkeypatch):
    built = []
    rng = np.random.default_rng(5)
    for n in (1, 2, 30, 500):
        points = rng.normal(size=(n, 8))
        graph = neighbours.Graph(np.concatenate([points, np.zeros((n, 1))], 1))
        row, vec, score = neighbours._answers(graph, points, [np.array([i]) for i in range(n)], points[:5], 21)
        truth = np.argsort(-(points[:5] @ points.T), 1, kind="stable")[:, :21]
        built.append(np.mean([len(set(vec[row == q]) & set(truth[q])) / len(truth[q]) for q in range(len(truth))]))
    assert min(built) >= 0.95 and built[:3] == [1.0, 1.0, 1.0]


def test_url_sample_takes_each_url_once(spark, monkeypatch):
    sampled = []
    monkeypatch.setattr(urls, "kept", lambda df, label, *a: sampled.append((label, df)) or shared.kept(df, label, *a))
    rules = (urls.Rule("bad/", "block"), urls.Rule("good/", "allow"))
    single = [f"http://h{i}.{'bad' if i % 2 else 'good'}/p{i}" for i in range(200)]
    first = [r.url for r in spark.createDataFrame([(u,) for u in single], "url string").orderBy(F.xxhash64("url")).limit(4).collect()]
    pages = spark.createDataFrame(list(enumerate(single + first * 300)), "page_id long, url string").repartition(4)
    assert urls.filter_urls(pages, rules, sample_rows=50).count() == 1400
    rows = [tuple(r) for label, df in sampled if label == "url-sample" for r in df.select("url", "label").collect()]
    assert len(rows) == len(set(rows)) == 100 and sum(label for _, label in rows) == 50


def test_nearest(spark):
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(3000, 16)).astype(np.float32)
    vectors[100:400] = vectors[100]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(vectors)]
    odd = [(9001, None, 1), (9002, [0.0] * 16, 1), (9003, [float("nan")] * 16, 1), (9004, [None] * 16, 1), (9005, [1.0], 1), (9006, [float("inf")] + [0.0] * 15, 1), (None, [1.0] * 16, 1), rows[3]]
    table = spark.createDataFrame([*rows, *odd], "vec_id long, embedding array<float>, label int")
    found: dict[int, list] = {}
    for r in neighbours.nearest(table, table.filter("vec_id % 20 = 0"), 20, shard=1500).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(found) == list(range(0, 3000, 20))
    wide = vectors.astype(float)
    hits = 0
    for q, rows in found.items():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, 21)) and q not in [r[1] for r in rows]
        assert all(a[2] > b[2] or a[2] == b[2] and a[1] < b[1] for a, b in pairwise(rows))
        score = wide @ wide[q]
        assert all(abs(score[v] - s) < 1e-9 for _, v, s in rows)
        order = [i for i in np.lexsort((np.arange(3000), -score)) if i != q][:20]
        hits += len(set(order) & {r[1] for r in rows})
    assert hits >= 0.9 * 20 * len(found)
    few = table.filter("vec_id < 5")
    assert neighbours.nearest(few, few.filter("vec_id = 0"), 20).count() == 4
    assert neighbours.nearest(table.limit(0), table.limit(0)).count() == 0


def brute_hits(texts: list, items: list, window: int = 10):
    words = lambda t: re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    cut = {}
    for item, t in items:
        w = words(t)
        if w and item is not None:
            cut.setdefault(str(item), set()).update(tuple(w[i : i + window]) for i in range(max(1, len(w) - window + 1)))
    out = []
    for t in texts:
        w, hit, names = words(t), set(), set()
        for name, wins in cut.items():
            for win in wins:
                for i in range(len(w) - len(win) + 1):
                    if tuple(w[i : i + len(win)]) == win:
                        hit.update(range(i, i + len(win)))
                        names.add(name)
        out.append((len(w), len(hit), sorted(names)))
    return out


@pytest.mark.parametrize("bound", [100_000, 0])
def test_decontamination_by_brute_force(spark, docs, nothing, monkeypatch, bound):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", bound)
    rows = documents()
    source = [r[1] for r in rows if r[1] and len(r[1].split()) > 30][:6]
    items = [(i, t[5:200]) for i, t in enumerate(source)] + [(50, "one"), (51, "A, b; c!"), (52, ""), (53, None), (None, source[0]), (1, source[1][5:200]), (54, "x x")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    distinct = sorted({(r[0] is None, r[0] or 0, r[1] or "") for r in rows})
    want = sorted((n, d, *h) for (n, d, _), h in zip(distinct, brute_hits([t for *_, t in distinct], items)))
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_hit, list(r["items"])) for r in decontaminate.contaminated(docs, bench).collect())
    assert got == [tuple(w) for w in want]
    kept = decontaminate.without_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not h[1] for h in brute_hits([r[1] for r in rows], items))
    assert decontaminate.contaminated(docs, bench.limit(0)).filter("contaminated").count() == 0
    assert decontaminate.contaminated(nothing, bench).count() == 0


@pytest.mark.parametrize("bound", [100_000, 0])
def test_decontamination_by_items_without_id(spark, monkeypatch, tmp_path, bound):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", bound)
    rng = random.Random(8)
    one, two, three = (passage(rng, 15) for _ in range(3))
    rows = [(1, f"{passage(rng, 5)} {one} end"), (2, f"{two} {three}"), (3, passage(rng, 40)), (4, f"{one} {two}")]
    items = [(None, one), (6, two), (None, two), (None, three), (7, "nowhere")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = {r.doc_id: r for r in queries.op4_decontamination(spark, str(tmp_path)).collect()}
    assert [(found[i].n_hit, found[i].n_items, found[i].contaminated) for i in (1, 2, 3, 4)] == [(15, 0, True), (30, 1, True), (0, 0, False), (30, 1, True)]
    sql = queries.ORACLES["op4_decontamination"]
    for table in ("documents", "benchmark"):
        sql = re.sub(rf"from {table}\b", f"from '{tmp_path}/{table}.parquet/*.parquet'", sql)
    for r in duckdb.connect().execute(f"select doc_id, n_words, n_hit, items_sha256, contaminated from ({sql})").fetchall():
        assert r == tuple(found[r[0]][k] for k in ("doc_id", "n_words", "n_hit", "items_sha256", "contaminated"))
    docs = shared.table(spark, str(tmp_path), "documents")
    assert [r.doc_id for r in corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path)).collect()] == [3]


def naive_spans(t: str) -> list:
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub("[ -]", "", m.group())
        if 13 <= len(digits) <= 19 and pii.luhn(digits):
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]


def test_base_spans_as_the_patterns_give_them():
    rng = random.Random(4)
    for _ in range(20_000):
        t = "".join(rng.choice("12 .@+-(a%_b)0\n4") for _ in range(rng.randrange(60)))
        assert pii.base_spans(t) == naive_spans(t), t


def test_personal_data(spark, folder, docs, nothing):
    table = shared.table(spark, folder, "documents")
    field = pii.fit_field(table, examples=150)
    rows = {r.doc_id: r for r in pii.find(table, field).collect()}
    for r in table.collect():
        base = naive_spans(r.text or "")
        assert rows[r.doc_id].base_sha256 == hashlib.sha256(pii.joined(base).encode()).hexdigest()
        assert set(pii.joined(base).split(",")) <= set(rows[r.doc_id].spans.split(",")) or not base
    kinds = lambda t: [s[0] for s in pii.all_spans(t, field)[1]]
    assert kinds("call (968) 555-9369 now") == ["phone"]
    assert kinds("Licensed under CC BY-NC 4.0.") == kinds("version 3.") == []
    assert pii.masked("a x@y.zz b", [("email", 2, 8)]) == "a <EMAIL> b"
    odd = pii.redact(docs, field)
    assert odd.columns == docs.columns and odd.count() == docs.count()
    assert odd.filter("text is null").count() == docs.filter("text is null").count()
    assert pii.find(nothing, pii.fit_field(nothing)).count() == 0
    assert pii.all_spans("7" * 20_000 + " " + "1.2.3." * 5000, field)[0] == naive_spans("7" * 20_000 + " " + "1.2.3." * 5000)


def test_added_spans_of_long_runs(spark, folder, monkeypatch):
    field = pii.fit_field(shared.table(spark, folder, "documents"), examples=150)
    rng = random.Random(6)
    phones = " ".join(f"({rng.randrange(200, 999)}) 555-{rng.randrange(10_000):04d}" for _ in range(150))
    assert pii.all_spans(phones, field)[1] == [("phone", i, i + 14) for i in range(0, len(phones), 15)]
    cards = ";".join(["4111.1111.1111.1111"] * 300)
    assert pii.all_spans(cards, field)[1] == [("card", i, i + 19) for i in range(0, len(cards), 20)]
    mixed = " ".join(rng.choice(("a@b.cc", "1.2.3.4", "+1 (968) 555-9369", "(968) 555-9369", "x7", "4111.1111.1111.1111")) for _ in range(80))
    whole = field.best(mixed)
    for block in (1, 7):
        monkeypatch.setattr(pii, "BLOCK", block)
        assert field.best(mixed) == whole


def test_field_sees_rare_kinds_in_any_layout(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(i, f"in {rng.randrange(10**6)} words") for i in range(60_000)]
    for i in range(7, 60_000, 6000):
        rows[i] = (i, f"server {'.'.join(str(rng.randrange(256)) for _ in range(4))} is up")
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    seen = []
    monkeypatch.setattr(pii, "fit", lambda found, **_: seen.append(found))
    pii.fit_field(docs)
    pii.fit_field(docs.repartition(3).orderBy(F.desc("doc_id")))
    assert seen[0] == seen[1]
    kinds = [spans[0][0] if spans else "" for _, spans in seen[0]]
    assert kinds.count("ip") == 10 and kinds.count("") == 600


def digest(value: str | None) -> int:
    """xxhash64 of a column of one text."""
    return 42 if value is None else int(np.array(xxhash.xxh64_intdigest(value.encode(), 42), np.uint64).view(np.int64))


def without_repeats(rows: list[tuple]) -> list[tuple]:
    """Of rows (doc_id, text): doc_id as text, kept, n_words, n_removed."""
    place = {r[:2]: (r[0] is None, r[0] or 0, digest(r[1])) for r in rows}
    first: dict[tuple, tuple] = {}
    for r in sorted(place, key=place.get):
        w = split(r[1])
        for i in range(len(w) - 19):
            first.setdefault(tuple(w[i : i + 20]), (place[r], i))
    want = []
    for r in rows:
        w, gone = split(r[1]), set()
        for i in range(len(w) - 19):
            if first[tuple(w[i : i + 20])] != (place[r[:2]], i):
                gone.update(range(i, i + 20))
        want.append((str(r[0]), " ".join(x for i, x in enumerate(w) if i not in gone), len(w), len(gone)))
    return sorted(want)


def test_substrings_by_brute_force(docs, nothing):
    got = [(str(r.doc_id), r.kept, r.n_words, r.n_removed) for r in substrings.without_repeats(docs).collect()]
    assert sorted(got) == without_repeats(documents())
    assert substrings.without_repeats(nothing).collect() == []


def test_substrings_without_ids_and_of_shared_ids(spark):
    """Texts without an id, or under one, are documents of their own: what one repeats is not removed from another."""
    rng = random.Random(8)
    p, u, v = passage(rng, 25), passage(rng, 40), passage(rng, 30)
    rows = [(1, p), (None, p + " tail"), (None, u), (None, None), (2, u + " more"), (2, v), (2, v), (None, v + " " + p), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(str(r.doc_id), r.kept, r.n_words, r.n_removed) for r in substrings.without_repeats(docs).collect()]
    assert sorted(got) == without_repeats(rows)
    assert ("None", u, 40, 0) not in got and ("2", u + " more", 41, 0) in got


def test_prefix_groups_are_bounded():
    counts = np.array([5, 0, 1000, 7, 90, 20, 350])
    first, splits, number = substrings.groups(counts, 100)
    load = np.zeros(number)
    for b, n in enumerate(counts):
        for j in range(splits[b]):
            load[first[b] + j] += n / splits[b]
    assert load.max() <= 100 and splits[2] == 10


def test_mix(spark, docs, nothing):
    per_document, slots = mixing.mix(docs, block=16)
    rows = per_document.collect()
    sizes: dict = {}
    for r in documents():
        sizes[r[3]] = sizes.get(r[3], 0) + len(split(r[1]))
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, left, open_ = {}, 1.5 * sum(sizes.values()), set(names)
    while True:
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 2 * sizes[s]
            left -= 2 * sizes[s]
            open_.discard(s)
    for s in names:
        own = [r for r in rows if r.source == s]
        assert own[0].source_size == sizes[s] and abs(own[0].target - target[s]) < 1e-6 * sizes[s] + 1e-9
        assert abs(sum(r.taken for r in own) - target[s]) <= 1
    assert all(0 <= r.taken <= 2 * r["size"] for r in rows)
    again, _ = mixing.mix(docs.repartition(3), block=16)
    assert sorted(map(str, again.collect())) == sorted(map(str, rows))
    assert slots.groupBy("source", "rank").count().filter("count > 1").count() == 0
    assert sorted(str((r.doc_id, r.source, r["size"])) for r in rows) == sorted(str((d[0], d[3], len(split(d[1])))) for d in documents())
    assert mixing.mix(nothing)[0].count() == 0


@pytest.fixture(scope="module")
def labelled():
    path = "/root/testdata/sf0.1"
    rows = duckdb.connect().execute(f"select doc_id, text, toxic, quality from '{path}/documents.parquet' join '{path}/labels.parquet' using (doc_id) order by doc_id").fetchall()
    return rows


def split_accuracy(fit, rows, column, held):
    train = [r for i, r in enumerate(rows) if i % 3 != held]
    test = [r for i, r in enumerate(rows) if i % 3 == held]
    some = [r for r in train if r[column] == 0][:700] + [r for r in train if r[column] == 1][:700]
    model = fit([r[1] or "" for r in some], [r[column] for r in some])
    score = np.concatenate([model.scores(pa.array([r[1] for r in test[i : i + 100]], pa.string())) for i in range(0, len(test), 100)])
    label = np.array([r[column] for r in test])
    return model, (score[label == 1] >= 0.7).mean(), (score[label == 0] >= 0.7).mean()


def test_toxicity_on_held_out_documents(labelled):
    model, caught, wrong = split_accuracy(toxicity.fit, labelled, 2, 1)
    assert caught > 0.8 and wrong < 0.1
    column = pa.array([None, "", " ,. ", "word " * 30_000, "x" * 50_000], pa.string())
    assert ((model.scores(column) >= 0) & (model.scores(column) <= 1)).all()
    assert toxicity.fit([], []).scores(column).max() < 0.7


def test_windows_cover_every_word():
    first = np.array([0, 0, 1, 33, 33 + 24 * 7 + 5])
    begin, size, owner = toxicity.windows(first)
    for i in range(len(first) - 1):
        seen = {w for b, s in zip(begin[owner == i], size[owner == i]) for w in range(b, b + s)}
        assert seen == set(range(first[i], first[i + 1]))


def test_quality_on_held_out_documents(spark, labelled, docs, nothing):
    model, good, wrong = split_accuracy(quality.fit, labelled, 3, 1)
    assert good > 0.95 and wrong < 0.1
    scored = quality.score(docs, model)
    assert scored.columns.count("score") == 1 and scored.count() == docs.count()
    assert scored.filter("score < 0 or score > 1 or score is null").count() == 0
    assert quality.score(nothing, quality.fit([], [])).count() == 0
    assert quality.fit(["a"], [1]).scores(pa.array(["b"]))[0] > 0.7


def test_sample_leaves_held_out_rows(spark, docs):
    labels = spark.createDataFrame([(i, i % 2, 5) for i in range(60)] + [(None, 1, 0), (3, None, 1), (4, 0, 0)], "doc_id long, toxic int, text int")
    rows = shared.bounded_sample(docs, labels, "toxic", 10, 3, 1).collect()
    import zlib

    assert {zlib.crc32(str(r.doc_id).encode()) % 3 for r in rows} <= {0, 2}
    assert sum(r.label == 0 for r in rows) == 10


def test_token_counts(spark, docs, nothing):
    tokenizers = pytest.importorskip("tokenizers")
    vocabulary = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    whole = tokenizers.Tokenizer.from_file(vocabulary)
    count = lambda t: len(whole.encode(t or "", add_special_tokens=False).ids)
    odd = [(1000 + i, t) for i, t in enumerate(["a<|endoftext|>b", "it's  we'll\n\n x", "日本語 text", "tab\x0b\x1c\x85 x", "  ", "!!! 12 ½²", "\u00ad\u200b x"])]
    table = docs.select("doc_id", "text").unionAll(spark.createDataFrame(odd, "doc_id long, text string"))
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in tokens.token_counts(table, vocabulary, cache_size=50).collect())
    assert got == sorted((str(r.doc_id), len((r.text or "").encode()), count(r.text)) for r in table.collect())
    assert tokens.token_counts(nothing, vocabulary).count() == 0
    lengths = tokens.Lengths(vocabulary, {}, 1000)
    for c in [9, 10, 13, *range(32, 127), *range(0xA1, 0x250), *range(0x2010, 0x2028), *range(0x2030, 0x205F), 0x20AC]:
        for t in (f"a{chr(c)}b", f"1{chr(c)} ", f" {chr(c)}{chr(c)}x", f"!{chr(c)}!"):
            assert lengths.count(t) == count(t), hex(c)


def test_words_and_hashes():
    column = pa.array(["a b", None, "", "  a\tb ", "ab", "b a", "é\u00a0x"], pa.string()).slice(0)
    data, offsets = text.flat(column)
    start, end, first = text.words(data, offsets)
    found = [[bytes(data[start[k] : end[k]]).decode() for k in range(first[i], first[i + 1])] for i in range(len(column))]
    assert found == [["a", "b"], [], [], ["a", "b"], ["ab"], ["b", "a"], ["é\u00a0x"]]
    codes = text.word_codes(data, start, end)
    assert codes[0] == codes[2] != codes[1] and codes[0] == codes[6]
    pairs = text.chains(codes, 2)
    assert pairs[0] == pairs[2] and pairs[0] != pairs[5]
