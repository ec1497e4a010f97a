"""The registered queries of this folder, over whole tables, and the SQL that checks those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, jaccard, lexical, merkle, mixing, neighbours, pii, quality, shared, simhash, substrings, tokens, toxicity, urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

LIMIT = 0.7


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql:
            ORACLES[name] = sql.strip()
        return build

    return register


def held_out(modulus: int, part: int) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus == part, F.lit(False))


@query("op1_ngram_jaccard", r"""
with recursive d as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words
    from documents
),
s as (
    select distinct doc_id, hash(words[i : i + 4]) as h
    from (select doc_id, words, unnest(range(1, greatest(1, len(words) - 4) + 1)) as i from d where len(words) > 0) x
),
n as (select doc_id, count(*) as n from s group by doc_id),
shared as (select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b on a.h = b.h and a.doc_id <> b.doc_id group by all),
link as (
    select a, b from shared join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 80 * (x.n + y.n - k)
),
reach(doc_id, other) as (
    select doc_id, doc_id from d union select r.doc_id, l.b from reach r join link l on l.a = r.other
)
select d.doc_id, coalesce(n.n, 0) as n_shingles, min(other) as component_id
from d left join n using (doc_id) join reach r on r.doc_id = d.doc_id group by all
""")
def op1_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.components(shared.table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op2_url_filters")
def op2_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return urls.filter_urls(shared.table(spark, folder, "pages"))


@query("op3_nearest_vectors")
def op3_nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    vectors = shared.table(spark, folder, "embeddings")
    return neighbours.nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0), 20)


WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query("op4_decontamination", f"""
with d as (select doc_id, {WORDS} as words from documents),
b as (select distinct cast(item_id as varchar) as item, {WORDS} as words from benchmark),
w as (
    select distinct item, words[s : s + 9] as win
    from (select item, words, unnest(range(1, greatest(1, len(words) - 9) + 1)) as s from b where len(words) > 0) x
),
sizes as (select distinct len(win) as k from w),
places as (
    select doc_id, s, k, words[s : s + k - 1] as win
    from (select doc_id, k, words, unnest(range(1, len(words) - k + 2)) as s from d, sizes where len(words) >= k) x
),
hits as (select p.doc_id, p.s, p.k, w.item from places p join w on p.win = w.win),
covered as (
    select doc_id, count(distinct place) as n_hit
    from (select doc_id, unnest(range(s, s + k)) as place from hits) x group by doc_id
),
items as (
    select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as names
    from (select distinct doc_id, item from hits) x group by doc_id
)
select d.doc_id, len(d.words) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join covered using (doc_id) left join items using (doc_id)
""")
def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contaminated(shared.table(spark, folder, "documents"), shared.table(spark, folder, "benchmark"), unnamed=True)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


@query("op5_personal_data")
def op5_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = shared.table(spark, folder, "documents").select("doc_id", "text")
    return pii.find(docs, pii.fit_field(docs))


@query("op6_substring_dedup", r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
w as (select doc_id, s, words[s : s + 19] as win from (select doc_id, words, unnest(range(1, len(words) - 18)) as s from d) x),
later as (
    select doc_id, s from (select doc_id, s, row_number() over (partition by win order by doc_id, s) as n from w) x where n > 1
),
gone as (select distinct doc_id, unnest(range(s, s + 20)) as place from later),
lists as (select doc_id, list(place) as places from gone group by doc_id)
select d.doc_id, len(words) as n_words, coalesce(len(places), 0) as n_removed,
    sha256(coalesce(array_to_string(list_filter(words, lambda w, i: not list_contains(coalesce(places, []), i)), ' '), '')) as kept_sha256
from d left join lists using (doc_id)
""")
def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substrings.without_repeats(shared.table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op7_source_mix")
def op7_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    per_document, _ = mixing.mix(shared.table(spark, folder, "documents"))
    return per_document.select("doc_id", "size", "source_size", "target", "taken")


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = shared.table(spark, folder, "documents").select("doc_id", "text")
    sample = shared.bounded_sample(docs, shared.table(spark, folder, "labels"), "toxic", 1500, 3, 1)
    scored = quality.score(docs, toxicity.fit_toxicity(sample))
    return scored.select("doc_id", held_out(3, 1).alias("held_out"), "score", (F.col("score") >= LIMIT).cast("int").alias("predicted"))


@query("op9_quality")
def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = shared.table(spark, folder, "documents").select("doc_id", "text")
    sample = shared.bounded_sample(docs, shared.table(spark, folder, "labels"), "quality", 1500, 4, 2)
    scored = quality.score(docs, quality.fit_quality(sample))
    return scored.select("doc_id", held_out(4, 2).alias("held_out"), "score", (F.col("score") >= LIMIT).cast("int").alias("predicted"))


@query("op10_token_counts")
def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    counts = tokens.token_counts(shared.table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


@query("op11_ranked_search", r"""
with d as (
    select row_number() over () as id, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
    from documents
),
b as (
    select item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from (select distinct item_id, text from benchmark) x
),
q as (select item_id, term, count(*) as times from b group by all),
t as (select count(*) as n_docs, sum(len(terms))::bigint as n_terms from d where len(terms) > 0),
tf as (select id, term, count(*) as tf from (select id, unnest(terms) as term from d) x group by all),
w as (select term, cast(floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)::double)) as bigint) as w from tf, t group by term, n_docs),
m as (select id, doc_id, 100 - 25 + (25 * len(terms) * n_docs) // n_terms as m from d, t where len(terms) > 0),
s as (
    select item_id, id, any_value(doc_id) as doc_id, cast(sum(times * (w * ((1000000000 * tf) // (1000 * tf + 12 * m)))) as bigint) as score
    from q join tf using (term) join w using (term) join m using (id) group by item_id, id
)
select item_id, rank, doc_id, score
from (select *, cast(row_number() over (partition by item_id order by score desc, doc_id nulls last) as int) as rank from s where score > 0) x where rank <= 20
""")
def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(shared.table(spark, folder, "documents"), shared.table(spark, folder, "benchmark"))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@query("op12_merkle_manifest", r"""
with recursive fields as (
    select row_number() over () as id, doc_id, lang, text,
        concat(coalesce(octet_length(encode(cast(doc_id as varchar))) || ':' || doc_id, '-'), coalesce(octet_length(encode(source)) || ':' || source, '-'),
            coalesce(octet_length(encode(lang)) || ':' || lang, '-'), coalesce(octet_length(encode(cast(n_chars as varchar))) || ':' || n_chars, '-')) as head,
        coalesce(octet_length(encode(text)) || ':' || text, '-') as body,
        coalesce(octet_length(encode(text)) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') as lowered,
        list_reduce(list_transform(string_split(cast(doc_id as varchar), ''), lambda c: cast(ascii(c) as bigint)),
            lambda crc, byte: list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(crc, byte)), 4294967295) as crc
    from documents
),
d as (
    select id, doc_id, lang, sha256(head || body) as leaf, sha256(head || case when xor(crc, 4294967295) % 3 = 0 then lowered else body end) as doubted from fields
),
lower_nodes(lang, level, p, digest, n) as (
    select lang, 0, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1, leaf, count(*) over (partition by lang) from d
    union all
    select lang, level + 1, p // 8, sha256(string_agg(digest, '' order by p)), (any_value(n) + 7) // 8 from lower_nodes where n > 1 group by lang, level, p // 8
),
upper_nodes(level, p, digest, n) as (
    select 0, row_number() over (order by encode(lang) nulls first) - 1, digest, count(*) over () from lower_nodes where n = 1
    union all
    select level + 1, p // 8, sha256(string_agg(digest, '' order by p)), (any_value(n) + 7) // 8 from upper_nodes where n > 1 group by level, p // 8
),
subroots as (select lang, digest, level as height, row_number() over (order by encode(lang) nulls first) - 1 as tree from lower_nodes where n = 1),
nodes as (
    select tree, level, p, l.digest, n > 1 as up from lower_nodes l join subroots s on s.lang is not distinct from l.lang
    union all select -1, level, p, digest, n > 1 from upper_nodes
),
beside as (
    select a.tree, a.level, a.p, coalesce(string_agg(b.digest, '' order by b.p) filter (b.p < a.p), '') as l, coalesce(string_agg(b.digest, '' order by b.p) filter (b.p > a.p), '') as r
    from nodes a join nodes b on a.tree = b.tree and a.level = b.level and a.p // 8 = b.p // 8 where a.up group by all
),
start as (
    select id, doc_id, leaf, doubted, lang, tree, height, s.digest as subroot, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as p
    from d join subroots s using (lang)
    union all
    select id, doc_id, leaf, doubted, d.lang, tree, height, s.digest, row_number() over (order by doc_id nulls first, leaf) - 1 from d join subroots s on d.lang is null and s.lang is null
),
climb(id, step, own, height, tree, level, p, folded, proof) as (
    select id, 0, tree, height, if(height = 0, -1, tree), 0, if(height = 0, tree, p), doubted, '' from start
    union all
    select id, step + 1, own, height, if(c.tree >= 0 and c.level + 1 = height, -1, c.tree), if(c.tree >= 0 and c.level + 1 = height, 0, c.level + 1), if(c.tree >= 0 and c.level + 1 = height, own, c.p // 8),
        sha256(l || folded || r), proof || l || r
    from climb c join beside b on b.tree = c.tree and b.level = c.level and b.p = c.p
)
select doc_id, leaf, subroot, u.digest as root, sha256(proof) as proof_sha256, folded as folded_root, folded = u.digest as verified
from start join (select id, arg_max(folded, step) as folded, arg_max(proof, step) as proof from climb group by id) using (id), (select digest from upper_nodes where n = 1) u
""")
def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = shared.table(spark, folder, "documents")
    fields = ["doc_id", "source", "lang", "n_chars"]
    leaf = merkle.digest_of(*fields, "text")
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    doubted = F.when(tampered, merkle.digest_of(*fields, F.translate("text", UPPER, LOWER))).otherwise(leaf)
    rows = docs.select("doc_id", "lang", F.unhex(leaf).alias("leaf"), F.unhex(doubted).alias("doubted"))
    found = merkle.audit(merkle.build(rows, "lang", ["doc_id"]), "doubted")
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@query("op13_simhash")
def op13_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.components(shared.table(spark, folder, "documents")).select("doc_id", "fingerprint", "component_id")
