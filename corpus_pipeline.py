"""A training corpus from raw documents: five stages, each one operator, each written before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fcbias.llm import decontaminate, jaccard, mixing, pii, quality, shared, toxicity

#: Documents that score this or more are rejected.
TOXIC = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose toxicity is below the limit; the network learns from labelled ones among them.

    Null and empty texts have the score of no words and stay. Repeated rows are judged each, rows without id as others
    (they have no label). Any other columns are kept, whatever their names. An empty table stays empty.
    """
    sample = shared.bounded_sample(docs, shared.table(spark, sf_dir, "labels"), "toxic", 1500, 3, 1)
    column = shared.free_name(docs, "toxic_score")
    scored = quality.score(docs, toxicity.fit_toxicity(sample), column)
    return scored.filter(F.col(column) < TOXIC).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of linked documents, the first by id (null last), text digest and other columns.

    Rows without words are in no group and all stay.
    """
    found = jaccard.components(docs).filter("component_key is not null")
    rows = found.groupBy("component_key", "doc_id", "digest").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest", "n")).alias("first")
    first = rows.groupBy("component_key").agg(first).select(F.col("first.doc_id").alias("kept_id"), F.col("first.digest").alias("kept_digest"), "first.n")
    first = shared.kept(first, "pipeline-first")

    def those(kept: DataFrame) -> DataFrame:
        same = docs["doc_id"].eqNullSafe(kept["kept_id"]) & (F.xxhash64(docs["text"]) == kept["kept_digest"])
        return docs.join(kept, same, "left_semi")

    out = docs.filter(~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))).unionAll(those(first.filter("n = 1")))
    repeated = first.filter("n > 1")
    if repeated.isEmpty():
        return out
    one = those(repeated).groupBy("doc_id", F.xxhash64("text")).agg(F.min(F.struct(*docs.columns)).alias("row"))
    return out.unionAll(one.select("row.*"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that hold no window of a benchmark item.

    Null and empty texts hold none and stay, as do all rows without id that hold none; repeated rows are judged each.
    Other columns are kept. Without documents or items nothing changes.
    """
    return decontaminate.without_contaminated(docs, shared.table(spark, sf_dir, "benchmark"), unnamed=True)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts by its kind.

    Null and empty texts stay as they are; every row stays, repeated ones too, and so do the other columns.
    """
    return pii.redact(docs, pii.fit_field(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes, repeats counted.

    A row for each document, also for null and empty texts (size 0), rows without id and exact repeats; a null source is
    one of its own. Other columns are left out.
    """
    per_document, _ = mixing.mix(docs)
    return per_document


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared.kept(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: Scores of a network and of a random field are not SQL; the stages are tested against brute force.
ORACLE_SQL = None
