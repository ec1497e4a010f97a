"""Tables between jobs, and bounded samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_folder


#: Bytes of an Arrow batch: a task holds several copies of one, in the JVM and in Python.
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the folder. For the session, Arrow batches are limited to BATCH_BYTES, as whole texts go to Python."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark.read.parquet(f"{folder}/{name}.parquet")


def free_name(docs: DataFrame, name: str) -> str:
    """The name, with underscores behind it as long as a column has it already."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def kept(df: DataFrame, label: str, schema=None) -> DataFrame:
    """Write to the folder that all executors share and read again: later jobs then start from files."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema or df.schema).parquet(path)


def bounded_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, modulus: int, held_out: int) -> DataFrame:
    """At most ``rows`` labelled documents of each class, in an order that a hash of the id fixes.

    Rows whose crc32(doc_id) leaves ``held_out`` modulo ``modulus`` never take part. Only ids are ranked; their number is
    bounded, so they are sent to the scan of the texts. Labels other than 0 and 1 and null ids are passed over; a
    document labelled twice counts by its larger label.
    """
    known = (
        labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .filter(F.crc32(F.col("doc_id").cast("string")) % modulus != held_out)
        .groupBy("doc_id").agg(F.max(label).alias("label"))
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.filter("label = 0").orderBy(*order).limit(rows).unionAll(known.filter("label = 1").orderBy(*order).limit(rows))
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")
