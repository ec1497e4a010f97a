"""Folders of an archive replaced in place, with a manifest of what each came from.

An archive is Parquet in folders by one column, such as months or half-years. A delivery replaces the folders it names
and touches no other. The manifest is a table beside the rows, in ``_manifest``, which readers of the archive pass over.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored

MANIFEST = "_manifest"


def _manifest_schema(folder: T.StructField) -> T.StructType:
    return T.StructType([
        folder, T.StructField("rows", T.LongType()), T.StructField("digest", T.DecimalType(38, 0)),
        T.StructField("source", T.StringType()), T.StructField("delivery", T.IntegerType()),
    ])


def contents(df: DataFrame, folder: str) -> DataFrame:
    """Rows and a digest of each folder. The digest is a sum over rows: their order is no matter, repeats count."""
    columns = sorted(c for c in df.columns if c != folder)
    digest = F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).cast("decimal(38,0)")
    return df.groupBy(folder).agg(F.count(F.lit(1)).alias("rows"), digest.alias("digest"))


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def replace_folders(df: DataFrame, path: str, folder: str, source: str, wanted: list | None = None) -> DataFrame:
    """Replace the folders of an archive that ``df`` has rows for, and return what was delivered: one row per folder.

    ``wanted`` names the folders; rows of others are left out, and a named one without a row is an error, as its old rows
    would stay unnoticed. Rows are computed, stored and counted before the archive is touched, so a delivery that fails on
    the way leaves it as it was, and ``df`` may read the archive itself. A folder that failed while it was being swapped
    shows in ``unlisted_folders``; the same delivery again mends it. Rows whose folder is null are an error. Deliveries
    to one archive must follow one another.
    """
    spark = df.sparkSession
    rows = df if wanted is None else df.where(F.col(folder).isin(list(wanted)) | F.col(folder).isNull())
    rows = stored(rows, "delivery")
    facts = stored(contents(rows, folder), "delivery-contents")
    # one row per folder of this delivery
    there = {r[folder] for r in facts.select(folder).collect()}
    if None in there:
        raise ValueError(f"rows without {folder}")
    missing = sorted(set(wanted or []) - there)
    if missing:
        raise ValueError(f"no rows for {folder} {missing}; nothing was replaced")
    last = 0
    if _exists(spark, f"{path}/{MANIFEST}"):
        last = deliveries(spark, path, rows.schema[folder]).agg(F.max("delivery")).first()[0] or 0
    listed = facts.withColumns({"source": F.lit(source), "delivery": F.lit(last + 1)})
    if there:
        out = rows.hint("rebalance", folder).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        out.partitionBy(folder).parquet(path)
        listed.coalesce(1).write.mode("append").parquet(f"{path}/{MANIFEST}")
    return listed


def deliveries(spark: SparkSession, path: str, folder: T.StructField) -> DataFrame:
    """All that was ever delivered, one row per delivery and folder."""
    return spark.read.schema(_manifest_schema(folder)).parquet(f"{path}/{MANIFEST}")


def manifest(spark: SparkSession, path: str, folder: T.StructField) -> DataFrame:
    """What each folder holds by its last delivery: rows, digest, source and number of the delivery."""
    last = F.max_by(F.struct("rows", "digest", "source", "delivery"), "delivery").alias("last")
    return deliveries(spark, path, folder).groupBy(folder.name).agg(last).select(folder.name, "last.*")


def unlisted_folders(archive: DataFrame, path: str, folder: str) -> DataFrame:
    """Folders whose rows are not those of their last delivery, such as after a swap that was cut off."""
    listed = manifest(archive.sparkSession, path, archive.schema[folder])
    found = contents(archive, folder).withColumnsRenamed({"rows": "rows_found", "digest": "digest_found"})
    same = F.col("rows").eqNullSafe(F.col("rows_found")) & F.col("digest").eqNullSafe(F.col("digest_found"))
    return listed.join(found, folder, "full").where(~same).select(folder, "rows", "rows_found", "source")
