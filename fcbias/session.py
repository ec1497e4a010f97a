"""Session settings for own runs; operators do not depend on them."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(name: str = "fcbias", cores: int | str = "*", partitions: int = 8, **conf) -> SparkSession:
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see. The cluster names it; only a local run without one makes its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = os.path.join(tempfile.gettempdir(), f"fcbias-{spark.sparkContext.applicationId}")
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other call gets."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a result to the shared folder and read it back, which cuts its lineage.

    For results that several later steps read, such as predictions of a model: the steps then plan
    and recover from a table and not from everything before it.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized(df: DataFrame) -> DataFrame:
    """One side of a join that is as large as a grid, or as all points, and never broadcast.

    A grid takes a few bytes a node in a file and a hundred in a broadcast, so its file passes for a small table; so do stored points.
    """
    return df.hint("merge")
