"""Writers. Rows are rebalanced over the output folders first, and AQE splits large folders, so
that neither many small files nor one task per folder come out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S


def _write(df: DataFrame, path: str, folders: list[str], mode: str) -> str:
    df.hint("rebalance", *folders).write.mode(mode).partitionBy(*folders).parquet(path)
    return path


def write_training(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Training table by year and half-year of the run."""
    parts = {"year": F.year("fcdate"), "half": F.when(F.month("fcdate") <= 6, 1).otherwise(2)}
    return _write(df.withColumns(parts), path, ["year", "half"], mode)


def write_periods(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Training table by named half-years."""
    return _write(df.withColumn("period", S.half_year("fcdate")), path, ["period"], mode)


def write_narrow(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Narrow archive by month of the run."""
    return _write(df.withColumn("yyyymm", S.yyyymm("fcdate")), path, ["yyyymm"], mode)


def write_product(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Corrected grids by parameter and run."""
    return _write(df, path, ["param", "analysistime"], mode)
