"""Readers. Schemas are given, never inferred, so a read starts without a pass over the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params as P
from ..functions import scalar as S

NARROW_SCHEMA = T.StructType(
    [
        T.StructField("sid", T.IntegerType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("model_elevation", T.DoubleType()),
        T.StructField("fcdate", T.TimestampNTZType()),
        T.StructField("validdate", T.TimestampNTZType()),
        T.StructField("leadtime", T.IntegerType()),
        T.StructField("parameter", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)

# headerless text observations, one file set per producer
OBS_CSV_SCHEMA = T.StructType(
    [
        T.StructField("sid", T.IntegerType()),
        T.StructField("station_id", T.IntegerType()),
        T.StructField("obs_lat", T.DoubleType()),
        T.StructField("obs_lon", T.DoubleType()),
        T.StructField("validdate", T.TimestampNTZType()),
        T.StructField("obs_elevation", T.DoubleType()),
        T.StructField("rh_pt1m_avg", T.DoubleType()),
        T.StructField("ta_pt1m_avg", T.DoubleType()),
        T.StructField("ws_pt10m_avg", T.DoubleType()),
        T.StructField("wg_pt1h_max", T.DoubleType()),
    ]
)


def obs_json_schema(value: str) -> T.StructType:
    return T.StructType(
        [
            T.StructField("station_id", T.IntegerType()),
            T.StructField("longitude", T.DoubleType()),
            T.StructField("latitude", T.DoubleType()),
            T.StructField("utctime", T.TimestampNTZType()),
            T.StructField("elevation", T.DoubleType()),
            T.StructField(value, T.DoubleType()),
        ]
    )


FEATURE_COLLECTION = T.StructType(
    [
        T.StructField(
            "features",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("geometry", T.StructType([T.StructField("coordinates", T.ArrayType(T.StringType()))])),
                        T.StructField(
                            "properties",
                            T.StructType(
                                [
                                    T.StructField("resultTime", T.StringType()),
                                    T.StructField("result", T.DoubleType()),
                                ]
                            ),
                        ),
                    ]
                )
            ),
        )
    ]
)

GRID_SCHEMA = T.StructType(
    [
        T.StructField("param", T.StringType()),
        T.StructField("data_date", T.IntegerType()),
        T.StructField("data_time", T.IntegerType()),
        T.StructField("step", T.IntegerType()),
        T.StructField("first_row", T.IntegerType()),
        T.StructField("ni", T.IntegerType()),
        T.StructField("values", T.ArrayType(T.DoubleType())),
    ]
)


def without_nan(df: DataFrame) -> DataFrame:
    """Missing numbers are null from the source on."""
    return df.withColumns({c: S.nan_to_null(c) for c, kind in df.dtypes if kind in ("double", "float")})


def read_narrow(spark: SparkSession, path: str, columns: list[str] | None = None, parameters=tuple(P.NARROW_TO_WIDE)) -> DataFrame:
    """Narrow archive with only the named parameters; filter and columns reach the scan."""
    wanted = without_nan(spark.read.parquet(path).where(F.col("parameter").isin(list(parameters))))
    return wanted.select(*columns) if columns else wanted


def read_periods(spark: SparkSession, path: str, periods: list[str]) -> DataFrame:
    """Half-years such as 2022q12 of a training table; others are not read."""
    return spark.read.parquet(path).where(F.col("period").isin(periods))


def _files_with(spark: SparkSession, paths, schema: T.StructType, names=()) -> DataFrame:
    """Files that are Parquet and whose named columns have the schema's types; without names only footers are read."""
    scan = spark.read.schema(schema).option("ignoreCorruptFiles", True).parquet(*paths)
    # the largest value is not wanted for itself: it makes the scan decode the column
    return scan.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"), *[F.max(c).alias(c) for c in names])


def merge_files(spark: SparkSession, *paths: str, schema: T.StructType = NARROW_SCHEMA) -> DataFrame:
    """All rows of the Parquet files of the given folders; files that are not Parquet are skipped.

    From file to file, whole numbers may have 32 or 64 bits, and times may be timestamps or seconds since 1970. Any other
    type, or a file damaged behind its footer, fails the job rather than losing rows. ``skipped_files`` lists what is
    left out.
    """
    times = [f.name for f in schema if isinstance(f.dataType, T.TimestampNTZType)]
    readable = {r["file"] for r in _files_with(spark, paths, schema).collect()}
    stamped = {r["file"] for r in _files_with(spark, paths, schema, times).collect()} if times else readable
    wide = {T.IntegerType(): T.LongType()}

    def read(files: set[str], kinds: dict) -> DataFrame:
        stored_as = T.StructType([T.StructField(f.name, kinds.get(f.dataType, f.dataType)) for f in schema])
        rows = spark.read.schema(stored_as).parquet(*sorted(files)) if files else spark.createDataFrame([], stored_as)
        seconds = {c: S.epoch_to_utc(c) for c in times if kinds.get(T.TimestampNTZType())}
        return rows.withColumns(seconds).select(*[F.col(f.name).cast(f.dataType) for f in schema])

    rows = read(stamped, wide)
    if readable - stamped:
        rows = rows.unionByName(read(readable - stamped, {**wide, T.TimestampNTZType(): T.LongType()}))
    return without_nan(rows)


def skipped_files(spark: SparkSession, *paths: str, schema: T.StructType = NARROW_SCHEMA) -> DataFrame:
    """Files of the given folders that ``merge_files`` takes no row from: (file, bytes)."""
    files = spark.read.format("binaryFile").load(list(paths)).select(F.col("_metadata.file_path").alias("file"), F.col("length").alias("bytes"))
    return files.join(_files_with(spark, paths, schema), "file", "left_anti")


def read_obs_csv(spark: SparkSession, *paths: str) -> DataFrame:
    """Headerless text observations; several producers are simply several paths."""
    return without_nan(spark.read.schema(OBS_CSV_SCHEMA).csv(list(paths)))


def read_obs_json(spark: SparkSession, path: str, value: str, one_list_per_file: bool = False) -> DataFrame:
    """Observation records, one per line or, as a service answers, one list per file."""
    return without_nan(spark.read.schema(obs_json_schema(value)).option("multiLine", one_list_per_file).json(path))


def flatten_features(documents: DataFrame, body: str = "body", value: str = "result") -> DataFrame:
    """Feature collections to one row per feature with its place in the document."""
    parsed = documents.withColumn("parsed", F.from_json(body, FEATURE_COLLECTION)).drop(body)
    rows = parsed.select(
        *[c for c in parsed.columns if c != "parsed"], F.posexplode("parsed.features").alias("place", "feature")
    )
    place = F.col("feature.geometry.coordinates")
    return rows.select(
        *[c for c in rows.columns if c != "feature"],
        place[2].cast("int").alias("station_id"),
        place[0].cast("double").alias("longitude"),
        place[1].cast("double").alias("latitude"),
        F.to_timestamp_ntz(F.substring("feature.properties.resultTime", 1, 19), F.lit("yyyy-MM-dd'T'HH:mm:ss")).alias("utctime"),
        F.col("feature.properties.result").alias(value),
    )


def grid_long(messages: DataFrame) -> DataFrame:
    """Messages with row-major values to one row per node, with analysis and valid time.

    A message may hold a whole field or a band of rows starting at ``first_row``.
    """
    zero = F.lit(0)
    return (
        messages.withColumns(
            {
                "analysistime": S.valid_time("data_date", "data_time", zero),
                "forecasttime": S.valid_time("data_date", "data_time", "step"),
            }
        )
        .select(
            "param", "analysistime", "forecasttime", F.col("step").alias("leadtime"), "first_row", "ni",
            F.posexplode("values").alias("place", "value"),
        )
        .select(
            "param", "analysistime", "forecasttime", "leadtime",
            (F.col("first_row") + F.floor(F.col("place") / F.col("ni"))).cast("int").alias("j"),
            (F.col("place") % F.col("ni")).cast("int").alias("i"),
            S.nan_to_null("value").alias("value"),
        )
    )


def first_message(df: DataFrame, keys=("param",), time: str = "forecasttime") -> DataFrame:
    """Rows of the earliest time per key: static fields repeat at every time.

    Only the earliest times are aggregated; the fields themselves are filtered, not sorted.
    """
    first = df.groupBy(*keys).agg(F.min(time).alias(time))
    return df.join(first, [*keys, time], "left_semi")


def file_months(df: DataFrame) -> DataFrame:
    """Month of each row from the digits in the name of its file."""
    return df.withColumn("yyyymm", S.first_digits(F.col("_metadata.file_name")).cast("int"))
