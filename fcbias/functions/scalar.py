"""Units, cyclic time, clipping, errors and time arithmetic as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import params as P


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: str | Column) -> Column:
    """NaN means missing in the inputs; Spark's aggregates skip null but not NaN."""
    c = col(c)
    return F.when(~F.isnan(c), c)


# --- units ---------------------------------------------------------------------------------------


def kelvin_to_celsius(c):
    return col(c) - F.lit(P.KELVIN)


def celsius_to_kelvin(c):
    return col(c) + F.lit(P.KELVIN)


def fraction_to_percent(c):
    return col(c) * F.lit(100.0)


def percent_to_fraction(c):
    return col(c) / F.lit(100.0)


def pascal_to_hectopascal(c):
    return col(c) / F.lit(100.0)


def cloud_to_okta(c):
    """Cloud fraction to eighths. Halves go to the even neighbour, hence ``rint`` and not ``round``."""
    return F.rint(col(c) / F.lit(P.OKTA))


def geopotential_to_height(c):
    return col(c) / F.lit(P.GRAVITY)


def to_model_units(field: str, c) -> Column:
    """A grid field from source units to the units the models were trained with."""
    convert = {
        "t2": kelvin_to_celsius,
        "rh": fraction_to_percent,
        "ppa": pascal_to_hectopascal,
        "nl": cloud_to_okta,
    }
    return convert[field](c) if field in convert else col(c)


def to_output_units(param: str, c) -> Column:
    """A corrected field from model units back to the units of the product."""
    convert = {"temperature": celsius_to_kelvin, "humidity": percent_to_fraction}
    return convert[param](c) if param in convert else col(c)


# --- calendar --------------------------------------------------------------------------------------


def cyclic(value: Column, period: int) -> tuple[Column, Column]:
    angle = value * F.lit(2 * math.pi) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def time_features(ts) -> dict[str, Column]:
    """Month and hour of a timestamp on the unit circle."""
    month_sin, month_cos = cyclic(F.month(col(ts)), 12)
    hour_sin, hour_cos = cyclic(F.hour(col(ts)), 24)
    return {"month_sin": month_sin, "month_cos": month_cos, "hour_sin": hour_sin, "hour_cos": hour_cos}


def hours(c) -> Column:
    return F.expr("interval '1' hour") * col(c).cast("int")


def epoch_to_utc(c) -> Column:
    """Unix seconds to a UTC timestamp, whatever the session time zone is."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.expr("interval '1' second") * col(c)


def instant_to_utc(c) -> Column:
    """An instant as a UTC timestamp without zone."""
    return epoch_to_utc(F.unix_micros(col(c)) / F.lit(1000000).cast("decimal(10,0)"))


def utc_to_epoch(c) -> Column:
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", epoch, col(c))


def valid_time(data_date, data_time, step) -> Column:
    """Valid time from yyyymmdd, hhmm (both integers) and a step in hours."""
    text = F.concat(F.lpad(col(data_date).cast("string"), 8, "0"), F.lpad(col(data_time).cast("string"), 4, "0"))
    return F.to_timestamp_ntz(text, F.lit("yyyyMMddHHmm")) + hours(step)


def origin_time(valid, lead) -> Column:
    return col(valid) - hours(lead)


def step_hours(valid, analysis) -> Column:
    return F.timestamp_diff("HOUR", col(analysis), col(valid)).cast("int")


def half_year(ts) -> Column:
    """Name of the half-year a row belongs to: 2022q12 or 2022q34."""
    half = F.when(F.month(col(ts)) <= 6, F.lit("q12")).otherwise(F.lit("q34"))
    return F.concat(F.year(col(ts)).cast("string"), half)


def yyyymm(ts) -> Column:
    return F.year(col(ts)) * 100 + F.month(col(ts))


def first_digits(text) -> Column:
    """First run of digits in a text such as a file name; null without digits."""
    found = F.regexp_extract(col(text), r"(\d+)", 1)
    return F.when(found != "", found)


def all_digits(text) -> Column:
    return F.regexp_extract_all(col(text), F.lit(r"(\d+)"), F.lit(1))


def compact_time(ts) -> Column:
    return F.date_format(col(ts), "yyyyMMddHHmmss")


def iso_time(ts) -> Column:
    return F.date_format(col(ts), "yyyy-MM-dd'T'HH:mm:ss")


# --- clipping ----------------------------------------------------------------------------------------


def clip(c, low, high) -> Column:
    """Limit to [low, high]; missing stays missing (``least`` and ``greatest`` alone would skip it)."""
    c = col(c)
    low = F.lit(low) if not isinstance(low, Column) else low
    high = F.lit(high) if not isinstance(high, Column) else high
    return F.when(c.isNotNull(), F.greatest(low, F.least(high, c)))


def clip_diff(param: str, c) -> Column:
    """Limit the correction itself; wind speed and gust have no limit."""
    limit = P.DIFF_LIMITS.get(param)
    return col(c) if limit is None else clip(c, -limit, limit)


def fill_missing(c) -> Column:
    """Null and NaN to the sentinel of the product."""
    return F.coalesce(nan_to_null(c), F.lit(P.MISSING))


def key_below(keys: list[str], share: float, seed: int) -> Column:
    """True for about ``share`` of all rows, decided by a digest of the row's key.

    Unlike a random draw it does not depend on partitioning, retries or row order, and any SQL
    engine with md5 repeats it.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return F.md5(text) < F.lit(f"{min(int(share * 2**32), 2**32 - 1):08x}")
