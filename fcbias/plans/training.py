"""From the narrow archive to training and feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions import scalar as S
from ..operators import joins as J
from ..operators import prepare as R


def forecast_wide(narrow: DataFrame, keys=()) -> DataFrame:
    """Wide forecasts with temperature in degrees Celsius."""
    return R.pivot_avg(narrow, keys=keys).withColumn("t2m", S.kelvin_to_celsius("t2m"))


def forecast_errors(narrow: DataFrame, obs: DataFrame) -> DataFrame:
    """Wide forecasts with observations and errors."""
    return J.with_errors(J.join_obs(forecast_wide(narrow), obs))


def build_training_table(narrow: DataFrame, obs: DataFrame) -> DataFrame:
    """Narrow forecasts and observations to the training table.

    Each input is read once. Repeated observations of an hour multiply the rows, by themselves and as lead biases.
    """
    errors = R.without_helpers(forecast_errors(narrow, obs))
    return J.lead_biases_of_run(errors, keep=R.any_of(P.OBS_COLUMNS))


def training_table_of_buckets(narrow: DataFrame, days: DataFrame, reach_hours: int) -> DataFrame:
    """The same from the tables of ``sources.buckets``, without a shuffle; half-years filtered on ``period`` are all that is read.

    Pivot, join and lead biases all group by the buckets' keys, station and day of the run, and more.
    """
    wide = forecast_wide(narrow, keys=["run_day"])
    errors = R.without_helpers(J.with_errors(J.join_listed_obs(wide, days.select("sid", "run_day", "seen"), reach_hours)))
    return J.lead_biases_of_run(errors, keep=R.any_of(P.OBS_COLUMNS), by=("sid", "run_day", "fcdate")).drop("run_day")


def feature_table_train(training: DataFrame, param: str, keep=()) -> DataFrame:
    """Training table to the complete feature rows of one parameter, as 32-bit floats."""
    ranged = R.within_physical_range(training, param)
    return R.to_float32(R.complete_rows(R.project_training(ranged, param, keep)))


def model_rows(training: DataFrame, param: str, keep=()) -> DataFrame:
    """Feature rows that models are trained and tested on: leads 0 and 1 are left out."""
    return R.without_leads(feature_table_train(training, param, keep))


def training_split(training: DataFrame, periods_with_test: list[str]) -> tuple[DataFrame, DataFrame]:
    """Training and test rows: the last days of the months of the given half-years are tested on."""
    marked = R.with_holdout(training)
    test = F.col("is_test") & S.half_year("fcdate").isin(periods_with_test)
    hold, rest = R.split_by(marked, test)
    return rest.drop("is_test"), hold.drop("is_test")
