"""Models of the error. Fits differ between engines, so predictions have no SQL check; the tests check them.

What SQL can repeat (which rows are scored, raw scores, observed biases, equality with a model read back) is checked by
queries of their own beside the full ones.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import params as P
from ..functions import scalar as S
from ..operators import model as M
from ..operators import prepare as R
from ..plans import correction as C
from ..plans import training as T
from ..plans.operational import by_model
from ..session import new_folder, stored
from ..sources.standins import FOLDS
from . import operational
from .gridding import SERVED_SQL, served
from .registry import query
from .tables import HOLDOUT, training

# Few and shallow trees: these queries show the jobs, not the skill of a model; ``train_gbt_rows_*`` and ``published_fit_*``
# fit all of them.
TREES, DEPTH = 3, 4
# Rows of a task that fits deep trees: each task shuffles its statistics of a whole level, up to 2,048 nodes of some 40 KB.
DEEP_ROWS = 500_000


def rows(t, param="T2m"):
    """Feature rows with the run time, stored: fits and scores of a query read them several times."""
    return stored(T.model_rows(training(t), param, keep=["fcdate"]), "model-rows")


def marked_rows(t, param="T2m"):
    return R.with_random_split(rows(t, param), ["sid", "validdate", "leadtime"])


def small(param="T2m", trees=TREES):
    return M.smaller(param, trees, DEPTH)


@query("train_gbt")
def train_gbt(t):
    """Fit on the training share; RMSE on both shares."""
    return split_scores(t, "T2m", small())


def split_scores(t, param, settings, **task):
    marked, raw = marked_rows(t, param), F.col(P.parameter(param).error).cast("double")
    model = M.train(M.gathered(marked.where(~F.col("is_validation")), **task), param, settings)
    scored = M.predict(marked, model)
    error = raw - F.col("prediction")
    return scored.groupBy("is_validation").agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(error * error)).alias("rmse_model"),
        F.sqrt(F.avg(raw * raw)).alias("rmse_raw"),
    )


SPLIT = "md5('42|' || sid || '|' || validdate || '|' || leadtime) < '19999999'"


def _train_queries(param: str) -> None:
    error = f"cast({P.parameter(param).error} as double)"

    @query(f"train_gbt_rows_{param.lower()}", f"""
select {SPLIT} as is_validation, count(*) as n, sqrt(avg({error} * {error})) as rmse_raw, true as model_beats_raw
from rows_{param.lower()} where not {SPLIT} group by 1
""", "rmse_raw")
    def train_gbt_rows(t):
        """Rows and raw score of the training share, on which the published trees, all of them, must beat the forecast."""
        scores = split_scores(t, param, P.TREES[param], rows_per_task=DEEP_ROWS).where(~F.col("is_validation"))
        return scores.select("is_validation", "n", "rmse_raw", (F.col("rmse_model") < F.col("rmse_raw")).alias("model_beats_raw"))


for _param in P.FEATURES:
    _train_queries(_param)


# the whole half-year that published fits are tested on, beside the hold-out days of the others
EXTRA = "1998q12"
_PART = f"case when year(fcdate) = 1998 and month(fcdate) <= 6 then 'extra' when {HOLDOUT} then 'holdout' else 'train' end"


def _published_queries(param: str) -> None:
    error = f"cast({P.parameter(param).error} as double)"

    @query(f"published_fit_{param.lower()}", f"""
select {_PART} as part, count(*) as n, sqrt(avg({error} * {error})) as rmse_raw, true as scored,
 case when {_PART} = 'train' then true end as model_beats_raw
from rows_{param.lower()} group by 1
""", "rmse_raw")
    def published_fit(t):
        """The published trees, all of them in full depth: scores on their own rows, hold-out days and another half-year."""
        is_extra = F.coalesce(S.half_year("fcdate") == EXTRA, F.lit(False))
        part = F.when(is_extra, "extra").when(F.col("is_test"), "holdout").otherwise("train")
        marked = R.with_holdout(rows(t, param)).withColumn("part", part)
        model = M.train(M.gathered(marked.where("part = 'train'")), param)
        raw = F.col(P.parameter(param).error).cast("double")
        left = raw - F.col("prediction")
        scores = M.predict(marked, model).groupBy("part").agg(
            F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(raw * raw)).alias("rmse_raw"), F.sqrt(F.avg(left * left)).alias("rmse_model"))
        # boosting of deep trees must fit its own rows; on other rows the stand-ins leave nothing to learn
        beats = F.when(F.col("part") == "train", F.col("rmse_model") < F.col("rmse_raw"))
        return scores.select("part", "n", "rmse_raw", F.col("rmse_model").isNotNull().alias("scored"), beats.alias("model_beats_raw"))


for _param in P.FEATURES:
    _published_queries(_param)


@query("predict_bias")
def predict_bias(t):
    """Biases at stations: observed at lead 1, predicted for later leads."""
    model = M.train(rows(t), "T2m", small())
    return C.predicted_biases(served(t, "temperature"), model, "T2m")


@query("predict_bias_lead1", f"select sid, leadtime, case when leadtime = 1 then cast(t1bias as double) end as bias, true as has_bias from ({SERVED_SQL}) s", "bias")
def predict_bias_lead1(t):
    """Which points and leads have a bias, and the observed one at lead 1."""
    found = predict_bias(t)
    return found.select("sid", "leadtime", F.when(F.col("leadtime") == 1, F.col("bias")).alias("bias"), F.col("bias").isNotNull().alias("has_bias"))


@query("compare_models_rows", "select sid, validdate, leadtime, cast(tero as double) as tero, true as compared from rows_t2m", "tero")
def compare_models_rows(t):
    """The rows that both models score."""
    both = (F.col("bc1") + F.col("bc2")).isNotNull()
    return compare_models(t).select("sid", "validdate", "leadtime", F.col("tero").cast("double").alias("tero"), both.alias("compared"))


@query("compare_models")
def compare_models(t):
    """Predictions of two models side by side."""
    data = rows(t)
    models = {"bc1": M.train(data, "T2m", small(trees=1)), "bc2": M.train(data, "T2m", small())}
    return M.compare(data, models).select("sid", "validdate", "leadtime", "tero", "bc1", "bc2")


@query("evaluate_models")
def evaluate_models(t):
    """Raw forecast, old model without station height and new model, by lead of the test days."""
    marked = R.with_holdout(rows(t))
    train, test = marked.where(~F.col("is_test")), marked.where("is_test")
    old = M.train(train, "T2m", small(), exclude=P.OLD_MODEL_EXCLUDES)
    new = M.train(train, "T2m", small())
    overall, by_lead = M.evaluate(test, "T2m", {"old": old, "new": new})
    return by_lead.unionByName(overall.withColumn("leadtime", F.lit(-1)))


@query("evaluate_models_rows", f"""
select leadtime, count(*) as n, sqrt(avg(cast(tero as double) * tero)) as rmse_raw from rows_t2m where {HOLDOUT} group by leadtime
union all select -1, count(*), sqrt(avg((cast(t2m as double) - ta_pt1m_avg) * (cast(t2m as double) - ta_pt1m_avg))) from rows_t2m where {HOLDOUT}
""", "rmse_raw")
def evaluate_models_rows(t):
    """Rows and raw scores of the test days, by lead and (lead -1) overall."""
    return evaluate_models(t).select("leadtime", "n", "rmse_raw")


@query("save_load_model", "select count(*) as n, 0e0 as largest_difference from rows_t2m", "largest_difference")
def save_load_model(t):
    """Predictions of a model and of the same model read back."""
    data = rows(t)
    model = M.train(data, "T2m", small())
    again = M.load(M.save(model, new_folder(t.spark, "model-T2m")))
    both = M.compare(data, {"kept": model, "loaded": again})
    return both.agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("kept") - F.col("loaded"))).alias("largest_difference"))


@query("hp_search")
def hp_search(t):
    """Two trials over the date folds; the published search has 35 of many deep trees."""
    folded = R.with_time_folds(rows(t), FOLDS)
    trials = M.draw_trials(2, {"depth": (2, 4)}, trees=2)
    return M.search(folded, "T2m", trials, list(range(len(FOLDS))))


@query("correct_grid_model")
def correct_grid_model(t):
    """The whole operational job: quality control, features, predicted biases, interpolation, limits, products."""
    model = M.train(rows(t), "T2m", small())
    return operational.run(t, "temperature", by_model(model, "T2m"))
