"""Models on a small learnable error, and the queries that fit them."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fcbias import params as P
from fcbias.catalog import QUERIES, learning
from fcbias.operators import model as M
from fcbias.operators import prepare as R
from fcbias.session import new_folder


@pytest.fixture(scope="module")
def learnable(spark):
    rng = np.random.default_rng(0)
    n = 1500
    df = pd.DataFrame({c: rng.normal(size=n) for c in P.FEATURES["T2m"]})
    df["leadtime"] = rng.integers(2, 9, n)
    df["sid"] = np.arange(n)
    df["tero"] = 2 * df["t1bias"] + (df["t2m"] > 0) + rng.normal(0, 0.1, n)
    df["ta_pt1m_avg"] = df["t2m"] - df["tero"]
    df["fold"] = np.where(df.sid % 5 == 0, -1, df.sid % 2)
    return spark.createDataFrame(df).persist()


def test_model_beats_the_raw_forecast(learnable):
    model = M.train(learnable, "T2m", M.smaller("T2m", 10, 4))
    overall, by_lead = M.evaluate(learnable, "T2m", {"new": model})
    row = overall.first()
    assert row["rmse_new"] < 0.6 * row["rmse_raw"]
    assert all(r["rmse_new"] < r["rmse_raw"] for r in by_lead.collect())


def test_saved_model_predicts_the_same(spark, learnable):
    model = M.train(learnable, "T2m", M.smaller("T2m", 3, 3), exclude=P.OLD_MODEL_EXCLUDES)
    again = M.load(M.save(model, new_folder(spark, "model")))
    both = M.compare(learnable, {"a": model, "b": again})
    assert both.where("a <> b").count() == 0


def test_lead_one_is_the_observed_bias(learnable):
    model = M.train(learnable, "T2m", M.smaller("T2m", 2, 3))
    first = learnable.withColumn("leadtime", F.lit(1))
    assert M.predict_bias(first, model, "T2m").where("abs(bias - t1bias) > 1e-6").count() == 0
    assert M.predict_bias(learnable, model, "T2m").where("bias is null").count() == 0


def test_search_ranks_trials_over_folds(learnable):
    trials = M.draw_trials(2, {"depth": (2, 3)}, trees=2)
    assert trials == M.draw_trials(2, {"depth": (2, 3)}, trees=2)
    ranked = M.search(learnable, "T2m", trials, [0, 1]).collect()
    assert len(ranked) == 2 and ranked[0]["mae_mean"] <= ranked[1]["mae_mean"]
    assert {r["folds"] for r in ranked} == {2}


def test_trials_stay_in_the_space():
    for t in M.draw_trials():
        assert 15 <= t.settings.depth <= 20 and 0.05 <= t.settings.rate <= 0.1 and 6 <= t.min_child <= 10


@pytest.mark.parametrize("name", ["train_gbt", "predict_bias", "compare_models", "evaluate_models", "save_load_model", "hp_search"])
def test_model_queries(spark, folder, name):
    rows = QUERIES[name](spark, folder).collect()
    assert rows
    if name == "save_load_model":
        assert rows[0]["largest_difference"] == 0.0


@pytest.mark.parametrize("param", P.FEATURES)
def test_scored_rows_are_of_the_published_trees(spark, monkeypatch, param):
    rng = np.random.default_rng(1)
    p, n = P.parameter(param), 300
    df = pd.DataFrame({c: rng.normal(size=n) for c in P.FEATURES[param]})
    df = df.assign(sid=np.arange(n), validdate=pd.Timestamp("2024-07-01"), leadtime=rng.integers(2, 9, n), **{p.error: 2 * df[p.bias1]})
    monkeypatch.setattr(learning, "rows", lambda t, of: spark.createDataFrame(df))
    fitted, fit = [], M.train
    monkeypatch.setattr(M, "train", lambda rows, of, settings: fitted.append(settings) or fit(rows, of, M.smaller(of, 2, 3)))
    row, = QUERIES[f"train_gbt_rows_{param.lower()}"](spark, "no folder").collect()
    assert fitted == [P.TREES[param]]
    assert not row["is_validation"] and row["model_beats_raw"] and 200 < row["n"] < n


def test_whole_job(spark, folder):
    rows = QUERIES["correct_grid_model"](spark, folder).collect()
    assert len(rows) == 200 * 6
    assert all(259.0 <= r["value"] <= 317.0 for r in rows)


def test_labels(spark):
    table = spark.createDataFrame([tuple([1.0] * 16)], ", ".join(f"{c} double" for c in ["wsero", *P.FEATURES["WS"][:15]]))
    assert R.target_and_features(table.withColumn("hour_cos", F.lit(1.0)), "WS").columns == ["label", *P.FEATURES["WS"]]


def test_few_rows_come_in_few_tasks(spark):
    rows = spark.range(0, 1000, 1, 16)
    assert M.gathered(rows).rdd.getNumPartitions() == 1
    assert M.gathered(rows, 300).rdd.getNumPartitions() == 4
    assert M.gathered(rows, 10).rdd.getNumPartitions() == 16
    assert M.gathered(rows.limit(0)).count() == 0
