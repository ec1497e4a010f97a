"""Merged states against scores of all rows at once."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fcbias.operators import states as ST


@pytest.fixture(scope="module")
def errors(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i % 4), f"2022-{m:02d}-03 00:00:00", int(s), None if i % 9 == 0 else float("nan") if i % 31 == 0 else float(rng.gamma(2, 2) - 3))
            for m in (1, 2, 3) for s in range(5) for i in range(400)]
    rows += [(7, "2022-01-03 00:00:00", 1, None)]
    df = spark.createDataFrame(rows, "leadtime int, fcdate string, sid int, tero double")
    return df.withColumn("fcdate", F.col("fcdate").cast("timestamp_ntz")).cache()


@pytest.mark.parametrize("keys", [["leadtime"], ["month", "sid"], []])
def test_any_slice_rolls_up(errors, keys):
    rows = errors.withColumns({"month": F.year("fcdate") * 100 + F.month("fcdate"), "e": F.nanvl("tero", F.lit(None))}).toPandas()
    got = ST.scores(ST.merge_scores(ST.score_states(errors, "T2m"), keys)).toPandas()
    groups = rows.groupby(keys) if keys else [((), rows)]
    assert len(got) == len(groups if keys else [0])
    for key, own in groups:
        e = own["e"].dropna().to_numpy()
        at = got
        for name, value in zip(keys, key if isinstance(key, tuple) else (key,)):
            at = at[at[name] == value]
        (row,) = at.to_dict("records")
        assert row["n"] == len(e)
        if not len(e):
            assert all(np.isnan(row[c]) for c in ("bias", "mae", "rmse", "min_value", "q50"))
            continue
        want = {"bias": e.mean(), "mae": np.abs(e).mean(), "rmse": np.sqrt((e**2).mean()), "min_value": e.min(), "max_value": e.max()}
        assert {c: row[c] for c in want} == pytest.approx(want, rel=1e-12)
        for q in (25, 50, 75):
            assert abs((e <= row[f"q{q}"]).mean() - q / 100) <= ST.RANK_ERROR + 2 / len(e)


def test_a_month_is_merged_or_replaced_alone(spark, errors, tmp_path):
    """The states of other months are not written again, and a month that is computed anew replaces itself."""
    states = ST.score_states(errors, "T2m")
    path = ST.write_states(states.where("month < 202203"), str(tmp_path / "states"))
    files = {f.name for f in (tmp_path / "states").rglob("*.parquet")}
    ST.write_states(states.where("month = 202203"), path)
    ST.write_states(states.where("month = 202203"), path)
    assert files < {f.name for f in (tmp_path / "states").rglob("*.parquet")}
    table = spark.read.schema(states.schema).parquet(path)
    scores = lambda df: sorted((r.leadtime, r.n, round(r.rmse or 0, 9), r.max_value) for r in ST.scores(ST.merge_scores(df, ["leadtime"])).collect())
    assert scores(table) == scores(states)


def test_moments_of_late_rows(spark):
    """Hours that get late rows, hours that do not, hours of late rows only; values far from zero keep their digits."""
    rng = np.random.default_rng(2)
    rows = [(h, bool(late), None if i % 10 == 3 else float(1e8 + h + rng.normal())) for h in range(6) for late in (0, 1) for i in range(30) if (h, late) not in {(1, 1), (2, 0)}]
    rows += [(9, False, 4.0), (None, False, 5.0), (None, True, 7.0), (10, True, None)]
    df = spark.createDataFrame(rows, "hour int, late boolean, v double")
    states = ST.moments(df.where("not late"), "v", ["hour"]).unionByName(ST.moments(df.where("late"), "v", ["hour"]))
    got = {r.hour: r for r in ST.merge_moments(states, ["hour"]).collect()}
    assert len(got) == len({r[0] for r in rows})
    for hour, found in got.items():
        v = np.array([r[2] for r in rows if r[0] == hour and r[2] is not None])
        assert found.n == len(v)
        if len(v):
            assert found["mean"] == pytest.approx(v.mean(), rel=1e-15) and found.spread == pytest.approx(((v - v.mean()) ** 2).sum(), rel=1e-6, abs=1e-9)
        else:
            assert found["mean"] is None and found.spread == 0
