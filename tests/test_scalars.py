"""Small literal frames for the rules that are easy to get wrong."""

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fcbias import params as P
from fcbias.functions import projection as PR
from fcbias.functions import scalar as S
from fcbias.operators import aggregates as A
from fcbias.operators import joins as J
from fcbias.operators import prepare as R
from fcbias.operators import quality as Q
from fcbias.plans import correction as C


def values(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def test_cloud_halves_go_to_the_even_eighth(spark):
    df = spark.createDataFrame([(0.0625,), (0.1875,), (0.3125,), (1.0,)], "nl double")
    assert [v for (v,) in values(df.select(S.cloud_to_okta("nl").alias("v")), "v")] == [0.0, 2.0, 2.0, 8.0]


def test_clip_keeps_missing(spark):
    df = spark.createDataFrame([(50.0,), (-50.0,), (None,)], "v double")
    assert values(df.select(S.clip_diff("temperature", "v").alias("v")), "v") == [(10.0,), (-10.0,), (None,)]
    assert values(df.select(S.clip_diff("gust", "v").alias("v")), "v") == [(50.0,), (-50.0,), (None,)]


def test_nan_and_null_become_the_sentinel(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "v double")
    assert values(df.select(S.fill_missing("v").alias("v")), "v") == [(1.0,), (9999.0,), (9999.0,)]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(1711864800, 20240331, 600, 18)], "s long, d int, t int, step int").select(
            S.epoch_to_utc("s").alias("utc"), S.valid_time("d", "t", "step").alias("valid")
        )
        row = df.withColumn("back", S.utc_to_epoch("utc")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert row["utc"] == datetime(2024, 3, 31, 6)
    assert row["valid"] == datetime(2024, 4, 1, 0)
    assert row["back"] == 1711864800


def test_day_31_stays_in_training(spark):
    times = [datetime(2022, 1, d, 3) for d in (24, 25, 30, 31)] + [datetime(2022, 1, 31, 1)]
    df = spark.createDataFrame([(t, 2) for t in times], "validdate timestamp_ntz, leadtime int")
    # the last run started on the 30th at 23 h
    assert [v for (v,) in values(R.with_holdout(df), "is_test")] == [False, True, True, False, True]


def test_complement_keeps_rows_with_a_missing_mask(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, mask boolean")
    hit, rest = R.split_by(df, F.col("mask"))
    assert values(hit, "id") == [(1,)]
    assert sorted(values(rest, "id")) == [(2,), (3,)]


def test_fold_ends_are_exclusive(spark):
    days = [datetime(2020, 12, 30), datetime(2020, 12, 31), datetime(2023, 6, 29), datetime(2023, 6, 30), datetime(2019, 1, 1)]
    df = spark.createDataFrame([(d,) for d in days], "fcdate timestamp_ntz")
    assert [f for (f,) in values(R.with_time_folds(df), "fold")] == [0, -1, 3, -1, -1]


def test_physical_range_leaves_missing_rows(spark):
    df = spark.createDataFrame([(44.9,), (45.0,), (None,)], "ws_pt10m_avg double")
    assert values(R.within_physical_range(df, "WS"), "ws_pt10m_avg") == [(44.9,), (None,)]


def test_months_span_years():
    assert R.months_from(202211, 6) == (202211, 202304)
    assert R.months_from(202301, 1) == (202301, 202301)


def test_thinning(spark):
    rows = [(datetime(2022, 1, 1, h), lead) for h in range(24) for lead in range(10)]
    df = R.thin_leads(spark.createDataFrame(rows, "fcdate timestamp_ntz, leadtime int"))
    kept = {}
    for time, lead in values(df, "fcdate", "leadtime"):
        kept.setdefault(time.hour, []).append(lead)
    assert sorted(kept) == list(range(0, 24, 2))
    assert sorted(kept[4]) == [0, 1, 2, 4, 6, 8] and sorted(kept[6]) == [0, 1, 3, 5, 7, 9]


def test_no_spread_means_no_outlier(spark):
    t = datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, t, 5.0), (2, t, 5.0), (3, t, None), (4, t, float("nan"))], "id int, t timestamp_ntz, v double")
    scored = Q.zscore(df, "v", ["t"], "t", "T2m")
    assert {r["is_outlier"] for r in scored.collect()} == {False}
    assert scored.count() == 4


def test_population_deviation_skips_nan(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (float("nan"),), (None,)], "v double")
    assert values(A.mean_std(df, "v"), "mean", "std") == [(2.0, 1.0)]


def test_outliers_by_value_and_by_flag_agree(spark):
    t = datetime(2024, 1, 1)
    rows = [(i, t, 10.0 + i % 5) for i in range(200)] + [(900, t, 60.0), (901, t, None)]
    df = spark.createDataFrame(rows, "id int, t timestamp_ntz, v double")
    flagged = Q.zscore(df, "v", ["t"], "t", "T2m")
    by_value = {r["id"] for r in Q.without_outliers(df, flagged, ["t"], "v").collect()}
    by_flag = {r["id"] for r in flagged.where("not is_outlier").collect()}
    assert by_value == by_flag and 900 not in by_value and 901 in by_value


def test_first_row_of_a_hot_key(spark):
    df = spark.range(0, 50000, numPartitions=8).selectExpr("if(id % 3 = 0, 0, id) as k", "50000 - id as o", "id as v")
    first = {r["k"]: r["v"] for r in Q.keep_first(df, ["k"], ["o"]).collect()}
    assert first[0] == 49998 and len(first) == 1 + sum(1 for i in range(50000) if i % 3)


def test_wind_takes_plain_where_potential_is_missing(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0), (float("nan"), 4.0)], "wsp double, ws double")
    assert values(Q.coalesce_wind(df), "wsp") == [(1.0,), (3.0,), (4.0,)]


def test_repeated_rows_multiply_in_the_lead_join(spark):
    errors = ["tero", "rhero", "wsero", "wgero"]
    t = datetime(2024, 1, 1)
    rows = [(1, t, 0, 1.0), (1, t, 0, 2.0), (1, t, 1, 3.0), (1, t, 2, 4.0)]
    df = spark.createDataFrame([(s, f, lead, *[e] * 4) for s, f, lead, e in rows],
                               "sid int, fcdate timestamp_ntz, leadtime int, " + ", ".join(f"{e} double" for e in errors))
    joined = J.join_lead_bias(J.join_lead_bias(df, 0), 1, source=df)
    assert joined.count() == 8
    assert {r["t0bias"] for r in joined.collect()} == {1.0, 2.0}


def test_gust_step_is_one_less(spark):
    t0, t3 = datetime(2024, 1, 1), datetime(2024, 1, 1, 3)
    df = spark.createDataFrame([(p, t0, t3) for p in P.PARAMETERS], "param string, analysistime timestamp_ntz, forecasttime timestamp_ntz")
    steps = {r["param"]: (r["step"], r["number"], r["template"]) for r in J.product_table(df).collect()}
    assert steps["gust"] == (2, 195, 72) and steps["humidity"] == (3, 193, 70)


def test_optional_columns(spark, inputs):
    from fcbias.plans import training as T

    table = T.build_training_table(inputs.fc_narrow(), inputs.obs())
    plain = R.project_training(table, "T2m").columns
    with_old = R.project_training(table.withColumn("oldb_t", F.lit(0.5)), "T2m").columns
    assert with_old == plain + ["oldb_t"] and plain[12] == "tero"
    for model in P.FEATURES:
        assert P.training_columns(model)[12] == P.parameter(model).error


def test_sentinel_fails_the_job(spark):
    clean = spark.createDataFrame([(1.0, 2.0, 3.0)], "ws double, rh double, t2 double")
    assert Q.require_no_sentinel(clean, P.SENTINEL_SUBSET).count() == 1
    bad = spark.createDataFrame([(1.0, 9999.0, 3.0)], "ws double, rh double, t2 double")
    with pytest.raises(Exception, match="missing data"):
        Q.require_no_sentinel(bad, P.SENTINEL_SUBSET).collect()


def test_fallback_when_a_producer_is_silent(spark):
    t = datetime(2024, 1, 1, 1)
    grid = spark.createDataFrame([(1, 1, t, 5.0)], "cell int, leadtime int, forecasttime timestamp_ntz, value double")
    corrected = spark.createDataFrame([(1, 1, 280.0)], "cell int, leadtime int, value double")
    for second, want in ((4.0, 280.0), (None, 278.15)):
        obs = spark.createDataFrame([("a", 3.0), ("b", second)], "producer string, v double")
        usable = Q.observations_usable(obs, "v", ["a", "b"])
        assert [round(v, 6) for (v,) in values(C.with_fallback(grid, corrected, usable, "temperature"), "value")] == [want]
    empty = spark.createDataFrame([], "producer string, v double")
    usable = Q.observations_usable(empty, "v", ["a", "b"])
    assert values(usable, "ok") == [(False,)]


def test_lambert_known_points(spark):
    lambert = PR.Lambert()
    x0, y0 = lambert.origin(P.FIRST_LAT, P.FIRST_LON)
    assert x0 == pytest.approx(-1060122.160, abs=1e-2) and y0 == pytest.approx(-1332565.801, abs=1e-2)
    want = {(0, 0): (50.319616, 0.27828), (1, 0): (49.765593, 33.026208), (0, 1): (72.761653, -18.121), (1, 1): (71.575746, 54.237749)}
    df = spark.createDataFrame(list(want), "i int, j int")
    lat, lon = PR.grid_coordinates(lambert, "i", "j", P.GRID_WIDTH, P.GRID_HEIGHT, P.FIRST_LAT, P.FIRST_LON)
    for r in df.select("i", "j", lat.alias("lat"), lon.alias("lon")).collect():
        assert (r["lat"], r["lon"]) == pytest.approx(want[r["i"], r["j"]], abs=2e-6)


@pytest.mark.parametrize("projection", [PR.Lambert(), PR.Lambert(50.0, 70.0, 10.0), PR.PolarStereographic(60.0, 20.0)])
def test_projections_invert(spark, projection):
    df = spark.createDataFrame([(lat, lon) for lat in (50.0, 61.5, 71.0) for lon in (0.0, 14.9, 31.0)], "lat double, lon double")
    x, y = projection.forward("lat", "lon")
    lat, lon = projection.inverse("x", "y")
    for r in df.withColumns({"x": x, "y": y}).withColumns({"lat2": lat, "lon2": lon}).collect():
        assert (r["lat2"], r["lon2"]) == pytest.approx((r["lat"], r["lon"]), abs=1e-9)


def test_histogram_is_a_density(spark):
    df = spark.range(0, 1000).selectExpr("cast(id % 37 as double) as x", "cast(id % 91 as double) as y")
    hist = A.hist2d_density(df, "x", "y", 10)
    assert hist.agg(F.sum("n")).first()[0] == 1000
    area = 36 / 10 * 90 / 10
    assert hist.agg(F.sum(F.col("density") * area)).first()[0] == pytest.approx(1.0)
    flat = A.hist2d_density(df.withColumn("x", F.lit(5.0)), "x", "y", 10)
    assert flat.agg(F.sum("n")).first()[0] == 1000


@pytest.mark.parametrize("n, distinct", [(1, 5), (2, 5), (3, 5), (4, 5), (5, 50), (10, 50), (11, 50), (1000, 7), (30000, 10**6)])
def test_quantiles_are_exact(spark, n, distinct):
    import numpy as np

    rng = np.random.default_rng(n)
    data = {g: rng.integers(0, distinct, n) / 7 for g in ("a", "b")}
    # a third of the rows of one group share one value
    data["b"][: n // 3] = data["b"][0]
    df = spark.createDataFrame([(g, float(v)) for g, vs in data.items() for v in vs], "g string, v double").repartition(6)
    shares = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    for r in A.quantiles(df, "v", ["g"], shares, 1000).collect():
        want = np.quantile(data[r["g"]], list(shares.values()))
        assert [r[k] for k in shares] == pytest.approx(list(want), abs=1e-12)


def test_places_number_all_rows(spark):
    df = spark.range(0, 500).selectExpr("id % 7 as k", "id")
    placed = [r["place"] for r in A.with_place(df, ["k", "id"]).orderBy("k", "id").collect()]
    assert placed == list(range(1, 501))


def test_split_share(spark):
    df = spark.range(0, 20000).selectExpr("id as sid", "id % 9 as validdate", "id % 5 as leadtime")
    a = R.with_random_split(df)
    share = a.where("is_validation").count() / 20000
    assert math.isclose(share, 0.10, abs_tol=0.01)
    again = R.with_random_split(df.repartition(3))
    assert a.where("is_validation").exceptAll(again.where("is_validation")).count() == 0
