"""Fixed values of the data model: parameters, limits, feature lists, model settings."""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values: parameter names of the narrow archive and their wide columns ------------------
NARROW_TO_WIDE = {
    "D10m": "d10m",
    "T2m": "t2m",
    "S10m": "s10m",
    "RH2m": "rh2m",
    "Pmsl": "pmsl",
    "Q2m": "q2m",
    "CClow": "cclow",
    "Gmax": "gmax",
}
NARROW_KEYS = ["leadtime", "sid", "lat", "lon", "model_elevation", "validdate", "fcdate"]
OBS_COLUMNS = ["rh_pt1m_avg", "ta_pt1m_avg", "ws_pt10m_avg", "wg_pt1h_max"]


@dataclass(frozen=True)
class Parameter:
    """One correctable parameter and the columns that belong to it."""

    name: str  # operational name
    model: str  # name of the trained model
    field: str  # grid field in source units
    fc: str  # forecast column of the wide table
    obs: str  # observation column of the wide table
    obs_national: str  # observation column of the national producer
    obs_foreign: str  # observation column of the other producer
    error: str  # forecast - observation
    bias0: str  # error at lead 0
    bias1: str  # error at lead 1
    crowd: bool  # crowd observations exist
    upper_limit: float | None  # observations at or above this are not trained on


# fixed values
PARAMETERS = {
    p.name: p
    for p in (
        Parameter("temperature", "T2m", "t2", "t2m", "ta_pt1m_avg", "TA_PT1M_AVG", "TA_PT1M_AVG",
                  "tero", "t0bias", "t1bias", True, None),
        Parameter("humidity", "RH", "rh", "rh2m", "rh_pt1m_avg", "RH_PT1M_AVG", "RH_PT1M_AVG",
                  "rhero", "rh0bias", "rh1bias", True, None),
        Parameter("windspeed", "WS", "ws", "s10m", "ws_pt10m_avg", "WSP_PT10M_AVG", "WS_PT10M_AVG",
                  "wsero", "ws0bias", "ws1bias", False, 45.0),
        Parameter("gust", "WG", "wg", "gmax", "wg_pt1h_max", "WG_PT1H_MAX", "WG_PT1H_MAX",
                  "wgero", "wg0bias", "wg1bias", False, 60.0),
    )
}
BY_MODEL = {p.model: p for p in PARAMETERS.values()}


def parameter(name: str) -> Parameter:
    """Look a parameter up by its operational or its model name."""
    found = PARAMETERS.get(name) or BY_MODEL.get(name)
    if found is None:
        raise ValueError(f"unknown parameter {name!r}; one of {sorted(PARAMETERS)} or {sorted(BY_MODEL)}")
    return found


# --- fixed values: features in model order, by model name ----------------------------------------
TIME_FEATURES = ["month_sin", "month_cos", "hour_sin", "hour_cos"]
_SITE = ["obs_lat", "obs_lon", "elevd", "obs_elevation"]
FEATURES = {
    "T2m": ["leadtime", "t2m", "s10m", "rh2m", "pmsl", "q2m", "cclow", *_SITE, "t1bias", *TIME_FEATURES],
    "RH": ["leadtime", "t2m", "s10m", "rh2m", "pmsl", "q2m", "cclow", *_SITE, "rh1bias", *TIME_FEATURES],
    "WS": ["leadtime", "d10m", "t2m", "s10m", "pmsl", "cclow", "gmax", *_SITE, "ws1bias", *TIME_FEATURES],
    "WG": ["leadtime", "d10m", "t2m", "s10m", "rh2m", "pmsl", "gmax", *_SITE, "wg1bias", *TIME_FEATURES],
}
# Columns of the wind-speed features as they were served before training and serving were unified.
SERVED_WIND_FEATURES = ["leadtime", "d10m", "t2m", "s10m", "rh2m", "pmsl", "gmax", *_SITE, "ws1bias", *TIME_FEATURES]
# The previous generation of models was trained without this feature.
OLD_MODEL_EXCLUDES = ["obs_elevation"]
# Optional column with the bias of an earlier model version.
OLD_BIAS = {"T2m": "oldb_t", "WS": "oldb_ws", "RH": "oldb_rh"}


def training_columns(model: str) -> list[str]:
    """Columns of the training table in order; the error column is number 12, counted from zero."""
    p = parameter(model)
    feats = FEATURES[p.model]
    weather, rest = feats[1 : feats.index("obs_lat")], feats[feats.index("elevd") :]
    rest = rest[: rest.index(p.bias1)] + [p.bias0] + rest[rest.index(p.bias1) :]
    return ["leadtime", "sid", "validdate", *weather, "obs_lat", "obs_lon", p.obs, p.error, *rest]


# --- fixed values: limits of the z-score by month, January first -----------------------------------
_ZSCORE = {
    "T2m": (
        [-6.0, -6.0, -5.0, -4.0, -4.0, -4.0, -4.0, -4.0, -4.0, -5.0, -6.0, -6.0],
        [2.5, 2.5, 2.5, 3.0, 4.0, 5.0, 5.0, 5.0, 3.0, 2.5, 2.5, 2.5],
    ),
    "RH": ([-4.5] * 12, [3.0] * 12),
    "WS": ([-4.0] * 12, [7.0] * 12),
    "WG": ([-4.0] * 12, [7.0] * 12),
}
# (model, month, lower, upper)
ZSCORE_LIMITS = [
    (model, month, lower[month - 1], upper[month - 1])
    for model, (lower, upper) in _ZSCORE.items()
    for month in range(1, 13)
]

# fixed values: admissible 2 m temperature in kelvin by month: (month, low, high)
TEMPERATURE_LIMITS = [
    (1, 222.0, 294.0),
    (2, 230.0, 296.0),
    (3, 232.0, 304.0),
    (4, 237.0, 305.0),
    (5, 247.0, 312.0),
    (6, 254.0, 316.0),
    (7, 259.0, 317.0),
    (8, 258.0, 314.0),
    (9, 250.0, 310.0),
    (10, 237.0, 306.0),
    (11, 229.0, 296.0),
    (12, 227.0, 293.0),
]
# fixed values: admissible output of the other parameters, largest correction
OUTPUT_LIMITS = {"humidity": (5.0, 100.0), "windspeed": (0.0, 38.0), "gust": (0.0, 50.0)}
DIFF_LIMITS = {"humidity": 40.0, "temperature": 10.0}

# fixed values: product metadata (parameter, category, number, level in metres, template, statistic)
PRODUCTS = [
    ("humidity", 1, 193, 2, 70, None),
    ("temperature", 0, 193, 2, 70, None),
    ("windspeed", 2, 194, 10, 70, None),
    ("gust", 2, 195, 10, 72, 2),
]

# --- fixed values: units and sentinels ---------------------------------------------------------------
KELVIN = 273.15
GRAVITY = 9.81
OKTA = 0.125
MISSING = 9999.0
GRID_FIELDS = ["t2", "ws", "wg", "rh", "wd", "nl", "ppa", "q2"]
# fields that the sentinel check looks at when only the original subset is wanted
SENTINEL_SUBSET = ["ws", "rh", "t2"]

# --- fixed values: geometry --------------------------------------------------------------------------
EARTH_RADIUS = 6371229.0
# output grid: Lambert conformal conic
LATIN1, LATIN2, LOV = 63.3, 63.3, 15.0
FIRST_LAT, FIRST_LON = 50.319616, 0.27828
GRID_WIDTH, GRID_HEIGHT = 2370000.0, 2670000.0
# box of the crowd observations and length of their time window
CROWD_BOX = {"lon": (4.0, 32.0), "lat": (54.0, 71.5)}
CROWD_MINUTES = 10

# --- fixed values: gridding -----------------------------------------------------------------------------
BARNES_H, BARNES_V, BARNES_W = 30000.0, 200.0, 0.5
MAX_POINTS = 20
VARIANCE_RATIO = 0.1
# weights below this are treated as zero, which bounds the search radius
MIN_RHO = 0.0013

# --- fixed values: archive thinning, hold-out, tuning ---------------------------------------------------
LEADS_MAIN = [0, 1, 2, 4, 6, 8]
LEADS_OFFSET = [0, 1, 3, 5, 7, 9]
RUN_STEP_HOURS, RUN_OFFSET_HOURS = 4, 2
RUN_HOURS = [0, 4, 8, 12, 16, 20]
HOLDOUT_DAYS = (25, 30)
VALIDATION_SHARE, SPLIT_SEED = 0.10, 42
# start inclusive, end exclusive
FOLD_RANGES = [
    ("2020-01-01", "2020-12-31"),
    ("2021-01-01", "2021-12-31"),
    ("2022-01-01", "2022-12-31"),
    ("2023-01-01", "2023-06-30"),
]


@dataclass(frozen=True)
class TreeSettings:
    """Settings of the boosted trees."""

    column_share: float
    rate: float
    depth: int
    trees: int
    l1: float  # has no counterpart in Spark ML; kept for the record
    row_share: float
    bins: int = 256  # of the histogram of a feature


# fixed values
TREES = {
    "T2m": TreeSettings(0.48, 0.21, 10, 108, 0.71, 0.90),
    "WS": TreeSettings(0.58, 0.10, 12, 127, 0.75, 0.95),
    "RH": TreeSettings(0.99, 0.23, 12, 124, 0.06, 0.50),
    "WG": TreeSettings(0.75, 0.27, 7, 114, 0.04, 0.61),
}
# fixed values: search space (low, high) and number of trials
SEARCH_SPACE = {
    "depth": (15, 20),
    "rate": (0.05, 0.10),
    "column_share": (0.5, 1.0),
    "row_share": (0.7, 1.0),
    "min_child": (6, 10),
}
SEARCH_TRIALS = 35
HIST_BINS = 60
