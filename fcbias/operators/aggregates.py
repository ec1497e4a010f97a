"""Summaries, scores and densities."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import params as P
from ..functions import scalar as S
from ..session import stored


def mean_std(df: DataFrame, value: str, group: list[str] | None = None) -> DataFrame:
    """Mean and population standard deviation without missing values."""
    v = S.nan_to_null(value)
    return df.groupBy(*(group or [])).agg(F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"))


def min_max(df: DataFrame, value: str, group: list[str] | None = None) -> DataFrame:
    v = S.nan_to_null(value)
    return df.groupBy(*(group or [])).agg(
        F.min(v).alias("min_value"), F.max(v).alias("max_value"), F.count(v).alias("n")
    )


def any_missing(df: DataFrame, value: str, group: list[str] | None = None) -> DataFrame:
    missing = F.col(value).isNull() | F.isnan(value)
    return df.groupBy(*(group or [])).agg(F.bool_or(missing).alias("has_missing"))


def extent(df: DataFrame, time: str = "fcdate", approximate: bool = False) -> DataFrame:
    """Rows, stations and time range. The exact station count shuffles every distinct station."""
    stations = F.approx_count_distinct("sid") if approximate else F.count_distinct("sid")
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        stations.alias("n_stations"),
        F.min(time).alias("first_time"),
        F.max(time).alias("last_time"),
    )


def rmse(a, b) -> Column:
    diff = S.col(a) - S.col(b)
    return F.sqrt(F.avg(diff * diff))


def rms(a) -> Column:
    return F.sqrt(F.avg(S.col(a) * S.col(a)))


def rmse_overall(df: DataFrame, param: str, predictions: dict[str, str] | None = None) -> DataFrame:
    """RMSE of the raw forecast and, by name, of predictions of its error."""
    p = P.parameter(param)
    scores = [rmse(p.fc, p.obs).alias("rmse_raw")]
    scores += [rmse(p.error, c).alias(f"rmse_{n}") for n, c in (predictions or {}).items()]
    return df.agg(*scores, F.count(F.lit(1)).alias("n"))


def rmse_by_lead(df: DataFrame, param: str, predictions: dict[str, str] | None = None) -> DataFrame:
    """The same for every lead time in one aggregation; the raw score is the rms of the error."""
    p = P.parameter(param)
    scores = [rms(p.error).alias("rmse_raw")]
    scores += [rmse(p.error, c).alias(f"rmse_{n}") for n, c in (predictions or {}).items()]
    return df.groupBy("leadtime").agg(*scores, F.count(F.lit(1)).alias("n"))


def mae_by_fold(df: DataFrame, error: Column, group=("candidate",)) -> DataFrame:
    """Mean absolute error per candidate and fold; rows of no fold are never tested."""
    return df.where(F.col("fold") >= 0).groupBy(*group, "fold").agg(F.avg(F.abs(error)).alias("mae"))


def mae_summary(folds: DataFrame, group=("candidate",)) -> DataFrame:
    """Mean and population deviation of the fold scores."""
    return folds.groupBy(*group).agg(
        F.avg("mae").alias("mae_mean"), F.stddev_pop("mae").alias("mae_std"), F.count(F.lit(1)).alias("folds")
    )


def hist2d_density(df: DataFrame, x: str, y: str, bins: int = P.HIST_BINS) -> DataFrame:
    """Two-dimensional histogram as a density; at most ``bins`` squared rows.

    The last bin is closed. The edges come from one aggregation used as scalar subqueries, so that
    the points themselves are never shuffled.
    """
    return (
        with_bins(df, x, y, bins)
        .groupBy("bx", "by")
        .agg(F.count(F.lit(1)).alias("n"), F.any_value("cell_area").alias("cell_area"), F.any_value("total").alias("total"))
        .select("bx", "by", "n", (F.col("n") / (F.col("total") * F.col("cell_area"))).alias("density"))
    )


def with_bins(df: DataFrame, x: str, y: str, bins: int = P.HIST_BINS) -> DataFrame:
    """Points with their bin, the area of a bin, the number of points, and their place in steps of a bin (_px, _py).

    A range of zero is widened by one half on both sides. A value on an edge belongs to the bin above,
    also if the last bits of the arithmetic put it just below.
    """
    points = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    edges = points.agg(
        F.struct(
            F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1"),
            F.count(F.lit(1)).alias("n"),
        )
    ).scalar()

    def low_width(lo: str, hi: str) -> tuple[Column, Column]:
        low, high = F.col("edges")[lo], F.col("edges")[hi]
        flat = low == high
        return F.when(flat, low - 0.5).otherwise(low), F.when(flat, F.lit(1.0)).otherwise(high - low)

    def bin_of(c: str, lo: str, hi: str) -> Column:
        low, width = low_width(lo, hi)
        return F.least(F.lit(bins - 1), F.floor((F.col(c) - low) / width * bins + 1e-9).cast("int"))

    def steps_of(c: str, lo: str, hi: str) -> Column:
        low, width = low_width(lo, hi)
        return (F.col(c) - low) / width * bins

    area = low_width("x0", "x1")[1] / bins * low_width("y0", "y1")[1] / bins
    return (
        points.withColumn("edges", edges)
        .withColumns(
            {
                "bx": bin_of(x, "x0", "x1"),
                "by": bin_of(y, "y0", "y1"),
                "_px": steps_of(x, "x0", "x1"),
                "_py": steps_of(y, "y0", "y1"),
                "cell_area": area,
                "total": F.col("edges")["n"],
            }
        )
        .drop("edges")
    )


def density_at_points(df: DataFrame, x: str, y: str, bins: int = P.HIST_BINS) -> DataFrame:
    """Points with the density of their bin. The histogram has at most ``bins`` squared rows."""
    histogram = hist2d_density(df, x, y, bins).select("bx", "by", "density")
    binned = with_bins(df, x, y, bins).drop("cell_area", "total", "_px", "_py")
    joined = binned.join(F.broadcast(histogram), ["bx", "by"], "left")
    return joined.withColumn("density", F.coalesce("density", F.lit(0.0)))


def spline_pieces(n: int) -> np.ndarray:
    """Cubic spline through n equidistant values, not-a-knot, as a linear map: [interval, power, value] for the offset
    from the interval's left end in steps."""
    values = np.eye(n)
    system, right = np.zeros((n, n)), np.zeros((n, n))
    for i in range(1, n - 1):
        system[i, i - 1 : i + 2] = 1, 4, 1
        right[i] = 6 * (values[i - 1] - 2 * values[i] + values[i + 1])
    system[0, :3] = system[-1, -3:] = 1, -2, 1
    bend = np.linalg.solve(system, right)
    low, high = bend[:-1], bend[1:]
    return np.stack([values[:-1], values[1:] - values[:-1] - (2 * low + high) / 6, low / 2, (high - low) / 6], axis=1)


def density_by_spline(df: DataFrame, x: str, y: str, bins: int = P.HIST_BINS) -> DataFrame:
    """Points with the density of a bicubic spline through the centres of the bins; beyond the outer centres it is 0.

    The spline is the one that interpolates the histogram without a knot next to its edge. The histogram, at most
    ``bins`` (4 to 200) squared rows, goes to the driver; what comes back is a row of 16 coefficients for each square between four
    centres, which the points meet on their square and evaluate as an expression.
    """
    if not 4 <= bins <= 200:
        raise ValueError("bins must be from 4 to 200")
    density = np.zeros((bins, bins))
    for row in hist2d_density(df, x, y, bins).collect():
        density[row.bx, row.by] = row.density
    pieces = spline_pieces(bins)
    squares = np.einsum("iak,kl,jbl->ijab", pieces, density, pieces, optimize=True)
    used = np.argwhere(np.abs(squares).max(axis=(2, 3)) > 0)
    rows = [(int(i), int(j), squares[i, j].ravel().tolist()) for i, j in used]
    table = df.sparkSession.createDataFrame(rows, "sx int, sy int, terms array<double>")
    placed = with_bins(df, x, y, bins)
    # offsets from the first centre in steps; the last centre belongs to the square before it
    offsets = {name: F.col(f"_p{name}") - 0.5 for name in "xy"}
    inside = [o.between(0.0, bins - 1.0) for o in offsets.values()]
    square = {f"s{name}": F.least(F.lit(bins - 2), F.floor(o).cast("int")) for name, o in offsets.items()}
    placed = placed.withColumns({k: F.when(inside[0] & inside[1], v) for k, v in square.items()})
    joined = placed.join(F.broadcast(table), ["sx", "sy"], "left")
    u, v = offsets["x"] - F.col("sx"), offsets["y"] - F.col("sy")

    def horner(terms: list[Column], at: Column) -> Column:
        return reduce(lambda total, term: total * at + term, reversed(terms))

    value = horner([horner([F.col("terms")[4 * a + b] for b in range(4)], v) for a in range(4)], u)
    kept = [c for c in joined.columns if c not in ("sx", "sy", "terms", "_px", "_py", "bx", "by", "cell_area", "total")]
    return joined.select(*kept, F.coalesce(value, F.lit(0.0)).alias("density"))


# Equal steps into which the bracket around a quantile is cut.
STEPS = 1024


def box_summary(df: DataFrame, value: str, group: list[str]) -> DataFrame:
    """Quartiles and extremes per group, as ``quantiles`` finds them."""
    present = df.where(F.col(value).isNotNull())
    extremes = present.groupBy(*group).agg(F.min(value).alias("low"), F.max(value).alias("high"), F.count(value).alias("n"))
    quartiles = quantiles(present, value, group, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    return quartiles.join(extremes, group)


def quantiles(df: DataFrame, value: str, group: list[str], shares: dict[str, float], accuracy: int = 10000) -> DataFrame:
    """Exact quantiles per group with linear interpolation, for groups of any size.

    A sketch of fixed size gives, for each share, two values between which the wanted ranks lie. A
    second pass counts the rows below and collapses the few rows in between to distinct values with
    their counts. Those are counted by equal steps of the bracket first, and ranked only within the
    steps that hold the wanted ranks. In a small group the sketch may be one rank off, so the
    neighbours on both sides are kept too. The brackets are stored, so that their size is known when
    the join with the rows is planned.
    """
    margin = 2 / accuracy
    names = list(shares)
    edges = [max(0.0, shares[n] - margin) for n in names] + [min(1.0, shares[n] + margin) for n in names]
    sketch = df.groupBy(*group).agg(F.percentile_approx(value, edges, accuracy).alias("edges"), F.count(value).alias("total"))
    brackets = sketch.select(
        *group,
        "total",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(n).alias("name"), F.lit(shares[n]).alias("share"),
                        F.col("edges")[i].alias("lo"), F.col("edges")[i + len(names)].alias("hi"),
                    )
                    for i, n in enumerate(names)
                ]
            )
        ),
    )
    v, lo, hi = F.col(value), F.col("lo"), F.col("hi")
    # every row meets the three brackets of its group; values outside collapse to one row per side
    side = F.when(v < lo, -1).when(v > hi, 1).otherwise(0)
    inside = F.when(side == 0, v)
    share = F.nanvl(F.coalesce(F.try_divide((v - lo).cast("double"), (hi - lo).cast("double")), F.lit(0.0)), F.lit(0.0))
    step = F.when(side < 0, -1).when(side > 0, STEPS).otherwise(F.least(F.lit(STEPS - 1), F.floor(share * STEPS)))
    counted = (
        df.join(stored(brackets, "brackets"), group)
        .groupBy(*group, "name", "share", "total", step.alias("step"), inside.alias("inside"))
        .agg(F.count(F.lit(1)).alias("n"), F.max(v).alias("top"), F.min(v).alias("bottom"))
    )
    rank = F.col("share") * (F.col("total") - 1) + 1
    first, last = F.floor(rank), F.ceil(rank)
    # at most STEPS + 2 rows of each group and share
    by_step = Window.partitionBy(*group, "name").orderBy("step")
    steps = counted.groupBy(*group, "name", "share", "total", "step").agg(F.sum("n").alias("rows"))
    steps = steps.withColumn("before", F.sum("rows").over(by_step) - F.col("rows"))
    wanted = steps.where((F.col("before") < last) & (F.col("before") + F.col("rows") >= first)).select(*group, "name", "step", "before")
    ordered = Window.partitionBy(*group, "name", "step").orderBy("inside").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.join(wanted, [*group, "name", "step"]).withColumn("upto", F.col("before") + F.sum("n").over(ordered))

    def at(r):
        # below the bracket only its largest row is known, above it only the smallest
        found = (F.col("upto") >= r) & (F.col("upto") - F.col("n") < r)
        return F.max(F.when(found, F.when(F.col("step") < 0, F.col("top")).otherwise(F.col("bottom"))))

    part = F.max(rank - first)
    low, high = at(first), at(last)
    picked = ranked.groupBy(*group, "name").agg((low + (high - low) * part).alias("value"))
    return picked.groupBy(*group).agg(*[F.max(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in names])


def sorted_leads(df: DataFrame) -> DataFrame:
    return df.select("leadtime").distinct().orderBy("leadtime")


def head(df: DataFrame, keys: list[str], n: int = 10) -> DataFrame:
    """First rows in key order; planned as a top-n, so each task sends at most n rows."""
    return df.orderBy(*keys).limit(n)


def order_by_density(df: DataFrame, keys: list[str]) -> DataFrame:
    """Densest points last."""
    return df.orderBy("density", *keys)


def by_lead(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.orderBy("leadtime", *keys)


def with_place(df: DataFrame, order: list[str]) -> DataFrame:
    """Place of every row in a total order, without putting equal or all rows into one task.

    The rows are sorted by range over all tasks and stored with their number within their part; the
    rows of the parts before are then added. The stored table fixes the parts, so that a lost and
    repeated task cannot number rows differently.
    """
    number = F.monotonically_increasing_id()
    parts = {"part": F.shiftright(number, 33), "within": number.bitwiseAND(F.lit((1 << 33) - 1))}
    sorted_rows = stored(df.orderBy(*order).withColumns(parts), "sorted")
    counts = sorted_rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # one row per task
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    placed = sorted_rows.join(F.broadcast(offsets), "part")
    return placed.withColumn("place", F.col("offset") + F.col("within") + 1).drop("part", "within", "offset")
