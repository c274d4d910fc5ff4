"""Correlation, trend, density, histogram and box statistics."""

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.functions.text import nan_to_null
from fieldlens.operators.ranks import quantiles


def pearson(x, y):
    """Pearson coefficient over the rows where both are present; NULL where one of them does not vary.

    The built-in ``corr`` raises on a constant column in ANSI mode.
    """
    return F.try_divide(F.regr_sxy(y, x), F.sqrt(F.regr_sxx(y, x) * F.regr_syy(y, x)))


MOMENTS = "i int, j int, n double, mx double, my double, cxx double, cyy double, cxy double"
# Groups of which a task holds moments at a time.
GROUPS_HELD = 256


def pair_moments(values):
    """(n, means and centred sums of x and y) of every column pair i <= j over the rows where both are present, as rows of six.

    Values are taken from the column's first one, so a column that does not vary has sums of exactly zero; matrix products
    of values and of presence marks then give all pairs at once.
    """
    present = ~np.isnan(values)
    first = values[present.argmax(axis=0), np.arange(values.shape[1])]
    first = np.where(np.isnan(first), 0.0, first)
    shifted, marks = np.where(present, values - first, 0.0), present.astype(float)
    n, sums, squares = marks.T @ marks, shifted.T @ marks, (shifted * shifted).T @ marks
    i, j = np.triu_indices(values.shape[1])
    n, sx, sy, xx, yy, xy = n[i, j], sums[i, j], sums[j, i], squares[i, j], squares[j, i], (shifted.T @ shifted)[i, j]
    some = np.maximum(n, 1.0)
    return np.stack([n, first[i] + sx / some, first[j] + sy / some, xx - sx * sx / some, yy - sy * sy / some, xy - sx * sy / some])


def merged_moments(a, b):
    """Moments of two sets of rows together."""
    n = a[0] + b[0]
    some = np.maximum(n, 1.0)
    dx, dy, share = b[1] - a[1], b[2] - a[2], a[0] * b[0] / some
    mean = lambda x, y, d: np.where(a[0] == 0, y, x + d * b[0] / some)
    return np.stack([n, mean(a[1], b[1], dx), mean(a[2], b[2], dy), a[3] + b[3] + dx * dx * share, a[4] + b[4] + dy * dy * share,
                     a[5] + b[5] + dx * dy * share])


def _task_moments(n_columns, by):
    """Function from a task's rows to the moments of its groups: a row per group and pair, however many rows there are."""
    i, j = np.triu_indices(n_columns)

    def rows(keys, moments):
        columns = [pa.array(np.zeros(len(i), "int64")) for _ in by]
        for at, key in enumerate(keys):
            columns[at] = pa.concat_arrays([key] * len(i)) if len(i) else key.slice(0, 0)
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(i, pa.int32()), pa.array(j, pa.int32()), *[pa.array(m) for m in moments]],
            names=[*by, "i", "j", "n", "mx", "my", "cxx", "cyy", "cxy"])

    def run(batches):
        held = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column("_v").flatten().to_numpy(zero_copy_only=False).reshape(-1, n_columns)
            names = batch.column("_key").to_pylist() if by else [""] * batch.num_rows
            members = pd.Series(range(len(names))).groupby(names, sort=False).indices
            for name, at in members.items():
                moments = pair_moments(flat[at])
                if name in held:
                    held[name] = held[name][0], merged_moments(held[name][1], moments)
                else:
                    held[name] = [batch.column(c).slice(int(at[0]), 1) for c in by], moments
            if len(held) > GROUPS_HELD:
                yield from (rows(*found) for found in held.values())
                held.clear()
        yield from (rows(*found) for found in held.values())

    return run


def corr_matrix(df, columns, by=()):
    """Pearson coefficient of every pair, pairwise complete, as (row_name, col_name, corr).

    A task multiplies its batches to moments of all pairs; what meets by pair are the moments of tasks, centred on their own
    means, so no row is dealt out and large means cost no digits. The lower half is the mirror of the upper.
    """
    columns, by = list(columns), list(by)
    values = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in columns])
    key = [F.to_json(F.struct(*by)).alias("_key")] if by else []
    schema = ", ".join([*[f"`{c}` {df.schema[c].dataType.simpleString()}" for c in by], MOMENTS])
    parts = df.select(*by, *key, values.alias("_v")).mapInArrow(_task_moments(len(columns), by), schema)
    one = F.struct("n", "mx", "my", "cxx", "cyy", "cxy")

    def merge(a, b):
        n = a["n"] + b["n"]
        some, dx, dy = F.greatest(n, F.lit(1.0)), b["mx"] - a["mx"], b["my"] - a["my"]
        share = a["n"] * b["n"] / some
        mean = lambda m, d: F.when(a["n"] == 0, b[m]).otherwise(a[m] + d * b["n"] / some)
        return F.struct(n.alias("n"), mean("mx", dx).alias("mx"), mean("my", dy).alias("my"), (a["cxx"] + b["cxx"] + dx * dx * share).alias("cxx"),
                        (a["cyy"] + b["cyy"] + dy * dy * share).alias("cyy"), (a["cxy"] + b["cxy"] + dx * dy * share).alias("cxy"))

    none = F.struct(*[F.lit(0.0).alias(c) for c in ("n", "mx", "my", "cxx", "cyy", "cxy")])
    upper = parts.groupBy(*by, "i", "j").agg(F.aggregate(F.collect_list(one), none, merge).alias("m")).select(
        *by, "i", "j", nan_to_null(F.try_divide(F.col("m.cxy"), F.sqrt(F.col("m.cxx") * F.col("m.cyy")))).alias("corr"))
    cell = lambda i, j: F.struct(F.col(i).alias("row_no"), F.col(j).alias("col_no"))
    both = F.when(F.col("i") == F.col("j"), F.array(cell("i", "j"))).otherwise(F.array(cell("i", "j"), cell("j", "i")))
    names = F.array(*[F.lit(c) for c in columns])
    cells = upper.select(*by, "corr", F.explode(both).alias("_c")).select(*by, "corr", "_c.*")
    return cells.select(*by, F.get(names, F.col("row_no")).alias("row_name"), F.get(names, F.col("col_no")).alias("col_name"),
                        "corr", "row_no", "col_no")


def corr_lower(matrix):
    """Below the diagonal."""
    return matrix.where("row_no > col_no")


def corr_pairs(matrix, kind="upper", by=()):
    """Pairs in order of the coefficient. ``kind="all"`` keeps the diagonal and both directions."""
    pairs = matrix if kind == "all" else matrix.where("row_no < col_no")
    return pairs.where("corr IS NOT NULL").orderBy(*by, "corr", "row_no", "col_no")


def negative_pairs(pairs):
    return pairs.where("corr < 0")


def strong_pairs(pairs, limit=0.5):
    return pairs.where(F.abs("corr") > limit)


def round_corr(matrix, digits=2):
    return matrix.withColumn("corr", F.bround("corr", digits))


def _student_tail(t, dof):
    """Two-sided p-value of Student's t, by the continued fraction of the incomplete beta function."""
    x = dof / (dof + t * t)
    a, b = dof / 2.0, 0.5
    flip = x > (a + 1) / (a + b + 2)
    if flip:
        a, b, x = b, a, 1 - x
    if x <= 0:
        return 1.0 if flip else 0.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    # modified Lentz evaluation
    tiny = 1e-300
    c, d = 1.0, 1.0 / max(1 - (a + b) * x / (a + 1), tiny)
    h = d
    for m in range(1, 500):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        d = 1 / (1 + even * d)
        c = 1 + even / c
        h *= d * c
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1 / (1 + odd * d)
        c = 1 + odd / c
        step = d * c
        h *= step
        if abs(step - 1) < 1e-15:
            break
    value = front * h
    return 1 - value if flip else value


@F.pandas_udf(T.DoubleType())
def student_p(t: pd.Series, dof: pd.Series) -> pd.Series:
    out = [None if pd.isna(a) or pd.isna(n) or n <= 0 else _student_tail(abs(a), float(n)) for a, n in zip(t, dof)]
    return pd.Series(out, dtype="float64")


def pearson_test(df, x, y, by=()):
    """r, t statistic and two-sided p-value. The p-value is worked out on the aggregated rows only."""
    pairs = df.select(*by, nan_to_null(F.col(x).cast("double")).alias("x"), nan_to_null(F.col(y).cast("double")).alias("y"))
    sums = pairs.where("x IS NOT NULL AND y IS NOT NULL").groupBy(*by).agg(
        pearson(F.col("x"), F.col("y")).alias("r"), F.count(F.lit(1)).alias("n"))
    t = F.col("r") * F.sqrt(F.try_divide(F.col("n") - 2, 1 - F.col("r") * F.col("r")))
    tested = sums.withColumn("t", t)
    return tested.withColumn("p_value", F.when(F.abs("r") >= 1, F.lit(0.0)).otherwise(
        student_p(F.col("t"), (F.col("n") - 2).cast("double"))))


def linear_trend(df, x, y, by=()):
    return df.groupBy(*by).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"), F.regr_count(y, x).alias("n"))


# Cells that a bandwidth is cut into, and the powers that are summed up in a cell. The kernel of a value d bandwidths from its
# cell's middle is the sum of He_k(u) d^k / k! at the middle; as |d| <= 1/32, what follows the seventh power is below
# 1/32^8 / 8! * 105, less than 1e-14 of the kernel's height.
CELLS_PER_BANDWIDTH = 16
POWERS = 8


def hermite(u, n):
    """The first n Hermite polynomials (of the kernel exp(-u^2 / 2)) as columns."""
    found = [F.lit(1.0), u]
    for k in range(1, n - 1):
        found.append(u * found[k] - F.lit(float(k)) * found[k - 1])
    return found[:n]


def density_grid(df, columns, gridsize=200, cut=3):
    """Gaussian kernel density of each column on an even grid.

    Bandwidth n^(-1/5) * standard deviation, grid from ``cut`` bandwidths below the least to above
    the greatest value. Values are binned first: a cell, a 16th of a bandwidth wide, keeps the sums of the first powers of its values'
    distances from its middle, from which their kernels together are known to rounding. So the shuffle carries a row per
    cell and task, and kernels are added up by cell, not by value.
    """
    long = df.unpivot([], [F.col(c).cast("double").alias(c) for c in columns], "variable", "value").where(
        F.col("value").isNotNull() & ~F.isnan("value"))
    spread = long.groupBy("variable").agg(
        F.count("value").alias("n"), F.stddev_samp("value").alias("_sd"),
        F.min("value").alias("_lo"), F.max("value").alias("_hi"),
    ).withColumn("h", F.pow(F.col("n").cast("double"), F.lit(-0.2)) * F.col("_sd")).where("h > 0")
    step = (F.col("_hi") - F.col("_lo") + 2 * cut * F.col("h")) / (gridsize - 1)
    points = spread.withColumns({"_step": step, "_from": F.col("_lo") - cut * F.col("h")})
    # at most one row per named column
    cells = long.join(F.broadcast(spread.select("variable", "_lo", "h")), "variable").withColumn(
        "_no", F.floor((F.col("value") - F.col("_lo")) / F.col("h") * CELLS_PER_BANDWIDTH))
    middle = F.col("_lo") + (F.col("_no") + 0.5) * (F.col("h") / CELLS_PER_BANDWIDTH)
    counted = cells.withColumns({"_middle": middle, "_d": (F.col("value") - middle) / F.col("h")}).groupBy("variable", "_no").agg(
        F.first("_middle").alias("value"),
        *[F.sum(F.pow("_d", F.lit(float(k))) / float(math.factorial(k))).alias(f"c{k}") for k in range(POWERS)])
    sums = [f"c{k}" for k in range(POWERS)]
    # a kernel is below 1e-14 of its height eight bandwidths away: only the grid points within that reach get a term; the
    # sums of the others start from a term of zero
    place = lambda x: (x - F.col("_from")) / F.col("_step")
    first = F.greatest(F.lit(0), F.ceil(place(F.col("value") - 8 * F.col("h"))).cast("int"))
    last = F.least(F.lit(gridsize - 1), F.floor(place(F.col("value") + 8 * F.col("h"))).cast("int"))
    grid = F.explode(F.sequence(first, F.greatest(first, last))).alias("point")
    every = points.select("variable", F.col("_lo").alias("value"), *[F.lit(0.0).alias(c) for c in sums], "n", "h", "_step",
                                       "_from", F.explode(F.sequence(F.lit(0), F.lit(gridsize - 1))).alias("point"))
    # at most one row per named column
    terms = counted.join(F.broadcast(points), "variable").select(
        "variable", "value", *sums, "n", "h", "_step", "_from", grid,
    ).unionByName(every).withColumn("x", F.col("_from") + F.col("point") * F.col("_step"))
    u = (F.col("x") - F.col("value")) / F.col("h")
    together = sum((polynomial * F.col(c) for polynomial, c in zip(hermite(u, POWERS), sums)), F.lit(0.0))
    return terms.groupBy("variable", "point").agg(
        F.max("x").alias("x"),
        (F.sum(together * F.exp(-0.5 * u * u)) / (F.max("n") * F.max("h") * F.lit(math.sqrt(2 * math.pi)))).alias("density"),
    )


def band_histogram(pixels, bands, keys=("field_id", "uuid"), bins=50):
    """Counts per crop, band and bin, all bands of a crop over one common range, last edge closed.

    Pixel values are whole numbers of a bounded range, so counting by value first makes the rows
    of even the largest crop few; the range and the bins are then worked out on the counts.
    """
    keys = list(keys)
    entries = F.array(*[F.struct(F.lit(b).alias("band"), F.col(b).alias("value")) for b in bands])
    counted = (
        pixels.select(*keys, F.explode(entries).alias("_e")).select(*keys, "_e.band", "_e.value")
        .where("value IS NOT NULL").groupBy(*keys, "band", "value").agg(F.count(F.lit(1)).alias("_n"))
    )
    spans = counted.groupBy(*keys).agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    # a crop of one single value gets the unit range around it
    low = F.when(F.col("_lo") == F.col("_hi"), F.col("_lo") - 0.5).otherwise(F.col("_lo").cast("double"))
    high = F.when(F.col("_lo") == F.col("_hi"), F.col("_hi") + 0.5).otherwise(F.col("_hi").cast("double"))
    binned = counted.join(spans.withColumns({"_low": low, "_high": high}), keys).withColumn(
        "bin", F.least(F.floor((F.col("value") - F.col("_low")) * bins / (F.col("_high") - F.col("_low"))), F.lit(bins - 1)).cast("int"))
    return binned.groupBy(*keys, "band", "bin").agg(F.sum("_n").alias("n_pixels"))


def box_stats(df, by, column):
    """Quartiles, mean and whiskers: the furthest values within 1.5 inter-quartile ranges."""
    by = list(by)
    counted = df.where(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count(F.lit(1)).alias("_n"))
    quarters = quantiles(df, by, column, (0.25, 0.5, 0.75)).select(
        *by, F.col("q0").alias("q1"), F.col("q1").alias("med"), F.col("q2").alias("q3"))
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    placed = counted.join(quarters, by)
    return placed.groupBy(*by, "q1", "med", "q3").agg(
        (F.sum(F.col(column) * F.col("_n")) / F.sum("_n")).alias("mean"),
        F.min(F.when(F.col(column) >= F.col("q1") - reach, F.col(column))).alias("_lo"),
        F.max(F.when(F.col(column) <= F.col("q3") + reach, F.col(column))).alias("_hi"),
        F.sum("_n").alias("n"),
    ).select(
        *by, "q1", "med", "q3", "mean", "n",
        # never inside the box
        F.least("_lo", "q1").alias("whisker_low"), F.greatest("_hi", "q3").alias("whisker_high"))


def row_mean(columns):
    """Mean across columns, missing ones left out."""
    present = sum((F.when(F.col(c).isNotNull(), 1).otherwise(0) for c in columns), F.lit(0))
    total = sum((F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns), F.lit(0.0))
    return F.try_divide(total, present)


def top_band_sets(scores, columns, k=10, by="target", tie="bands"):
    """Best ``k`` per target by mean score. The rank filter is applied before the shuffle too."""
    ranked = scores.withColumn("mean", row_mean(columns))
    order = Window.partitionBy(by).orderBy(F.desc("mean"), F.asc(tie))
    return ranked.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def accuracy(df, label="label", prediction="prediction", by=()):
    return df.groupBy(*by).agg(
        F.avg(F.when(F.col(label) == F.col(prediction), 1.0).otherwise(0.0)).alias("accuracy"),
        F.count(F.lit(1)).alias("n"))


def confusion_matrix(df, labels, label="label", prediction="prediction"):
    """Counts by label and prediction, zeros kept. The labels are given."""
    counts = df.where(F.col(label).isin(list(labels))).groupBy(label).agg(
        *[F.count_if(F.col(prediction) == p).alias(f"predicted_{p}") for p in labels])
    frame = df.sparkSession.createDataFrame([(p,) for p in labels], [label]).withColumn(
        label, F.col(label).cast(df.schema[label].dataType))
    return frame.join(counts, label, "left").na.fill(0)


def cv_summary(fold_scores, by, score="score"):
    return fold_scores.groupBy(*by).agg(F.avg(score).alias("mean_score"), F.stddev_pop(score).alias("std_score"))
