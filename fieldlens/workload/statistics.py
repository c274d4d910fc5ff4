"""Correlation, trend, density, histogram, box and score statistics."""

from pyspark.sql import functions as F

from fieldlens.constants import ANALYSIS_BANDS, SCORE_COLUMNS, TARGETS
from fieldlens.operators import stats
from fieldlens.operators.tables import analysis_long, unpivot_columns
from fieldlens.workload.registry import query, rounded
from fieldlens.workload.relations import frame_of, frame_sql

BANDS = ANALYSIS_BANDS
COLUMNS = ("rating", *BANDS, "mean_ndvi", "mean_ndwi")


def rated(t):
    return analysis_long(frame_of(t, BANDS), TARGETS)


def rated_sql():
    """CTEs ending in ``rated``: a row per field and tested target."""
    parts = " UNION ALL ".join(
        f"SELECT '{target}' AS target, {target} AS rating, field_id, {', '.join(BANDS)}, mean_ndvi, mean_ndwi FROM frame WHERE {target} > 0"
        for target in TARGETS)
    return f"{frame_sql(BANDS)}, rated AS ({parts})"


def corr_sql():
    cells = " UNION ALL ".join(
        f"SELECT target, '{a}' AS row_name, '{b}' AS col_name, {i} AS row_no, {j} AS col_no, corr({a}, {b}) AS corr FROM rated GROUP BY target"
        for i, a in enumerate(COLUMNS) for j, b in enumerate(COLUMNS))
    return f"{rated_sql()}, cells AS ({cells}), matrix AS (SELECT * REPLACE (CASE WHEN isfinite(corr) THEN corr END AS corr) FROM cells)"


def matrix_of(t):
    return stats.corr_matrix(rated(t), COLUMNS, by=["target"])


@query("corr_matrix", f"WITH {corr_sql()} SELECT target, row_name, col_name, round(corr, 6) AS corr FROM matrix")
def _(t):
    return rounded(matrix_of(t).select("target", "row_name", "col_name", "corr"), 6, "corr")


@query("corr_lower", f"WITH {corr_sql()} SELECT target, row_name, col_name, round(corr, 6) AS corr FROM matrix WHERE row_no > col_no")
def _(t):
    return rounded(stats.corr_lower(matrix_of(t)).select("target", "row_name", "col_name", "corr"), 6, "corr")


# coefficients are rounded to two digits before pairs are filtered, so 0.504 is not strong
ROUNDED_SQL = f"{corr_sql()}, two AS (SELECT * REPLACE (round_even(corr, 2) AS corr) FROM matrix)"


def rounded_matrix(t):
    return stats.round_corr(matrix_of(t))


@query("corr_pairs", f"""
    WITH {ROUNDED_SQL} SELECT target, row_name, col_name, round(corr, 6) AS corr, corr < 0 AS is_negative, abs(corr) > 0.5 AS is_strong
    FROM two WHERE row_no < col_no AND corr IS NOT NULL""")
def _(t):
    pairs = stats.corr_pairs(rounded_matrix(t), by=["target"])
    marked = pairs.select("target", "row_name", "col_name", "corr", (F.col("corr") < 0).alias("is_negative"), (F.abs("corr") > 0.5).alias("is_strong"))
    return rounded(marked, 6, "corr")


@query("corr_strong_pairs_all", f"""
    WITH {ROUNDED_SQL} SELECT target, row_name, col_name, round(corr, 6) AS corr FROM two WHERE abs(corr) > 0.5""")
def _(t):
    strong = stats.strong_pairs(stats.corr_pairs(rounded_matrix(t), "all", by=["target"]))
    return rounded(strong.select("target", "row_name", "col_name", "corr"), 6, "corr")


@query("corr_negative_pairs", f"""
    WITH {ROUNDED_SQL} SELECT target, row_name, col_name, round(corr, 6) AS corr FROM two WHERE row_no < col_no AND corr < 0""")
def _(t):
    negative = stats.negative_pairs(stats.corr_pairs(rounded_matrix(t), by=["target"]))
    return rounded(negative.select("target", "row_name", "col_name", "corr"), 6, "corr")


def pearson_sql(x, y):
    return f"""
    WITH {rated_sql()},
         s AS (SELECT target, corr({x}, {y}) AS r, count(*) AS n FROM rated GROUP BY target),
         grid AS (SELECT unnest(generate_series(0, 20000)) AS i),
         area AS (SELECT target, sum((CASE WHEN i IN (0, 20000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)
                                     * pow(1 - pow(abs(r) * i / 20000.0E0, 2), (n - 4) / 2.0E0)) * abs(r) / 60000.0E0 AS a
                  FROM s, grid GROUP BY target, r)
    SELECT target, round(r, 6) AS r, n, round(r * sqrt((n - 2) / (1 - r * r)), 6) AS t,
           round(1 - 2 * a * exp(lgamma((n - 1) / 2.0E0) - lgamma((n - 2) / 2.0E0)) / sqrt(pi()), 6) AS p_value
    FROM s JOIN area USING (target)"""


def trend_sql(x, y):
    return f"""
    WITH {rated_sql()}
    SELECT target, round(regr_slope({y}, {x}), 6) AS slope, round(regr_intercept({y}, {x}), 6) AS intercept,
           round(regr_r2({y}, {x}), 6) AS r2, cast(regr_count({y}, {x}) AS bigint) AS n FROM rated GROUP BY target"""


def _register_pearson(key, x, y):
    @query(key, pearson_sql(x, y))
    def _(t):
        return rounded(stats.pearson_test(rated(t), x, y, by=["target"]), 6, "r", "t", "p_value")


def _register_trend(key, x, y):
    @query(key, trend_sql(x, y))
    def _(t):
        return rounded(stats.linear_trend(rated(t), x, y, by=["target"]), 6, "slope", "intercept", "r2")


_register_pearson("pearson_test", "rating", "mean_ndvi")
_register_pearson("pearson_test_indices", "mean_ndwi", "mean_ndvi")
_register_trend("linear_trend", "rating", "mean_ndwi")
_register_trend("linear_trend_indices", "mean_ndvi", "mean_ndwi")


@query("density_grid", f"""
    WITH {frame_sql(BANDS)},
         l AS ({" UNION ALL ".join(f"SELECT '{c}' AS variable, cast({c} AS double) AS value FROM frame" for c in ("B08_10m", "B02_10m", "B04_10m", "B03_10m", "carbon_rating"))}),
         s AS (SELECT variable, count(value) AS n, pow(count(value), -0.2) * stddev_samp(value) AS h, min(value) AS lo, max(value) AS hi
               FROM l WHERE value IS NOT NULL GROUP BY variable),
         g AS (SELECT s.*, i AS point, lo - 3 * h + i * (hi - lo + 6 * h) / 199 AS x FROM s, (SELECT unnest(generate_series(0, 199)) AS i))
    SELECT g.variable, cast(g.point AS int) AS point, round(g.x, 6) AS x,
           round(sum(exp(-0.5 * pow((g.x - l.value) / g.h, 2))) / (any_value(g.n) * any_value(g.h) * sqrt(2 * pi())), 9) AS density
    FROM g JOIN l ON l.variable = g.variable AND l.value IS NOT NULL GROUP BY g.variable, g.point, g.x""")
def _(t):
    density = stats.density_grid(frame_of(t, BANDS), ("B08_10m", "B02_10m", "B04_10m", "B03_10m", "carbon_rating"))
    return density.select("variable", "point", F.round("x", 6).alias("x"), F.round("density", 9).alias("density"))


BOX_SQL = """
    q AS (SELECT {by}, quantile_cont({v}, 0.25) AS q1, quantile_cont({v}, 0.5) AS med, quantile_cont({v}, 0.75) AS q3,
                 avg({v}) AS mean, count({v}) AS n FROM {src} WHERE {v} IS NOT NULL GROUP BY {by})
    SELECT q.{by}, round(q1, 6) AS q1, round(med, 6) AS med, round(q3, 6) AS q3, round(mean, 6) AS mean, q.n,
           round(least(min({v}) FILTER ({v} >= q1 - 1.5 * (q3 - q1)), q1), 6) AS whisker_low,
           round(greatest(max({v}) FILTER ({v} <= q3 + 1.5 * (q3 - q1)), q3), 6) AS whisker_high
    FROM q JOIN {src} l ON l.{by} = q.{by} GROUP BY q.{by}, q1, med, q3, mean, q.n"""
BOX_COLUMNS = ("q1", "med", "q3", "mean", "whisker_low", "whisker_high")


@query("box_stats", "WITH l0 AS ("
       + " UNION ALL ".join(f"SELECT bands, {c} AS score FROM fx_scores" for c in SCORE_COLUMNS)
       + "), " + BOX_SQL.format(by="bands", v="score", src="l0"))
def _(t):
    long = unpivot_columns(t.view("fx_scores"), ["bands"], SCORE_COLUMNS, "score_kind", "score")
    return rounded(stats.box_stats(long, ["bands"], "score"), 6, *BOX_COLUMNS)


@query("box_stats_events", "WITH e0 AS (SELECT event_type, value FROM events), "
       + BOX_SQL.format(by="event_type", v="value", src="e0"))
def _(t):
    return rounded(stats.box_stats(t.raw("events"), ["event_type"], "value"), 6, *BOX_COLUMNS)


@query("accuracy", """
    SELECT round(avg((label = prediction)::int), 6) AS accuracy, count(*) AS n FROM fx_predictions""")
def _(t):
    return rounded(stats.accuracy(t.view("fx_predictions")), 6, "accuracy")


@query("confusion_matrix", "SELECT label, " + ", ".join(
    f"count(*) FILTER (prediction = {p}) AS predicted_{p}" for p in range(1, 8)) + " FROM fx_predictions GROUP BY label")
def _(t):
    return stats.confusion_matrix(t.view("fx_predictions"), list(range(1, 8)))


@query("cv_summary", """
    SELECT target, round(avg(scores_cross_val), 6) AS mean_score, round(stddev_pop(scores_cross_val), 6) AS std_score
    FROM fx_scores GROUP BY target""")
def _(t):
    return rounded(stats.cv_summary(t.view("fx_scores"), ["target"], "scores_cross_val"), 6, "mean_score", "std_score")
