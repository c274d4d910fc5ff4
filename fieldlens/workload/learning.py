"""Splits, folds, neighbours, classifiers and the band search."""

import numpy as np
from pyspark.sql import functions as F

from fieldlens.constants import QUICKLOOK_BANDS, SCORE_COLUMNS, SEARCH_BANDS, TARGETS
from fieldlens.operators import band_search, knn, models, newton, resample, stats
from fieldlens.operators.tables import analysis_frame, attach_soil
from fieldlens.plans.survey import band_means_at_survey
from fieldlens.session import materialize
from fieldlens.workload.registry import query, rounded

FEATURES = [f"f{i}" for i in range(1, 13)]

# --- SQL of the splits ------------------------------------------------------

SPLIT = """split AS (SELECT *, row_number() OVER (ORDER BY md5(concat('7|', vec_id)), vec_id)
                                <= floor(0.75 * count(*) OVER ()) AS is_train FROM fx_samples)"""


def folds_sql(name, source, order):
    """Positions in the class-sorted order, modulo 5, dealt to the rows of the class in ``order``."""
    return f"""
        {name}_c AS (SELECT label, min(vec_id) AS first_id FROM {source} GROUP BY label),
        {name}_p AS (SELECT label, (row_number() OVER (ORDER BY first_id, vec_id) - 1) % 5 AS m
                     FROM {source} JOIN {name}_c USING (label)),
        {name}_d AS (SELECT label, m, row_number() OVER (PARTITION BY label ORDER BY m) AS r FROM {name}_p),
        {name} AS (SELECT s.vec_id, cast(d.m AS int) AS fold
                   FROM (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY {order}) AS r FROM {source}) s
                   JOIN {name}_d d ON d.label = s.label AND d.r = s.r)"""


@query("train_test_split", f"WITH {SPLIT} SELECT vec_id, label, is_train FROM split")
def _(t):
    return resample.train_test_split(t.view("fx_samples").select("vec_id", "label"), "vec_id")


@query("stratified_folds", f"""
    WITH {folds_sql('fs', 'fx_samples', "md5(concat('7|', vec_id)), vec_id")}
    SELECT s.vec_id, s.label, fs.fold FROM fx_samples s JOIN fs USING (vec_id)""")
def _(t):
    return resample.stratified_folds(t.view("fx_samples").select("vec_id", "label"), "label", "vec_id")


@query("contiguous_folds", f"""
    WITH {folds_sql('fc', 'fx_samples', 'vec_id')}
    SELECT s.vec_id, s.label, fc.fold FROM fx_samples s JOIN fc USING (vec_id)""")
def _(t):
    return resample.contiguous_folds(t.view("fx_samples").select("vec_id", "label"), "label", "vec_id")


@query("balanced_weights", """
    WITH m AS (SELECT label, count(*) AS m FROM fx_samples GROUP BY label)
    SELECT vec_id, label, round((SELECT count(*) FROM fx_samples) / ((SELECT count(*) FROM m) * m.m)::double, 6) AS weight
    FROM fx_samples JOIN m USING (label)""")
def _(t):
    return rounded(resample.balanced_weights(t.view("fx_samples").select("vec_id", "label"), "label"), 6, "weight")


DISTANCE = " + ".join(f"(a.{f} - b.{f}) * (a.{f} - b.{f})" for f in FEATURES)


@query("knn", f"""
    WITH {SPLIT},
         d AS (SELECT a.vec_id, a.label, b.label AS vote, row_number() OVER (PARTITION BY a.vec_id ORDER BY {DISTANCE}, b.vec_id) AS r
               FROM split a JOIN split b ON NOT a.is_train AND b.is_train),
         v AS (SELECT vec_id, label, vote, count(*) AS n FROM d WHERE r <= 5 GROUP BY ALL)
    SELECT vec_id, label, prediction FROM (
        SELECT vec_id, label, vote AS prediction, row_number() OVER (PARTITION BY vec_id ORDER BY n DESC, vote) AS k FROM v) WHERE k = 1""")
def _(t):
    split = materialize(resample.train_test_split(t.view("fx_samples"), "vec_id"), "split")
    test = split.where("NOT is_train")
    guesses = knn.knn_predict(split.where("is_train"), test, FEATURES, "vec_id")
    return test.select("vec_id", "label").join(guesses, "vec_id")


# --- classifiers on the surveyed fields -------------------------------------

def learning_frame(t, bands):
    """Surveyed fields with ratings and a numeric id, written once for the jobs that follow."""
    fields = t.fields.select("field_id", "field_key", "survey_date")
    survey = band_means_at_survey(fields, t.products, t.pixels, bands)
    frame = analysis_frame(attach_soil(survey, t.ratings))
    return materialize(frame.select("field_id", "field_key", *bands, *TARGETS), "frame")


# Classes that an SQL rule over all rows of a table tells apart by a wide margin: a classifier that is right must give the
# rule back, in every fold. Ratings are 1, 2 and 3; the centres form a triangle, so each class is also linearly apart.
MARGIN_FEATURES = ("m1", "m2", "m3", "m4")
MARGIN_SPLIT = SPLIT.replace("fx_samples", "fx_margin")
MARGIN_SQL = f"""
    WITH {MARGIN_SPLIT}, tr AS (SELECT * FROM split WHERE is_train),
         {folds_sql('fs', 'tr', "md5(concat('7|', vec_id)), vec_id")}, {folds_sql('fc', 'tr', 'vec_id')},
         fits AS (
             SELECT 'holdout' AS scheme, 0 AS fold, label FROM split WHERE NOT is_train
             UNION ALL SELECT 'train', 0, label FROM tr
             UNION ALL SELECT 'fold_s', fold, label FROM tr JOIN fs USING (vec_id)
             UNION ALL SELECT 'fold_c', fold, label FROM tr JOIN fc USING (vec_id))"""


def margin_counts(t, names):
    """Confusion counts of models over all their fits."""
    frame = t.view("fx_margin").select("vec_id", F.col("label").alias("rating"), *MARGIN_FEATURES)
    return models.compare_models(frame, MARGIN_FEATURES, "rating", "vec_id", "vec_id", models=names).select(
        "model", "scheme", "fold", "class_no", "prediction", "n")


def _register_model(key, name):
    @query(key, MARGIN_SQL + f"""
    SELECT '{name}' AS model, scheme, cast(fold AS int) AS fold, label - 1.0E0 AS class_no, label - 1.0E0 AS prediction, count(*) AS n
    FROM fits GROUP BY ALL""")
    def _(t):
        return margin_counts(t, [name])


MODEL_KEYS = {
    "linear_svc": "LinearSVC", "linear_svc_balanced": "LinearSVC modified", "svc_linear_c10": "SVC (Linear kernel)",
    "svc_linear_c10_g10": "SVC (Linear kernel 2)", "svc_rbf": "SVC (rbf kernel)", "logistic_l1": "L1 logistic",
    "logistic_l2": "L2 logistic (Multinomial)", "logistic_ovr": "L2 logistic (OvR)", "logistic_default": "logistic",
    "decision_tree": "DecisionTreeClassifier", "decision_tree_entropy": "DecisionTreeClassifier (entropy)",
    "random_forest": "RandomForest Classifier", "knn_model": "KNeighbors",
}
for _key, _name in MODEL_KEYS.items():
    _register_model(_key, _name)

ALL_MODELS_SQL = ", ".join(f"('{name}')" for name in MODEL_KEYS.values())


def every_model(t):
    return margin_counts(t, list(MODEL_KEYS.values()))


@query("cross_validate", MARGIN_SQL + f"""
    SELECT m.model, scheme, cast(fold AS int) AS fold, 1.0E0 AS score
    FROM (SELECT DISTINCT scheme, fold FROM fits) f, (VALUES {ALL_MODELS_SQL}) m(model)""")
def _(t):
    """Score of every model in every fit."""
    return models.fold_scores(every_model(t))


@query("compare_models", f"""
    SELECT model, 1.0E0 AS scores_stratified_KFold, 1.0E0 AS scores_cross_val, 1.0E0 AS accuracy_score, 0.0E0 AS cross_val_std, 1.0E0 AS train_score
    FROM (VALUES {ALL_MODELS_SQL}) m(model)""")
def _(t):
    """The three scores, their spread and the training score of all models."""
    return models.score_table(models.fold_scores(every_model(t)))


# Classes that overlap: each one against the rest by one feature and a bias, to the coefficients. The SQL takes Newton's steps.
NEWTON_SUMS = {
    "squared_hinge": ("greatest(0, 1 - y * (b + w * x))", "-2 * y * {0}", "CASE WHEN {0} > 0 THEN 2 ELSE 0 END"),
    "logistic": ("1 / (1 + exp(y * (b + w * x)))", "-y * {0}", "{0} * (1 - {0})"),
}


def _coefficients_sql():
    parts = []
    for loss, (inner, first, second) in NEWTON_SUMS.items():
        first, second = first.format("m"), second.format("m")
        parts.append(f"""
        {loss} AS (
            SELECT feature, c, 0 AS i, 0.0E0 AS b, 0.0E0 AS w FROM kinds
            UNION ALL
            SELECT feature, c, i + 1, b - (hww * gb - hbw * gw) / (hbb * hww - hbw * hbw), w - (hbb * gw - hbw * gb) / (hbb * hww - hbw * hbw)
            FROM (SELECT feature, c, i, b, w, b + sum({first}) AS gb, w + sum(({first}) * x) AS gw, 1 + sum({second}) AS hbb,
                         sum(({second}) * x) AS hbw, 1 + sum(({second}) * x * x) AS hww
                  FROM (SELECT *, {inner} AS m
                        FROM (SELECT s.*, d.x, CASE WHEN d.label = s.c THEN 1 ELSE -1 END AS y FROM {loss} s JOIN d ON d.feature = s.feature AND s.i < 40) j) k
                  GROUP BY feature, c, i, b, w) t)""")
    listed = " UNION ALL ".join(f"SELECT '{f}' AS feature, {f} AS x, label FROM split WHERE is_train" for f in FEATURES)
    picked = " UNION ALL ".join(
        f"SELECT '{loss}' AS loss, feature, c AS class_no, round(b, 6) AS bias, round(w, 6) AS weight FROM {loss} WHERE i = 40" for loss in NEWTON_SUMS)
    return f"""WITH RECURSIVE {SPLIT}, d AS ({listed}),
        kinds AS (SELECT feature, label AS c FROM d GROUP BY ALL), {', '.join(parts)} {picked}"""


@query("linear_coefficients", _coefficients_sql())
def _(t):
    """Bias and weight of every class and single feature under both losses, from one Newton method over all of them."""
    split = resample.train_test_split(t.view("fx_samples"), "vec_id").withColumns(
        {"class_no": F.col("label"), "fold_s": F.lit(None).cast("int"), "fold_c": F.lit(None).cast("int")})
    samples = newton.narrow_samples(split, FEATURES, None)
    n_classes, rows = band_search.class_count(samples), []
    for loss in NEWTON_SUMS:
        fitted = newton.fit_linear(samples, FEATURES, n_classes, loss, masks=np.eye(len(FEATURES)), folds=0)
        (weights,), (live,) = fitted.weights.values(), fitted.live.values()
        rows += [(loss, f, int(c), round(float(weights[i, 0, c]), 6), round(float(weights[i, i + 1, c]), 6))
                 for i, f in enumerate(FEATURES) for c in np.flatnonzero(live)]
    return t.spark.createDataFrame(rows, "loss string, feature string, class_no int, bias double, weight double")


@query("cross_validate_fields")
def _(t):
    """Scores of a tree on the surveyed fields, whose classes nothing tells apart for certain."""
    frame = learning_frame(t, QUICKLOOK_BANDS)
    counts = models.compare_models(
        frame, QUICKLOOK_BANDS, order_column="field_key", models=["DecisionTreeClassifier (entropy)"])
    return models.fold_scores(counts)


# --- band search ------------------------------------------------------------

def gram_samples(t):
    """Embeddings as samples of one target, with split and folds."""
    base = t.view("fx_samples").withColumns({"target": F.lit("label"), "class_no": F.col("label")})
    split = resample.train_test_split(base, "vec_id")
    train = resample.stratified_folds(split.where("is_train"), "class_no", "vec_id", out="fold_s")
    train = resample.contiguous_folds(train, "class_no", "vec_id", out="fold_c")
    none = F.lit(None).cast("int")
    return train.unionByName(split.where("NOT is_train").withColumns({"fold_s": none, "fold_c": none}))


def _gram_sql():
    columns = ["one", *FEATURES]
    products = " UNION ALL ".join(
        f"SELECT is_train, fold_s, fold_c, 'g_{i}_{j}' AS name, sum({a} * {b}) AS value FROM parts GROUP BY ALL"
        for i, a in enumerate(columns) for j, b in enumerate(columns) if i <= j)
    crosses = " UNION ALL ".join(
        f"SELECT is_train, fold_s, fold_c, 'v_{i}_{c}' AS name, sum(CASE WHEN label = {c} THEN {a} ELSE 0 END) AS value FROM parts GROUP BY ALL"
        for i, a in enumerate(columns) for c in range(10))
    return f"""
    WITH {SPLIT}, tr AS (SELECT * FROM split WHERE is_train),
         {folds_sql('fs', 'tr', "md5(concat('7|', vec_id)), vec_id")}, {folds_sql('fc', 'tr', 'vec_id')},
         parts AS (SELECT split.*, 1.0E0 AS one, fs.fold AS fold_s, fc.fold AS fold_c FROM split
                   LEFT JOIN fs ON fs.vec_id = split.vec_id LEFT JOIN fc ON fc.vec_id = split.vec_id)
    SELECT is_train, fold_s, fold_c, name, round(value, 6) AS value FROM ({products} UNION ALL {crosses})"""


@query("band_gram", _gram_sql())
def _(t):
    sums = band_search.gram_sums(gram_samples(t), FEATURES, 10).drop("target")
    names = [c for c in sums.columns if c[:2] in ("g_", "v_")]
    return rounded(sums.unpivot(["is_train", "fold_s", "fold_c"], names, "name", "value"), 6, "value")


def search_samples(t):
    frame = learning_frame(t, SEARCH_BANDS)
    return materialize(band_search.search_samples(frame, SEARCH_BANDS, TARGETS, order_column="field_key"), "samples")


@query("band_search")
def _(t):
    return band_search.band_search(search_samples(t))


@query("band_search_hinge")
def _(t):
    return band_search.band_search(search_samples(t), solver="hinge")


def _few_sets_sql():
    """Three feature sets: Newton's steps of every fit and class by Cramer's rule, then the scores."""
    fits = ", ".join(f"('{scheme}', {fold})" for scheme, fold in models.all_fits())
    learns = "p.is_train AND (t.scheme = 'holdout' OR (t.scheme = 'fold_s' AND p.fold_s <> t.fold) OR (t.scheme = 'fold_c' AND p.fold_c <> t.fold))"
    scored = "(t.scheme = 'holdout' AND NOT p.is_train) OR (t.scheme = 'fold_s' AND p.fold_s = t.fold) OR (t.scheme = 'fold_c' AND p.fold_c = t.fold)"
    det = "(a * (d * f - e * e) - b * (b * f - c * e) + c * (b * e - c * d))"
    return f"""
    WITH RECURSIVE {SPLIT}, tr AS (SELECT * FROM split WHERE is_train),
         {folds_sql('fs', 'tr', "md5(concat('7|', vec_id)), vec_id")}, {folds_sql('fc', 'tr', 'vec_id')},
         parts AS (SELECT split.*, fs.fold AS fold_s, fc.fold AS fold_c FROM split
                   LEFT JOIN fs ON fs.vec_id = split.vec_id LEFT JOIN fc ON fc.vec_id = split.vec_id),
         fits(scheme, fold) AS (VALUES {fits}),
         sets(bands, n_bands, m1, m2) AS (VALUES ('f1', 1, 1, 0), ('f2', 1, 0, 1), ('f1 f2', 2, 1, 1)),
         learnt AS (SELECT t.scheme, t.fold, s.bands, p.label, p.f1 * s.m1 AS x1, p.f2 * s.m2 AS x2 FROM parts p, fits t, sets s WHERE {learns}),
         steps AS (
             SELECT scheme, fold, bands, label AS k, 0 AS i, 0.0E0 AS w0, 0.0E0 AS w1, 0.0E0 AS w2 FROM learnt GROUP BY ALL
             UNION ALL
             SELECT scheme, fold, bands, k, i + 1,
                    w0 - (g0 * (d * f - e * e) - b * (g1 * f - e * g2) + c * (g1 * e - d * g2)) / {det},
                    w1 - (a * (g1 * f - e * g2) - g0 * (b * f - c * e) + c * (b * g2 - g1 * c)) / {det},
                    w2 - (a * (d * g2 - g1 * e) - b * (b * g2 - g1 * c) + g0 * (b * e - c * d)) / {det}
             FROM (SELECT scheme, fold, bands, k, i, w0, w1, w2, w0 - 2 * sum(y * m) AS g0, w1 - 2 * sum(y * m * x1) AS g1, w2 - 2 * sum(y * m * x2) AS g2,
                          1 + 2 * sum(h) AS a, 2 * sum(h * x1) AS b, 2 * sum(h * x2) AS c, 1 + 2 * sum(h * x1 * x1) AS d, 2 * sum(h * x1 * x2) AS e,
                          1 + 2 * sum(h * x2 * x2) AS f
                   FROM (SELECT *, greatest(0, 1 - y * (w0 + w1 * x1 + w2 * x2)) AS m, CASE WHEN y * (w0 + w1 * x1 + w2 * x2) < 1 THEN 1 ELSE 0 END AS h
                         FROM (SELECT s.*, l.x1, l.x2, CASE WHEN l.label = s.k THEN 1 ELSE -1 END AS y
                               FROM steps s JOIN learnt l ON l.scheme = s.scheme AND l.fold = s.fold AND l.bands = s.bands AND s.i < 30) j) v
                   GROUP BY scheme, fold, bands, k, i, w0, w1, w2) t),
         guesses AS (
             SELECT t.scheme, t.fold, s.bands, p.label, arg_max(w.k, w.w0 + w.w1 * p.f1 + w.w2 * p.f2) AS guess
             FROM parts p, fits t, sets s, steps w
             WHERE ({scored}) AND w.scheme = t.scheme AND w.fold = t.fold AND w.bands = s.bands AND w.i = 30
             GROUP BY t.scheme, t.fold, s.bands, p.vec_id, p.label),
         scores AS (SELECT scheme, fold, bands, avg(CASE WHEN guess = label THEN 1.0E0 ELSE 0.0E0 END) AS score FROM guesses GROUP BY ALL)
    SELECT 'label' AS target, bands, n_bands, round(avg(score) FILTER (scheme = 'fold_s'), 9) AS scores_stratified_KFold,
           round(avg(score) FILTER (scheme = 'fold_c'), 9) AS scores_cross_val, round(avg(score) FILTER (scheme = 'holdout'), 9) AS accuracy_score,
           'hinge' AS solver
    FROM scores JOIN sets USING (bands) GROUP BY bands, n_bands"""


@query("band_search_few", _few_sets_sql())
def _(t):
    """Scores of a few feature sets on classes that overlap, by the squared-hinge search."""
    found = band_search.band_search(gram_samples(t), FEATURES[:2], 10, solver="hinge")
    return rounded(found, 9, *SCORE_COLUMNS)


@query("best_band_sets")
def _(t):
    return stats.top_band_sets(band_search.band_search(search_samples(t)), SCORE_COLUMNS)
