"""The classifiers of the comparison and their three scores.

Three kinds, by what a pass over the rows gives them: linear classifiers whose fits all go through one Newton method
(``newton``, ``softmax``), kernel classifiers solved exactly in the dual (``svm``), and Spark ML's trees. The inverse regularisation
strength C weighs the summed loss.
"""

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from fieldlens.operators import newton, softmax, svm
from fieldlens.operators.knn import knn_predict_views
from fieldlens.operators.resample import balanced_weights, contiguous_folds, stratified_folds, train_test_split
from fieldlens.session import materialize

# Layout only: a small frame is held in few tasks, since every optimiser step is a job.
ROWS_PER_TASK = 100_000
FOLDS = 5


LABEL = "class_no"
# Candidate thresholds of a feature in trees that grow out: quantiles, exact up to so many distinct values.
TREE_BINS = 1_024


# One against the rest, all fits and classes in one Newton method.
LINEAR = {
    "LinearSVC": {"loss": "squared_hinge", "C": 1.0},
    "LinearSVC modified": {"loss": "squared_hinge", "C": 2.0, "balanced": True},
    "L2 logistic (OvR)": {"loss": "logistic", "C": 10.0, "penalise_bias": False},
    "logistic": {"loss": "logistic", "C": 1.0},
}
# All classes in one objective.
SOFTMAX = {
    "L1 logistic": {"C": 10.0, "absolute": True},
    "L2 logistic (Multinomial)": {"C": 10.0},
}
# Pairs of classes vote.
KERNEL = {
    "SVC (Linear kernel)": {"kernel": "linear", "C": 10.0},
    # differs from the former by a kernel width that a linear kernel does not use
    "SVC (Linear kernel 2)": {"kernel": "linear", "C": 10.0},
    "SVC (rbf kernel)": {"kernel": "rbf", "C": 10.0},
}
# Spark ML's. The names of all four are fixed values.
FITTED = {
    "DecisionTreeClassifier": lambda: DecisionTreeClassifier(maxDepth=30, maxBins=TREE_BINS, seed=7, labelCol=LABEL),
    "DecisionTreeClassifier (entropy)": lambda: DecisionTreeClassifier(impurity="entropy", maxDepth=3, seed=7, labelCol=LABEL),
    "RandomForest Classifier": lambda: RandomForestClassifier(numTrees=100, maxDepth=30, maxBins=TREE_BINS, seed=7, labelCol=LABEL),
}
MODELS = (*LINEAR, *KERNEL, "KNeighbors", *SOFTMAX, *FITTED)
SAME_MODEL = {"SVC (Linear kernel 2)": "SVC (Linear kernel)"}


def class_numbers(df, label):
    """A row per class: the label and its number in the order of the labels. The window holds one row per class."""
    return df.where(F.col(label).isNotNull()).select(label).distinct().withColumn(
        LABEL, (F.row_number().over(Window.orderBy(label)) - 1).cast("double"))


def prepare(df, features, label):
    """Labelled rows with their class number. A row with a missing feature can't be fitted: that raises."""
    known = df.where(F.col(label).isNotNull())
    missing = known.where(reduce(lambda a, b: a | b, [F.col(f).isNull() for f in features])).count()
    if missing:
        raise ValueError(f"{missing} labelled rows lack a feature; fill or drop them first")
    return known.join(class_numbers(df, label), label)


def with_splits(df, label, id_column, order_column=None, seed=7):
    """Adds is_train, fold_s (shuffled) and fold_c (contiguous); folds are for training rows only."""
    split = materialize(train_test_split(df, id_column, 0.75, seed), "split")
    train = split.where("is_train")
    train = stratified_folds(train, label, id_column, FOLDS, seed, out="fold_s")
    train = contiguous_folds(train, label, id_column, order_column, FOLDS, out="fold_c")
    none = F.lit(None).cast("int")
    test = split.where(~F.col("is_train")).withColumns({"fold_s": none, "fold_c": none})
    return train.unionByName(test)


def fit_plan(scheme, fold):
    """(training filter, scoring filter) of one fit."""
    if scheme == "holdout":
        return "is_train", "NOT is_train"
    return f"is_train AND {scheme} <> {fold}", f"is_train AND {scheme} = {fold}"


def all_fits():
    return [("holdout", 0)] + [(s, i) for s in ("fold_s", "fold_c") for i in range(FOLDS)]


def _predictor(name, train):
    """Function from rows to their predictions, fitted on ``train``."""
    return FITTED[name]().fit(train).transform


COUNTS = "scheme string, fold int, class_no double, prediction double, n bigint"


def scored_counts(rows, columns, predict, fits):
    """(scheme, fold, class_no, prediction, n) of the rows of ``newton.narrow_samples`` in one pass; ``predict`` (broadcast): function from
    scheme, fold and a matrix to the classes. A task hands on a row per fit and pair of classes."""
    parts = list(fits) + [("train", fold) for scheme, fold in fits if scheme == "holdout"]

    def count(frames):
        found = None
        for frame in frames:
            made = []
            for scheme, fold in parts:
                scored = frame[newton.scored_rows(frame, scheme, fold)]
                if len(scored):
                    guesses = predict.value(scheme, fold, scored[list(columns)].to_numpy(dtype=float))
                    made.append(pd.DataFrame({"scheme": scheme, "fold": fold, "class_no": scored["class_no"].to_numpy(dtype=float),
                                              "prediction": np.asarray(guesses, dtype=float), "n": 1}))
            every = pd.concat([*([] if found is None else [found]), *made]) if made or found is not None else None
            found = None if every is None else every.groupby(["scheme", "fold", "class_no", "prediction"], as_index=False)["n"].sum()
        if found is not None:
            yield found

    return rows.mapInPandas(count, COUNTS).groupBy("scheme", "fold", "class_no", "prediction").agg(F.sum("n").alias("n"))


class _Linear:
    def __init__(self, fitted):
        self.fitted = fitted

    def __call__(self, scheme, fold, rows):
        return self.fitted.scores("", scheme, fold, np.concatenate([np.ones((len(rows), 1)), rows], axis=1))[:, 0].argmax(axis=1)


def _all_at_once(df, name, features, fits):
    """Counts of a linear or kernel classifier, all of whose fits are found together."""
    rows = newton.narrow_samples(df, features, None)
    n_classes = int(df.agg(F.max(LABEL)).first()[0] or 0) + 1
    if name in LINEAR:
        predict = _Linear(newton.fit_linear(rows, features, n_classes, folds=FOLDS, **LINEAR[name]))
    elif name in SOFTMAX:
        predict = _Linear(softmax.fit_softmax(rows, features, n_classes, folds=FOLDS, **SOFTMAX[name]))
    else:
        predict = svm.fit_kernel(rows, features, n_classes, folds=FOLDS, **KERNEL[name]).predict
    return scored_counts(rows, features, df.sparkSession.sparkContext.broadcast(predict), fits)


def _neighbour_counts(df, features, id_column, fits):
    """Counts of the nearest neighbours: all fits learn from the training rows but for a fold, so one search serves them."""
    schemes = [None] * any(scheme == "holdout" for scheme, _ in fits) + [s for s in newton.SCHEMES if any(scheme == s for scheme, _ in fits)]
    part = [F.col("is_train").cast("int") if s is None else F.when(F.col("is_train") & F.col(s).isin([f for scheme, f in fits if scheme == s]), F.col(s))
            for s in schemes]
    rows = df.select(id_column, LABEL, *features, "is_train", *newton.SCHEMES, *[p.alias(f"_part{v}") for v, p in enumerate(part)])
    found = knn_predict_views(rows.where("is_train"), rows, features, id_column, LABEL, [(f"_part{v}", s) for v, s in enumerate(schemes)])
    asked = reduce(lambda a, b: a.unionByName(b), [
        rows.where(f"_part{v} IS NOT NULL").select(id_column, LABEL, F.lit(v).alias("view"), F.col(f"_part{v}").alias("part")) for v in range(len(schemes))])
    view, part = F.col("view"), F.col("part")
    scheme = F.element_at(F.array(*[F.lit(s or "") for s in schemes]), view + 1)
    whole = scheme == ""
    return asked.join(found, [id_column, "view", "part"]).groupBy(
        F.when(whole & (part == 0), "holdout").when(whole, "train").otherwise(scheme).alias("scheme"), F.when(whole, 0).otherwise(part).alias("fold"),
        F.col(LABEL).cast("double").alias(LABEL), F.col("prediction").cast("double").alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def confusion_counts(df, name, features, id_column, fits=None, parallelism=8):
    """(model, scheme, fold, class_no, prediction, n) for the fits of one model, written to the shared folder.

    Scheme ``train`` scores the hold-out fit on the rows it was trained on. The fits of linear and kernel classifiers and of the nearest neighbours are
    found together; those of trees are independent jobs that run side by side.
    """
    fits = fits or all_fits()
    if name == "KNeighbors":
        return materialize(_neighbour_counts(df, features, id_column, fits).withColumn("model", F.lit(name)), "confusion")
    if name not in FITTED:
        return materialize(_all_at_once(df, name, features, fits).withColumn("model", F.lit(name)), "confusion")

    def run(fit):
        scheme, fold = fit
        chosen, scored = fit_plan(scheme, fold)
        predict = _predictor(name, df.where(chosen))
        parts = [(scheme, scored)] + ([("train", chosen)] if scheme == "holdout" else [])
        return [predict(df.where(rows)).groupBy(F.col(LABEL).cast("double").alias(LABEL), F.col("prediction").cast("double").alias("prediction")).agg(
            F.count(F.lit(1)).alias("n")).select(F.lit(part).alias("scheme"), F.lit(fold).alias("fold"), LABEL, "prediction", "n")
                for part, rows in parts]

    with ThreadPoolExecutor(parallelism) as pool:
        counts = [part for found in pool.map(run, fits) for part in found]
    return materialize(reduce(lambda a, b: a.unionByName(b), counts).withColumn("model", F.lit(name)), "confusion")


def fold_scores(counts):
    """Share of correct predictions per fit."""
    return counts.groupBy("model", "scheme", "fold").agg(
        (F.sum(F.when(F.col(LABEL) == F.col("prediction"), F.col("n")).otherwise(0)) / F.sum("n")).alias("score"))


def score_table(scores, by="model"):
    """One row per model with the three scores, the spread of the folds and the score on the training rows."""
    at = lambda scheme: F.avg(F.when(F.col("scheme") == scheme, F.col("score")))
    return scores.groupBy(by).agg(
        at("fold_s").alias("scores_stratified_KFold"), at("fold_c").alias("scores_cross_val"),
        at("holdout").alias("accuracy_score"),
        F.stddev_pop(F.when(F.col("scheme") == "fold_c", F.col("score"))).alias("cross_val_std"),
        at("train").alias("train_score"))


def split_frame(frame, features, target, id_column="field_id", order_column=None, seed=7):
    """Tested rows with vectors, class numbers, split and folds, kept for the fits that share them."""
    tested = frame.where(F.col(target) > 0)
    columns = tested.select(*dict.fromkeys([id_column, order_column or id_column, target, *features]))
    split = with_splits(prepare(columns, features, target), LABEL, id_column, order_column, seed)
    stored = materialize(split, "split")
    # an iterative fit runs a job per step: a small frame must not be spread over many tasks
    parts = max(1, min(stored.rdd.getNumPartitions(), -(-stored.count() // ROWS_PER_TASK)))
    vector = array_to_vector(F.array(*[F.col(f).cast("double") for f in features]))
    return stored.coalesce(parts).withColumn("features", vector).persist(StorageLevel.MEMORY_AND_DISK)


def compare_models(frame, features, target="carbon_rating", id_column="field_id", order_column=None, models=None,
                   fits=None, seed=7, parallelism=8):
    """All models on one split and one set of folds: confusion counts per model and fit."""
    data = split_frame(frame, features, target, id_column, order_column, seed)
    try:
        names = list(models or MODELS)
        fitted = list(dict.fromkeys(SAME_MODEL.get(name, name) for name in names))
        with ThreadPoolExecutor(4) as pool:
            parts = dict(zip(fitted, pool.map(
                lambda name: confusion_counts(data, name, features, id_column, fits, parallelism), fitted)))
        return reduce(lambda a, b: a.unionByName(b), [
            parts[SAME_MODEL.get(name, name)].withColumn("model", F.lit(name)) for name in names])
    finally:
        data.unpersist()
