"""Scores of a linear classifier on every subset of the bands, for several targets.

Two solvers with the same output:

* ``gram`` (least-squares classifier): one aggregate over all rows gives the sums X'X and X'Y per
  target and fold. They are a few thousand numbers whatever the row count, and every subset's model
  is a sub-system of them. A second pass scores the rows where they lie.
* ``hinge`` (squared hinge, one against the rest, bias penalised with the weights): the Newton method of ``newton``, a pass
  over the rows per step for all band sets, fits, classes and targets at once; then one pass to score.

Neither holds the rows anywhere: what grows with the number of band sets is sent around, the rows stay where they are.
"""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from fieldlens.constants import SEARCH_BANDS
from fieldlens.operators import newton
from fieldlens.operators.models import FOLDS, all_fits
from fieldlens.operators.resample import contiguous_folds, stratified_folds, train_test_split
from fieldlens.operators.tables import analysis_long
from fieldlens.session import materialize

SCHEME_SCORES = {"fold_s": "scores_stratified_KFold", "fold_c": "scores_cross_val", "holdout": "accuracy_score"}


def band_subsets(spark, bands=SEARCH_BANDS):
    """Every non-empty subset: id (bit i = band i), bands as list and as text."""
    names = F.array(*[F.lit(b) for b in bands])
    chosen = F.filter(names, lambda b, i: F.getbit(F.col("subset_id"), i) == 1)
    subsets = spark.range(1, 2 ** len(bands)).select(F.col("id").alias("subset_id"), chosen.alias("band_list"))
    return subsets.withColumn("bands", F.array_join("band_list", " ")).withColumn("n_bands", F.size("band_list"))


def gram_sums(samples, bands, n_classes):
    """Sums of products per target and (is_train, fold_s, fold_c) part.

    ``samples``: target, class_no (0, 1, ...), the bands, is_train, fold_s, fold_c. The result has at
    most 26 rows per target.
    """
    columns = ["_one", *bands]
    ones = samples.withColumn("_one", F.lit(1.0))
    aggs = [
        F.sum(F.col(a).cast("double") * F.col(b).cast("double")).alias(f"g_{i}_{j}")
        for i, a in enumerate(columns) for j, b in enumerate(columns) if i <= j
    ] + [
        F.sum(F.when(F.col("class_no") == c, F.col(a).cast("double")).otherwise(0.0)).alias(f"v_{i}_{c}")
        for i, a in enumerate(columns) for c in range(n_classes)
    ]
    return ones.groupBy("target", "is_train", "fold_s", "fold_c").agg(*aggs)


def _systems(rows, n_columns, n_classes):
    """(target, scheme, fold) -> (X'X, X'Y with +1/-1 labels) of that fit's training rows."""
    out = {}
    for target in sorted({r["target"] for r in rows}):
        for scheme, fold in all_fits():
            gram, cross = np.zeros((n_columns, n_columns)), np.zeros((n_columns, n_classes))
            for r in rows:
                if r["target"] != target or not r["is_train"] or (scheme != "holdout" and r[scheme] == fold):
                    continue
                for i in range(n_columns):
                    for j in range(i, n_columns):
                        gram[i, j] += r[f"g_{i}_{j}"]
                    for c in range(n_classes):
                        cross[i, c] += r[f"v_{i}_{c}"]
            gram = gram + np.triu(gram, 1).T
            out[target, scheme, fold] = gram, 2 * cross - gram[:, :1]
    return out


def subset_masks(ids, n_bands):
    bits = (np.asarray(ids)[:, None] >> np.arange(n_bands)[None, :]) & 1
    return np.concatenate([np.ones((len(bits), 1)), bits], axis=1)


def solve_subsets(gram, cross, masks, ridge=1e-9):
    """Weights (subset, column, class) of the sub-systems; columns outside a subset get 0."""
    scale = 1.0 / np.sqrt(np.maximum(np.diag(gram), 1e-300))
    unit = gram * scale[:, None] * scale[None, :]
    right = cross * scale[:, None]
    n = len(unit)
    picked = unit[None] * masks[:, :, None] * masks[:, None, :]
    picked[:, np.arange(n), np.arange(n)] += (1 - masks) + ridge
    return np.linalg.solve(picked, right[None] * masks[:, :, None]) * scale[None, :, None]


def hits_per_subset(rows, labels, weights, live, step=128):
    """Correct predictions per subset over a block of rows. ``live`` = classes seen in training."""
    n_subsets, n_columns, n_classes = weights.shape
    flat = weights.transpose(1, 0, 2).reshape(n_columns, n_subsets * n_classes)
    hits = np.zeros(n_subsets, dtype=np.int64)
    for lo in range(0, len(rows), step):
        scores = (rows[lo:lo + step] @ flat).reshape(-1, n_subsets, n_classes)
        scores[:, :, ~live] = -np.inf
        hits += (scores.argmax(axis=2) == labels[lo:lo + step, None]).sum(axis=0)
    return hits


def _score_rows(frame, target, scheme, fold):
    on = frame["target"] == target
    if scheme == "holdout":
        return frame[on & ~frame["is_train"]]
    return frame[on & frame["is_train"] & (frame[scheme] == fold)]


HIT_SCHEMA = "target string, scheme string, fold int, subset_id bigint, hits bigint, n bigint"


def _hit_frame(target, scheme, fold, ids, hits, n):
    return pd.DataFrame({"target": target, "scheme": scheme, "fold": fold, "subset_id": ids, "hits": hits, "n": n})


def item_subsets(items, name, order):
    """Every non-empty subset of the rows of a small table, named in their order: the list of names is one row, which each
    subset's bits pick from. As subsets are listed in full, a table of some 20 rows is meant."""
    listed = items.groupBy().agg(F.array_sort(F.collect_list(F.struct(*order, F.col(name).alias("_name")))).alias("_items"))
    names = listed.select(F.transform("_items", lambda i: i["_name"]).alias("_names"))
    every = names.select("_names", F.explode(F.expr("sequence(1L, shiftleft(1L, size(_names)) - 1)")).alias("subset_id"))
    chosen = every.withColumn("_list", F.filter("_names", lambda n, i: F.getbit(F.col("subset_id"), i) == 1))
    return chosen.select("subset_id", F.array_join("_list", " ").alias("bands"), F.size("_list").alias("n_bands"))


def class_count(samples):
    """One more than the largest class number of the samples."""
    return (samples.agg(F.max("class_no")).first()[0] or 0) + 1


def search_gram(samples, bands=SEARCH_BANDS, n_classes=None):
    """Hits per target, fit and subset by the least-squares solver."""
    bands, n_classes = list(bands), n_classes or class_count(samples)
    n_columns = len(bands) + 1
    systems = _systems(gram_sums(samples, bands, n_classes).collect(), n_columns, n_classes)
    ids = np.arange(1, 2 ** len(bands))

    def score(frames):
        masks = subset_masks(ids, len(bands))
        solved, totals = {}, {}
        for frame in frames:
            for key, (gram, cross) in systems.items():
                rows = _score_rows(frame, *key)
                if not len(rows):
                    continue
                if key not in solved:
                    # X'Y column of the constant holds (2 * class count - n): a class without rows has -n
                    solved[key] = solve_subsets(gram, cross, masks), cross[0] > -gram[0, 0]
                weights, live = solved[key]
                block = np.concatenate([np.ones((len(rows), 1)), rows[bands].to_numpy(dtype=float)], axis=1)
                hits = hits_per_subset(block, rows["class_no"].to_numpy(), weights, live)
                seen, n = totals.get(key, (0, 0))
                totals[key] = seen + hits, n + len(rows)
        for key, (hits, n) in totals.items():
            yield _hit_frame(*key, ids, hits, n)

    narrow = samples.select("target", "class_no", "is_train", "fold_s", "fold_c", *[F.col(b).cast("double").alias(b) for b in bands])
    return narrow.mapInPandas(score, HIT_SCHEMA)


def search_hinge(samples, bands=SEARCH_BANDS, n_classes=None, C=1.0):
    """Hits per target, fit and subset by the squared-hinge solver; what is broadcast to score is the weights."""
    bands, n_classes = list(bands), n_classes or class_count(samples)
    ids = np.arange(1, 2 ** len(bands))
    narrow = newton.narrow_samples(samples, bands, "target")
    fitted = newton.fit_linear(narrow, bands, n_classes, C=C, masks=subset_masks(ids, len(bands))[:, 1:], folds=FOLDS)
    sent = samples.sparkSession.sparkContext.broadcast((fitted.weights, fitted.live))

    def score(frames):
        weights, live = sent.value
        totals = {}
        for frame in frames:
            for key in weights:
                part = frame[frame["group"] == key[0]]
                rows = part[newton.scored_rows(part, *key[1:])]
                if len(rows) and live[key].any():
                    hits = hits_per_subset(newton.design(rows, bands), rows["class_no"].to_numpy(), weights[key], live[key])
                    seen, n = totals.get(key, (0, 0))
                    totals[key] = seen + hits, n + len(rows)
        for key, (hits, n) in totals.items():
            yield _hit_frame(*key, ids, hits, n)

    return narrow.mapInPandas(score, HIT_SCHEMA)


def subset_scores(hits, subsets, solver):
    """Mean of the fold accuracies per scheme: one row per target and band set."""
    per_fold = hits.groupBy("target", "subset_id", "scheme", "fold").agg((F.sum("hits") / F.sum("n")).alias("score"))
    means = per_fold.groupBy("target", "subset_id").agg(
        *[F.avg(F.when(F.col("scheme") == s, F.col("score"))).alias(name) for s, name in SCHEME_SCORES.items()])
    return means.join(subsets.select("subset_id", "bands", "n_bands"), "subset_id").select(
        "target", "bands", "n_bands", *SCHEME_SCORES.values(), F.lit(solver).alias("solver"))


def band_search(samples, bands=SEARCH_BANDS, n_classes=None, solver="gram", **options):
    search = {"gram": search_gram, "hinge": search_hinge}[solver]
    hits = search(samples, bands, n_classes or class_count(samples), **options)
    return subset_scores(hits, band_subsets(samples.sparkSession, bands), solver)


def search_samples(frame, bands, targets, id_column="field_id", order_column=None, seed=7):
    """Tested rows of every target with split and folds: one long frame, ratings 1..k as class 0..k-1."""
    extra = [order_column] if order_column and order_column != id_column else []
    long = analysis_long(frame.select(id_column, *extra, *targets, *bands), targets)
    for b in bands:
        long = long.where(F.col(b).isNotNull())
    long = long.withColumn("class_no", (F.col("rating") - 1).cast("int"))
    split = materialize(train_test_split(long, id_column, 0.75, seed, by=["target"]), "split")
    train = split.where("is_train")
    train = stratified_folds(train, "class_no", id_column, FOLDS, seed, by=["target"], out="fold_s")
    train = contiguous_folds(train, "class_no", id_column, order_column, FOLDS, by=["target"], out="fold_c")
    none = F.lit(None).cast("int")
    return train.unionByName(split.where(~F.col("is_train")).withColumns({"fold_s": none, "fold_c": none}))
