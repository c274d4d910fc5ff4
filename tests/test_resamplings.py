"""Work that the eleven fits of a model share."""

import numpy as np
import pandas as pd
import pytest

from fieldlens.operators import knn, models, newton, softmax, svm


def overlapping(n, seed=3):
    rng = np.random.default_rng(seed)
    label = rng.choice(3, n, p=[0.6, 0.3, 0.1])
    return pd.DataFrame(np.round(rng.normal(size=(n, 2)) + np.array([[0, 0], [1.5, 0], [0, 1.5]])[label], 1), columns=["a", "b"]).assign(
        key=np.arange(n), class_no=label, is_train=rng.random(n) < 0.8, fold_s=rng.integers(0, 5, n), fold_c=np.arange(n) * 5 // n)


def test_one_search_finds_the_neighbours_of_all_fits(spark, monkeypatch):
    frame = overlapping(500)
    frame.loc[490:, "key"] = [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]  # keys may repeat
    df = spark.createDataFrame(frame).cache()
    fits = [("holdout", 0), ("fold_s", 2), ("fold_c", 0), ("fold_c", 4)]
    searches = []
    placed = knn._placed
    monkeypatch.setattr(knn, "_placed", lambda *a, **k: searches.append(1) or placed(*a, **k))
    monkeypatch.setattr(knn, "VIEW_POOL", 3)
    monkeypatch.setattr(knn, "VIEW_LEAF_ROWS", 8)
    monkeypatch.setattr(knn.knn_predict_views, "__defaults__", (5, 60, 7))
    got = models.confusion_counts(df, "KNeighbors", ["a", "b"], "key", fits).toPandas()
    assert len(searches) == 1
    want = []
    for scheme, fold in fits:
        chosen, scored = models.fit_plan(scheme, fold)
        for part, rows in [(scheme, scored)] + ([("train", chosen)] if scheme == "holdout" else []):
            guesses = knn.knn_predict(df.where(chosen), df.where(rows), ["a", "b"], "key", "class_no")
            counts = df.where(rows).select("key", "class_no").join(guesses, "key").groupBy("class_no", "prediction").count().collect()
            want += [(part, fold, float(r["class_no"]), float(r["prediction"]), r["count"]) for r in counts]
    columns = ["scheme", "fold", "class_no", "prediction", "n"]
    assert sorted(got[columns].itertuples(index=False, name=None)) == sorted(want)


LIMITS = {"squared_hinge": 5, "logistic": 4, "softmax": 4, "absolute": 4}


@pytest.mark.parametrize("fit", LIMITS)
def test_passes_over_all_rows_start_near_the_end(spark, monkeypatch, fit):
    frame = overlapping(3000)
    narrow = newton.narrow_samples(spark.createDataFrame(frame), ["a", "b"], None)

    def fitted():
        if fit in ("softmax", "absolute"):
            return softmax.fit_softmax(narrow, ["a", "b"], 3, absolute=fit == "absolute", C=0.1)
        return newton.fit_linear(narrow, ["a", "b"], 3, loss=fit, C=0.1)

    want, sent, passed = fitted(), [], newton._passed  # a task holds all rows
    monkeypatch.setattr(newton, "ROWS_PER_TASK", 1000)
    monkeypatch.setattr(newton, "START_ROWS", 2000, raising=False)
    monkeypatch.setattr(newton, "_passed", lambda *a: sent.append(1) or passed(*a))
    got = fitted()
    assert 0 < len(sent) <= LIMITS[fit]
    for key, weights in want.weights.items():
        # only differences between the classes of one objective are known
        centre = (lambda w: w - w.mean(axis=2, keepdims=True)) if fit in ("softmax", "absolute") else (lambda w: w)
        assert np.abs(centre(got.weights[key]) - centre(weights)).max() < 1e-5


def test_kernel_rows_are_made_when_asked_for():
    rows = np.random.default_rng(4).normal(size=(200, 3))
    for gamma in (None, 0.4):
        kernel = svm.KernelRows(rows, gamma)
        assert np.abs(kernel[7] - svm.kernel_block(rows[7:8], rows, gamma)[0]).max() < 1e-12
        assert len(kernel.held) == 1


def test_problems_of_fewer_parts_meet_in_their_own(spark):
    frame = overlapping(800)
    narrow = newton.narrow_samples(spark.createDataFrame(frame), ["a", "b"], None)
    whole = svm.fit_kernel(narrow, ["a", "b"], 3, C=2.0, part_rows=800)
    parts = svm.fit_kernel(narrow, ["a", "b"], 3, C=2.0, part_rows=15)
    rows = frame[["a", "b"]].to_numpy()
    for scheme, fold in models.all_fits():
        assert (whole.predict(scheme, fold, rows) == parts.predict(scheme, fold, rows)).mean() > 0.995
