import numpy as np
import pandas as pd
import pytest

from fieldlens.operators import models


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(8)
    label = np.arange(90) % 3 + 1
    data = pd.DataFrame(rng.normal(size=(90, 2)) + label[:, None] * 6, columns=["a", "b"]).assign(key=range(90), y=label)
    return spark.createDataFrame(data)


def test_separable_classes_are_found(blobs):
    names = ["KNeighbors", "L2 logistic (Multinomial)", "DecisionTreeClassifier (entropy)"]
    counts = models.compare_models(blobs, ["a", "b"], "y", "key", "key", models=names, fits=[("holdout", 0), ("fold_s", 2)])
    scores = models.fold_scores(counts).toPandas()
    assert len(scores) == 9 and scores["score"].between(0, 1).all()
    assert scores[scores.scheme == "holdout"]["score"].min() > 0.9


def test_three_scores_of_one_model(blobs):
    counts = models.compare_models(blobs, ["a", "b"], "y", "key", "key", models=["DecisionTreeClassifier (entropy)"])
    row = models.score_table(models.fold_scores(counts)).first()
    assert all(0 <= row[c] <= 1 for c in ("scores_stratified_KFold", "scores_cross_val", "accuracy_score"))


def test_unfinished_fits_raise(blobs, monkeypatch):
    monkeypatch.setattr(models.newton.run_passes, "__defaults__", (1,))
    with pytest.raises(Exception, match="open after 1 passes"):
        models.compare_models(blobs, ["a", "b"], "y", "key", "key", models=["L2 logistic (Multinomial)"], fits=[("holdout", 0)])


def test_missing_features_raise(blobs):
    holed = blobs.selectExpr("CASE WHEN key = 3 THEN NULL ELSE a END AS a", "b", "key", "y")
    with pytest.raises(ValueError, match="1 labelled rows"):
        models.compare_models(holed, ["a", "b"], "y", "key", "key", models=["KNeighbors"])


def test_model_list():
    assert len(models.MODELS) == 13 and len(models.all_fits()) == 11
