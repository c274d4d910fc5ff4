"""The dual solver beside the conditions it has to meet, and cascades beside the solution of all rows."""

import numpy as np
import pandas as pd
import pytest

from fieldlens.operators import newton, svm


def clouds(seed, n, apart):
    rng = np.random.default_rng(seed)
    signs = rng.choice([-1.0, 1.0], n)
    return rng.normal(size=(n, 3)) * [1, 2, 0.5] + signs[:, None] * apart, signs


@pytest.mark.parametrize("gamma", [None, 0.3, 5.0])
@pytest.mark.parametrize("apart", [0.2, 1.0, 4.0])
@pytest.mark.parametrize("cells", [16_000_000, 500])
def test_dual_gap_closes(monkeypatch, gamma, apart, cells):
    monkeypatch.setattr(svm, "KERNEL_CELLS", cells)
    rows, signs = clouds(int(apart * 10), 150, apart)
    alpha, bias = svm.solve_dual(rows, signs, 10.0, gamma)
    assert (alpha >= 0).all() and (alpha <= 10).all() and abs((alpha * signs).sum()) < 1e-8
    assert svm.dual_gap(rows, signs, 10.0, gamma, alpha, bias) < 1e-4
    # from another start the same classifier is found
    again, other = svm.solve_dual(rows, signs, 10.0, gamma, start=np.random.default_rng(1).uniform(0, 10, 150))
    values = [svm.kernel_block(rows, rows, gamma) @ (a * signs) + b for a, b in ((alpha, bias), (again, other))]
    assert np.abs(values[0] - values[1]).max() < 1e-2


def test_one_sided_rows():
    alpha, bias = svm.solve_dual(np.ones((3, 2)), np.ones(3), 1.0)
    assert (alpha == 0).all() and bias == 1.0


@pytest.mark.parametrize("kernel", ["rbf", "linear"])
def test_merged_parts_equal_the_solution_of_all_rows(spark, kernel):
    rng = np.random.default_rng(9)
    n = 360
    label = np.arange(n) % 3
    frame = pd.DataFrame(rng.normal(size=(n, 2)) + np.array([[0, 0], [1.8, 0], [0, 1.8]])[label], columns=["a", "b"]).assign(
        class_no=label, is_train=rng.random(n) < 0.8, fold_s=rng.integers(0, 5, n), fold_c=np.arange(n) * 5 // n)
    narrow = newton.narrow_samples(spark.createDataFrame(frame), ["a", "b"], None)
    fits = svm.fit_kernel(narrow, ["a", "b"], 3, C=2.0, kernel=kernel, part_rows=30)
    rows, train = frame[["a", "b"]].to_numpy(), frame["is_train"].to_numpy()
    for scheme, fold in (("holdout", 0), ("fold_s", 3)):
        mine = newton.in_training(frame, scheme, fold)
        x = rows[mine]
        gamma = 1 / (2 * x.var()) if kernel == "rbf" else None
        votes = np.zeros((n, 3))
        for a, b in ((0, 1), (0, 2), (1, 2)):
            pair = mine & np.isin(label, (a, b))
            signs = np.where(label[pair] == a, 1.0, -1.0)
            alpha, bias = svm.solve_dual(rows[pair], signs, 2.0, gamma)
            value = svm.kernel_block(rows, rows[pair], gamma) @ (alpha * signs) + bias
            vectors, weights, own_bias, own_gamma = fits.parts[scheme, fold, a, b]
            assert np.abs(svm.kernel_block(rows, vectors, own_gamma) @ weights + own_bias - value).max() < 5e-3
            votes[np.arange(n), np.where(value > 0, a, b)] += 1
        assert (fits.predict(scheme, fold, rows) == votes.argmax(axis=1)).mean() > 0.995
    assert train.any()


def test_too_many_support_vectors_raise(spark):
    rng = np.random.default_rng(2)
    frame = pd.DataFrame({"a": rng.normal(size=80), "class_no": np.arange(80) % 2, "is_train": True, "fold_s": np.arange(80) % 5, "fold_c": 0})
    with pytest.raises(Exception, match="limit"):
        svm.fit_kernel(newton.narrow_samples(spark.createDataFrame(frame), ["a"], None), ["a"], 2, max_set=20)
