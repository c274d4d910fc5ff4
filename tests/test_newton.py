"""The Newton method for many problems beside plain solvers of single problems."""

import numpy as np
import pandas as pd
import pytest

from fieldlens.operators import band_search, newton


def plain_hinge(rows, signs, penalty, C, weights):
    """Squared hinge of one problem: Newton steps, each to the exact minimum among its breakpoints."""
    w = np.zeros(rows.shape[1])
    for _ in range(500):
        margins = signs * (rows @ w)
        gap = np.maximum(0, 1 - margins)
        gradient = penalty * w - 2 * C * rows.T @ (weights * signs * gap)
        on = gap > 0
        hessian = np.diag(penalty + 1e-14) + 2 * C * (rows[on] * weights[on, None]).T @ rows[on]
        step = -np.linalg.solve(hessian, gradient)
        if -gradient @ step < 1e-18:
            return w
        along = signs * (rows @ step)
        slope = lambda t: (penalty * (w + t * step) * step).sum() - 2 * C * (weights * np.maximum(0, 1 - margins - t * along) * along).sum()
        with np.errstate(divide="ignore", invalid="ignore"):
            at = (1 - margins) / along
        at = np.concatenate([[0.0], np.sort(at[np.isfinite(at) & (at > 0)])])
        k = max(i for i, t in enumerate(at) if slope(t) <= 0 or i == 0)
        lo, hi = at[k], at[k + 1] if k + 1 < len(at) else at[k] + 2.0
        a, b = slope(lo), slope(hi)
        w = w + (lo if b <= a else lo - a * (hi - lo) / (b - a)) * step
    raise AssertionError("the plain solver did not end")


def plain_logistic(rows, signs, penalty, C, weights):
    w = np.zeros(rows.shape[1])
    value = lambda w: C * (weights * np.logaddexp(0, -signs * (rows @ w))).sum() + 0.5 * (penalty * w * w).sum()
    for _ in range(200):
        below = 1 / (1 + np.exp(signs * (rows @ w)))
        gradient = penalty * w - C * rows.T @ (weights * signs * below)
        step = -np.linalg.solve(np.diag(penalty + 1e-14) + C * (rows * (weights * below * (1 - below))[:, None]).T @ rows, gradient)
        if -gradient @ step < 1e-15 * max(1.0, value(w)):
            return w + step
        t = 1.0
        while value(w + t * step) > value(w) and t > 1e-12:
            t /= 2
        w = w + t * step
    raise AssertionError("the plain solver did not end")


def solve(loss, rows, signs, masks, penalty, C, weights):
    state = newton.first_state(masks)
    for passes in range(newton.MAX_PASSES):
        if (state["mode"] == newton.DONE).all():
            return state["w"], passes
        sums = newton.partial_sums(newton.trial_of(state), loss, rows, newton.pair_products(rows), signs, weights)
        state = newton.next_state(state, *sums, penalty, C)
    raise AssertionError("problems stay open")


def reflectances(seed, n, d, apart):
    """Band means near 3,000 that move together, and signs that they tell apart or not."""
    rng = np.random.default_rng(seed)
    level = rng.normal(3000, 400, n)
    bands = level[:, None] * rng.uniform(0.5, 1.5, d) + rng.normal(0, 60, (n, d))
    side = bands @ rng.normal(size=d)
    signs = np.where(side > np.median(side), 1.0, -1.0) if apart else rng.choice([-1.0, 1.0], n)
    return np.c_[np.ones(n), bands], signs


@pytest.mark.parametrize("loss,plain", [("squared_hinge", plain_hinge), ("logistic", plain_logistic)])
@pytest.mark.parametrize("n,d,apart", [(27, 12, True), (27, 4, True), (200, 6, False), (60, 12, False), (5, 12, True)])
def test_problems_equal_a_plain_solver(loss, plain, n, d, apart):
    rows, signs = reflectances(n + d, n, d, apart)
    scale = np.sqrt((rows ** 2).mean(axis=0))
    rows, penalty, weights = rows / scale, 1 / scale ** 2, np.random.default_rng(1).uniform(0.5, 2, n)
    if loss == "logistic":
        penalty = penalty * 1e4  # without a real penalty separable classes have no finite fit worth comparing
    ids = [1, 2 ** d - 1, *np.random.default_rng(2).integers(1, 2 ** d, 6)]
    masks = band_search.subset_masks(ids, d)
    found, passes = solve(loss, rows, signs, masks, penalty, 1.0, weights)
    for w, mask in zip(found, masks):
        on = mask > 0
        want = plain(rows[:, on], signs, penalty[on], 1.0, weights)
        assert (w[~on] == 0).all()
        assert np.abs(rows[:, on] @ (w[on] - want)).max() < 1e-6 and np.abs(w[on] - want).max() < 1e-6 * max(1, np.abs(want).max())
    assert passes < 120


def samples(seed, n, n_classes=3):
    rng = np.random.default_rng(seed)
    label = np.arange(n) % n_classes
    frame = pd.DataFrame(rng.normal(size=(n, 3)) * [1, 50, 2000] + label[:, None] * [0.7, 20, -900], columns=["a", "b", "c"])
    return frame.assign(class_no=label, is_train=rng.random(n) < 0.8, fold_s=rng.integers(0, 5, n), fold_c=np.arange(n) * 5 // n,
                        target=np.where(rng.random(n) < 0.5, "x", "y"))


@pytest.mark.parametrize("per_task", [10, 20_000])  # rows over many tasks, a job per pass; and all in one
@pytest.mark.parametrize("loss,plain,balanced,penalise", [("squared_hinge", plain_hinge, True, True), ("logistic", plain_logistic, False, False)])
def test_every_fit_and_class_equals_a_plain_solver(spark, monkeypatch, per_task, loss, plain, balanced, penalise):
    monkeypatch.setattr(newton, "ROWS_PER_TASK", per_task)
    monkeypatch.setattr(newton, "MEET", 3)
    frame = samples(3, 240)
    table = spark.createDataFrame(frame)
    narrow = newton.narrow_samples(table, ["a", "b", "c"], "target")
    masks = [[1, 1, 1], [0, 1, 0]]
    fitted = newton.fit_linear(narrow, ["a", "b", "c"], 3, loss, 2.0, masks, balanced=balanced, penalise_bias=penalise)
    assert len(fitted.weights) == 22
    for (group, scheme, fold), weights in fitted.weights.items():
        part = frame[frame.target == group]
        part = part[newton.in_training(part, scheme, fold)]
        rows, labels = newton.design(part, ["a", "b", "c"]), part["class_no"].to_numpy()
        counts = np.bincount(labels, minlength=3)
        row_weights = (len(part) / (3 * counts))[labels] if balanced else np.ones(len(part))
        for c in range(3):
            for s, mask in enumerate(masks):
                on = np.array([1, *mask]) > 0
                want = plain(rows[:, on], np.where(labels == c, 1.0, -1.0), np.array([1.0 if penalise else 0.0, *[1.0] * sum(mask)]), 2.0, row_weights)
                assert np.allclose(weights[s, on, c], want, rtol=1e-6, atol=1e-9) and (weights[s, ~on, c] == 0).all()


def test_a_class_without_rows_is_never_chosen(spark):
    frame = samples(5, 60).assign(target="x")
    frame.loc[(frame.fold_s != 2) & (frame.class_no == 1), "is_train"] = False
    fitted = newton.fit_linear(newton.narrow_samples(spark.createDataFrame(frame), ["a"], "target"), ["a"], 3)
    assert not fitted.live["x", "fold_s", 2][1]
    assert (fitted.scores("x", "fold_s", 2, np.ones((4, 2))).argmax(axis=2) != 1).all()


def test_problems_whose_minimum_is_rounding_end():
    """A penalty of nearly nothing on rows a plane tells apart: the objective falls to the rounding of its sums."""
    rng = np.random.default_rng(3)
    x = rng.integers(100, 9000, size=(3000, 6)).astype(float)
    x[:, 5] = x[:, :5].sum(axis=1) + rng.integers(0, 2, 3000)
    scale = np.concatenate([[1.0], np.sqrt((x * x).mean(axis=0))])
    rows = np.concatenate([np.ones((3000, 1)), x], axis=1) / scale
    signs = np.where(x[:, 5] - x[:, :5].sum(axis=1) > 0.5, 1.0, -1.0)
    w, passes = solve("squared_hinge", rows, signs, np.ones((1, 7)), 1e-9 / scale ** 2, 1.0, np.ones(3000))
    assert passes < 100 and ((rows @ w[0] > 0) == (signs > 0)).all()


def test_stalled_points_end_a_problem():
    state = newton.first_state(np.ones((1, 1)))
    sums = np.array([[1.0, 1e-3, 1.0]])  # each point promises a gain and brings none
    for _ in range(20):
        state = newton.next_state(state, sums, np.zeros((1, 1)), np.zeros(1), 1.0) if state["mode"][0] in (newton.TRIAL, newton.TAKE) else state
        state["mode"] = np.where(state["mode"] == newton.OCTAVE, newton.TAKE, state["mode"])
    assert state["mode"][0] == newton.DONE and state["step"][0, 0] == 0


def test_many_problems_keep_more_rows_in_a_task():
    assert newton.rows_in_task(1) == newton.rows_in_task(300) == newton.ROWS_PER_TASK
    assert newton.rows_in_task(4095) == 10 * newton.ROWS_PER_TASK
