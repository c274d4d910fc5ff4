"""Multinomial regression beside the conditions of its minimum, on classes that overlap."""

import numpy as np
import pytest

from fieldlens.operators import newton, softmax
from test_newton import samples


def objective(w, rows, labels, C, absolute):
    scores = rows @ w
    scores = scores - scores.max(axis=1, keepdims=True)
    loss = (np.log(np.exp(scores).sum(axis=1)) - scores[np.arange(len(rows)), labels]).sum()
    return C * loss + (np.abs(w[1:]).sum() if absolute else 0.5 * (w[1:] ** 2).sum())


def test_sums_are_derivatives():
    rng = np.random.default_rng(1)
    rows, labels, w = np.c_[np.ones(30), rng.normal(size=(30, 2))], rng.integers(0, 3, 30), rng.normal(size=(3, 3))
    live = np.ones(3, bool)
    value, gradient, pairs = softmax.softmax_sums(w, live, rows, newton.pair_products(rows), labels)
    hessian = softmax.full_hessian(pairs, 3, 3)
    for k in range(9):
        move = np.zeros((3, 3))
        move[k % 3, k // 3] = 1e-5
        up, down = (softmax.softmax_sums(w + s * move, live, rows, newton.pair_products(rows), labels) for s in (1, -1))
        assert abs((up[0][0] - down[0][0]) / 2e-5 - gradient[k % 3, k // 3]) < 1e-6
        assert np.allclose(((up[1] - down[1]) / 2e-5).T.ravel(), hessian[:, k], atol=1e-5)


@pytest.mark.parametrize("per_task", [10, 20_000])
@pytest.mark.parametrize("absolute", [False, True])
def test_every_fit_is_at_its_minimum(spark, monkeypatch, per_task, absolute):
    monkeypatch.setattr(newton, "ROWS_PER_TASK", per_task)
    frame = samples(4, 150).assign(target="x")
    columns, C = ["a", "b", "c"], 0.3
    fitted = softmax.fit_softmax(newton.narrow_samples(spark.createDataFrame(frame), columns, "target"), columns, 3, C, absolute)
    assert len(fitted.weights) == 11
    zeros = 0
    for (group, scheme, fold), (w,) in fitted.weights.items():
        part = frame[newton.in_training(frame, scheme, fold)]
        rows, labels = newton.design(part, columns), part["class_no"].to_numpy()
        scale = np.sqrt((rows ** 2).mean(axis=0))
        value, gradient, _ = softmax.softmax_sums(w, np.ones(3, bool), rows, newton.pair_products(rows), labels)
        gradient = C * gradient / scale[:, None]
        assert np.abs(gradient[0]).max() < 1e-5
        if absolute:
            inner = w[1:] != 0
            limit = np.repeat(1 / scale[1:, None], 3, axis=1)
            assert np.abs((gradient[1:] + np.sign(w[1:]) * limit)[inner]).max() < 1e-5 and (np.abs(gradient[1:])[~inner] <= (limit + 1e-6)[~inner]).all()
            zeros += int((~inner).sum())
        else:
            assert np.abs(gradient[1:] + w[1:] / scale[1:, None]).max() < 1e-5
        best = objective(w, rows, labels, C, absolute)
        rng = np.random.default_rng(0)
        assert all(objective(w + rng.normal(size=w.shape) * 1e-3 / scale[:, None], rows, labels, C, absolute) > best - 1e-9 for _ in range(20))
    assert zeros or not absolute


def test_a_missing_class_is_left_out(spark):
    frame = samples(6, 90).assign(target="x")
    frame.loc[(frame.fold_s != 1) & (frame.class_no == 2), "is_train"] = False
    fitted = softmax.fit_softmax(newton.narrow_samples(spark.createDataFrame(frame), ["a"], "target"), ["a"], 3)
    assert not fitted.live["x", "fold_s", 1][2] and (fitted.scores("x", "fold_s", 1, np.ones((3, 2))).argmax(axis=2) != 2).all()


def test_loss_far_from_the_border_keeps_its_digits():
    rows, w = np.array([[1.0, 20.0], [1.0, -20.0]]), np.array([[0.0, 0.0], [1.0, -1.0]])
    value, gradient, pairs = softmax.softmax_sums(w, np.ones(2, bool), rows, newton.pair_products(rows), np.array([0, 1]))
    tiny = np.exp(-40.0)
    assert value[0] == pytest.approx(2 * tiny, rel=1e-12)
    assert gradient[1] == pytest.approx([-40 * tiny, 40 * tiny], rel=1e-12)
    assert pairs[0] == pytest.approx([2 * tiny, -2 * tiny, 2 * tiny], rel=1e-12)


def test_a_step_lost_in_rounding_ends_the_fit():
    one = np.ones((2, 2))
    state = {"w": one, "step": one * 1e-3, "value": 1.0, "gain": 1e-12, "done": False}
    sums = [np.array([10.0]), np.zeros((2, 2)), np.zeros((3, 3))]  # no trial is better
    for _ in range(20):
        state = state if state["done"] else softmax.next_softmax(state, sums, np.ones(2, bool), np.zeros(2), 1.0, True)
    assert state["done"] and (state["w"] + state["step"] == one).all()
