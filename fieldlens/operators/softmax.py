"""Multinomial logistic regression of all fits at once, with a quadratic or an absolute penalty, by Newton's method.

The classes of a fit share one objective: C * sum of -log p(label) + penalty of the weights; biases are free. A pass (see ``newton``) adds up its
value, gradient and full Hessian at a trial point. The step minimises the quadratic model plus the penalty: a linear
system for the quadratic penalty, coordinate descent for the absolute one, which leaves weights at exactly zero. A step that
doesn't lower the objective enough is halved. A fit is done when its step, whole or halved, can't gain more than ``newton.TOLERANCE`` of the
objective.
"""

import numpy as np

from fieldlens.operators import newton

# Only differences between classes matter for the free biases: this keeps the system regular and moves no difference.
RIDGE = 1e-9
SWEEPS = 2_000


def class_pairs(n):
    return np.triu_indices(n)


def softmax_sums(weights, live, rows, products, labels):
    """(value, gradient, Hessian) over some rows: the last by pairs of classes and pairs of columns. ``weights``: (column, class).

    What a class lacks to one is summed from the other classes: where rows are far from the border, 1 - p has no digits left.
    """
    scores = np.where(live[None], rows @ weights, -np.inf)
    every, top = np.arange(len(rows)), scores.argmax(axis=1)
    scores -= scores[every, top][:, None]
    p, but_one = np.exp(scores), 1.0 - np.eye(len(live))
    rest = (p @ but_one)[every, top]
    value = (np.log1p(rest) - scores[every, labels]).sum()
    p /= 1.0 + rest[:, None]
    others = p @ but_one
    off = p.copy()
    off[every, labels] = -others[every, labels]
    a, b = class_pairs(len(live))
    return np.array([value]), rows.T @ off, products.T @ np.where(a == b, p[:, a] * others[:, a], -p[:, a] * p[:, b])


def full_hessian(sums, n_columns, n_classes):
    """(class, column, class, column) matrix of the pairs."""
    i, j = np.triu_indices(n_columns)
    a, b = class_pairs(n_classes)
    out = np.zeros((n_classes, n_columns, n_classes, n_columns))
    for k in range(len(a)):
        block = np.zeros((n_columns, n_columns))
        block[i, j] = block[j, i] = sums[:, k]
        out[a[k], :, b[k], :] = out[b[k], :, a[k], :] = block
    return out.reshape(n_classes * n_columns, n_classes * n_columns)


def _on_face(gradient, hessian, w, step, penalty):
    """The minimum with the signs that w + step has, if it has these signs itself and nothing beyond them pulls harder than the penalty; else None."""
    point = w + step
    live = np.diag(hessian) > 0
    on = live & ((point != 0) | (penalty == 0))
    found = np.where(on, 0.0, np.where(live, -w, 0.0))
    pull = np.where(penalty > 0, np.sign(point) * penalty, 0.0)
    found[on] = np.linalg.solve(hessian[np.ix_(on, on)], -(gradient + pull + hessian @ found)[on])
    slope = gradient + hessian @ found
    same = (np.sign(w + found) == np.sign(point)) | (penalty == 0)
    return found if same[on].all() and (np.abs(slope) <= penalty * (1 + 1e-9) + 1e-300)[live & ~on].all() else None


def lasso_step(gradient, hessian, w, penalty):
    """Step that minimises gradient s + s H s / 2 + sum penalty |w + s|: coordinate descent finds out which weights are zero and the
    signs of the others, a linear system does the rest."""
    step, moved = np.zeros(len(w)), np.zeros(len(w))  # moved = H step
    scale = np.abs(gradient).max() + penalty.max() + 1e-300
    diagonal = np.diag(hessian)
    for sweep in range(SWEEPS):
        most = 0.0
        for k in np.flatnonzero(diagonal > 0):
            slope = gradient[k] + moved[k] - diagonal[k] * (w[k] + step[k])
            best = -np.sign(slope) * max(abs(slope) - penalty[k], 0.0) / diagonal[k]
            change = best - w[k] - step[k]
            if change:
                step[k] += change
                moved += change * hessian[:, k]
                most = max(most, abs(change) * diagonal[k])
        if most <= 1e-11 * scale:
            break
        if sweep % 5 == 4:
            found = _on_face(gradient, hessian, w, step, penalty)
            if found is not None:
                return found
    return step


def next_softmax(state, sums, live, penalty, C, absolute):
    """The state after a pass. State: w, value and step of the last accepted point (columns, classes), gain, done."""
    found, gradient, pairs = sums
    n_columns, n_classes = state["w"].shape
    point, weigh = state["w"] + state["step"], penalty[:, None]
    cost = (weigh * np.abs(point)).sum() if absolute else 0.5 * (weigh * point * point).sum()
    value = C * found[0] + cost
    if value > state["value"] - 1e-4 * state["gain"] + 1e-13 * abs(value):
        # a step whose gain is lost in the rounding of the sums can't be told from none
        lost = state["gain"] / 2 <= newton.TOLERANCE * abs(state["value"])
        return state | {"step": state["step"] * (0.0 if lost else 0.5), "gain": state["gain"] / 2, "done": bool(lost)}
    flat = lambda m: m.T.ravel()
    free = np.repeat(live, n_columns)
    w, weigh = flat(point), np.tile(penalty, n_classes)
    slope = np.where(free, C * flat(gradient) + (0.0 if absolute else weigh * w), 0.0)
    hessian = C * full_hessian(pairs, n_columns, n_classes) * np.outer(free, free)
    diagonal = np.arange(len(w))
    hessian[diagonal, diagonal] += np.where(free, RIDGE * max(hessian.max(), 1e-300), 0.0 if absolute else 1.0) + (0.0 if absolute else weigh * free)
    if absolute:
        step = lasso_step(slope, hessian, w, np.where(free, weigh, 0.0))
        gain = -(slope @ step) - (weigh * (np.abs(w + step) - np.abs(w)))[free].sum()
    else:
        step = -np.linalg.solve(hessian, slope)
        gain = -(slope @ step)
    step = step.reshape(n_classes, n_columns).T
    done = gain <= newton.TOLERANCE * max(value, 1e-300)
    return {"w": point + step if done else point, "step": np.zeros_like(step) if done else step, "value": value, "gain": gain, "done": bool(done)}


def fit_softmax(samples, columns, n_classes, C=1.0, absolute=False, folds=5):
    """``newton.LinearFits`` of every (group, fit); arguments as in ``newton.fit_linear``. ``absolute``: the penalty is the sum of the weights'
    sizes, else half the sum of their squares."""
    columns = list(columns)
    found = newton.fit_statistics(samples, columns, folds, n_classes)
    scales = {g: s for g, (_, s) in found.items()}
    live = {(g, *fit): n > 0 for g, (counts, _) in found.items() for fit, n in counts.items()}
    keys = [k for k, on in live.items() if on.any()]
    penalties = []
    for group, *_ in keys:
        penalty = 1.0 / scales[group] ** (1 if absolute else 2)
        penalty[0] = 0.0
        penalties.append(penalty)

    def sums(number, trial, part):
        mine = part.of(*keys[number][1:])
        return softmax_sums(trial, live[keys[number]], part.rows[mine], part.products[mine], part.labels[mine])

    problem = newton.Problem(sums, lambda number, state, got: next_softmax(state, got, live[keys[number]], penalties[number], C, absolute),
                             lambda state: None if state["done"] else state["w"] + state["step"])
    zero = np.zeros((len(columns) + 1, n_classes))
    first = {"w": zero, "step": zero, "value": np.inf, "gain": 0.0, "done": False}
    largest = max((int(counts["holdout", 0].sum()) for counts, _ in found.values()), default=0)
    states = newton.run_passes(samples, problem, [first for _ in keys], columns, keys, scales, largest, live=live)
    weights = {k: np.zeros((1, *zero.shape)) for k in live}
    for number, state in states.items():
        weights[keys[number]][0] = state["w"] / scales[keys[number][0]][:, None]
    return newton.LinearFits(weights, live)
