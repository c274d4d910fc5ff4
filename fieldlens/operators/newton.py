"""Many small linear classifiers at once, by a Newton method whose every pass is one aggregate over the rows.

A problem is (group, fit, class, column subset): penalty + C * loss of one class against the rest, on the training rows of
one fit of one group. Rows are read where they lie: a task adds up, for all open problems of its groups, the loss, its
gradient and its Hessian at each problem's trial point; the sums meet by (group, fit, class), where the next trial points
are worked out. What a pass sends around depends on the number of problems, never on the number of rows.

Losses: ``squared_hinge`` (the bias is penalised with the weights) and ``logistic``. Columns are scaled to a mean square of one and
the penalty is transformed to match, so columns in the thousands beside a bias of one do no harm. A step that doesn't
lower the objective enough is shortened where the derivative along it, increasing as the objective is convex, is zero:
one pass finds the octave, one refines it, and the point is interpolated. A problem is done when a Newton step can't gain
more than ``TOLERANCE`` of its objective, or when several in a row haven't.
"""

import pickle
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from fieldlens.session import materialize

SCHEMES = ("fold_s", "fold_c")
TOLERANCE = 1e-13
MAX_PASSES = 300
# Passes over the sample at most.
START_PASSES = 100
# Points in a row that come less than the tolerance below the best, whatever was expected of them: what is left is rounding.
STALLS = 5
# Points at which a pass looks along a step.
LINE_POINTS = 24
# Sums of so many tasks meet in one; more are added up in two levels.
MEET = 32
ROWS_PER_TASK = 20_000
# Rows and problems that are worked on together: so many of each, or more rows of fewer problems.
SQUARE = 512
# Training rows of the sample whose solution the passes over all rows start from.
START_ROWS = 5_000
TRIAL, OCTAVE, REFINE, TAKE, DONE = range(5)


# --- one pass, within a task ------------------------------------------------

def pair_products(rows):
    """Products of all column pairs i <= j, a column each."""
    i, j = np.triu_indices(rows.shape[1])
    return rows[:, i] * rows[:, j]


def _losses(loss, margins):
    """Loss, its first and second derivative by the margin."""
    if loss == "squared_hinge":
        gap = np.maximum(0.0, 1.0 - margins)
        return gap * gap, -2.0 * gap, 2.0 * (gap > 0)
    small = np.exp(-np.abs(margins))
    below = np.where(margins >= 0, small, 1.0) / (1.0 + small)  # logistic function of -margin
    return np.maximum(0.0, -margins) + np.log1p(small), -below, below * (1.0 - below)


def line_points(mode, lo, hi):
    """(problem, point) steps at which the derivative is looked at."""
    octaves = 2.0 ** -np.arange(LINE_POINTS)[::-1]
    return np.where((mode == OCTAVE)[:, None], octaves[None], lo[:, None] + (hi - lo)[:, None] * np.arange(LINE_POINTS)[None] / (LINE_POINTS - 1))


def _sums_at(loss, at, rows, products, signed, weights):
    """Loss, gradient and Hessian of the problems ``at`` over some rows."""
    if loss == "squared_hinge":
        gap = signed @ at.T
        np.subtract(1.0, gap, out=gap)
        np.maximum(gap, 0.0, out=gap)
        weighed = weights[:, None] * gap
        return np.concatenate([np.einsum("ij,ij->j", weighed, gap)[:, None], -2.0 * weighed.T @ signed,
                               2.0 * (gap > 0).astype(float).T @ (weights[:, None] * products)], axis=1)
    value, first, second = (weights[:, None] * x for x in _losses(loss, signed @ at.T))
    return np.concatenate([value.sum(axis=0)[:, None], first.T @ signed, second.T @ products], axis=1)


def _slopes_along(loss, base, along, points, weights):
    """Derivative of the loss along each problem's step at each of its points."""
    found, weighed = np.zeros(points.shape), weights[:, None] * along
    for j in range(points.shape[1]):
        margins = base + points[:, j] * along
        if loss == "squared_hinge":
            np.subtract(1.0, margins, out=margins)
            np.maximum(margins, 0.0, out=margins)
            found[:, j] = -2.0 * np.einsum("ij,ij->j", margins, weighed)
        else:
            found[:, j] = (_losses(loss, margins)[1] * weighed).sum(axis=0)
    return found


def partial_sums(trial, loss, rows, products, signs, weights):
    """Sums over some rows at a key's trial points: loss, gradient and Hessian of ``at``, derivatives along ``step`` of the others.
    Rows and problems are taken in squares, of few problems in longer stretches of rows, that stay in the cache."""
    points = line_points(trial["mode"], trial["lo"], trial["hi"])
    sums, slopes = np.zeros((len(trial["at"]), 1 + rows.shape[1] + products.shape[1])), np.zeros(points.shape)
    signed = signs[:, None] * rows
    stretch = SQUARE * max(1, SQUARE // max(1, len(sums), len(points)) // 16)
    for lo in range(0, len(rows), stretch):
        some = slice(lo, lo + stretch)
        for a in range(0, len(sums), SQUARE):
            sums[a:a + SQUARE] += _sums_at(loss, trial["at"][a:a + SQUARE], rows[some], products[some], signed[some], weights[some])
        for a in range(0, len(points), SQUARE):
            base, along = (signed[some] @ trial[k][a:a + SQUARE].T for k in ("base", "step"))
            slopes[a:a + SQUARE] += _slopes_along(loss, base, along, points[a:a + SQUARE], weights[some])
    return sums, slopes


# --- the state of a key's problems ------------------------------------------

def first_state(masks):
    n, d = masks.shape
    zero = np.zeros(n)
    return {"masks": masks, "w": np.zeros((n, d)), "step": np.zeros((n, d)), "value": zero + np.inf, "drop": zero.copy(),
            "lo": zero.copy(), "hi": zero + 1.0, "mode": np.full(n, TAKE), "best": zero + np.inf, "stalls": zero.astype(int)}


def trial_of(state):
    """What a pass needs of the problems that are open."""
    mode = state["mode"]
    at, line = (mode == TRIAL) | (mode == TAKE), (mode == OCTAVE) | (mode == REFINE)
    return {"at": (state["w"] + state["step"])[at], "base": state["w"][line], "step": state["step"][line],
            "lo": state["lo"][line], "hi": state["hi"][line], "mode": mode[line]}


def next_state(state, sums, slopes, penalty, C):
    """The state after a pass; ``penalty``: weight of each column's square."""
    n_columns = state["w"].shape[1]
    mode = state["mode"].copy()
    at = np.flatnonzero((mode == TRIAL) | (mode == TAKE))
    line = np.flatnonzero((mode == OCTAVE) | (mode == REFINE))

    points = line_points(mode[line], state["lo"][line], state["hi"][line])
    base, step = state["w"][line], state["step"][line]
    slope = C * slopes + (penalty * base * step).sum(axis=1)[:, None] + points * (penalty * step * step).sum(axis=1)[:, None]
    below = slope <= 0
    last = np.where(below.any(axis=1), points.shape[1] - 1 - below[:, ::-1].argmax(axis=1), -1) if len(line) else np.zeros(0, int)
    octave = mode[line] == OCTAVE
    every = np.arange(len(line))
    lo = np.where(last >= 0, points[every, np.maximum(last, 0)], 0.0)
    end = np.minimum(last + 1, points.shape[1] - 1) if len(line) else last
    hi = points[every, end]
    rise = np.where(last >= 0, slope[every, np.maximum(last, 0)], 0.0)
    width = slope[every, end] - rise
    share = np.where(width > 0, np.clip(-rise / np.where(width > 0, width, 1.0), 0.0, 1.0), 0.0)
    length = np.where(hi > lo, lo + share * (hi - lo), lo)
    state["lo"][line], state["hi"][line] = np.where(octave, lo, 0.0), np.where(octave, hi, 1.0)
    refined = line[~octave]
    state["step"][refined] *= length[~octave][:, None]
    mode[line] = np.where(octave, REFINE, TAKE)

    if len(at):
        point, masks = (state["w"] + state["step"])[at], state["masks"][at]
        value = C * sums[:, 0] + 0.5 * (penalty * point * point).sum(axis=1)
        gradient = (C * sums[:, 1:1 + n_columns] + penalty * point) * masks
        i, j = np.triu_indices(n_columns)
        hessian = np.zeros((len(at), n_columns, n_columns))
        hessian[:, i, j] = hessian[:, j, i] = C * sums[:, 1 + n_columns:] * masks[:, i] * masks[:, j]
        diagonal = np.arange(n_columns)
        # a column without any weight (all zero, no penalty) must not make the system singular
        hessian[:, diagonal, diagonal] += penalty * masks + (1.0 - masks) + 1e-14
        before, drop = state["value"][at], state["drop"][at]
        good = (mode[at] == TAKE) | (value <= before - 1e-4 * drop + 1e-13 * np.abs(before))
        short = at[~good]
        mode[short], state["lo"][short], state["hi"][short] = OCTAVE, 0.0, 1.0
        taken = at[good]
        if len(taken):
            newton = -np.linalg.solve(hessian[good], gradient[good][:, :, None])[:, :, 0]
            gain = -(gradient[good] * newton).sum(axis=1)
            stalled = state["best"][taken] - value[good] <= TOLERANCE * np.abs(value[good])
            state["best"][taken] = np.minimum(state["best"][taken], value[good])
            state["stalls"][taken] = np.where(stalled, state["stalls"][taken] + 1, 0)
            state["w"][taken], state["value"][taken] = point[good], value[good]
            state["step"][taken], state["drop"][taken] = newton, gain
            still = state["stalls"][taken] >= STALLS
            mode[taken] = np.where(still | (gain <= TOLERANCE * np.maximum(value[good], 1e-300)), DONE, TRIAL)
            state["step"][taken[still]] = 0.0
            # so short a step needs no trial
            done = taken[mode[taken] == DONE]
            state["w"][done] += state["step"][done]
            state["step"][done] = 0.0
    state["mode"] = mode
    return state


# --- fits -------------------------------------------------------------------

def all_fits(folds):
    return [("holdout", 0)] + [(s, i) for s in SCHEMES for i in range(folds)]


def in_training(frame, scheme, fold):
    train = frame["is_train"].to_numpy(dtype=bool)
    return train if scheme == "holdout" else train & (frame[scheme] != fold).to_numpy(dtype=bool)


def scored_rows(frame, scheme, fold):
    """Rows that a fit is scored on; scheme ``train`` scores the hold-out fit on its own training rows."""
    train = frame["is_train"].to_numpy(dtype=bool)
    if scheme in ("holdout", "train"):
        return train if scheme == "train" else ~train
    return train & (frame[scheme] == fold).to_numpy(dtype=bool)


def fit_statistics(samples, columns, folds, n_classes):
    """{group: (rows per fit and class, column scales)} of the training rows; a row per group, part and class is collected."""
    squares = [F.sum(F.col(f"`{c}`") * F.col(f"`{c}`")).alias(f"q{i}") for i, c in enumerate(columns)]
    parts = samples.where("is_train").groupBy("group", "fold_s", "fold_c", "class_no").agg(F.count(F.lit(1)).alias("n"), *squares).toPandas()
    found = {}
    for group, part in parts.groupby("group"):
        counts = {}
        for scheme, fold in all_fits(folds):
            mine = part if scheme == "holdout" else part[part[scheme] != fold]
            counts[scheme, fold] = np.bincount(mine["class_no"].astype(int), mine["n"], n_classes)
        mean = part[[f"q{i}" for i in range(len(columns))]].sum().to_numpy() / part["n"].sum()
        found[group] = counts, np.concatenate([[1.0], np.where(mean > 0, np.sqrt(mean), 1.0)])
    return found


class LinearFits:
    """Fitted weights of all problems: ``weights[group, scheme, fold]`` is (subset, column, class), the bias first;
    ``live``: the classes that the fit's training rows have."""

    def __init__(self, weights, live):
        self.weights, self.live = weights, live

    def scores(self, group, scheme, fold, rows):
        """(row, subset, class) decision values; classes without training rows are never chosen."""
        key = group, "holdout" if scheme == "train" else scheme, fold
        weights = self.weights[key]
        flat = weights.transpose(1, 0, 2).reshape(weights.shape[1], -1)
        found = (rows @ flat).reshape(len(rows), weights.shape[0], weights.shape[2])
        found[:, :, ~self.live[key]] = -np.inf
        return found


def design(frame, columns):
    return np.concatenate([np.ones((len(frame), 1)), frame[list(columns)].to_numpy(dtype=float)], axis=1)


def narrow_samples(samples, columns, group):
    """group, class_no, is_train, fold_s, fold_c and the columns as numbers, written, and dealt out so that a task has few groups."""
    found = samples.select(F.col(group).cast("string").alias("group") if group else F.lit("").alias("group"), F.col("class_no").cast("int"),
                           F.col("is_train"), "fold_s", "fold_c", *[F.col(f"`{c}`").cast("double").alias(c) for c in columns])
    return materialize(found, "fit-samples")


def _dealt(samples):
    samples = samples.where("is_train")
    rows = samples.count()
    parts = max(1, -(-rows // ROWS_PER_TASK))
    dealt = samples.withColumn("__part", F.floor(F.rand(7) * parts).cast("int"))
    return materialize(dealt.repartition(max(parts, 8), "group", "__part").sortWithinPartitions("group").drop("__part"), "fit-rows")


class Problem:
    """What ``run_passes`` needs to know of a kind of problem: three functions that tasks call.

    ``sums(number, trial, part)``: arrays that add up over rows; ``part`` is a ``Part``. ``advance(number, state, sums)``: the state after a pass.
    ``trial(state)``: what a pass needs of a state, or None if nothing of it is open.
    """

    def __init__(self, sums, advance, trial):
        self.sums, self.advance, self.trial = sums, advance, trial


class Part:
    """Rows of one group within a task: design matrix in scaled columns, products of its columns, labels, members of each fit."""

    def __init__(self, frame, columns, scale):
        self.frame, self.rows, self.labels = frame, design(frame, columns) / scale, frame["class_no"].to_numpy()
        self.products, self.members = pair_products(self.rows), {}

    def of(self, scheme, fold):
        """Numbers of the rows that a fit learns from."""
        if (scheme, fold) not in self.members:
            self.members[scheme, fold] = np.flatnonzero(in_training(self.frame, scheme, fold))
        return self.members[scheme, fold]


def _passed(problem, trials, columns, keys, scales):
    """Function from a task's rows to the sums of each key: (key, payload)."""

    def run(frames):
        open_, sums, now = trials.value, {}, None

        def out():
            found = [(k, pickle.dumps(v)) for k, v in sums.items()]
            sums.clear()
            for row in found:  # one at a time: a payload has a few MB
                yield pd.DataFrame([row], columns=["key", "payload"])

        for frame in frames:
            for group, rows in frame.groupby("group", sort=False):
                if now is not None and group != now:
                    yield from out()
                now = group
                if group not in scales:
                    continue
                part = Part(rows, columns, scales[group])
                for number, key in enumerate(keys):
                    if key[0] == group and number in open_ and len(part.of(*key[1:3])):
                        made = problem.sums(number, open_[number], part)
                        sums[number] = [a + b for a, b in zip(sums[number], made)] if number in sums else list(made)
        yield from out()

    return run


def _started_in_task(problem, start, columns, keys, scales, share, live):
    """Function from a ``share`` of the rows of a key's group to the key's weights there, its sums weighed up to those of all rows. A sample
    that lacks a class of the fit tells too little: such a key starts where it would have."""

    def solve(key, frame):
        number = int(key[0])
        part, state = Part(frame, columns, scales[keys[number][0]]), pickle.loads(start[number])
        w = state["w"]
        if set(part.labels[part.of(*keys[number][1:3])]) >= set(np.flatnonzero(live[keys[number][:3]])):
            for _ in range(START_PASSES):
                trial = problem.trial(state)
                if trial is None:
                    break
                state = problem.advance(number, state, [x / share for x in problem.sums(number, trial, part)])
            w = state["w"] if np.isfinite(state["w"]).all() else w
        return pd.DataFrame({"key": [number], "w": [pickle.dumps(w)]})

    return solve


def _solved_in_task(problem, start, columns, keys, scales, max_passes):
    """Function from all rows of a key's group to its last state: the same passes, without a job for each."""

    def solve(key, frame):
        number = int(key[0])
        part, state = Part(frame, columns, scales[keys[number][0]]), pickle.loads(start[number])
        for _ in range(max_passes):
            trial = problem.trial(state)
            if trial is None:
                return pd.DataFrame({"key": [number], "state": [pickle.dumps(state)]})
            state = problem.advance(number, state, problem.sums(number, trial, part))
        raise RuntimeError(f"problems are open after {max_passes} passes")

    return solve


def _added(payloads):
    return reduce(lambda a, b: [x + y for x, y in zip(a, b)], (pickle.loads(p) for p in payloads))


def _add_up(key, frame):
    return pd.DataFrame({"key": [frame["key"].iloc[0]], "payload": [pickle.dumps(_added(frame["payload"]))]})


def rows_in_task(each):
    """Rows of a group that one task may hold. Where a key has ``each`` = thousands of problems their sums outweigh the rows: every part of
    the rows would send MBs for each key and pass, so more rows, of a bounded number, go to the problems once."""
    return ROWS_PER_TASK * max(1, min(10, each // 400))


def run_passes(samples, problem, states, columns, keys, scales, largest, max_passes=MAX_PASSES, *, each=1, live=None):
    """Last state of each key, by its number. ``keys``: (group, scheme, fold, ...); ``states``: the first state of each; ``largest``: training
    rows of the largest group; ``each``: problems of a key. What comes to the driver, and goes out again, is states and trials: their size depends on the problems alone.
    With ``live`` (the classes of each group and fit) the passes over all rows start from the weights (``w``) of a sample, where few are left to do.
    """
    spark = samples.sparkSession
    start = [pickle.dumps(state) for state in states]

    def gathered(table):
        return {r["key"]: pickle.loads(r["state"]) for r in table.select("key", "state").toLocalIterator()}

    if largest <= rows_in_task(each):
        # every group fits into a task: the passes need no jobs
        named = spark.createDataFrame([(i, k[0]) for i, k in enumerate(keys)], "key int, group string")
        solve = _solved_in_task(problem, start, columns, keys, scales, max_passes)
        solved = samples.where("is_train").join(named, "group").repartition(max(len(keys), 1), "key").groupBy("key").applyInPandas(
            solve, "key int, state binary")
        return gathered(materialize(solved, "fit-state"))
    dealt = _dealt(samples)
    if live is not None and largest > START_ROWS:
        share = START_ROWS / largest
        named = spark.createDataFrame([(i, k[0]) for i, k in enumerate(keys)], "key int, group string")
        solve = _started_in_task(problem, start, columns, keys, scales, share, live)
        some = dealt.sample(share, 7).join(named, "group").repartition(max(len(keys), 1), "key").groupBy("key").applyInPandas(solve, "key int, w binary")
        for r in materialize(some, "fit-start").toLocalIterator():
            start[r["key"]] = pickle.dumps(states[r["key"]] | {"w": pickle.loads(r["w"])})
    tasks = dealt.rdd.getNumPartitions()
    schema = "key int, state binary, trial binary"

    def row(number, state):
        trial = problem.trial(state)
        return pd.DataFrame({"key": [number], "state": [pickle.dumps(state)], "trial": [None if trial is None else pickle.dumps(trial)]})

    def update(key, old, sums):
        if not len(old):
            return pd.DataFrame({"key": [], "state": [], "trial": []})
        number, state = int(old["key"].iloc[0]), pickle.loads(old["state"].iloc[0])
        return row(number, problem.advance(number, state, _added(sums["payload"])) if len(sums) else state)

    table = spark.createDataFrame([(i,) for i in range(len(keys))], "key int").mapInPandas(
        lambda frames: (row(n, pickle.loads(start[n])) for f in frames for n in f["key"]), schema)
    table = materialize(table, "fit-state")
    for _ in range(max_passes):
        trials = {r["key"]: pickle.loads(r["trial"]) for r in table.where("trial IS NOT NULL").select("key", "trial").toLocalIterator()}
        if not trials:
            return gathered(table)
        sent = spark.sparkContext.broadcast(trials)
        sums = dealt.mapInPandas(_passed(problem, sent, columns, keys, scales), "key int, payload binary")
        if tasks > MEET:
            sums = sums.withColumn("part", F.spark_partition_id() % MEET).groupBy("key", "part").applyInPandas(_add_up, "key int, payload binary")
        table = materialize(table.groupBy("key").cogroup(sums.groupBy("key")).applyInPandas(update, schema), "fit-state")
        sent.destroy()
    raise RuntimeError(f"problems are open after {max_passes} passes")


def fit_linear(samples, columns, n_classes, loss="squared_hinge", C=1.0, masks=None, folds=5, balanced=False, penalise_bias=True,
               max_passes=MAX_PASSES):
    """Weights of every (group, fit, class) on every subset of the columns, as ``LinearFits``.

    ``samples`` (of ``narrow_samples``): group, class_no, is_train, fold_s, fold_c and the columns, without nulls. ``masks``: a row of 0
    and 1 per subset (default: all columns); the bias is in each. ``balanced``: rows weigh by n / (classes * rows of their
    class) of the fit's training rows. The weights come to the driver: problems * columns numbers, whatever the rows.
    """
    columns = list(columns)
    masks = np.ones((1, len(columns))) if masks is None else np.asarray(masks, dtype=float)
    masks = np.concatenate([np.ones((len(masks), 1)), masks], axis=1)
    found = fit_statistics(samples, columns, folds, n_classes)
    scales = {g: s for g, (_, s) in found.items()}
    live = {(g, *fit): n > 0 for g, (counts, _) in found.items() for fit, n in counts.items()}
    row_weights = {(g, *fit): np.where(n > 0, n.sum() / (max((n > 0).sum(), 1) * np.maximum(n, 1)), 0.0) if balanced else np.ones(n_classes)
                   for g, (counts, _) in found.items() for fit, n in counts.items()}
    keys = [(g, *fit, c) for g, (counts, _) in found.items() for fit, n in counts.items() for c in np.flatnonzero(n)]
    penalties = []
    for group, *_ in keys:
        penalty = 1.0 / scales[group] ** 2
        penalty[0] = 1.0 if penalise_bias else 0.0
        penalties.append(penalty)

    def sums(number, trial, part):
        group, scheme, fold, c = keys[number]
        mine = part.of(scheme, fold)
        labels = part.labels[mine]
        return partial_sums(trial, loss, part.rows[mine], part.products[mine], np.where(labels == c, 1.0, -1.0), row_weights[group, scheme, fold][labels])

    problem = Problem(sums, lambda number, state, found: next_state(state, *found, penalties[number], C),
                      lambda state: None if (state["mode"] == DONE).all() else trial_of(state))
    largest = max((int(counts["holdout", 0].sum()) for counts, _ in found.values()), default=0)
    states = run_passes(samples, problem, [first_state(masks) for _ in keys], columns, keys, scales, largest, max_passes, each=len(masks),
                        live=live if len(masks) == 1 else None)
    weights = {k: np.zeros((*masks.shape, n_classes)) for k in live}
    for number, state in states.items():
        group, scheme, fold, c = keys[number]
        weights[group, scheme, fold][:, :, c] = state["w"] / scales[group]
    return LinearFits(weights, live)
