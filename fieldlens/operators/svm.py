"""Support vector classifiers with a kernel, solved exactly in the dual.

One problem is a pair of classes in one fit. Its training rows are dealt to parts; each part is solved by itself and keeps its
support vectors, parts are merged two by two (all of them, where few vectors are left) and solved again, until one is left. Then every training row is held
against the result: rows that break its conditions join the set, which is solved again, until no row does. A solution of a subset that
no other row contradicts is the solution of all rows, so what the parts leave out changes nothing.

All problems of all fits go through the same steps side by side. A task holds a part, at the end the support vectors of one
problem; that set grows with the rows where classes overlap, as for any kernel classifier, and ``MAX_SET`` bounds it.
"""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from fieldlens.operators import newton
from fieldlens.session import materialize

PART_ROWS = 2_000
# Rows of the last set of one problem.
MAX_SET = 50_000
# Kernel rows held at a time, as numbers.
KERNEL_CELLS = 16_000_000
# Greatest difference of the conditions' two sides, relative to the margin of one.
TOLERANCE = 1e-5
MAX_STEPS = 5_000_000
MAX_ROUNDS = 50


def kernel_block(a, b, gamma):
    """Kernel values of two sets of rows; linear without ``gamma``."""
    if gamma is None:
        return a @ b.T
    squares = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.exp(-gamma * np.maximum(squares, 0.0))


class KernelRows:
    """Rows of the kernel matrix, each made when it is first asked for: most are never needed. Too many are not held."""

    def __init__(self, rows, gamma):
        self.rows, self.gamma = rows, gamma
        self.squares = (rows * rows).sum(axis=1)
        self.diagonal = self.squares if gamma is None else np.ones(len(rows))
        self.held = {}

    def __getitem__(self, i):
        if i not in self.held:
            if len(self.held) * len(self.rows) > KERNEL_CELLS:
                self.held.pop(next(iter(self.held)))
            made = self.rows @ self.rows[i]
            if self.gamma is not None:
                made = np.exp(-self.gamma * np.maximum(self.squares[i] + self.squares - 2 * made, 0.0))
            self.held[i] = made
        return self.held[i]


def solve_dual(rows, signs, C, gamma=None, start=None, tolerance=TOLERANCE, max_steps=MAX_STEPS):
    """(alpha, bias) of the hinge-loss classifier: pairs of multipliers are set to their joint best, the pair with the largest gain
    of second order first, until the conditions hold within ``tolerance``."""
    n = len(rows)
    alpha = np.zeros(n) if start is None else np.clip(start, 0.0, C)
    if not n or (signs > 0).all() or (signs < 0).all():
        return np.zeros(n), float(signs[0]) if n else 0.0
    # multipliers of both signs must weigh the same: the heavier side of a merged start gives way
    plus, minus = alpha[signs > 0].sum(), alpha[signs < 0].sum()
    if plus != minus:
        side = signs > 0 if plus > minus else signs < 0
        alpha[side] *= min(plus, minus) / max(plus, minus)
    kernel = KernelRows(rows, gamma)
    gradient = -np.ones(n)
    for i in np.flatnonzero(alpha):
        gradient += alpha[i] * signs[i] * signs * kernel[i]
    tiny = 1e-12 * C
    for _ in range(max_steps):
        value = -signs * gradient
        room, held = alpha < C - tiny, alpha > tiny
        up, low = np.where(signs > 0, room, held), np.where(signs > 0, held, room)
        i = int(np.where(up, value, -np.inf).argmax())
        gap = value[i] - value
        most, least = value[i], np.where(low, value, np.inf).min()
        if most - least < tolerance:
            return alpha, float((most + least) / 2)
        own = kernel[i]
        bend = np.maximum(kernel.diagonal[i] + kernel.diagonal - 2 * own, 1e-12)
        j = int(np.where(low & (gap > 0), gap * gap / bend, -np.inf).argmax())
        other = kernel[j]
        # alpha_i moves by signs_i * t, alpha_j by -signs_j * t
        t = gap[j] / bend[j]
        t = min(t, C - alpha[i] if signs[i] > 0 else alpha[i], alpha[j] if signs[j] > 0 else C - alpha[j])
        alpha[i] = min(max(alpha[i] + signs[i] * t, 0.0), C)
        alpha[j] = min(max(alpha[j] - signs[j] * t, 0.0), C)
        gradient += signs * t * (own - other)
    raise RuntimeError(f"the conditions do not hold after {max_steps} steps")


def dual_gap(rows, signs, C, gamma, alpha, bias):
    """Difference of the primal and the dual objective, relative to the primal."""
    spread = kernel_block(rows, rows, gamma) @ (alpha * signs)
    square = (alpha * signs) @ spread
    primal = 0.5 * square + C * np.maximum(0.0, 1 - signs * (spread + bias)).sum()
    return (primal - (alpha.sum() - 0.5 * square)) / max(primal, 1e-300)


class KernelFits:
    """Support vectors of every (scheme, fold, first class, second class): rows, their signed multipliers, bias, kernel width."""

    def __init__(self, parts, live):
        self.parts, self.live = parts, live

    def predict(self, scheme, fold, rows):
        """Class of each row: every pair of classes has a vote, ties go to the first class."""
        fold_key = ("holdout", 0) if scheme == "train" else (scheme, fold)
        counts = np.where(self.live[fold_key], 0, -1)[None].repeat(len(rows), axis=0)
        for (s, f, a, b), (vectors, weights, bias, gamma) in self.parts.items():
            if (s, f) == fold_key:
                first = kernel_block(rows, vectors, gamma) @ weights + bias > 0
                counts[np.arange(len(rows)), np.where(first, a, b)] += 1
        return counts.argmax(axis=1)


def kernel_widths(samples, columns, folds):
    """{(scheme, fold): 1 / (columns * variance over all entries of the fit's training rows)}; a row per part is collected."""
    x = [F.col(f"`{c}`") for c in columns]
    total, squares = sum(x[1:], x[0]), sum((c * c for c in x[1:]), x[0] * x[0])
    parts = samples.where("is_train").groupBy("fold_s", "fold_c").agg(
        F.count(F.lit(1)).alias("n"), F.sum(total).alias("s"), F.sum(squares).alias("q")).toPandas()
    found = {}
    for scheme, fold in newton.all_fits(folds):
        mine = parts if scheme == "holdout" else parts[parts[scheme] != fold]
        n = max(mine["n"].sum() * len(columns), 1)
        variance = mine["q"].sum() / n - (mine["s"].sum() / n) ** 2
        found[scheme, fold] = 1.0 / (len(columns) * variance) if variance > 0 else 1.0
    return found


def dealt_to(numbers, parts):
    """Part of each row, of a power of two."""
    hashed = (numbers.to_numpy().astype("uint64") * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
    return (hashed % np.uint64(parts)).astype("int64")


def fit_kernel(samples, columns, n_classes, C=1.0, kernel="rbf", folds=5, part_rows=PART_ROWS, max_set=MAX_SET):
    """``KernelFits`` of all fits of the rows of one group (``newton.narrow_samples``). ``kernel``: ``rbf``, its width from the
    variance of the training rows' entries, or ``linear``."""
    columns = list(columns)
    spark = samples.sparkSession
    rows = materialize(samples.withColumn("row", F.monotonically_increasing_id()), "kernel-rows")
    found = newton.fit_statistics(rows, columns, folds, n_classes)
    (counts, _), = found.values() if found else [({}, None)]
    live = {fit: n > 0 for fit, n in counts.items()}
    widths = kernel_widths(rows, columns, folds) if kernel == "rbf" else {fit: None for fit in live}
    problems = [(*fit, a, b) for fit, on in live.items() for a in np.flatnonzero(on) for b in np.flatnonzero(on) if a < b]
    sizes = {(s, f, a, b): int(counts[s, f][a] + counts[s, f][b]) for s, f, a, b in problems}
    parts = [max(1, 1 << max(0, int(np.ceil(np.log2(sizes[p] / part_rows))))) for p in problems]
    fields = ", ".join(f"`{c}` double" for c in columns)
    schema = f"problem int, part long, row long, sign double, alpha double, bias double, {fields}"
    order = ["problem", "part", "row", "sign", "alpha", "bias", *columns]

    def spread(frames):
        for frame in frames:
            members = {fit: newton.in_training(frame, *fit) for fit in live}
            label = frame["class_no"].to_numpy()
            for number, (s, f, a, b) in enumerate(problems):
                mine = members[s, f] & ((label == a) | (label == b))
                if mine.any():
                    out = frame.loc[mine, ["row", *columns]].assign(problem=number, alpha=0.0, bias=0.0, sign=np.where(label[mine] == a, 1.0, -1.0))
                    yield out.assign(part=dealt_to(out["row"], parts[number]))[order]

    def solve(frame):
        number = int(frame["problem"].iloc[0])
        if len(frame) > max_set:
            raise ValueError(f"{len(frame)} support vectors meet in one problem; the limit is {max_set}")
        frame = frame.sort_values("row")
        s, f, _, _ = problems[number]
        alpha, bias = solve_dual(frame[columns].to_numpy(dtype=float), frame["sign"].to_numpy(), C, widths[s, f], frame["alpha"].to_numpy())
        frame = frame.assign(alpha=alpha, bias=bias)
        kept = frame[alpha > 0] if (alpha > 0).any() else frame.head(1)
        return kept[order]

    def solved(table):
        # what is left is small, solving it isn't: AQE must not merge the parts into few tasks
        dealt = table.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "problem", "part")
        return materialize(dealt.groupBy("problem", "part").applyInPandas(solve, schema), "support-vectors")

    most_parts = max(parts, default=1)

    @F.pandas_udf("long")
    def chunk(numbers: pd.Series) -> pd.Series:
        return pd.Series(dealt_to(numbers, most_parts))

    def solve_chunk(frame):
        """The parts of all problems in the rows of a chunk. A problem of fewer parts has several chunks in one: its rows are handed on, to meet
        when parts are first merged."""
        frame = frame.sort_values("row", ignore_index=True)
        every, label, part = frame[columns].to_numpy(dtype=float), frame["class_no"].to_numpy(), int(frame["chunk"].iloc[0])
        members, made = {fit: newton.in_training(frame, *fit) for fit in live}, []
        for number, (s, f, a, b) in enumerate(problems):
            mine = np.flatnonzero(members[s, f] & ((label == a) | (label == b)))
            signs = np.where(label[mine] == a, 1.0, -1.0)
            alpha, bias, at = np.zeros(len(mine)), 0.0, 2 * (part % parts[number])
            if parts[number] == most_parts:
                if len(mine) > max_set:
                    raise ValueError(f"{len(mine)} support vectors meet in one problem; the limit is {max_set}")
                alpha, bias = solve_dual(every[mine], signs, C, widths[s, f])
                kept = np.flatnonzero(alpha > 0) if (alpha > 0).any() else np.arange(min(1, len(mine)))
                mine, signs, alpha, at = mine[kept], signs[kept], alpha[kept], part
            made.append((np.full(len(mine), number), np.full(len(mine), at), mine, signs, alpha, np.full(len(mine), bias)))
        number, at, mine, signs, alpha, bias = (np.concatenate(c) for c in zip(*made))
        return frame.loc[mine, ["row", *columns]].assign(problem=number, part=at, sign=signs, alpha=alpha, bias=bias)[order]

    if problems and most_parts >= spark.sparkContext.defaultParallelism:
        # rows are sent once, not once for each problem; they are small, the work isn't: AQE must not merge them into few tasks
        dealt = rows.where("is_train").withColumn("chunk", chunk("row"))
        dealt = dealt.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "chunk")
        state = materialize(dealt.groupBy("chunk").applyInPandas(solve_chunk, schema), "support-vectors")
    else:
        state = solved(rows.mapInPandas(spread, schema))
    left = most_parts
    while left > 1:
        most = state.groupBy("problem").count().agg(F.max("count")).first()[0]
        left = 1 if most <= part_rows else left // 2
        state = solved(state.withColumn("part", F.lit(0).cast("long") if left == 1 else F.floor(F.col("part") / 2)))
    for _ in range(MAX_ROUNDS):
        size = state.count()
        if size > max_set * max(len(problems), 1):
            raise ValueError(f"{size} support vectors exceed the limit {max_set} a problem")
        held = {}
        for number, part in state.toPandas().groupby("problem"):
            s, f, _, _ = problems[number]
            held[problems[number]] = (part[columns].to_numpy(dtype=float), (part["alpha"] * part["sign"]).to_numpy(), float(part["bias"].iloc[0]), widths[s, f])
        fits = KernelFits(held, live)
        sent = spark.sparkContext.broadcast(held)  # at most max_set rows a problem

        def broken(frames):
            for frame in spread(frames):
                number = int(frame["problem"].iloc[0])
                vectors, weights, bias, gamma = sent.value[problems[number]]
                value = kernel_block(frame[columns].to_numpy(dtype=float), vectors, gamma) @ weights + bias
                # twice the tolerance: a row within it would come and go
                yield frame[(frame["sign"] * value < 1 - 2 * TOLERANCE).to_numpy()].assign(part=0)[order]

        joined = rows.mapInPandas(broken, schema).join(state.select("problem", "row"), ["problem", "row"], "left_anti").select(*order)
        joined = materialize(joined, "broken-conditions")
        if joined.isEmpty():
            return fits
        state = solved(state.withColumn("part", F.lit(0).cast("long")).unionByName(joined))
    raise RuntimeError(f"rows break the conditions after {MAX_ROUNDS} rounds")
