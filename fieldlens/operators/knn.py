"""Exact nearest-neighbour classification without comparing every pair.

A tree of cuts, found on a bounded sample of the training rows, parts the space into leaves; a leaf's training rows are cut into
blocks of bounded size. A row is first compared with a block of its own leaf: its k-th neighbour there bounds the distance of
the true ones, and only blocks whose leaf's box reaches into that bound are visited. A task compares one block of training rows with
a bounded number of test rows and passes on k rows per test row. ``compared_share`` tells how much of all pairs that is: little in few
dimensions or on data with clusters, nearly all of it in many dimensions without.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from fieldlens.operators.ranks import hash_key
from fieldlens.session import materialize

BLOCK_ROWS = 2048
# leaves at most, a power of two; rows of the sample for each
MAX_LEAVES = 4096
SAMPLE_PER_LEAF = 16
# distances that a task holds at once
PAIRS = 200_000
# Views (see ``knn_predict_views``): rows of a block, of a leaf within it, and the closest rows among which each view finds its own first.
VIEW_BLOCK_ROWS = 16_384
VIEW_LEAF_ROWS = 64
VIEW_POOL = 24


class Tree:
    """Cuts in heap order: the widest column of a node's sample rows at their median, larger values to the right."""

    def __init__(self, sample, depth):
        self.depth = depth
        self.column, self.cut = np.zeros(2 ** depth - 1, dtype=int), np.zeros(2 ** depth - 1)
        parts = [sample]
        for node in range(2 ** depth - 1):
            rows = parts[node]
            if len(rows):
                self.column[node] = (rows.max(axis=0) - rows.min(axis=0)).argmax()
                self.cut[node] = np.median(rows[:, self.column[node]])
            right = rows[:, self.column[node]] > self.cut[node]
            parts += [rows[~right], rows[right]]
            parts[node] = None

    def leaves(self, rows):
        node, every = np.zeros(len(rows), dtype=int), np.arange(len(rows))
        for _ in range(self.depth):
            node = 2 * node + 1 + (rows[every, self.column[node]] > self.cut[node])
        return node - (2 ** self.depth - 1)


class Boxes:
    """Boxes of the leaves that have training rows, with the numbers of their blocks."""

    def __init__(self, found, n_leaves, block_rows, d):
        found = sorted(found, key=lambda r: r["_leaf"])
        number = np.array([r["_leaf"] for r in found])
        self.n = np.array([r["n"] for r in found])
        self.blocks = -(-self.n // block_rows)
        self.start = np.cumsum(self.blocks) - self.blocks
        self.lo, self.hi = (np.array([[r[f"{side}{i}"] for i in range(d)] for r in found], dtype=float) for side in ("lo", "hi"))
        # a leaf without training rows is served by the next that has some
        self.home = np.minimum(np.searchsorted(number, np.arange(n_leaves)), len(number) - 1)

    def unit(self, leaves, hashes):
        """Block of a leaf for a row: the one its hash falls on."""
        at = self.home[leaves]
        return self.start[at] + hashes % self.blocks[at]

    def farthest(self, rows, k, n=None):
        """Square within which each row has k training rows (inf: there are fewer), by the far corners of the boxes. ``n``: rows of each leaf that count."""
        n = self.n if n is None else n
        far = sum(np.maximum(np.abs(rows[:, i, None] - self.lo[None, :, i]), np.abs(rows[:, i, None] - self.hi[None, :, i])) ** 2
                  for i in range(rows.shape[1]))
        order = np.argsort(far, axis=1)
        enough = np.cumsum(n[order], axis=1) >= k
        last = np.take_along_axis(far, order, axis=1)[np.arange(len(rows)), enough.argmax(axis=1)]
        return np.where(enough.any(axis=1), last, np.inf)

    def reached(self, rows, bound, own):
        """(row, block) pairs, but those of block ``own``, whose leaf's box is within the square ``bound`` of the row."""
        gap = np.maximum(0.0, np.maximum(self.lo - rows.max(axis=0), rows.min(axis=0) - self.hi))
        near = np.flatnonzero((gap ** 2).sum(axis=1) <= bound.max())
        found = []
        step = max(1, PAIRS // max(1, len(near)))
        for at in range(0, len(rows), step):
            some = rows[at:at + step]
            total = np.zeros((len(some), len(near)))
            for i in range(rows.shape[1]):
                total += np.maximum(0.0, np.maximum(self.lo[near, i] - some[:, i, None], some[:, i, None] - self.hi[near, i])) ** 2
            row, leaf = np.nonzero(total <= bound[at:at + step, None])
            row, leaf = row + at, near[leaf]
            times = self.blocks[leaf]
            within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            row, unit = np.repeat(row, times), np.repeat(self.start[leaf], times) + within
            found.append((row[unit != own], unit[unit != own]))
        return tuple(np.concatenate(part) for part in zip(*found))


def _closest(left, right, k, bound):
    """(row, other, square) of the k closest others of each row within the square ``bound``; equal squares in the order of the others."""
    found = []
    step = max(1, PAIRS // max(1, len(right)))
    for at in range(0, len(left) if len(right) else 0, step):
        some = left[at:at + step]
        total = np.zeros((len(some), len(right)))
        for i in range(left.shape[1]):
            total += (some[:, i, None] - right[None, :, i]) ** 2
        limit = bound[at:at + step].copy()
        many = np.flatnonzero((total <= limit[:, None]).sum(axis=1) > k)
        if len(many):
            limit[many] = np.partition(total[many], k - 1, axis=1)[:, k - 1]
        row, other = np.nonzero(total <= limit[:, None])
        square = total[row, other]
        order = np.lexsort((other, square, row))
        row, other, square = row[order], other[order], square[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        found.append((row[place < k] + at, other[place < k], square[place < k]))
    if not found:
        return np.zeros(0, dtype=int), np.zeros(0, dtype=int), np.zeros(0)
    return tuple(np.concatenate(part) for part in zip(*found))


def _salted(rows, train, block_rows):
    """Both sides by block and salt: a block that many rows visit is compared in several tasks."""
    spark = train.sparkSession
    load = [(r["_unit"], -(-r["count"] // (4 * block_rows))) for r in rows.groupBy("_unit").count().collect()]
    salts = F.broadcast(spark.createDataFrame(load, "_unit int, _salts int"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ["_unit", "_salt"]
    rows = rows.join(salts, "_unit").withColumn("_salt", F.pmod(F.xxhash64("_rid"), F.col("_salts")).cast("int")).drop("_salts")
    train = train.join(salts, "_unit").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_salts")
    # the rows are small, the comparisons are not: keep AQE from merging them into few tasks
    return rows.repartition(parts, *keys).groupBy(*keys).cogroup(train.repartition(parts, *keys).groupBy(*keys))


def _placed(train, test, features, id_column, label, n_pivots, block_rows, seed, of_train=(), of_test=()):
    """(training rows, test rows, boxes), the rows with their block (and training rows with their leaf). What reaches the driver is the sample and a
    few numbers per leaf."""
    as_double = [F.col(f).cast("double").alias(f) for f in features]
    whole = " AND ".join(f"`{f}` IS NOT NULL AND NOT isnan(`{f}`)" for f in features)
    train = train.select(F.col(id_column).alias("_sid"), F.col(label).alias("_label"), *as_double, *of_train).where(whole)
    test = test.select(F.col(id_column).alias("_rid"), *as_double, *of_test).where(whole)
    wanted = max(n_pivots or 1, -(-train.count() // block_rows))
    depth = min(MAX_LEAVES.bit_length() - 1, (wanted - 1).bit_length())
    sample = train.orderBy(hash_key(seed, "_sid")).select(*features).limit(SAMPLE_PER_LEAF << depth).toPandas().to_numpy(dtype=float)
    if not len(sample):
        raise ValueError("no training rows")
    tree = Tree(sample, depth)

    @F.pandas_udf("int")
    def leaf(rows: pd.DataFrame) -> pd.Series:
        return pd.Series(tree.leaves(rows.to_numpy(dtype=float)))

    extremes = [side(f).alias(f"{name}{i}") for i, f in enumerate(features) for name, side in (("lo", F.min), ("hi", F.max))]
    placed = train.withColumn("_leaf", leaf(F.struct(*features)))
    boxes = Boxes(placed.groupBy("_leaf").agg(F.count(F.lit(1)).alias("n"), *extremes).collect(), 1 << depth, block_rows, len(features))

    @F.pandas_udf("int")
    def unit(rows: pd.DataFrame, hashes: pd.Series) -> pd.Series:
        return pd.Series(boxes.unit(tree.leaves(rows.to_numpy(dtype=float)), hashes.to_numpy()))

    train = placed.withColumn("_unit", unit(F.struct(*features), F.xxhash64("_sid")))
    test = test.withColumn("_unit", unit(F.struct(*features), F.xxhash64("_rid")))
    return train, test, boxes


def _rounds(train, test, features, id_column, label, k, n_pivots, block_rows, seed):
    """(found, training rows, test rows), the rows with their block: ``found`` (written) has for each test row its closest rows in a block of its own leaf (``_unit`` -1), and
    a row per other block to visit. What reaches the driver is the sample and a few numbers per leaf and block."""
    train, test, boxes = _placed(train, test, features, id_column, label, n_pivots, block_rows, seed)
    train = train.drop("_leaf")
    types = {name: frame.schema[name].dataType.simpleString() for frame, name in ((test, "_rid"), (train, "_sid"), (train, "_label"))}
    schema = ", ".join([f"_rid {types['_rid']}", *[f"`{f}` double" for f in features], "_bound double, _unit int",
                        f"_sid {types['_sid']}, _label {types['_label']}, _square double"])
    columns = ["_rid", *features, "_bound", "_unit", "_sid", "_label", "_square"]

    def own_block(key, rows, others):
        if not len(rows):
            return pd.DataFrame({c: [] for c in columns})
        others = others.sort_values("_sid", kind="stable", ignore_index=True)
        left = rows[features].to_numpy()
        bound = np.full(len(rows), np.inf)
        row, other, square = _closest(left, others[features].to_numpy(), k, bound)
        if len(others) >= k:
            bound = square.reshape(-1, k)[:, -1]
        else:
            step = max(1, PAIRS // len(boxes.n))
            bound = np.concatenate([boxes.farthest(left[at:at + step], k) for at in range(0, len(left), step)])
        bound = bound * (1 + 1e-9)
        to, units = boxes.reached(left, bound, int(key[0]))
        rows = rows.assign(_bound=bound)[["_rid", *features, "_bound"]]
        near = rows.take(row).assign(_unit=-1, _sid=others["_sid"].to_numpy()[other], _label=others["_label"].to_numpy()[other], _square=square)
        # id and label of a visit are not read: any value keeps the columns' types
        any_id, any_label = (others["_sid"].iloc[0], others["_label"].iloc[0]) if len(others) else (None, None)
        visits = rows.take(to).assign(_unit=units, _sid=any_id, _label=any_label, _square=0.0)
        return pd.concat([part for part in (near, visits) if len(part)] or [near], ignore_index=True)

    return materialize(_salted(test, train, block_rows).applyInPandas(own_block, schema), "knn"), train, test


def compared_share(train, test, features, id_column="field_id", label="label", k=5, n_pivots=None, block_rows=BLOCK_ROWS, seed=7):
    """Share of all pairs of rows that ``nearest_neighbours`` compares."""
    found, train, test = _rounds(train, test, list(features), id_column, label, k, n_pivots, block_rows, seed)
    sizes = {r["_unit"]: r["count"] for r in train.groupBy("_unit").count().collect()}
    seen = test.select("_unit").unionByName(found.where("_unit >= 0").select("_unit"))
    met = sum(r["count"] * sizes.get(r["_unit"], 0) for r in seen.groupBy("_unit").count().collect())
    return met / max(1, sum(sizes.values()) * test.count())


def nearest_neighbours(train, test, features, id_column="field_id", label="label", k=5, n_pivots=None,
                       block_rows=BLOCK_ROWS, seed=7):
    """(id, neighbour_id, neighbour_label, distance, place) of the k nearest training rows.

    Equal distances are ordered by the neighbour's id. Rows that lack a feature have and are no neighbours. ``n_pivots``: leaves at least.
    """
    features = list(features)
    found, train, _ = _rounds(train, test, features, id_column, label, k, n_pivots, block_rows, seed)
    columns = ["_rid", "_sid", "_label", "_square"]

    def compare(rows: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        others = others.sort_values("_sid", kind="stable", ignore_index=True)
        row, other, square = _closest(rows[features].to_numpy(), others[features].to_numpy(), k, rows["_bound"].to_numpy())
        return pd.DataFrame({"_rid": rows["_rid"].to_numpy()[row], "_sid": others["_sid"].to_numpy()[other],
                             "_label": others["_label"].to_numpy()[other], "_square": square})

    near, visits = found.where("_unit < 0").select(*columns), found.where("_unit >= 0").select("_rid", *features, "_bound", "_unit")
    others = _salted(visits, train, block_rows).applyInPandas(compare, near.schema)
    order = Window.partitionBy("_rid").orderBy("_square", "_sid")
    return near.unionByName(others).withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).select(
        F.col("_rid").alias(id_column), F.col("_sid").alias("neighbour_id"), F.col("_label").alias("neighbour_label"),
        F.sqrt("_square").alias("distance"), "place")


def knn_predict(train, test, features, id_column="field_id", label="label", k=5, **options):
    """Majority label of the k nearest; a tie goes to the smallest label."""
    near = nearest_neighbours(train, test, features, id_column, label, k, **options)
    votes = near.groupBy(id_column, "neighbour_label").agg(F.count(F.lit(1)).alias("_votes"))
    return votes.groupBy(id_column).agg(
        F.min_by("neighbour_label", F.struct(-F.col("_votes"), F.col("neighbour_label"))).alias("prediction"))


# --- several questions about the same rows -----------------------------------

class Block:
    """Training rows of a block, cut into small leaves with their boxes."""

    def __init__(self, rows):
        self.tree = Tree(rows, max(0, (len(rows) // VIEW_LEAF_ROWS).bit_length() - 1))
        leaf = self.tree.leaves(rows)
        order = np.argsort(leaf, kind="stable")
        number, start = np.unique(leaf[order], return_index=True)
        self.members = np.split(order, start[1:])
        self.lo, self.hi = (np.array([side(rows[m], axis=0) for m in self.members]) for side in (np.min, np.max))
        self.home = np.minimum(np.searchsorted(number, np.arange(2 ** self.tree.depth)), len(number) - 1)

    def groups(self, rows):
        """(leaf, numbers of rows in or next to it), few at a time."""
        home = self.home[self.tree.leaves(rows)]
        order = np.argsort(home, kind="stable")
        for some in np.split(order, np.flatnonzero(np.diff(home[order])) + 1):
            for at in range(0, len(some), 2 * VIEW_LEAF_ROWS):
                yield home[some[0]], some[at:at + 2 * VIEW_LEAF_ROWS]

    def reached(self, rows, bound):
        """Rows of the leaves that come within the square ``bound`` of the rows' box, in order."""
        gap = np.maximum(0.0, np.maximum(self.lo - rows.max(axis=0), rows.min(axis=0) - self.hi))
        near = np.flatnonzero((gap ** 2).sum(axis=1) <= bound * (1 + 1e-9))
        return np.sort(np.concatenate([self.members[i] for i in near])) if len(near) else np.zeros(0, dtype=int)


def _squares(left, right):
    total, gap = np.zeros((len(left), len(right))), np.empty((len(left), len(right)))
    for i in range(left.shape[1]):
        np.subtract(left[:, i, None], right[None, :, i], out=gap)
        np.multiply(gap, gap, out=gap)
        total += gap
    return total


def _counts(part, fold):
    """Whether training rows count for rows: their fold is known and not the row's own."""
    return True if fold is None else (fold != part) & ~np.isnan(fold)


def _first(row, k):
    """Marks the first k entries of each row; the rows are in order."""
    return np.arange(len(row)) - np.searchsorted(row, row) < k


def closest_by_view(left, parts, right, folds, k, bound=None):
    """(row, view, other, square) of the k closest others of each row in each view, equal squares in the order of the others.

    ``parts``: (row, view), NaN where a row does not ask; ``folds``: for each view None or the folds of the others; ``bound``: (row, view) squares beyond
    which nothing is wanted. Distances are found once for all views.
    """
    found = [(np.zeros(0, dtype=int),) * 3 + (np.zeros(0),)]
    block = Block(right) if len(right) else None
    for leaf, group in block.groups(left) if block and len(left) else ():
        asked = ~np.isnan(parts[group])
        if bound is None:
            limit = np.full(asked.shape, np.inf)
            seeds = block.members[leaf]
            if len(seeds) >= k:
                total = _squares(left[group], right[seeds])
                for v, fold in enumerate(folds):
                    valid = _counts(parts[group, v][:, None], None if fold is None else fold[seeds][None])
                    limit[:, v] = np.partition(np.where(valid, total, np.inf), k - 1, axis=1)[:, k - 1]
        else:
            limit = bound[group]
        limit = np.where(asked, limit, -1.0)
        near = block.reached(left[group], limit.max())
        step = max(1, PAIRS // max(1, len(near)))
        for at in range(0, len(group) if len(near) else 0, step):
            some, most = group[at:at + step], limit[at:at + step]
            total, top = _squares(left[some], right[near]), most.max(axis=1)
            pool = top
            if len(near) > VIEW_POOL + k:
                pool = np.minimum(top, np.partition(total, VIEW_POOL + k - 1, axis=1)[:, VIEW_POOL + k - 1])
            row, other = np.nonzero(total <= pool[:, None])
            square = total[row, other]
            order = np.lexsort((other, square, row))
            row, other, square = row[order], other[order], square[order]
            for v, fold in enumerate(folds):
                part, fold = parts[some, v], None if fold is None else fold[near]
                mine = (square <= most[row, v]) & _counts(part[row], None if fold is None else fold[other])
                enough = (np.bincount(row[mine], minlength=len(some)) >= k) | (pool >= most[:, v])
                mine &= enough[row]
                keep = np.flatnonzero(mine)[_first(row[mine], k)]
                found.append((some[row[keep]], np.full(len(keep), v), near[other[keep]], square[keep]))
                # too few of the closest count for these rows: all are looked at
                few = np.flatnonzero(~enough)
                if len(few):
                    masked = np.where(_counts(part[few][:, None], None if fold is None else fold[None]), total[few], np.inf)
                    to = np.minimum(most[few, v], np.partition(masked, min(k, len(near)) - 1, axis=1)[:, min(k, len(near)) - 1])
                    r, o = np.nonzero((masked <= to[:, None]) & np.isfinite(masked))
                    order = np.lexsort((o, masked[r, o], r))
                    r, o = r[order], o[order]
                    keep = _first(r, k)
                    r, o = r[keep], o[keep]
                    found.append((some[few[r]], np.full(len(r), v), near[o], masked[r, o]))
    return tuple(np.concatenate(part) for part in zip(*found))


def knn_predict_views(train, test, features, id_column, label, views, k=5, block_rows=VIEW_BLOCK_ROWS, seed=7):
    """(id, view, part, prediction): ``knn_predict`` for several sets of training rows at once, with one search.

    ``views``: pairs of a column of the test rows, their part of the view (a whole number, NULL: the row isn't asked for), and None or a column of
    the training rows: those whose value there is NULL or the test row's part do not count. Rows of a part of a view are a test set by themselves.
    """
    features = list(features)
    asked, fold_columns = [f"_p{v}" for v in range(len(views))], [f"_f{v}" for v in range(len(views))]
    bounds = [f"_b{v}" for v in range(len(views))]
    train, test, boxes = _placed(
        train, test.where(F.coalesce(*[F.col(part) for part, _ in views]).isNotNull()), features, id_column, label, None, block_rows, seed,
        [(F.lit(None) if fold is None else F.col(fold)).cast("double").alias(f) for (_, fold), f in zip(views, fold_columns)],
        [F.col(part).cast("double").alias(p) for (part, _), p in zip(views, asked)])
    sizes = train.groupBy("_leaf", *fold_columns).agg(F.count(F.lit(1)).alias("n")).toPandas()  # a row per leaf and combination of folds
    train = train.drop("_leaf")
    leaves = np.unique(sizes["_leaf"])
    types = {name: frame.schema[name].dataType.simpleString() for frame, name in ((test, "_rid"), (train, "_sid"), (train, "_label"))}
    near_schema = f"_rid {types['_rid']}, _view int, _part int, _sid {types['_sid']}, _label {types['_label']}, _square double"
    near_columns = ["_rid", "_view", "_part", "_sid", "_label", "_square"]
    visit_columns = [*features, *asked, *bounds, "_unit"]
    schema = ", ".join([near_schema, *[f"`{c}` double" for c in visit_columns[:-1]], "_unit int"])

    def counting(v, part):
        """Rows of each leaf that count for a part of a view."""
        mine = sizes if views[v][1] is None else sizes[sizes[fold_columns[v]].notna() & (sizes[fold_columns[v]] != part)]
        return mine.groupby("_leaf")["n"].sum().reindex(leaves, fill_value=0).to_numpy()

    def in_order(others):
        others = others.sort_values("_sid", kind="stable", ignore_index=True)
        return others, [None if fold is None else others[f].to_numpy(dtype=float) for (_, fold), f in zip(views, fold_columns)]

    def pairs(rows, others, parts, row, view, other, square):
        return pd.DataFrame({"_rid": rows["_rid"].to_numpy()[row], "_view": view.astype("int32"), "_part": parts[row, view].astype("int32"),
                             "_sid": others["_sid"].to_numpy()[other], "_label": others["_label"].to_numpy()[other], "_square": square})

    def own_block(key, rows, others):
        if not len(rows):
            return pd.DataFrame({c: [] for c in [*near_columns, *visit_columns]})
        others, folds = in_order(others)
        left, parts = rows[features].to_numpy(), rows[asked].to_numpy(dtype=float)
        row, view, other, square = closest_by_view(left, parts, others[features].to_numpy(), folds, k)
        bound, number = np.zeros(parts.shape), np.zeros(parts.shape, dtype=int)
        np.maximum.at(bound, (row, view), square)
        np.add.at(number, (row, view), 1)
        for v in range(len(views)):
            open_ = (number[:, v] < k) & ~np.isnan(parts[:, v])
            for part in np.unique(parts[open_, v]):
                mine, n = np.flatnonzero(open_ & (parts[:, v] == part)), counting(v, part)
                step = max(1, PAIRS // len(boxes.n))
                for at in range(0, len(mine), step):
                    bound[mine[at:at + step], v] = boxes.farthest(left[mine[at:at + step]], k, n)
        bound = np.where(np.isnan(parts), -1.0, bound * (1 + 1e-9))
        to, units = boxes.reached(left, bound.max(axis=1), int(key[0]))
        near = pairs(rows, others, parts, row, view, other, square).assign(**{c: np.nan for c in visit_columns[:-1]}, _unit=-1)
        # id and label of a visit are not read: any value keeps the columns' types
        any_id, any_label = (others["_sid"].iloc[0], others["_label"].iloc[0]) if len(others) else (None, None)
        visits = rows[["_rid", *features, *asked]].assign(**{b: bound[:, v] for v, b in enumerate(bounds)}).take(to).assign(
            _unit=units, _view=-1, _part=-1, _sid=any_id, _label=any_label, _square=0.0)
        return pd.concat([part for part in (near, visits) if len(part)] or [near], ignore_index=True)[[*near_columns, *visit_columns]]

    def compare(rows: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        others, folds = in_order(others)
        parts = rows[asked].to_numpy(dtype=float)
        found = closest_by_view(rows[features].to_numpy(), parts, others[features].to_numpy(), folds, k, rows[bounds].to_numpy())
        return pairs(rows, others, parts, *found)

    found = materialize(_salted(test, train, block_rows).applyInPandas(own_block, schema), "knn")
    near, visits = found.where("_unit < 0").select(*near_columns), found.where("_unit >= 0").select("_rid", *visit_columns)
    others = _salted(visits, train, block_rows).applyInPandas(compare, near_schema)
    mine = ["_view", "_part", "_rid"]
    place = F.row_number().over(Window.partitionBy(*mine).orderBy("_square", "_sid"))
    votes = near.unionByName(others).withColumn("_place", place).where(F.col("_place") <= k).groupBy(*mine, "_label").agg(F.count(F.lit(1)).alias("_votes"))
    return votes.groupBy(*mine).agg(F.min_by("_label", F.struct(-F.col("_votes"), F.col("_label"))).alias("prediction")).select(
        F.col("_rid").alias(id_column), F.col("_view").alias("view"), F.col("_part").alias("part"), "prediction")
