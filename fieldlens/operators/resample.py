"""Splits and folds: seeded by md5, exact in size, and free of single-task sorts."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from fieldlens.operators.ranks import bucket_starts, hash_bucket, hash_key, join_on, positions, value_bucket


def train_test_split(df, id_column="field_id", train=0.75, seed=7, by=(), out="is_train"):
    """Adds ``is_train``: the first floor(train * n) rows of the md5 order.

    The bucket sizes settle all rows but those of the one bucket that holds the cut; only its rows
    are sorted. ``by`` splits each group on its own.
    """
    by = list(by)
    keyed = df.withColumn("_md5", hash_key(seed, id_column)).withColumn("_bucket", hash_bucket(F.col("_md5")))
    starts = bucket_starts(keyed, by)
    whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    cut = F.floor(F.lit(train) * F.sum("_size").over(whole)).cast("bigint")
    marked = join_on(keyed, starts.withColumn("_cut", cut), [*by, "_bucket"])
    straddles = (F.col("_start") < F.col("_cut")) & (F.col("_start") + F.col("_size") > F.col("_cut"))
    within = Window.partitionBy(*by, "_bucket").orderBy("_md5", id_column)
    settled = marked.where(~straddles).withColumn(out, F.col("_start") < F.col("_cut"))
    open_rows = marked.where(straddles).withColumn(
        out, F.col("_start") + F.row_number().over(within) <= F.col("_cut"))
    return settled.unionByName(open_rows).drop("_md5", "_bucket", "_start", "_size", "_cut")


def _class_layout(df, label, id_column, by):
    """Size and offset per class; classes follow each other by their first row."""
    classes = df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("_m"), F.min(id_column).alias("_first"))
    before = Window.partitionBy(*by).orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)
    return classes.select(*by, label, "_m", F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_o"))


def _fold_column(rank, offset, size, k):
    """Fold of the row with a rank in its class: fold i takes as many rows of the class as there are
    positions p with p % k = i in the class's stretch of the class-sorted order."""
    up_to = lambda x, i: F.floor((x + F.lit(k - 1 - i)) / F.lit(k))
    fold = F.lit(0)
    running = F.lit(0)
    for i in range(k - 1):
        running = running + up_to(offset + size, i) - up_to(offset, i)
        fold = fold + F.when(rank >= running, 1).otherwise(0)
    return fold.cast("int")


def _folds(ranked, layout, label, by, k, out):
    joined = join_on(ranked, layout, [*by, label])
    return joined.withColumn(out, _fold_column(F.col("_rank"), F.col("_o"), F.col("_m"), k)).drop("_rank", "_m", "_o")


def _by_label(df, label, out):
    """(rows with a label, rows without one and without a fold)."""
    return df.where(F.col(label).isNotNull()), df.where(F.col(label).isNull()).withColumn(out, F.lit(None).cast("int"))


def stratified_folds(df, label, id_column="field_id", k=5, seed=7, by=(), out="fold"):
    """Shuffled folds that keep the class shares. Rows without a label are kept with no fold."""
    by, known, rest = list(by), *_by_label(df, label, out)
    keyed = known.withColumn("_md5", hash_key(seed, id_column)).withColumn("_bucket", hash_bucket(F.col("_md5")))
    ranked = positions(keyed, [*by, label], ["_md5", id_column], out="_rank").drop("_md5")
    return _folds(ranked, _class_layout(known, label, id_column, by), label, by, k, out).unionByName(rest)


def contiguous_folds(df, label, id_column="field_id", order_column=None, k=5, by=(), out="fold"):
    """The same without shuffling: rows of a class fill the folds in id order.

    ``order_column`` is a numeric column in the same order as the id; without it the id is numeric.
    Rows without a label are kept with no fold, rows without an order come first.
    """
    by, known, rest = list(by), *_by_label(df, label, out)
    order = order_column or id_column
    bucketed = value_bucket(known, order)
    ranked = positions(bucketed, [*by, label], [order, id_column], out="_rank")
    return _folds(ranked, _class_layout(known, label, order, by), label, by, k, out).unionByName(rest)


def balanced_weights(df, label, out="weight"):
    """n / (number of classes * rows of the class), NULL without a label. Class sizes are joined back, so no class is
    gathered in one task."""
    sizes = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("_m"))
    whole = Window.partitionBy(F.lit(1))
    weights = sizes.select(
        label, (F.sum("_m").over(whole) / (F.count(F.lit(1)).over(whole) * F.col("_m"))).alias(out))
    return df.join(weights, label, "left")
