"""Exact positions in a total order, without sorting any group in one task.

Rows are put into buckets that follow the order. The bucket sizes (a small table) give each bucket
its start, and only the rows within a bucket are sorted together.
"""

from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Window
from pyspark.sql import functions as F

def join_on(left, right, keys, how="inner"):
    """Join on columns of the same name in which NULL equals NULL, so that no group is lost."""
    named = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(named, same, how).drop(*[f"_r_{k}" for k in keys])


HASH_BUCKETS = 1 << 16
VALUE_BUCKETS = 512


def hash_key(seed, id_column):
    """Shuffle order: repeatable for a seed, the same in any engine that has md5."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(id_column).cast("string")).cast("binary"))


def hash_bucket(key, buckets=HASH_BUCKETS):
    """Bucket of an md5 text; even by nature of the hash, and in its order."""
    return F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint") / F.lit(2**32 // buckets)).cast("int")


def value_bucket(df, column, buckets=VALUE_BUCKETS, out="_bucket"):
    """Bucket of a number by approximate quantiles; any split points give exact positions."""
    if not column.isidentifier():
        raise ValueError(column)
    as_double = df.withColumn("_order", F.col(column).cast("double"))
    inner = [i / buckets for i in range(1, buckets)]
    splits = sorted(set(as_double.approxQuantile("_order", inner, 0.25 / buckets)))
    bounded = [float("-inf"), *(splits or [0.0]), float("inf")]
    bucketed = Bucketizer(splits=bounded, inputCol="_order", outputCol="_bucket_double", handleInvalid="keep").transform(as_double)
    return bucketed.withColumn(out, F.col("_bucket_double").cast("int")).drop("_order", "_bucket_double")


def bucket_starts(df, by, bucket="_bucket", weight=None):
    """Rows (or summed weight) before each bucket, per group."""
    size = F.count(F.lit(1)) if weight is None else F.sum(weight)
    sizes = df.groupBy(*by, bucket).agg(size.alias("_size"))
    before = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("_start", F.coalesce(F.sum("_size").over(before), F.lit(0)))


def positions(df, by, order, bucket="_bucket", out="position"):
    """0-based position of each row in its group, in the order (bucket, order)."""
    starts = bucket_starts(df, by, bucket).drop("_size")
    within = Window.partitionBy(*by, bucket).orderBy(*order)
    placed = df.withColumn("_place", F.row_number().over(within) - 1)
    return (
        join_on(placed, starts, [*by, bucket])
        .withColumn(out, (F.col("_start") + F.col("_place")).cast("bigint"))
        .drop("_start", "_place", bucket)
    )


def quantiles(df, by, column, probs):
    """Exact, linearly interpolated quantiles per group: one row per group, q0, q1, ...

    Equal values are counted together first, then running counts over the buckets tell which two
    values each quantile lies between.
    """
    counted = df.where(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count(F.lit(1)).alias("_n"))
    counted = value_bucket(counted, column)
    starts = bucket_starts(counted, by, weight="_n").drop("_size")
    within = Window.partitionBy(*by, "_bucket").orderBy(column).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        join_on(counted.withColumn("_cum", F.sum("_n").over(within)), starts, [*by, "_bucket"])
        .withColumn("_to", F.col("_start") + F.col("_cum")).withColumn("_from", F.col("_to") - F.col("_n"))
    )
    totals = counted.groupBy(*by).agg(F.sum("_n").alias("_total"))
    ranked = join_on(placed, totals, list(by)) if by else placed.withColumn("_total", F.lit(counted.agg(F.sum("_n")).first()[0]))
    aggs = []
    for i, p in enumerate(probs):
        target = F.lit(p) * (F.col("_total") - 1)
        at = lambda r: F.max(F.when((F.col("_from") <= r) & (r < F.col("_to")), F.col(column)))
        lower, upper, share = at(F.floor(target)), at(F.ceil(target)), F.max(target - F.floor(target))
        aggs.append((lower + (upper - lower) * share).alias(f"q{i}"))
    return ranked.groupBy(*by).agg(*aggs)
