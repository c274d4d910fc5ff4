"""Nearest-in-time joins. An equal distance goes to the later time, then to the smaller id."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from fieldlens.functions.dates import epoch_micros


def asof_nearest(fields, candidates, payload=(), probe_time="survey_date", time="generationdate", key="field_id",
                 tie="uuid"):
    """For tables with one probe per key (a field has one survey date).

    The join then gives one row per candidate and nothing more. The nearest one is an aggregate that
    combines on the map side, so a key that holds a large share of the candidates sends one row per
    task and nothing is sorted. Keys without a probe time or without candidates are kept with NULLs.
    """
    probes = fields.where(F.col(probe_time).isNotNull()).select(key, F.col(probe_time).alias("_probe"))
    distance = epoch_micros(F.col(time)) - epoch_micros(F.col("_probe"))
    order = F.struct(F.abs(distance), -epoch_micros(F.col(time)), F.col(tie))
    best = (
        candidates.where(F.col(time).isNotNull()).select(key, tie, time, *payload).join(probes, key)
        .groupBy(key).agg(F.min_by(F.struct(tie, time, *payload), order).alias("_best")).select(key, "_best.*")
    )
    return fields.join(best, key, "left")


def asof_next_nearest(fields, candidates, rejected, **options):
    """Choose again after dropping rejected (field_id, uuid) pairs."""
    keys = [options.get("key", "field_id"), options.get("tie", "uuid")]
    left = candidates.join(rejected.select(*keys).distinct(), keys, "left_anti")
    return asof_nearest(fields, left, **options)


def asof_nearest_series(probes, series, key, probe_time, time, tie, bucket_seconds):
    """For long series with many probes per key.

    Both sides are cut into time buckets, so one key's rows spread over many tasks. Within a
    bucket two windows carry the last and the next series row; the rows just outside come from a
    summary of one row per key and bucket. Repeated instants are reduced first on either side.
    Probe rows without any series row of their key are kept with NULLs.
    """
    width = int(bucket_seconds * 1_000_000)
    bucket = lambda t: F.floor(t / F.lit(width)).cast("bigint")
    points = (
        series.where(F.col(time).isNotNull())
        .groupBy(F.col(key).alias("_key"), epoch_micros(F.col(time)).alias("_t")).agg(F.min(tie).alias("_id"))
    )
    wanted = (
        probes.where(F.col(probe_time).isNotNull())
        .select(F.col(key).alias("_key"), epoch_micros(F.col(probe_time)).alias("_t")).distinct()
    )
    point = F.struct(F.col("_t").alias("t"), F.col("_id").alias("id"))
    both = points.select("_key", "_t", point.alias("_point"), F.lit(0).alias("_is_probe")).unionByName(
        wanted.select("_key", "_t", F.lit(None).cast(points.select(point.alias("p")).schema["p"].dataType).alias("_point"),
                      F.lit(1).alias("_is_probe")))
    both = both.withColumn("_bucket", bucket(F.col("_t")))

    within = Window.partitionBy("_key", "_bucket").orderBy("_t", "_is_probe")
    carried = both.withColumns({
        "_before": F.last("_point", ignorenulls=True).over(within),
        "_after": F.first("_point", ignorenulls=True).over(
            within.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
    }).where("_is_probe = 1")

    edges = both.groupBy("_key", "_bucket").agg(F.min("_point").alias("_first"), F.max("_point").alias("_last"))
    over = Window.partitionBy("_key").orderBy("_bucket")
    outside = edges.select(
        "_key", "_bucket",
        F.last("_last", ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, -1)).alias("_previous"),
        F.first("_first", ignorenulls=True).over(over.rowsBetween(1, Window.unboundedFollowing)).alias("_next"),
    )
    options = F.filter(F.array("_before", "_after", "_previous", "_next"), lambda p: p.isNotNull())
    ranked = F.transform(options, lambda p: F.struct(
        F.abs(p["t"] - F.col("_t")).alias("d"), (-p["t"]).alias("later"), p["id"].alias("id"), p["t"].alias("t")))
    nearest = carried.join(outside, ["_key", "_bucket"]).select(
        "_key", "_t", F.array_min(ranked).alias("_best"))
    answers = nearest.select(
        "_key", "_t", F.col("_best.id").alias(f"nearest_{tie}"),
        F.timestamp_micros("_best.t").cast("timestamp_ntz").alias(f"nearest_{time}"))
    keyed = probes.withColumns({"_key": F.col(key), "_t": epoch_micros(F.col(probe_time))})
    return keyed.join(answers, ["_key", "_t"], "left").drop("_key", "_t")
