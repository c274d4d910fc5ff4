"""Ingest only what has not been seen: a file stream whose batches leave mergeable partial sums.

Each micro-batch writes, per crop, the pixel counts and sums that the clear test and the band means
are made of. Sums add up, so a scene may arrive in any number of files and in any order; the means
are formed when the table is read. Batches are merged as they pile up, see ``segments``.
"""

from pyspark.sql import functions as F

from fieldlens.constants import ALL_BANDS, NOT_CLEAR_CLASSES
from fieldlens.streaming import segments


def crop_partials(pixels, bands=ALL_BANDS, scl="SCL_20m", keys=("field_id", "uuid")):
    counts = [F.count(b).alias(f"n_{b}") for b in bands]
    sums = [F.sum(F.col(b).cast("double")).alias(f"sum_{b}") for b in bands]
    unclear = F.count_if(F.col(scl).isin(*NOT_CLEAR_CLASSES)).alias("n_unclear")
    return pixels.groupBy(*keys).agg(F.count(scl).alias("n_scl"), unclear, *counts, *sums)


def merge_partials(partials, bands=ALL_BANDS, keys=("field_id", "uuid")):
    """Partial sums of any number of batches -> clear flag and band means per crop."""
    means = [F.try_divide(F.sum(f"sum_{b}"), F.sum(f"n_{b}")).alias(b) for b in bands]
    # a crop without any class pixel is neither clear nor cloudy, as in the batch test
    cloudy = F.when(F.sum("n_scl") > 0, F.sum("n_unclear") > 0).alias("is_cloudy")
    return partials.groupBy(*keys).agg(cloudy, *means)


def add_partials(partials, keys=("field_id", "uuid")):
    """The partial sums of a crop added up to one row, of the same columns."""
    return partials.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in partials.columns if c not in keys])


def ingest_new_products(source, to_pixels, out, checkpoint, bands=ALL_BANDS, fanout=segments.FANOUT, **trigger):
    """Run once over all files that arrived since the last run, then stop.

    ``source`` is a streaming DataFrame, ``to_pixels`` maps its batches to wide pixels. A batch
    writes its own folder and overwrites it when it is repeated after a failure, so every file
    counts exactly once. Batches before the present one are finished; ``fanout`` of them are merged.
    """

    def write(batch, batch_id):
        crop_partials(to_pixels(batch), bands).write.mode("overwrite").parquet(segments.batch_folder(out, batch_id))
        segments.merge_segments(batch.sparkSession, out, add_partials, below=batch_id, fanout=fanout)

    query = (
        source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )
    query.awaitTermination()
    return query


def read_ingested(spark, out, bands=ALL_BANDS):
    """Clear flag and band means of all that was ingested up to now: one version of the folder."""
    return merge_partials(spark.read.parquet(*segments.live_folders(spark, out)), bands)
