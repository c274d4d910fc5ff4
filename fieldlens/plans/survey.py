"""Band means of each field at its survey date: the main result."""

from pyspark.sql import functions as F

from fieldlens.constants import ALL_BANDS, NOT_CLEAR_CLASSES
from fieldlens.functions.spectral import ndvi_of_means, ndwi_of_means
from fieldlens.operators.asof import asof_nearest
from fieldlens.operators.bandstats import band_mean_wide
from fieldlens.session import materialize


def clear_crop_means(pixels, bands=ALL_BANDS, scl="SCL_20m", fill="mask", classes=NOT_CLEAR_CLASSES):
    """Clear test and all band means of every crop in one pass and one shuffle on (field, product)."""
    cloudy = F.bool_or(F.col(scl).isin(*classes)).alias("_cloudy")
    crops = band_mean_wide(pixels, bands, fill, extra=(cloudy,))
    return crops.where(~F.col("_cloudy")).drop("_cloudy")


# Chosen crops that may be sent to every executor (some 50 MB); more are left to Spark's own choice of join.
BROADCAST_ROWS = 500_000


def band_means_at_survey(fields, products, pixels, bands=ALL_BANDS, fill="mask", rejected=None):
    """Fields with the clear acquisition nearest to their survey date and its band means.

    The clear test reduces all pixels to crops before any join; band means are then formed of the chosen crops' pixels alone, one crop a
    field, so what is shuffled beside the test is a small share of the pixels. ``rejected`` holds (field_id, uuid) pairs that a
    reader found cloudy after all; the next nearest is then chosen for those fields.
    """
    crops = clear_crop_means(pixels, (), fill=fill)
    if rejected is not None:
        crops = crops.join(rejected.select("field_id", "uuid").distinct(), ["field_id", "uuid"], "left_anti")
    dated = crops.join(products.select("uuid", "generationdate"), "uuid")
    chosen = materialize(asof_nearest(fields, dated), "chosen")
    wanted = chosen.where(F.col("uuid").isNotNull()).select("field_id", "uuid").distinct()
    wanted = F.broadcast(wanted) if wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else wanted
    means = band_mean_wide(pixels.join(wanted, ["field_id", "uuid"], "left_semi"), bands, fill, passes=1)
    chosen = chosen.join(means, ["field_id", "uuid"], "left").select(*chosen.columns, *bands)
    chosen = chosen.withColumnsRenamed({"uuid": "nearest_product_uuid", "generationdate": "nearest_product_generationdate"})
    if {"B08_10m", "B04_10m"} <= set(bands):
        chosen = chosen.withColumn("mean_ndvi", ndvi_of_means())
    if {"B03_20m", "B8A_20m"} <= set(bands):
        chosen = chosen.withColumn("mean_ndwi", ndwi_of_means())
    return chosen
