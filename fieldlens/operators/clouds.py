"""Which acquisitions are clear over which field."""

from pyspark.sql import functions as F

from fieldlens.constants import CLOUD_ALERT, CLOUD_CLASSES, NOT_CLEAR_CLASSES
from fieldlens.functions.dates import date_label


def cloud_flag(pixels, scl="SCL_20m", classes=NOT_CLEAR_CLASSES, keys=("field_id", "uuid"), out="is_cloudy"):
    """Per crop: does any class pixel fall in ``classes``? One partial aggregate, one shuffle."""
    known = pixels.where(F.col(scl).isNotNull())
    return known.groupBy(*keys).agg(F.bool_or(F.col(scl).isin(*classes)).alias(out))


def cloud_alert_label(pixels, scl="SCL_20m", keys=("field_id", "uuid")):
    flags = cloud_flag(pixels, scl, CLOUD_CLASSES, keys, "_alert")
    return flags.select(*keys, F.when(F.col("_alert"), CLOUD_ALERT).otherwise("Clear").alias("label"))


def clear_pairs(pixels, scl="SCL_20m", classes=NOT_CLEAR_CLASSES):
    """(field_id, uuid) with at least one class pixel and none in ``classes``."""
    return cloud_flag(pixels, scl, classes).where(~F.col("is_cloudy")).select("field_id", "uuid")


def clear_product_list(pairs, products):
    """One row per field: its clear products in catalogue order, as a list.

    The list is the output asked for; work that goes on from it should use the pairs instead.
    """
    dated = pairs.join(products.select("uuid", "generationdate"), "uuid")
    entries = F.array_sort(F.collect_list(F.struct("generationdate", "uuid")))
    return dated.groupBy("field_id").agg(F.transform(entries, lambda e: e["uuid"]).alias("cloud_free_products"))


def clear_products_of_field(products, pairs, band=None):
    """Catalogue rows of each field's clear products, with ``band`` present where named."""
    rows = products if band is None else products.where(F.col(band).isNotNull())
    return rows.join(pairs.select("field_id", "uuid"), "uuid")


def clear_product_table(pixels, products, band="B04_10m", scl="SCL_20m"):
    """Clear test, catalogue lookup and crop check in one aggregate over the pixels."""
    crops = pixels.groupBy("field_id", "uuid").agg(
        F.bool_or(F.col(scl).isin(*NOT_CLEAR_CLASSES)).alias("_cloudy"),
        F.count(band).alias("n_pixels"),
    )
    clear = crops.where(~F.col("_cloudy") & (F.col("n_pixels") > 0)).drop("_cloudy")
    return clear.join(products, "uuid")


def cloud_series(pixels, shown="TCI_10m", scl="SCL_20m"):
    """Per crop: pixel counts of the true-colour and the class picture, and the alert label."""
    return pixels.groupBy("field_id", "uuid").agg(
        F.count(shown).alias("n_shown"),
        F.count(scl).alias("n_class"),
        F.when(F.bool_or(F.col(scl).isin(*CLOUD_CLASSES)), CLOUD_ALERT).otherwise("Clear").alias("label"),
    ).where("n_shown > 0 AND n_class > 0")


def dated_cloud_series(pixels, products, shown="TCI_10m", scl="SCL_20m"):
    series = cloud_series(pixels, shown, scl).join(products.select("uuid", "generationdate"), "uuid")
    return series.withColumn("day", date_label(F.col("generationdate")))
