"""Cleaning, equi-joins, filters and reshaping of the field and product tables.

No join here is hinted: Spark broadcasts a side only below its own size limit
(``spark.sql.autoBroadcastJoinThreshold``) and shuffles on the key above it.
"""

from functools import reduce

from pyspark.sql import functions as F

from fieldlens.constants import ALL_BANDS, GRANULES, NON_ANALYSIS_BANDS, PLATFORM, PROCESSING_LEVEL, TARGETS
from fieldlens.functions.text import contains_any, rating_to_int, sanitize_header


def sanitize_headers(df):
    return df.toDF(*[sanitize_header(c) for c in df.columns])


def rename_columns(df, renames):
    return df.withColumnsRenamed(renames)


def drop_columns(df, columns):
    return df.drop(*columns)


def ratings_to_int(df, targets=TARGETS):
    return df.withColumns({t: rating_to_int(t) for t in targets})


def union_fields(*frames):
    """Stack field tables; a column missing from one becomes NULL. Ids become text first."""
    texts = [f.withColumn("field_id", F.col("field_id").cast("string")) for f in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), texts)


def duplicate_keys(df, keys):
    """Keys that occur more than once; a left join on them would multiply rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def left_join_on(left, right, key, null_safe=False):
    """Left join on one key column. ``null_safe`` lets missing keys match each other."""
    if not null_safe:
        return left.join(right, key, "left")
    other = right.withColumnRenamed(key, "_key")
    return left.join(other, left[key].eqNullSafe(other["_key"]), "left").drop("_key")


def attach_boundaries(fields, boundaries, null_safe=False):
    return left_join_on(fields, boundaries.select("field_id", "rings"), "field_id", null_safe)


def attach_soil(fields, soil, null_safe=False):
    return left_join_on(fields, soil, "field_id", null_safe)


def attach_field_index(products, field_index):
    """Catalogue with one row per product and field that has an index value."""
    return products.join(field_index, "uuid", "left")


def attach_field_index_wide(products, field_index, field_ids, value="mean_ndvi"):
    """The same with a column per named field. The list of fields is given, never collected."""
    narrow = field_index.where(F.col("field_id").isin(list(field_ids)))
    wide = narrow.groupBy("uuid").pivot("field_id", list(field_ids)).agg(F.max(value))
    named = wide.withColumnsRenamed({f: f"{f}_{value}" for f in field_ids})
    return products.join(named, "uuid", "left")


# --- catalogue --------------------------------------------------------------

def search_catalogue(products, box, start, end, platform=PLATFORM, level=PROCESSING_LEVEL, cloud=(0, 99)):
    """Scenes that touch ``box`` = (xmin, ymin, xmax, ymax), generated from ``start`` to ``end``."""
    xmin, ymin, xmax, ymax = box
    hit = (
        (F.col("xmin") <= xmax) & (F.col("xmax") >= xmin) & (F.col("ymin") <= ymax) & (F.col("ymax") >= ymin)
        & F.col("generationdate").between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz"))
        & (F.col("platformname") == platform) & (F.col("processinglevel") == level)
        & F.col("cloudcoverpercentage").between(*cloud)
    )
    return order_by_date(products.where(hit))


def order_by_date(products):
    return products.orderBy("generationdate", "uuid")


def granule_filter(products, granules=GRANULES):
    return products.where(contains_any(F.col("title"), granules))


def band_paths(product_files, bands=ALL_BANDS):
    """(uuid, path) of raster files -> one row per product with a path column per band.

    Among several files that contain a band's name the smallest path wins; no file gives NULL.
    """
    names = F.array(*[F.lit(b) for b in bands])
    tagged = product_files.select(
        "uuid", "path", F.explode(F.filter(names, lambda b: F.contains(F.col("path"), b))).alias("band"))
    return tagged.groupBy("uuid").pivot("band", list(bands)).agg(F.min("path"))


def add_band_paths(products, product_files, bands=ALL_BANDS):
    return products.join(band_paths(product_files, bands), "uuid", "left")


def band_present(products, band):
    return products.where(F.col(band).isNotNull())


def progress_counts(products, present, key="identifier"):
    """Products in all, with files, and still to fetch."""
    seen = present.select(key).distinct().withColumn("_seen", F.lit(True))
    return products.join(seen, key, "left").agg(
        F.count(F.lit(1)).alias("available"),
        F.count_if(F.col("_seen").isNotNull()).alias("present"),
        F.count_if(F.col("_seen").isNull()).alias("missing"),
    )


# --- analysis frame ---------------------------------------------------------

def tested_only(df, target):
    return df.where(F.col(target) > 0)


def analysis_frame(fields, unused=NON_ANALYSIS_BANDS + ("farm_id(from_platform)",)):
    """Fields that have band means, without the columns no model uses."""
    return fields.where(F.col("B08_10m").isNotNull()).drop(*unused)


def analysis_long(frame, targets=TARGETS):
    """One row per field and tested target: the rating moves to ``target``/``rating``."""
    kept = [c for c in frame.columns if c not in targets]
    entries = F.array(*[F.struct(F.lit(t).alias("target"), F.col(t).alias("rating")) for t in targets])
    return (
        frame.select(*kept, F.explode(F.filter(entries, lambda e: e["rating"] > 0)).alias("_e"))
        .select("_e.target", "_e.rating", *kept)
    )


# --- lists and exclusion ----------------------------------------------------

def exclude_products(field_products, excluded):
    """Drop (field_id, uuid) pairs named in ``excluded``."""
    return field_products.join(excluded.select("field_id", "uuid").distinct(), ["field_id", "uuid"], "left_anti")


def exclude_from_list(fields, column, uuid_column):
    """List form of the same: remove one id from the list beside it."""
    return fields.withColumn(column, F.when(
        F.col(uuid_column).isNotNull(), F.array_remove(F.col(column), F.col(uuid_column))).otherwise(F.col(column)))


def missing_crops_out(field_products, crops):
    """Keep field-product pairs that have a crop."""
    return field_products.join(crops.select("field_id", "uuid").distinct(), ["field_id", "uuid"], "left_semi")


def chosen_product_crops(survey, field_products):
    """Fields in analysis with the crop chosen for them."""
    chosen = survey.where("nearest_product_uuid IS NOT NULL").select(
        "field_id", F.col("nearest_product_uuid").alias("uuid"))
    return chosen.join(field_products, ["field_id", "uuid"], "inner")


def not_yet_done(work, ledger, keys, force=False):
    """Work items absent from the ledger; ``force`` takes them all."""
    if force:
        return work
    return work.join(ledger.select(*keys), keys, "left_anti")


def unpivot_columns(df, ids, columns, name="variable", value="value"):
    return df.unpivot(ids, list(columns), name, value)


def map_column(df, column, fn, out=None):
    """Cell function: ``fn`` takes and returns a Column (a ``pandas_udf`` is one such function)."""
    return df.withColumn(out or column, fn(F.col(column)))


def apply_per_row(df, fn, schema):
    """Door for row functions that are no columns: ``fn`` maps a pandas batch to a pandas batch."""

    def batches(frames):
        for frame in frames:
            yield fn(frame)

    return df.mapInPandas(batches, schema)
