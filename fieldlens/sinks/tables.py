"""GeoJSON, CSV and clipped-pixel writers. All write in parallel, a file per task."""

from pyspark.sql import functions as F

from fieldlens.functions.geometry import polygons_to_geojson
from fieldlens.functions.text import list_to_text
from fieldlens.operators.bandstats import wide_to_long


def to_features(df, rings="rings", polygons="polygons"):
    """One GeoJSON feature per row as text; list columns become blank-joined text.

    The geometry is column ``polygons`` where the table has one, else the rings as one polygon.
    """
    columns = []
    for field in df.schema.fields:
        if field.name in (rings, polygons):
            continue
        is_list = field.dataType.typeName() == "array"
        columns.append(list_to_text(F.col(field.name)).alias(field.name) if is_list else F.col(field.name))
    # a feature keeps its empty properties
    options = {"ignoreNullFields": "false"}
    shape = F.col(polygons) if polygons in df.columns else F.when(F.col(rings).isNotNull(), F.array(F.col(rings)))
    geometry = F.coalesce(polygons_to_geojson(shape), F.lit("null"))
    return df.select(F.concat(
        F.lit('{"type":"Feature","geometry":'), geometry, F.lit(',"properties":'), F.to_json(F.struct(*columns), options),
        F.lit("}")).alias("value"))


def write_geojson(df, path, rings="rings", mode="errorifexists"):
    to_features(df, rings).write.mode(mode).text(path)


def write_analysis_csv(frame, path, mode="errorifexists"):
    frame.write.mode(mode).option("header", "true").csv(path)


def write_scores_csv(scores, path, mode="errorifexists"):
    """A folder of files per target."""
    columns = ["target", "bands", "scores_stratified_KFold", "scores_cross_val", "accuracy_score"]
    scores.select(*columns).write.mode(mode).partitionBy("target").option("header", "true").csv(path)


def write_crops(clipped, path, mode="errorifexists", parts=None, bands=None, group_bytes=16 << 20):
    """Clipped pixels, a folder per band, clustered by field.

    Rows go to tasks by (band, field, product, stretch of rows), so even one very large crop is
    written by several tasks; the sort gives the row groups narrow field ranges. ``bands``: the pixels are wide, with a column for each of
    these. A pixel is then dealt out and sorted as one row, and becomes a row per band in the task that writes it, which has a file of
    each band open at a time, with row groups of ``group_bytes``; long rows are neither shuffled nor sorted.
    """
    keys, stretch = ["field_id", "uuid"], F.floor(F.col("px_row") / 512)
    if bands is None:
        keys = ["band", *keys]
    spread = clipped.repartition(*([parts] if parts else []), *keys, stretch).sortWithinPartitions(*keys)
    if bands is None:
        spread.write.mode(mode).partitionBy("band").parquet(path)
        return
    long = wide_to_long(spread, [c for c in clipped.columns if c not in bands], bands)
    conf, name = clipped.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(name)
    # one more than the files: at the limit itself Spark goes over to sorting
    conf.set(name, str(max(int(before), len(bands) + 1)))
    try:
        long.write.mode(mode).option("parquet.block.size", group_bytes).partitionBy("band").parquet(path)
    finally:
        conf.set(name, before)


# Cells along each side of the key's square.
MORTON_BITS = 20


def morton_key(x, y, box, bits=MORTON_BITS):
    """Place of a point along a curve that stays within squares: the bits of its cell's column and row in turn. ``box``: (xmin, ymin, xmax,
    ymax) that the cells divide; points beyond it count to the cells of its border."""
    xmin, ymin, xmax, ymax = box
    top = (1 << bits) - 1

    def cell(value, lo, hi):
        share = (F.col(value) - F.lit(float(lo))) / F.lit(float(hi - lo) or 1.0)
        return F.least(F.greatest(F.floor(share * (top + 1)), F.lit(0)), F.lit(top)).cast("long")

    def spread(value):
        # 20 bits, one after every gap, by halving the distances
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            value = value.bitwiseOR(F.shiftleft(value, shift)).bitwiseAND(F.lit(mask))
        return value

    return spread(cell(x, xmin, xmax)).bitwiseOR(F.shiftleft(spread(cell(y, ymin, ymax)), 1))


def write_clustered(pixels, path, x="x", y="y", box=None, parts=None, group_bytes=8 << 20, mode="errorifexists"):
    """Pixel table in the order of ``morton_key``, so that a row group holds a small square of the map and a filter on a box
    skips nearly all others by their statistics.

    Rows are range-partitioned by the key, whatever their density. ``box``: of the whole table if known, else it is looked up
    by one aggregate. ``group_bytes``: size of a row group.
    """
    if box is None:
        box = tuple(v or 0.0 for v in pixels.agg(F.min(x), F.min(y), F.max(x), F.max(y)).first())
    placed = pixels.withColumn("_morton", morton_key(x, y, box))
    spread = placed.repartitionByRange(*([parts] if parts else []), "_morton").sortWithinPartitions("_morton").drop("_morton")
    spread.write.mode(mode).option("parquet.block.size", group_bytes).option("parquet.page.row.count.limit", 5_000).parquet(path)
