"""Raster files and tiles."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F


PRODUCT_FOLDER = r"([^/]+)\.SAFE/GRANULE/"


def list_product_files(spark, root, glob="*.jp2", product_pattern=PRODUCT_FOLDER):
    """(product, path) of every raster below ``root``. Only names are listed: the content column is
    pruned, so no file is opened."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
        .select("path")
    )
    return files.where(F.contains("path", F.lit("IMG_DATA"))).select(
        F.regexp_extract("path", product_pattern, 1).alias("product"), "path")


def scan_pixels(spark, path, bands=None, field_ids=None, uuids=None):
    """The pixel table with filters that reach the scan: band is a partition column, field and
    product are pushed to the row groups."""
    pixels = spark.read.parquet(path)
    if bands is not None:
        pixels = pixels.where(F.col("band").isin(*bands))
    if field_ids is not None:
        pixels = pixels.where(F.col("field_id").isin(*field_ids))
    if uuids is not None:
        pixels = pixels.where(F.col("uuid").isin(*uuids))
    return pixels


# Pixels that are handed on at a time; small tiles are decoded together up to so many.
PIXELS_AT_ONCE = 100_000


def _tiles_together(dtypes, sizes):
    """(start, end) of runs of tiles with one sample type and about ``PIXELS_AT_ONCE`` pixels; a larger tile stands alone."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and (dtypes[i] != dtypes[start] or total + size > PIXELS_AT_ONCE):
            yield start, i
            start, total = i, 0
        total += size
    if len(sizes):
        yield start, len(sizes)


def tiles_to_pixels(tiles):
    """Raw tiles (row-major samples) -> one row per pixel with its row, column and centre x, y.

    Samples of any numeric type become doubles. Tiles are independent rows, so they spread over the
    tasks as Spark reads them; small ones are decoded together, large ones handed on in slices.
    """

    def decode(batches):
        for batch in batches:
            data, dtypes = batch.column("data"), batch.column("dtype").to_pylist()
            height, width = (np.array(batch.column(c).to_pylist(), dtype="int64") for c in ("height", "width"))
            for first, last in _tiles_together(dtypes, (height * width).tolist()):
                parts, sizes, dtype = data.slice(first, last - first).to_pylist(), (height * width)[first:last], np.dtype(dtypes[first])
                if any(len(part) != size * dtype.itemsize for part, size in zip(parts, sizes)):
                    raise ValueError("a tile's data does not have height x width samples")
                values, ends = np.frombuffer(parts[0] if len(parts) == 1 else b"".join(parts), dtype=dtype), np.cumsum(sizes)
                for lo in range(0, len(values), PIXELS_AT_ONCE):
                    at = np.arange(lo, min(lo + PIXELS_AT_ONCE, len(values)))
                    tile = np.searchsorted(ends, at, side="right")
                    place, across = at - (ends - sizes)[tile], width[first:last][tile]
                    of = lambda c: batch.column(c).take(pa.array(tile + first))
                    yield pa.RecordBatch.from_arrays([
                        of("uuid"), of("band"), pa.array(place // across, pa.int32()), pa.array(place % across, pa.int32()),
                        pa.array(values[at[0]:at[-1] + 1].astype("float64")), *[of(c).cast(pa.float64()) for c in ("x0", "y0", "res")],
                    ], names=["uuid", "band", "px_row", "px_col", "value", "x0", "y0", "res"])

    pixels = tiles.mapInArrow(
        decode, "uuid string, band string, px_row int, px_col int, value double, x0 double, y0 double, res double")
    return pixels.select(
        "uuid", "band", "px_row", "px_col", "value",
        (F.col("x0") + (F.col("px_col") + 0.5) * F.col("res")).alias("x"),
        (F.col("y0") - (F.col("px_row") + 0.5) * F.col("res")).alias("y"))
