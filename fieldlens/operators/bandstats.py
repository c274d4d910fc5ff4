"""Per-crop aggregates of pixel values and the index maths on them.

All of them are algebraic aggregates: Spark combines them on the map side, so a crop of any
size costs one small partial row per task.
"""

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from fieldlens.constants import ALL_BANDS
from fieldlens.functions.spectral import normalized_difference


def _filled(value, fill):
    if fill == "zero":
        return F.when(F.col("inside"), F.col(value)).otherwise(F.lit(0))
    if fill == "mask":
        return F.when(F.col("inside"), F.col(value))
    raise ValueError(f"fill must be 'zero' or 'mask', not {fill!r}")


def band_mean(pixels, fill="mask", keys=("field_id", "uuid")):
    """Long pixels -> mean per crop and band.

    ``fill="mask"`` averages the pixels inside the field, ``"zero"`` counts the pixels of the
    surrounding window as 0. Without an ``inside`` column every pixel counts.
    """
    value = _filled("value", fill) if "inside" in pixels.columns else F.col("value")
    return pixels.groupBy(*keys, "band").agg(F.avg(value).alias("band_mean"))


# Bands whose sums a task holds for all its crops at a time; with more bands the crops are taken in turns.
BANDS_PER_PASS = 7


def in_passes(pixels, keys, passes, aggregate):
    """``aggregate`` of the crops in so many passes, each over all pixels of its share of the crops.

    Where the pixels of a crop lie far apart, a task meets nearly as many crops as pixels, and the sums of all of them are wider than
    its input; a share of them is held in memory where all would spill. Pixels of a crop still combine before the shuffle.
    """
    if passes < 2 or not keys:
        return aggregate(pixels)
    share = F.pmod(F.xxhash64(*keys), F.lit(passes))
    return reduce(lambda a, b: a.unionByName(b), [aggregate(pixels.where(share == i)) for i in range(passes)])


def band_mean_wide(pixels, bands=ALL_BANDS, fill="mask", keys=("field_id", "uuid"), extra=(), passes=None):
    """Wide pixels -> one row per crop with a mean per band, no pivot: every crop is shuffled once.

    ``passes``: see ``in_passes``; by the number of bands where not given.
    """
    inside = "inside" in pixels.columns
    means = [F.avg(_filled(b, fill) if inside else F.col(b)).alias(b) for b in bands]
    passes = -(-len(bands) // BANDS_PER_PASS) if passes is None else passes
    return in_passes(pixels, keys, passes, lambda part: part.groupBy(*keys).agg(*extra, *means))


def band_mean_of_wide(pixels, bands=ALL_BANDS, fill="mask", keys=("field_id", "uuid")):
    """``band_mean`` of wide pixels: the means are formed in wide form, and one row per crop is unpivoted, not one per pixel."""
    means = band_mean_wide(pixels, bands, fill, keys)
    return means.unpivot(list(keys), list(bands), "band", "band_mean")


def index_of_means(means, first, second, out):
    """Index from band means: a ratio of means, not a mean of ratios."""
    return means.withColumn(out, normalized_difference(first, second))


def mean_of_pixel_index(pixels, first, second, out, keys=("field_id", "uuid")):
    """Mean of the pixel-wise index; pixels whose two bands sum to zero do not count."""
    return pixels.groupBy(*keys).agg(F.avg(normalized_difference(first, second)).alias(out))


def mean_ndvi(pixels, keys=("field_id", "uuid")):
    return mean_of_pixel_index(pixels, "B08_10m", "B04_10m", "mean_ndvi", keys)


def mean_ndwi(pixels, keys=("field_id", "uuid")):
    return mean_of_pixel_index(pixels, "B03_10m", "B08_10m", "mean_ndwi", keys)


def apply_index(pixels, pairs, **aggregates):
    """Any Column aggregates over the crops of the clear pairs."""
    named = [agg.alias(name) for name, agg in aggregates.items()]
    return pixels.join(pairs, ["field_id", "uuid"], "left_semi").groupBy("field_id", "uuid").agg(*named)


def whole_groups(frames, keys):
    """Frames of a task whose rows are sorted by ``keys``, cut anew so that each holds whole groups, numbered by ``group``."""
    keys, held = list(keys), []

    def numbered(parts):
        frame = pd.concat(parts, ignore_index=True) if len(parts) > 1 else parts[0].reset_index(drop=True)
        first = np.arange(len(frame)) == 0
        for key in keys:
            codes = pd.factorize(frame[key])[0]
            first[1:] |= codes[1:] != codes[:-1]
        return frame.assign(group=np.cumsum(first) - 1)

    def like(frame, row):
        same = np.ones(len(frame), dtype=bool)
        for key in keys:
            same &= (frame[key].isna() if pd.isna(row[key]) else frame[key] == row[key]).to_numpy(dtype=bool)
        return same

    for frame in frames:
        if not len(frame):
            continue
        # the last group may go on in the next frame
        start = int(like(frame, frame.iloc[-1]).argmax())
        if start:
            yield numbered([*held, frame.iloc[:start]])
            held = [frame.iloc[start:]]
        elif held and not like(frame.iloc[:1], held[-1].iloc[-1])[0]:
            yield numbered(held)
            held = [frame]
        else:
            held.append(frame)
    if held:
        yield numbered(held)


def _apply_to_groups(df, fn, schema, keys, together, hidden=()):
    """``fn`` over the groups of ``keys``: one at a time, or (``together``) over frames of many whole ones."""

    def run(frames):
        for frame in whole_groups(frames, keys):
            frame = frame.drop(columns=list(hidden))
            if together:
                yield fn(frame)
            else:
                groups = (part.drop(columns="group").reset_index(drop=True) for _, part in frame.groupby("group", sort=False))
                yield pd.concat([fn(group) for group in groups], ignore_index=True)

    # the rows are small, the Python calls are not: keep AQE from merging them into few tasks
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, *keys).sortWithinPartitions(*keys).mapInPandas(run, schema)


def apply_per_crop(pixels, fn, schema, keys=("field_id", "uuid"), value_columns=("value",), together=False):
    """User function over one crop: ``fn(pandas frame) -> pandas frame``.

    The frame holds each distinct pixel value of the crop once, with its count in
    ``n_pixels``. Counting is done on the map side, so what reaches one task is bounded by the
    value range of the sensor and not by the size of the crop. ``together``: a frame holds many whole crops, numbered by
    ``group``, for functions that take them all in one call: a call per crop costs more than the work where crops are small.
    """
    counted = pixels.groupBy(*keys, *value_columns).agg(F.count(F.lit(1)).alias("n_pixels"))
    return _apply_to_groups(counted, fn, schema, keys, together)


def apply_per_block(pixels, fn, schema, block=256, halo=0, keys=("field_id", "uuid"), row="px_row", col="px_col", together=False):
    """User function over square blocks of a crop's pixels: ``fn(pandas frame) -> pandas frame``.

    A frame holds the pixels of ``block`` x ``block`` rows and columns, and those up to ``halo`` beyond its borders, with ``own`` (false
    for these): what looks at neighbours gives the same for any size of block. Frames are bounded, whatever the crop's size; what
    blocks return is for the caller to add up. ``together``: a frame holds many whole blocks, numbered by ``group``.
    """
    if halo > block:
        raise ValueError("the halo must not reach beyond the neighbouring blocks")
    homes = lambda c: F.array_distinct(F.array(*[F.floor((F.col(c) + d * halo) / block) for d in ((-1, 0, 1) if halo else (0,))]))
    spread = pixels.withColumn("_br", F.explode(homes(row))).withColumn("_bc", F.explode(homes(col)))
    own = (F.col("_br") == F.floor(F.col(row) / block)) & (F.col("_bc") == F.floor(F.col(col) / block))
    return _apply_to_groups(spread.withColumn("own", own), fn, schema, (*keys, "_br", "_bc"), together, hidden=("_br", "_bc"))


def stack_bands(pixels, bands, pixel_keys=("field_id", "uuid", "px_row", "px_col")):
    """Long pixels -> one row per pixel with a column per band: one aggregate, and none more where the pixels lie clustered by its keys."""
    picked = [F.max(F.when(F.col("band") == b, F.col("value"))).alias(b) for b in bands]
    return pixels.where(F.col("band").isin(*bands)).groupBy(*pixel_keys).agg(*picked)


def stack_wide(pixels, bands, pixel_keys=("field_id", "uuid", "px_row", "px_col")):
    """The same of wide pixels, a row each: a projection."""
    return pixels.select(*pixel_keys, *bands)


def rgb_composite(pixels, pixel_keys=("field_id", "uuid", "px_row", "px_col")):
    stacked = stack_bands(pixels, ("B04_10m", "B03_10m", "B02_10m"), pixel_keys)
    return stacked.withColumnsRenamed({"B04_10m": "red", "B03_10m": "green", "B02_10m": "blue"})


def wide_to_long(pixels, keys, bands=ALL_BANDS):
    return pixels.unpivot(list(keys), list(bands), "band", "value")
