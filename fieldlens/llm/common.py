"""Helpers shared by the text operators."""

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from fieldlens.session import materialize  # noqa: F401

# ASCII white space as the contracts name it: blank and the five control characters 9 to 13.
WORD = "[^\\x20\\x09-\\x0D]+"
SPACE = "[\\x20\\x09-\\x0D]+"

# Characters of text that one numpy pass takes at a time.
PASS_CHARS = 4_000_000


def need(df, *columns):
    """Raise if a column that an operator reads is missing, or named twice up to case."""
    names = [c.lower() for c in df.columns]
    for c in columns:
        if names.count(c.lower()) != 1:
            raise ValueError(f"the input needs exactly one column {c!r}, it has {df.columns}")


def keep(df, *columns):
    """The named columns alone; whatever else a table carries can't clash with results."""
    need(df, *columns)
    return df.select(*[F.col(f"`{c}`") for c in columns])


def text_groups(texts, limit=PASS_CHARS):
    """Slices (start, end) of a string array whose UTF-8 bytes stay near ``limit``; a longer text stands alone."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0))
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += int(n)
    if len(sizes) > start:
        yield start, len(sizes)


# Rows of a table of short terms or counts that may be sent to every executor: about 100 MB.
BROADCAST_ROWS = 1_000_000


def small(df, rows=BROADCAST_ROWS):
    """The (written) table as a broadcast side if it has at most ``rows`` rows, else as it is, for Spark to shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def seeded_first(rows, by, n, seed, *key):
    """The first ``n`` rows (a number, or one per group) of each group of column ``by`` in the order of a seeded hash of
    ``key``, with their place as __place.

    Groups are few, such as classes. Their sizes are counted first, and only rows whose hash is low enough to hold three
    times the rows asked for are ranked, so what is shuffled doesn't grow with the table.
    """
    place = F.xxhash64(F.lit(seed), *key)
    low = F.lit(False)
    wanted = F.lit(0)
    for group, size in rows.groupBy(by).count().collect():
        most = n[group] if isinstance(n, dict) else n
        bound = min(2 ** 63 - 1, -2 ** 63 + int(2 ** 64 * 3 * most / size)) if size > 3 * most else 2 ** 63 - 1
        same = F.col(by).eqNullSafe(F.lit(group))
        low, wanted = low | (same & (F.col("__hash") <= bound)), F.when(same, most).otherwise(wanted)
    order = Window.partitionBy(by).orderBy("__hash", *key)
    ranked = rows.withColumn("__hash", place).filter(low).withColumn("__place", F.row_number().over(order))
    return ranked.filter(F.col("__place") <= wanted).drop("__hash")
