"""Date columns."""

from pyspark.sql import functions as F


def parse_date(col, *formats):
    """First format that fits, else the default parser, else NULL."""
    col = F.col(col) if isinstance(col, str) else col
    tries = [F.try_to_timestamp(col, F.lit(fmt)) for fmt in formats]
    tries.append(F.try_to_timestamp(col))
    return F.coalesce(*tries).cast("timestamp_ntz")


def date_label(col):
    """Day/month/year without padding."""
    return F.date_format(col, "d/M/yyyy")


def epoch_micros(col):
    return F.unix_micros(F.col(col).cast("timestamp") if isinstance(col, str) else col.cast("timestamp"))
