"""Text, list and rating columns."""

from pyspark.sql import functions as F


def sanitize_header(name):
    return name.strip().lower().replace(" ", "_")


def canonical_field_id(col):
    """``g7`` -> ``G007``. Longer numbers are kept whole; text of another form gives NULL."""
    digits = F.regexp_extract(col, r"^[A-Za-z]+([0-9]+)", 1)
    padded = F.lpad(digits, F.greatest(F.lit(3), F.length(digits)), "0")
    return F.when(digits != "", F.concat(F.lit("G"), padded))


def rating_to_int(col):
    """Missing or NaN rating -> 0; fractions are cut off."""
    return F.coalesce(nan_to_null(col), F.lit(0)).cast("bigint")


def list_to_text(col):
    return F.array_join(col, " ")


def text_to_list(col):
    """Blank-separated text to a list; empty text is an empty list."""
    return F.filter(F.split(col, r"\s+"), lambda item: item != "")


def contains_any(col, needles):
    """Case-insensitive "contains one of"."""
    lowered = F.lower(col)
    hit = F.lit(False)
    for needle in needles:
        hit = hit | F.contains(lowered, F.lit(needle.lower()))
    return hit


def nan_to_null(col):
    col = F.col(col) if isinstance(col, str) else col
    return F.when(~F.isnan(col), col)
