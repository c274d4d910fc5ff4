"""Band arithmetic."""

from pyspark.sql import functions as F


def normalized_difference(first, second):
    """(first - second) / (first + second); NULL where the sum is zero."""
    a = (F.col(first) if isinstance(first, str) else first).cast("double")
    b = (F.col(second) if isinstance(second, str) else second).cast("double")
    return F.try_divide(a - b, a + b)


def ndvi_of_means():
    return normalized_difference("B08_10m", "B04_10m")


def ndwi_of_means():
    return normalized_difference("B03_20m", "B8A_20m")
