"""Exported sheets, score tables and catalogue tables."""

from functools import reduce

from pyspark.sql import functions as F

from fieldlens.constants import FIELD_SHEET_COLUMNS, GNUM_RENAMES, GNUM_SHEET_COLUMNS, SOIL_RENAMES
from fieldlens.operators.tables import ratings_to_int, rename_columns, sanitize_headers


def read_field_sheet(spark, path, columns, used, banner=None, **options):
    """A CSV export with a banner row above the header.

    ``columns``: all column names of the sheet in order; every cell is read as text. ``banner`` is
    the first cell of the banner row, whose other cells are empty. That row and the header row are
    filtered out wherever the splits put them; they are told by all of their cells, so a data row that
    only begins like one of them stays.
    """
    schema = ", ".join(f"`{c}` string" for c in columns)
    rows = spark.read.options(**options).schema(schema).csv(path)
    cells = [F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in columns]
    skipped = [list(columns)] + ([[banner] + [""] * (len(columns) - 1)] if banner else [])
    for row in skipped:
        rows = rows.where(~reduce(lambda a, b: a & b, [cell == text for cell, text in zip(cells, row)]))
    return rows.select(*[F.col(f"`{c}`") for c in used])


def read_fields_by_id(spark, path, columns, banner=None):
    return sanitize_headers(read_field_sheet(spark, path, columns, FIELD_SHEET_COLUMNS, banner))


def read_fields_by_gnum(spark, path, columns, banner=None):
    sheet = read_field_sheet(spark, path, columns, GNUM_SHEET_COLUMNS, banner)
    return sanitize_headers(rename_columns(sheet, GNUM_RENAMES))


def clean_soil(df):
    """Canonical names, ratings as whole numbers with 0 for no result, no second name column."""
    renamed = rename_columns(sanitize_headers(df), SOIL_RENAMES)
    return ratings_to_int(renamed.drop("farmer_name"))


def read_soil_results(spark, path, columns):
    schema = ", ".join(f"`{c}` string" for c in columns)
    rows = spark.read.schema(schema).option("header", "true").option("enforceSchema", "true").csv(path)
    ratings = [c for c in rows.columns if "=_low" in c.strip().lower().replace(" ", "_")]
    for c in ratings:
        rows = rows.withColumn(c, F.expr(f"try_cast(`{c}` AS double)"))
    return clean_soil(rows)


def read_scores_csv(spark, path):
    """Saved band-set scores: the first column is the band set, also given as a list."""
    schema = ("bands string, scores_stratified_KFold double, scores_cross_val double, accuracy_score double")
    rows = spark.read.schema(schema).option("header", "true").csv(path)
    return rows.withColumn("band_list", F.split("bands", " "))
