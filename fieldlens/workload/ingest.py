"""Sources, sinks and the incremental ingest, each as a round trip of derived files."""

import io
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from fieldlens.constants import ALL_BANDS, SCORE_COLUMNS, SUMMARY_BANDS
from fieldlens.functions.geometry import with_bbox
from fieldlens.operators import bandstats, clouds
from fieldlens.session import scratch_path
from fieldlens.sinks import tables as sinks
from fieldlens.sources import boundaries, rasters, sheets
from fieldlens.streaming import ingest
from fieldlens.workload.registry import CLEAR, CORNERS, NOT_CLEAR, _fill, VIEWS, query, rounded

BOUNDARY_SQL = """
    SELECT field_id, 5 AS n_points, round(x0, 9) AS xmin, round(y0 + 0.0022, 9) AS ymax FROM fx_fields"""


def kml_text(lon="x0", lat="y0"):
    point = lambda dx, dy: F.concat((F.col(lon) + F.lit(dx)).cast("string"), F.lit(","), (F.col(lat) + F.lit(dy)).cast("string"), F.lit(",0"))
    ring = F.concat_ws(" ", *[point(dx, dy) for dx, dy in CORNERS + CORNERS[:1]])
    return F.concat(
        F.lit('<kml><Document><Placemark><open>1</open><Polygon><outerBoundaryIs><LinearRing><coordinates> '), ring,
        F.lit(' </coordinates></LinearRing></outerBoundaryIs></Polygon></Placemark></Document></kml>'))


def write_files(texts, path):
    """A folder per ``file``, dealt over the tasks by file. Tasks put their folders in place themselves (committer 2): the driver would
    move them one by one, which takes longer than writing them; nothing reads the path before the job has ended."""
    texts.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy("file").text(path)


def by_file(t, texts):
    return texts.repartition(int(t.spark.conf.get("spark.sql.shuffle.partitions")), "file")


def boundary_report(df):
    boxed = with_bbox(df)
    return rounded(boxed.select("field_id", F.size(F.flatten("rings")).alias("n_points"), "xmin", "ymax"), 9, "xmin", "ymax")


@query("read_boundaries_kml", BOUNDARY_SQL)
def _(t):
    path = scratch_path(t.spark, "kml")
    files = t.fields.select(F.concat(F.lit("g"), F.col("field_key").cast("string")).alias("file"), kml_text().alias("value"))
    write_files(by_file(t, files), path)
    return boundary_report(boundaries.read_boundaries_kml(t.spark, path, id_pattern=r"file=([^/]+)/"))


def write_archives(t, path):
    """A zip archive per field below ``path``. The text sink writes a cell's bytes and one line end, which the archive declares as its comment."""

    def zipped(frames):
        for frame in frames:
            contents = []
            for text in frame["kml"]:
                buffer = io.BytesIO()
                with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                    archive.writestr("doc.kml", text)
                    archive.comment = b"\n"
                contents.append(buffer.getvalue()[:-1])
            yield pd.DataFrame({"file": frame["file"], "content": contents})

    texts = t.fields.select(F.concat(F.lit("g"), F.col("field_key").cast("string")).alias("file"), kml_text().alias("kml"))
    archives = by_file(t, texts).mapInPandas(zipped, "file string, content binary")
    write_files(archives.select("file", F.col("content").cast("string").alias("value")), path)


@query("read_boundaries_kmz", BOUNDARY_SQL)
def _(t):
    path = scratch_path(t.spark, "kmz")
    write_archives(t, path)
    return boundary_report(boundaries.read_boundaries_kmz(t.spark, path, id_pattern=r"file=([^/]+)/", glob="part-*"))


@query("read_field_sheets", """
    SELECT field_id, farm_name, strftime(survey_date, '%Y-%m-%d') AS date_of_survey FROM fx_fields""")
def _(t):
    path = scratch_path(t.spark, "sheet")
    columns = ("Sl.No", "Village", "Farmer name", "Date of survey")
    line = lambda *cells: F.struct(*[F.lit(cell).cast("string").alias(f"c{i}") for i, cell in enumerate(cells)])
    rows = t.fields.select(F.struct(F.col("field_id").alias("c0"), F.lit("-").alias("c1"), F.col("farm_name").alias("c2"),
                                    F.date_format("survey_date", "yyyy-MM-dd").alias("c3")).alias("row"))
    # the banner, then the header, as such sheets are exported
    above = t.spark.range(1).select(F.explode(F.array(line("Master", None, None, None), line(*columns))).alias("row"))
    above.unionByName(rows).select("row.*").write.csv(path)
    return sheets.read_fields_by_gnum(t.spark, path, columns, banner="Master")


@query("read_soil_results", """
    SELECT field_id, cast(coalesce(carbon_raw, 0) AS bigint) AS carbon_rating, cast(coalesce(nitrogen_raw, 0) AS bigint) AS nitrogen_rating,
           cast(coalesce(phosphorus_raw, 0) AS bigint) AS phosphorus_rating, cast(coalesce(potassium_raw, 0) AS bigint) AS potassium_rating
    FROM fx_soil""")
def _(t):
    path = scratch_path(t.spark, "soil")
    headers = ("Field IDs", "Farmer name", "O.C. (1 = low; 2 = med; 3 = high)", "N(1 = low; 2 = med; 3 = high)",
               "P (1 = low; 5 = high)", "K (1 = low; 2 = med; 3 = high)")
    source = (F.col("field_id"), F.lit("-"), F.col("carbon_raw"), F.col("nitrogen_raw"), F.col("phosphorus_raw"), F.col("potassium_raw"))
    t.soil.select(*[c.alias(h) for c, h in zip(source, headers)]).write.option("header", "true").csv(path)
    return sheets.read_soil_results(t.spark, path, headers)


def listed_fields(t):
    lists = clouds.clear_product_list(clouds.clear_pairs(t.pixels), t.products)
    return t.shaped(extra=("survey_date",)).join(lists, "field_id", "left")


@query("read_geojson", f"""
    WITH clear AS ({CLEAR})
    SELECT f.field_id, f.survey_date, count(c.uuid) AS n_products, 5 AS n_points, round(min(f.x0), 9) AS xmin, round(min(f.y0) + 0.0022, 9) AS ymax
    FROM fx_fields f LEFT JOIN clear c ON c.field_id = f.field_id GROUP BY f.field_id, f.survey_date""")
def _(t):
    path = scratch_path(t.spark, "fields")
    sinks.write_geojson(listed_fields(t), path)
    back = boundaries.read_geojson(t.spark, path, {
        "field_id": "string", "survey_date": "timestamp_ntz", "cloud_free_products": "string"})
    listed = F.size(F.filter(F.split(F.coalesce("cloud_free_products", F.lit("")), " "), lambda p: p != ""))
    boxed = with_bbox(back.withColumn("n_products", listed.cast("bigint")))
    return rounded(boxed.select(
        "field_id", "survey_date", "n_products", F.size(F.flatten("rings")).alias("n_points"), "xmin", "ymax"), 9, "xmin", "ymax")


@query("write_geojson", f"""
    WITH clear AS ({CLEAR})
    SELECT f.field_id, 'Feature' AS kind, 'Polygon' AS shape, string_agg(c.uuid, ' ' ORDER BY p.generationdate, c.uuid) AS products
    FROM fx_fields f LEFT JOIN clear c ON c.field_id = f.field_id LEFT JOIN fx_products p ON p.uuid = c.uuid GROUP BY f.field_id""")
def _(t):
    path = scratch_path(t.spark, "features")
    sinks.write_geojson(listed_fields(t), path)
    at = lambda where: F.get_json_object("value", where)
    return t.spark.read.text(path).select(
        at("$.properties.field_id").alias("field_id"), at("$.type").alias("kind"), at("$.geometry.type").alias("shape"),
        at("$.properties.cloud_free_products").alias("products"))


@query("write_analysis_csv", """
    SELECT field_id, uuid, round(avg(B04_10m), 6) AS B04_10m, round(avg(B08_10m), 6) AS B08_10m FROM fx_pixels GROUP BY field_id, uuid""")
def _(t):
    path = scratch_path(t.spark, "frame")
    sinks.write_analysis_csv(bandstats.band_mean_wide(t.pixels, ("B04_10m", "B08_10m")), path)
    back = t.spark.read.schema("field_id string, uuid string, B04_10m double, B08_10m double").option("header", "true").csv(path)
    return rounded(back, 6, "B04_10m", "B08_10m")


SCORE_SQL = ", ".join(f"round({c}, 6) AS {c}" for c in SCORE_COLUMNS)


@query("write_scores_csv", f"SELECT target, bands, {SCORE_SQL} FROM fx_scores")
def _(t):
    path = scratch_path(t.spark, "scores")
    sinks.write_scores_csv(t.view("fx_scores"), path)
    back = t.spark.read.schema(
        "bands string, scores_stratified_KFold double, scores_cross_val double, accuracy_score double, target string").option(
        "header", "true").csv(path)
    return rounded(back.select("target", "bands", *SCORE_COLUMNS), 6, *SCORE_COLUMNS)


@query("read_scores_csv", f"SELECT bands, {SCORE_SQL}, cast(len(string_split(bands, ' ')) AS int) AS n_bands FROM fx_scores")
def _(t):
    path = scratch_path(t.spark, "target")
    t.view("fx_scores").drop("target").write.option("header", "true").csv(path)
    back = sheets.read_scores_csv(t.spark, path)
    return rounded(back.withColumn("n_bands", F.size("band_list")).drop("band_list"), 6, *SCORE_COLUMNS)


CROP_SQL = " UNION ALL ".join(
    f"SELECT field_id, '{b}' AS band, count({b}) AS n_pixels, sum({b})::bigint AS total FROM fx_pixels GROUP BY field_id"
    for b in ALL_BANDS)


def stored_crops(t, bands=SUMMARY_BANDS):
    path = scratch_path(t.spark, "crops")
    sinks.write_crops(t.pixels.select("field_id", "uuid", "px_row", "px_col", *bands), path, bands=bands)
    return path


@query("write_crops", CROP_SQL)
def _(t):
    back = t.spark.read.parquet(stored_crops(t, ALL_BANDS))
    return back.groupBy("field_id", "band").agg(F.count("value").alias("n_pixels"), F.sum("value").alias("total"))


@query("scan_pixels", """
    SELECT field_id, uuid, count(*) AS n_pixels, sum(SCL_20m)::bigint AS total FROM fx_pixels GROUP BY field_id, uuid""")
def _(t):
    scan = rasters.scan_pixels(t.spark, stored_crops(t), bands=["SCL_20m"])
    return scan.groupBy("field_id", "uuid").agg(F.count(F.lit(1)).alias("n_pixels"), F.sum("value").alias("total"))


@query("list_product_files", "SELECT identifier AS product, band, 1 AS listed FROM fx_products, (VALUES "
       + ", ".join(f"('{b}')" for b in ALL_BANDS) + ") b(band)")
def _(t):
    path = scratch_path(t.spark, "archive")
    names = F.explode(F.array(*[F.lit(b) for b in ALL_BANDS]))
    listed = t.products.select(F.concat("identifier", F.lit(".SAFE/GRANULE")).alias("product"), names.alias("IMG_DATA"), F.lit("-").alias("value"))
    listed.write.partitionBy("product", "IMG_DATA").text(path)
    files = rasters.list_product_files(t.spark, path, glob="*.txt", product_pattern=r"product=([^/]+)\.SAFE")
    return files.select("product", F.regexp_extract("path", r"IMG_DATA=([^/]+)/", 1).alias("band"), F.lit(1).alias("listed")).distinct()


@query("tiles_to_pixels", """
    WITH o AS (SELECT l_orderkey, l_partkey % 2000 + 100 AS value,
                      row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) - 1 AS px_col FROM lineitem)
    SELECT cast(l_orderkey AS string) AS uuid, 'B04_10m' AS band, 0 AS px_row, cast(px_col AS int) AS px_col, cast(value AS double) AS value,
           600000 + l_orderkey * 10 + (px_col + 0.5) * 10 AS x, 1700000 - 5.0 AS y FROM o""")
def _(t):
    # one tile per order: its lines, in order, as a row of big-endian 16-bit samples
    sample = F.struct("l_linenumber", "l_partkey", (F.col("l_partkey") % 2000 + 100).alias("v"))
    tiles = t.raw("lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(sample)).alias("s")).select(
        F.col("l_orderkey").cast("string").alias("uuid"), F.lit("B04_10m").alias("band"),
        (F.lit(600000.0) + F.col("l_orderkey") * 10).alias("x0"), F.lit(1700000.0).alias("y0"), F.lit(10.0).alias("res"),
        F.size("s").alias("width"), F.lit(1).alias("height"), F.lit(">u2").alias("dtype"),
        F.unhex(F.array_join(F.transform("s", lambda p: F.lpad(F.hex(p["v"]), 4, "0")), "")).alias("data"))
    return rasters.tiles_to_pixels(tiles)


@query("ingest_new_products", f"""
    SELECT field_id, uuid, bool_or(SCL_20m IN {NOT_CLEAR}) AS is_cloudy, round(avg(B04_10m), 6) AS B04_10m, round(avg(B08_10m), 6) AS B08_10m
    FROM fx_pixels GROUP BY field_id, uuid""")
def _(t):
    bands = ("B04_10m", "B08_10m")
    out, checkpoint = scratch_path(t.spark, "ingested"), scratch_path(t.spark, "progress")
    source = t.spark.readStream.schema(t.raw("lineitem").schema).option("pathGlobFilter", "lineitem.parquet").parquet(t.sf_dir)
    text = _fill(VIEWS["fx_pixels"], "timestamp_ntz", lambda i: "", lambda name: "{" + name + "}")
    to_pixels = lambda batch: batch.sparkSession.sql(text, lineitem=batch)
    for _run in range(2):
        # the second run finds nothing new
        ingest.ingest_new_products(source, to_pixels, out, checkpoint, bands)
    return rounded(ingest.read_ingested(t.spark, out, bands), 6, *bands)
