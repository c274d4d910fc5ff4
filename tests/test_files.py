import io
import zipfile

import numpy as np
from pyspark.sql import functions as F

from fieldlens.sinks import tables as sinks
from fieldlens.sources import boundaries, rasters, sheets
from fieldlens.streaming import ingest

KML = """<?xml version="1.0" encoding="UTF-8"?>
<kml xmlns="http://www.opengis.net/kml/2.2"><Document><Placemark><open>1</open><Polygon><outerBoundaryIs><LinearRing>
<coordinates> 76.71,15.25,0 76.72,15.25,0 76.72,15.26,0 76.71,15.25,0
</coordinates></LinearRing></outerBoundaryIs></Polygon></Placemark></Document></kml>"""


def test_kml_folder(spark, tmp_path):
    (tmp_path / "g7.kml").write_text(KML)
    (tmp_path / "G1234.kml").write_text(KML)
    rows = boundaries.read_boundaries_kml(spark, str(tmp_path)).collect()
    assert {r["field_id"] for r in rows} == {"G007", "G1234"}
    assert all(len(r["rings"]) == 1 and len(r["rings"][0]) == 4 and r["rings"][0][1]["x"] == 76.72 for r in rows)


def test_kmz_folder(spark, tmp_path):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        archive.writestr("doc.kml", KML)
    (tmp_path / "G47.kmz").write_bytes(buffer.getvalue())
    row = boundaries.read_boundaries_kmz(spark, str(tmp_path)).first()
    assert row["field_id"] == "G047" and len(row["rings"][0]) == 4


def test_geojson_collection_and_bad_geometry(spark, tmp_path):
    (tmp_path / "a.geojson").write_text(
        '{"type":"FeatureCollection","features":['
        '{"type":"Feature","properties":{"field_id":"G001","n":3},"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}},\n'
        '{"type":"Feature","properties":{"field_id":"G002","n":null},"geometry":{"type":"Point","coordinates":[0,0]}}]}')
    rows = boundaries.read_geojson(spark, str(tmp_path), {"field_id": "string", "n": "int"}, collection=True)
    got = {r["field_id"]: (r["n"], r["rings"] is not None) for r in rows.collect()}
    assert got == {"G001": (3, True), "G002": (None, False)}
    assert boundaries.bad_geometry(rows).first()["bad_geometry"] == 1


def test_sheet_with_banner(spark, tmp_path):
    (tmp_path / "s.csv").write_text("Farms by number,,,\nSl.No,Village,Farmer name,Date of survey\nG001,x,one,2022-01-01\nG002,y,two,\n")
    rows = sheets.read_fields_by_gnum(
        spark, str(tmp_path), ("Sl.No", "Village", "Farmer name", "Date of survey"), banner="Farms by number")
    assert rows.columns == ["field_id", "farm_name", "date_of_survey"]
    assert [tuple(r) for r in rows.orderBy("field_id").collect()] == [("G001", "one", "2022-01-01"), ("G002", "two", None)]


def test_tiles(spark):
    values = np.arange(6, dtype="<u2").reshape(2, 3)
    tiles = spark.createDataFrame(
        [("p", "B04_10m", 100.0, 200.0, 10.0, 3, 2, "<u2", bytearray(values.tobytes()))],
        "uuid string, band string, x0 double, y0 double, res double, width int, height int, dtype string, data binary")
    got = {(r["px_row"], r["px_col"]): (r["value"], r["x"], r["y"]) for r in rasters.tiles_to_pixels(tiles).collect()}
    assert got[0, 0] == (0, 105.0, 195.0) and got[1, 2] == (5, 125.0, 185.0) and len(got) == 6


def test_raster_listing(spark, tmp_path):
    folder = tmp_path / "S1.SAFE" / "GRANULE" / "L2A" / "IMG_DATA" / "R10m"
    folder.mkdir(parents=True)
    (folder / "T43_B04_10m.jp2").write_bytes(b"x")
    (folder / "notes.txt").write_text("x")
    rows = rasters.list_product_files(spark, str(tmp_path)).collect()
    assert len(rows) == 1 and rows[0]["product"] == "S1" and rows[0]["path"].endswith("B04_10m.jp2")


def test_scan_is_pruned(spark, tmp_path):
    pixels = spark.range(100).select(
        F.lit("A").alias("field_id"), F.lit("p").alias("uuid"), F.lit("B04_10m").alias("band"),
        F.col("id").cast("int").alias("px_row"), F.lit(0).alias("px_col"), F.lit(1).alias("value"))
    sinks.write_crops(pixels, str(tmp_path / "crops"))
    scan = rasters.scan_pixels(spark, str(tmp_path / "crops"), bands=["B04_10m"], field_ids=["A"]).select("value")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert scan.count() == 100 and "PartitionFilters: [isnotnull(band" in plan.replace("\n", " ") or "PartitionFilters: [(band" in plan
    assert "EqualTo(field_id,A)" in plan or "In(field_id" in plan


def test_stream_equals_batch_over_several_runs(spark, tmp_path):
    pixels = spark.range(400).select(
        F.concat(F.lit("F"), (F.col("id") % 3).cast("string")).alias("field_id"), F.lit("p").alias("uuid"),
        (F.col("id") % 9).cast("int").alias("SCL_20m"), F.col("id").cast("int").alias("B04_10m"))
    inbox, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    (tmp_path / "in").mkdir()
    source = spark.readStream.schema(pixels.schema).option("maxFilesPerTrigger", "1").parquet(inbox)
    # one scene arrives in several files and over several runs
    for low, high in ((0, 150), (150, 300), (300, 400)):
        pixels.where(f"B04_10m >= {low} AND B04_10m < {high}").repartition(2).write.mode("append").parquet(inbox)
        ingest.ingest_new_products(source, lambda b: b, out, progress, ["B04_10m"])
    ingest.ingest_new_products(source, lambda b: b, out, progress, ["B04_10m"])
    got = {r["field_id"]: (r["is_cloudy"], r["B04_10m"]) for r in ingest.read_ingested(spark, out, ["B04_10m"]).collect()}
    want = pixels.groupBy("field_id").agg(F.bool_or(F.col("SCL_20m").isin(1, 3, 8)).alias("c"), F.avg("B04_10m").alias("m")).collect()
    assert got == {r["field_id"]: (r["c"], r["m"]) for r in want}
