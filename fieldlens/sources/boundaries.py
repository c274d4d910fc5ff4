"""Field boundaries from KML, KMZ and GeoJSON."""

import io
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from fieldlens.functions.geometry import force_2d, parse_geometry, polygons_2d, ring_from_kml
from fieldlens.functions.text import canonical_field_id

FILE_STEM = r"([^/]+)\.[^./]+$"

# only the outer ring is declared: names and descriptions in the file are never read
OUTER_RING = "struct<outerBoundaryIs:struct<LinearRing:struct<coordinates:string>>>"
PLACEMARK_DDL = f"Polygon {OUTER_RING}"
KML_DDL = f"Document struct<Placemark:array<struct<Polygon:{OUTER_RING}>>>"


def _boundary(df, path, coordinates, id_pattern):
    stem = F.regexp_extract(F.url_decode(path), id_pattern, 1)
    ring = ring_from_kml(coordinates)
    return df.select(
        stem.alias("file_id"), canonical_field_id(stem).alias("field_id"),
        F.when(F.size(ring) > 0, F.array(ring)).alias("rings"))


def read_boundaries_kml(spark, path, id_pattern=FILE_STEM):
    """A polygon per placemark; the id is the file's stem, also in canonical form."""
    rows = (
        spark.read.format("xml").option("rowTag", "Placemark").schema(PLACEMARK_DDL).load(path)
        .select("*", F.col("_metadata.file_path").alias("_path"))
    )
    return _boundary(rows, F.col("_path"), F.col("Polygon.outerBoundaryIs.LinearRing.coordinates"), id_pattern)


def unzip_kml(archives, member="doc.kml"):
    """(path, content) rows of zip archives -> (path, kml text). One archive per row, in tasks."""

    def read(frames):
        for frame in frames:
            texts = []
            for content in frame["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    texts.append(archive.read(member).decode("utf-8"))
            yield pd.DataFrame({"path": frame["path"], "kml": texts})

    return archives.select("path", "content").mapInPandas(read, "path string, kml string")


def parse_kml_text(df, path="path", kml="kml", id_pattern=FILE_STEM):
    """KML documents held as text -> a boundary per placemark."""
    placed = df.select(
        F.col(path).alias("_path"), F.explode(F.from_xml(F.col(kml), KML_DDL)["Document"]["Placemark"]).alias("_p"))
    return _boundary(placed, F.col("_path"), F.col("_p.Polygon.outerBoundaryIs.LinearRing.coordinates"), id_pattern)


def read_boundaries_kmz(spark, path, id_pattern=FILE_STEM, glob="*.kmz"):
    archives = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return parse_kml_text(unzip_kml(archives), id_pattern=id_pattern)


FEATURE_DDL = "type string, geometry string, properties map<string,string>"
COLLECTION_DDL = "features array<struct<type:string,geometry:string,properties:map<string,string>>>"


def read_geojson(spark, path, properties, collection=False):
    """Features -> rows of the named properties (name -> type) and the geometry as text, as polygons and as the rings of all
    of them in one list.

    ``collection=False``: one feature per line, which splits and scales. ``True``: each file is one
    FeatureCollection document, read whole as the format demands.
    """
    if collection:
        documents = spark.read.schema(COLLECTION_DDL).option("multiLine", "true").json(path)
        features = documents.select(F.explode("features").alias("f")).select("f.*")
    else:
        features = spark.read.schema(FEATURE_DDL).json(path)
    parsed = features.withColumn("_g", parse_geometry(F.col("geometry")))
    columns = [F.col("properties")[name].cast(kind).alias(name) for name, kind in properties.items()]
    return parsed.select(
        *columns, F.col("geometry").alias("geometry_text"), polygons_2d(F.col("_g.parts")).alias("polygons"),
        force_2d(F.col("_g.parts")).alias("rings"))


def bad_geometry(df, text="geometry_text", rings="rings"):
    """Number of rows whose geometry text could not be read."""
    return df.agg(F.count_if(F.col(text).isNotNull() & F.col(rings).isNull()).alias("bad_geometry"))
