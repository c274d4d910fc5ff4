import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldlens.constants import ALL_BANDS, FLATTENING, SCALE_FACTOR, SEMI_MAJOR_AXIS
from fieldlens.functions import dates, geometry, projection, spectral, text


def one(spark, expr, **values):
    frame = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return frame.select(expr.alias("v")).first()["v"]


def test_band_list():
    assert len(ALL_BANDS) == len(set(ALL_BANDS)) == 28


@pytest.mark.parametrize("raw, want", [("g7", "G007"), ("G47", "G047"), ("G1234", "G1234"), ("ab12x", "G012"), ("12g", None)])
def test_canonical_id_pads_and_never_cuts(spark, raw, want):
    assert one(spark, text.canonical_field_id(F.col("c")), c=raw) == want


def test_ratings_and_lists(spark):
    rows = spark.createDataFrame([(2.9, "a  b"), (None, "")], "r double, l string").select(
        text.rating_to_int("r").alias("r"), text.text_to_list("l").alias("l")).collect()
    assert [r["r"] for r in rows] == [2, 0]
    assert [r["l"] for r in rows] == [["a", "b"], []]


def test_headers():
    assert text.sanitize_header(" Date of Survey ") == "date_of_survey"


def test_dates(spark):
    frame = spark.createDataFrame([("05/11/2021",), ("2021-11-05 10:00:00",), ("never",)], ["c"])
    got = [r["v"] for r in frame.select(dates.date_label(dates.parse_date("c", "dd/MM/yyyy")).alias("v")).collect()]
    assert got == ["5/11/2021", "5/11/2021", None]


def test_index_of_zero_is_missing(spark):
    assert one(spark, spectral.normalized_difference("a", "b"), a=0, b=0) is None
    assert one(spark, spectral.normalized_difference("a", "b"), a=3, b=1) == 0.5


def test_projection_on_the_meridian_is_the_meridian_arc(spark):
    e2 = FLATTENING * (2 - FLATTENING)
    phi = np.linspace(0, math.radians(15.2), 200_001)
    arc = np.trapezoid(SEMI_MAJOR_AXIS * (1 - e2) / (1 - e2 * np.sin(phi) ** 2) ** 1.5, phi)
    x, y = projection.project_utm("lon", "lat")
    got = one(spark, F.struct(x.alias("x"), y.alias("y")), lon=75.0, lat=15.2)
    assert abs(got["x"] - 500000) < 1e-6 and abs(got["y"] - SCALE_FACTOR * arc) < 1e-3


def test_projection_there_and_back(spark):
    frame = spark.range(500).select(
        (F.lit(73.0) + F.col("id") * 0.008).alias("lon"), (F.lit(-2.0) + F.col("id") * 0.1).alias("lat"))
    x, y = projection.project_utm("lon", "lat")
    there = frame.select("lon", "lat", x.alias("x"), y.alias("y"))
    lon, lat = projection.unproject_utm("x", "y")
    worst = there.select(F.max(F.greatest(F.abs(lon - F.col("lon")), F.abs(lat - F.col("lat"))))).first()[0]
    assert worst < 1e-8


GEOMETRIES = {
    "z_hole": '{"type":"Polygon","coordinates":[[[0,0,1],[4,0,1],[4,4,1],[0,0,1]],[[1,1,1],[2,1,1],[2,2,1],[1,1,1]]]}',
    "flat_hole": '{"type":"Polygon","coordinates":[[[0,0],[4,0],[4,4],[0,0]],[[1,1],[2,1],[2,2],[1,1]]]}',
    "multi": '{"type":"MultiPolygon","coordinates":[[[[0,0],[1,0],[1,1],[0,0]]],[[[5,5],[6,5],[6,6],[5,5]]]]}',
    "point": '{"type":"Point","coordinates":[1,2]}',
    "broken": '{"type":"Polygon","coordinates":[[[1',
    "missing": None,
}


def test_geometry_text(spark):
    frame = spark.createDataFrame(list(GEOMETRIES.items()), "k string, g string")
    parsed = frame.select("k", geometry.parse_geometry("g").alias("p"))
    rings = {r["k"]: r["n"] for r in parsed.select("k", F.size(geometry.force_2d("p.parts")).alias("n")).collect()}
    assert rings == {"z_hole": 1, "flat_hole": 2, "multi": 2, "point": None, "broken": None, "missing": None}


def test_point_in_polygon_with_hole(spark):
    parts = geometry.parse_geometry(F.lit('{"type":"Polygon","coordinates":[[[0,0],[10,0],[10,10],[0,10],[0,0]],[[4,4],[6,4],[6,6],[4,6],[4,4]]]}'))
    edge_list = geometry.edges(geometry.force_2d(parts["parts"]))
    inside = lambda x, y: one(spark, geometry.point_in_edges(F.col("x"), F.col("y"), edge_list), x=x, y=y)
    assert inside(1.0, 1.0) and not inside(5.0, 5.0) and not inside(11.0, 5.0)
    # the lower left border belongs to the polygon, the upper right one does not
    assert inside(0.0, 0.0) and not inside(10.0, 10.0)


def test_polygon_within_needs_no_crossing_edges(spark):
    ring = lambda pts: F.array(F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in pts]))
    # a U-shaped outer polygon whose notch cuts through the inner one
    outer = ring([(0, 0), (10, 0), (10, 10), (6, 10), (6, 3), (4, 3), (4, 10), (0, 10), (0, 0)])
    bridge = ring([(1, 5), (9, 5), (9, 6), (1, 6), (1, 5)])
    block = ring([(1, 1), (2, 1), (2, 2), (1, 2), (1, 1)])
    for inner, want in ((block, True), (bridge, False)):
        shapes = spark.range(1).select(geometry.part_edges(F.array(inner)).alias("i"), geometry.inside_points(F.array(inner)).alias("p"),
                                       geometry.part_edges(F.array(outer)).alias("o"))
        assert shapes.select(geometry.parts_within("i", "p", "o")).first()[0] is want


def test_box_wkt_starts_lower_right(spark):
    wkt = geometry.rings_to_wkt(geometry.box_rings("a", "b", "c", "d"))
    assert one(spark, wkt, a=0.0, b=1.0, c=2.0, d=3.0) == "POLYGON ((2.0 1.0, 2.0 3.0, 0.0 3.0, 0.0 1.0, 2.0 1.0))"
