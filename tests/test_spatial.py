"""Containment, local point tests and tile clipping beside plain geometry."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldlens.functions import geometry
from fieldlens.operators import spatial
from fieldlens.sources.rasters import tiles_to_pixels

POLYGONS = "array<array<array<struct<x:double,y:double>>>>"


def box(x1, y1, x2, y2):
    return [(x1, y1), (x2, y1), (x2, y2), (x1, y2), (x1, y1)]


def shapes(spark, rows, key):
    """rows: (id, polygons); a polygon is a list of rings."""
    made = [(k, [[[(float(x), float(y)) for x, y in ring] for ring in rings] for rings in polygons]) for k, polygons in rows]
    frame = spark.createDataFrame(made, f"{key} string, polygons {POLYGONS}").withColumn("rings", F.flatten("polygons"))
    return geometry.with_bbox(frame)


U_SHAPE = [[(0, 0), (10, 0), (10, 10), (6, 10), (6, 3), (4, 3), (4, 10), (0, 10), (0, 0)]]
SLANTED = [[(0, 0), (3, 1), (4, 4), (1, 3), (0, 0)]]
OUTER = {
    "holed": [[box(0, 0, 10, 10), box(4, 4, 5, 5)]],
    "notched": [U_SHAPE],
    "two": [[box(0, 0, 4, 4)], [box(6, 0, 10, 4)]],
    "slanted": [SLANTED],
}
INNER = {
    "round the hole": [[box(2, 2, 8, 8)]], "beside the hole": [[box(1, 1, 3, 3)]], "with the same hole": [[box(2, 2, 8, 8), box(4, 4, 5, 5)]],
    "with a larger hole": [[box(2, 2, 8, 8), box(3, 3, 6, 6)]], "with a smaller hole": [[box(2, 2, 8, 8), box(4.2, 4.2, 4.8, 4.8)]],
    "in the hole": [[box(4.2, 4.2, 4.8, 4.8)]], "the hole": [[box(4, 4, 5, 5)]], "touching the hole": [[box(5, 4, 7, 5)]],
    "the notch": [[box(4, 3, 6, 10)]], "in the notch": [[box(4.5, 5, 5.5, 9)]], "below the notch": [[box(4, 1, 6, 3)]], "bridge": [[box(1, 5, 9, 6)]],
    "left arm": [[box(0, 3, 4, 10)]], "both arms": [[box(1, 4, 3, 9)], [box(7, 4, 9, 9)]], "arm and notch": [[box(1, 4, 3, 9)], [box(4.5, 4, 5.5, 9)]],
    "first part": [[box(0, 0, 4, 4)]], "both parts": [[box(1, 1, 2, 2)], [box(7, 1, 8, 2)]], "across": [[box(3, 1, 7, 2)]], "between": [[box(4, 0, 6, 4)]],
    "corner": [[box(9, 9, 11, 11)]], "slanted itself": [SLANTED], "half a slant": [[[(0, 0), (1.5, 0.5), (2, 2), (0.5, 1.5), (0, 0)]]],
    "no area": [[[(1, 1), (2, 1), (1, 1)]]],
}
# by hand
WITHIN = {
    "holed": {"beside the hole", "with the same hole", "with a larger hole", "touching the hole", "left arm", "both arms", "first part",
              "both parts", "across", "slanted itself", "half a slant", "no area", "below the notch"} - {"slanted itself"},
    "notched": {"beside the hole", "below the notch", "left arm", "both arms", "both parts", "no area", "across", "half a slant"},
    "two": {"first part", "both parts", "beside the hole", "slanted itself", "half a slant", "no area"},
    "slanted": {"slanted itself", "half a slant"},
}


def by_points(inner, outer, step=0.05):
    """Containment of all points of a fine grid that are inside: no more than a necessary condition."""
    def inside(polygons, x, y):
        return any(sum(((y1 <= y) != (y2 <= y)) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1)
                       for ring in rings for (x1, y1), (x2, y2) in zip(ring, ring[1:])) % 2 for rings in polygons)

    grid = np.arange(step / 3, 11, step)
    return all(inside(outer, x, y) for x in grid for y in grid if inside(inner, x, y))


@pytest.mark.parametrize("cell", [1.7, 50.0])
def test_containment_of_parts_holes_and_notches(spark, cell):
    fields = shapes(spark, list(INNER.items()), "field_id")
    footprints = shapes(spark, list(OUTER.items()), "uuid")
    found = {(r.uuid, r.field_id) for r in spatial.contains_join(fields, footprints, cell).collect()}
    for name, outer in OUTER.items():
        got = {f for u, f in found if u == name}
        want = {f for f, inner in INNER.items() if by_points(inner, outer, 0.13)} - {"no area"}
        assert got - {"no area"} == want, name


def test_hole_and_notch_by_hand(spark):
    fields = shapes(spark, list(INNER.items()), "field_id")
    found = {(r.uuid, r.field_id) for r in spatial.contains_join(fields, shapes(spark, list(OUTER.items()), "uuid"), 4.0).collect()}
    for pair in (("holed", "round the hole"), ("holed", "the hole"), ("holed", "in the hole"), ("notched", "the notch"), ("notched", "in the notch"),
                 ("notched", "bridge"), ("notched", "arm and notch"), ("two", "across"), ("two", "between"), ("holed", "with a smaller hole")):
        assert pair not in found
    for pair in (("holed", "with the same hole"), ("holed", "touching the hole"), ("notched", "left arm"), ("notched", "both arms"),
                 ("two", "both parts"), ("slanted", "slanted itself"), ("slanted", "half a slant"), ("notched", "below the notch")):
        assert pair in found


def star(n, seed, holes=0):
    """A polygon of n corners at uneven distances from its middle, with holes."""
    rng = np.random.default_rng(seed)
    angle = np.linspace(0, 2 * np.pi, n, endpoint=False)
    far = 40 + 9 * np.sin(5 * angle) + rng.uniform(-4, 4, n)
    ring = [(50 + r * np.cos(a), 50 + r * np.sin(a)) for r, a in zip(far, angle)]
    return [ring + ring[:1]] + [box(45 + 6 * h, 45, 48 + 6 * h, 52) for h in range(holes)]


@pytest.mark.parametrize("corners,cell", [(40, 7.0), (2_000, 3.3), (10_000, 11.0)])
def test_local_edges_give_the_same_points(spark, corners, cell):
    field = shapes(spark, [("A", [star(corners, corners, holes=2)])], "field_id")
    edge = np.array([(e.x1, e.y1, e.x2, e.y2) for e in field.select(F.explode(geometry.edges("rings")).alias("e")).select("e.*").collect()])
    rng = np.random.default_rng(1)
    xy = np.concatenate([rng.uniform(0, 100, (3_000, 2)), edge[rng.integers(0, len(edge), 300), :2], np.round(rng.uniform(0, 100, (300, 2)) / cell) * cell])
    points = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(xy)], "uuid long, x double, y double")
    got = {r.uuid: r.inside for r in spatial.clip_pixels(points, field, cell).collect()}
    x1, y1, x2, y2 = edge.T
    for i, (x, y) in enumerate(xy):
        on = (y1 <= y) != (y2 <= y)
        want = ((x < x1[on] + (y - y1[on]) * (x2[on] - x1[on]) / (y2[on] - y1[on])).sum() % 2) == 1
        assert got.get(i, False) == want


def test_a_cell_looks_at_few_edges(spark):
    sizes = []
    for corners in (1_000, 8_000):
        field = shapes(spark, [("A", [star(corners, 3)])], "field_id").withColumn("_edges", geometry.edges("rings"))
        cells = spatial.local_edges(spatial.cover_cells(field, 100 / corners ** 0.5), 100 / corners ** 0.5)
        sizes.append(cells.select((F.size("_edges") + F.size("_turns")).alias("n")).agg(F.avg("n")).first()[0])
    assert sizes[0] < 30 and sizes[1] < 60


def test_tiles_give_the_pixels_of_the_pixel_table(spark):
    rng = np.random.default_rng(7)
    tiles = []
    for k, (x0, y0, kind) in enumerate([(0.0, 100.0, "uint16"), (50.0, 100.0, "uint16"), (0.0, 50.0, "float32"), (400.0, 400.0, "uint8")]):
        data = rng.integers(0, 200, (25, 25)).astype(kind)
        tiles += [(f"p{k}", band, kind, data.tobytes(), 25, 25, x0, y0, 2.0) for band in ("B02", "B03")]
    tiles = spark.createDataFrame(tiles, "uuid string, band string, dtype string, data binary, height int, width int, x0 double, y0 double, res double")
    fields = shapes(spark, [("star", [star(60, 4, holes=1)]), ("box", [[box(3, 3, 7, 97)]]), ("line", [[box(10.2, 10.2, 10.4, 10.4)]]), ("far", [[box(900, 900, 901, 901)]]),
                            ("two", [[box(1, 60, 9, 70)], [box(60, 1, 71, 9)]])], "field_id")
    order = ["uuid", "band", "field_id", "px_row", "px_col"]
    for outside in (True, False):
        want = spatial.clip_pixels(tiles_to_pixels(tiles), fields, 20.0, keep_outside=outside).orderBy(*order).toPandas()
        clipped = spatial.clip_tiles(tiles, fields, 20.0, keep_outside=outside)
        got = clipped.orderBy(*order).toPandas()[want.columns]
        assert len(want) and got.equals(want)
