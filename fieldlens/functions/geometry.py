"""Polygons as arrays of rings of (x, y) structs, and the tests on them.

Everything here is a column expression; a polygon never leaves the JVM.
"""

from pyspark.sql import functions as F

from fieldlens.functions.projection import project_utm


def parse_geometry(text):
    """GeoJSON geometry text -> struct(kind, parts), or NULL for anything that is no polygon.

    ``parts`` is a list of polygons, each a list of rings, each a list of coordinate lists, so a
    Polygon is a MultiPolygon of one part. Malformed JSON gives NULL.
    """
    text = F.col(text) if isinstance(text, str) else text
    kind = F.get_json_object(text, "$.type")
    coords = F.get_json_object(text, "$.coordinates")
    single = F.from_json(coords, "array<array<array<double>>>")
    multi = F.from_json(coords, "array<array<array<array<double>>>>")
    parts = F.when(kind == "Polygon", F.when(single.isNotNull(), F.array(single))).when(kind == "MultiPolygon", multi)
    return F.when(parts.isNotNull(), F.struct(kind.alias("kind"), parts.alias("parts")))


def polygons_2d(parts, drop_holes="3d"):
    """Coordinate lists -> polygons, each a list of rings of (x, y).

    ``drop_holes``: ``"3d"`` keeps only the outer rings of shapes that carry a height,
    ``"always"`` of every shape, ``"never"`` keeps all rings.
    """
    parts = F.col(parts) if isinstance(parts, str) else parts
    to_xy = lambda ring: F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
    outer = F.transform(parts, lambda rings: F.array(to_xy(rings[0])))
    every = F.transform(parts, lambda rings: F.transform(rings, to_xy))
    if drop_holes == "always":
        return outer
    if drop_holes == "never":
        return every
    has_z = F.exists(F.flatten(F.flatten(parts)), lambda p: F.size(p) > 2)
    return F.when(has_z, outer).otherwise(every)


def force_2d(parts, drop_holes="3d"):
    """The rings of all polygons in one list, for the even-odd tests, which need no more."""
    return F.flatten(polygons_2d(parts, drop_holes))


def ring_from_kml(text):
    """``lon,lat,alt`` tuples separated by blanks -> one ring."""
    text = F.col(text) if isinstance(text, str) else text
    tuples = F.filter(F.split(F.trim(text), r"\s+"), lambda t: t != "")
    return F.transform(
        tuples,
        lambda t: F.struct(
            F.element_at(F.split(t, ","), 1).cast("double").alias("x"),
            F.element_at(F.split(t, ","), 2).cast("double").alias("y"),
        ),
    )


def project_rings(rings):
    """Rings in degrees -> rings in metres."""

    def point(p):
        x, y = project_utm(p["x"], p["y"])
        return F.struct(x.alias("x"), y.alias("y"))

    rings = F.col(rings) if isinstance(rings, str) else rings
    return F.transform(rings, lambda ring: F.transform(ring, point))


def with_bbox(df, rings="rings", prefix=""):
    """Adds xmin, ymin, xmax, ymax of the rings."""
    xs = F.transform(F.flatten(F.col(rings)), lambda p: p["x"])
    ys = F.transform(F.flatten(F.col(rings)), lambda p: p["y"])
    return df.withColumns({
        f"{prefix}xmin": F.array_min(xs), f"{prefix}ymin": F.array_min(ys),
        f"{prefix}xmax": F.array_max(xs), f"{prefix}ymax": F.array_max(ys),
    })


def box_rings(xmin, ymin, xmax, ymax):
    """A box as one closed ring, from its lower right corner counter-clockwise."""
    corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    return F.array(F.array(
        corner(xmax, ymin), corner(xmax, ymax), corner(xmin, ymax), corner(xmin, ymin), corner(xmax, ymin),
    ))


def _wkt_rings(rings):
    ring_text = lambda ring: F.concat(
        F.lit("("), F.array_join(F.transform(ring, lambda p: F.concat_ws(" ", p["x"], p["y"])), ", "), F.lit(")"))
    return F.concat(F.lit("("), F.array_join(F.transform(rings, ring_text), ", "), F.lit(")"))


def rings_to_wkt(rings):
    """One-part polygon as WKT text."""
    return F.concat(F.lit("POLYGON "), _wkt_rings(F.col(rings) if isinstance(rings, str) else rings))


def polygons_to_wkt(polygons):
    """POLYGON of one polygon, MULTIPOLYGON of several."""
    polygons = F.col(polygons) if isinstance(polygons, str) else polygons
    several = F.concat(F.lit("MULTIPOLYGON ("), F.array_join(F.transform(polygons, _wkt_rings), ", "), F.lit(")"))
    return F.when(F.size(polygons) == 1, F.concat(F.lit("POLYGON "), _wkt_rings(polygons[0]))).otherwise(several)


def edges(rings):
    """All edges of all rings as (x1, y1, x2, y2); unclosed rings are closed."""
    rings = F.col(rings) if isinstance(rings, str) else rings

    def ring_edges(ring):
        following = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
        return F.zip_with(
            ring, following,
            lambda p, q: F.struct(p["x"].alias("x1"), p["y"].alias("y1"), q["x"].alias("x2"), q["y"].alias("y2")),
        )

    return F.flatten(F.transform(rings, ring_edges))


def point_in_edges(x, y, edge_list):
    """Even-odd test. Half-open in y, so a point on a shared border belongs to one polygon."""

    def crosses(e):
        spans = (e["y1"] <= y) != (e["y2"] <= y)
        at = e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / (e["y2"] - e["y1"])
        # the branch keeps level edges (y1 = y2) away from the division
        return F.when(spans, x < at).otherwise(F.lit(False))

    return F.size(F.filter(edge_list, crosses)) % 2 == 1


# --- containment, as SQL text: one parse in place of hundreds of calls ------
# ``e``, ``g``: edges; ``part``: a list of edges; ``p``: a point.

# A point this close to an edge, in shares of its coordinates, lies on it: points worked out on slanted edges are rounded.
ON_EDGE = "1E-13D"
_DX, _DY = "(e.x2 - e.x1)", "(e.y2 - e.y1)"


def _on_line(x, y):
    """The point lies on the line through ``e``."""
    return (f"abs({_DX} * ({y} - e.y1) - {_DY} * ({x} - e.x1)) <= {ON_EDGE} * (abs({x}) + abs({y})) * (abs({_DX}) + abs({_DY}))")


def _on_part():
    slack = f"{ON_EDGE} * (abs(p.x) + abs(p.y))"
    between = " AND ".join(f"p.{c} BETWEEN least(e.{c}1, e.{c}2) - {slack} AND greatest(e.{c}1, e.{c}2) + {slack}" for c in "xy")
    return f"exists(part, e -> {_on_line('p.x', 'p.y')} AND {between})"


_IN_PART = ("size(filter(part, e -> CASE WHEN (e.y1 <= p.y) <> (e.y2 <= p.y) "
            f"THEN p.x < e.x1 + (p.y - e.y1) * {_DX} / {_DY} ELSE false END)) % 2 = 1")


def _covered(parts):
    """The point lies in one of the parts or on its border."""
    return f"exists({parts}, part -> {_IN_PART} OR {_on_part()})"


def _inside(parts):
    """The point lies in one of the parts and on no border of it."""
    return f"exists({parts}, part -> {_IN_PART} AND NOT {_on_part()})"


def _split_midpoints(edge_list, others):
    """Midpoints of the pieces into which ``others`` cut the edges: where they cross, touch, or where a common stretch ends.

    A piece lies wholly inside, outside or on the border of the other shape, so its midpoint stands for it.
    """
    meet = " AND ".join(f"greatest(e.{c}1, e.{c}2) >= least(g.{c}1, g.{c}2) AND greatest(g.{c}1, g.{c}2) >= least(e.{c}1, e.{c}2)" for c in "xy")
    turn = f"({_DX} * (g.y2 - g.y1) - {_DY} * (g.x2 - g.x1))"
    crossing = (f"CASE WHEN try_divide((g.x1 - e.x1) * {_DY} - (g.y1 - e.y1) * {_DX}, {turn}) BETWEEN -1E-9D AND 1 + 1E-9D "
                f"THEN try_divide((g.x1 - e.x1) * (g.y2 - g.y1) - (g.y1 - e.y1) * (g.x2 - g.x1), {turn}) END")
    corner = [f"CASE WHEN {_on_line(x, y)} THEN try_divide({_DX} * ({x} - e.x1) + {_DY} * ({y} - e.y1), {_DX} * {_DX} + {_DY} * {_DY}) END"
              for x, y in (("g.x1", "g.y1"), ("g.x2", "g.y2"))]
    cuts = (f"array_sort(array_distinct(concat(array(0D, 1D), filter(flatten(transform(filter({others}, g -> {meet}), "
            f"g -> array({crossing}, {corner[0]}, {corner[1]}))), t -> t IS NOT NULL AND t > 0 AND t < 1))))")
    pieces = ("filter(zip_with(slice(ts, 1, size(ts) - 1), slice(ts, 2, size(ts) - 1), (a, b) -> struct(b - a AS wide, (a + b) / 2 AS t)), m -> m.wide > 1E-12D)")
    points = f"transform({pieces}, m -> struct(e.x1 + m.t * {_DX} AS x, e.y1 + m.t * {_DY} AS y))"
    return (f"flatten(transform(filter({edge_list}, e -> e.x1 <> e.x2 OR e.y1 <> e.y2), "
            f"e -> element_at(transform(array({cuts}), ts -> {points}), 1)))")


def parts_within(inner_parts, inner_points, outer_parts):
    """True where every point of the inner polygons belongs to the outer ones, borders included. The names of columns made by
    ``part_edges`` and ``inside_points``, which are worked out once a shape, not once a pair.

    Three things must hold: the inner border lies in the outer shape; the outer border, with its holes and notches, runs nowhere
    through the inner shape; and each inner part has a point inside that the outer shape covers, which tells a part in the
    shape from one that fills a hole or a notch.
    """
    inner, outer = f"flatten({inner_parts})", f"flatten({outer_parts})"
    border_in = f"forall({_split_midpoints(inner, outer)}, p -> {_covered(outer_parts)})"
    cut = f"exists({_split_midpoints(outer, inner)}, p -> {_inside(inner_parts)} AND NOT {_inside(outer_parts)})"
    return F.expr(f"{border_in} AND NOT {cut} AND forall({inner_points}, p -> {_covered(outer_parts)})")


def part_edges(polygons):
    """A list of edges per polygon."""
    return F.transform(polygons, edges)


def inside_points(polygons):
    """A point inside each polygon that has an area."""
    return F.filter(F.transform(polygons, interior_point), lambda p: p.isNotNull())


def interior_point(rings):
    """A point inside one polygon: the middle of its widest stretch halfway between two neighbouring corner heights. NULL for one without area."""
    edge_list = edges(rings)
    heights = F.array_sort(F.array_distinct(F.transform(F.flatten(rings), lambda p: p["y"])))
    middle = F.floor(F.size(heights) / 2).cast("int")
    y = (F.get(heights, middle - 1) + F.get(heights, middle)) / 2
    spanning = F.filter(edge_list, lambda e: (e["y1"] <= y) != (e["y2"] <= y))
    xs = F.array_sort(F.transform(spanning, lambda e: e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / (e["y2"] - e["y1"])))
    firsts = F.filter(xs, lambda x, i: i % 2 == 0)
    seconds = F.filter(xs, lambda x, i: i % 2 == 1)
    stretches = F.zip_with(firsts, seconds, lambda a, b: F.struct((b - a).alias("wide"), ((a + b) / 2).alias("x"), y.alias("y")))
    return F.array_max(F.filter(stretches, lambda p: p["wide"] > 0))


def is_box(polygons):
    """True for one rectangle along the axes, without holes: for it a test of boxes says all."""
    polygons = F.col(polygons) if isinstance(polygons, str) else polygons
    lines = edges(polygons[0])
    real = F.filter(lines, lambda e: (e["x1"] != e["x2"]) | (e["y1"] != e["y2"]))
    along = F.forall(real, lambda e: (e["x1"] == e["x2"]) | (e["y1"] == e["y2"]))
    return (F.size(polygons) == 1) & (F.size(F.get(polygons, F.lit(0))) == 1) & (F.size(real) == 4) & along


def polygons_to_geojson(polygons):
    """GeoJSON geometry text: a Polygon of one polygon, a MultiPolygon of several."""
    polygons = F.col(polygons) if isinstance(polygons, str) else polygons
    coords = F.transform(polygons, lambda rings: F.transform(rings, lambda ring: F.transform(ring, lambda p: F.array(p["x"], p["y"]))))
    text = lambda kind, of: F.concat(F.lit(f'{{"type":"{kind}","coordinates":'), F.to_json(of), F.lit("}"))
    return F.when(F.size(polygons) == 1, text("Polygon", coords[0])).when(polygons.isNotNull(), text("MultiPolygon", coords))
