"""Spatial joins on a grid key.

A box condition alone would make Spark compare every pair. Here both sides get the number of a
grid cell and are joined on it; the box and the exact polygon test follow as a filter. Cells
that hold a large share of the rows are spread over ``salts`` sub-keys: the many-row side draws a
salt from a hash of the row, the polygon side is repeated once per salt.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from fieldlens.functions.geometry import edges, inside_points, is_box, part_edges, parts_within, point_in_edges
from fieldlens.functions.projection import project_utm


def cell_number(value, size):
    value = F.col(value) if isinstance(value, str) else value
    return F.floor(value / F.lit(float(size))).cast("bigint")


def cover_cells(df, cell_size, box=("xmin", "ymin", "xmax", "ymax")):
    """One row per grid cell that the row's box touches."""
    xmin, ymin, xmax, ymax = box
    return (
        df.withColumn("_cx", F.explode(F.sequence(cell_number(xmin, cell_size), cell_number(xmax, cell_size))))
        .withColumn("_cy", F.explode(F.sequence(cell_number(ymin, cell_size), cell_number(ymax, cell_size))))
    )


def local_edges(windows, cell_size):
    """The rows of ``cover_cells`` with the part of ``_edges`` that a point test in their cell needs, whatever the polygon's size.

    The even-odd test counts the edges to the right of a point that span its height. In a cell that leaves three things:
    the edges that meet the cell (``_edges``); the parity of the edges to the right of it at its lower border (``_odd``); and the heights in
    the cell at which that parity changes (``_turns``). An edge to the right changes it at both its ends, so the ends that two
    such edges share cancel out, and turns are left only where the border comes into or leaves the cell's strip.
    Cells are taken a little larger, as the number of a point's cell is rounded.
    """
    pad, size = 1e-6 * cell_size, float(cell_size)
    x0, x1 = F.col("_cx") * size - pad, (F.col("_cx") + 1) * size + pad
    y0, y1 = F.col("_cy") * size - pad, (F.col("_cy") + 1) * size + pad
    in_strip = lambda e: (F.greatest(e["y1"], e["y2"]) >= y0) & (F.least(e["y1"], e["y2"]) <= y1)
    left, right = lambda e: F.least(e["x1"], e["x2"]), lambda e: F.greatest(e["x1"], e["x2"])
    found = windows.withColumn("_beyond", F.filter("_edges", lambda e: in_strip(e) & (left(e) > x1)))
    found = found.withColumns({
        "_edges": F.filter("_edges", lambda e: in_strip(e) & (left(e) <= x1) & (right(e) >= x0)),
        "_odd": F.size(F.filter("_beyond", lambda e: (e["y1"] <= y0) != (e["y2"] <= y0))) % 2 == 1,
        "_ends": F.array_sort(F.filter(F.flatten(F.transform("_beyond", lambda e: F.array(e["y1"], e["y2"]))), lambda y: (y > y0) & (y <= y1)))})
    # of equal heights, an odd number leaves one
    runs = F.filter("_ends", lambda y, i: (i == F.size("_ends") - 1) | (F.get("_ends", i + 1) != y))
    odd = F.filter(runs, lambda y: F.size(F.filter("_ends", lambda z: z == y)) % 2 == 1)
    return found.withColumn("_turns", odd).drop("_beyond", "_ends")


def inside_cell(x, y):
    """The even-odd test of a point with what ``local_edges`` kept for its cell; equal to the test of all edges."""
    turned = F.size(F.filter("_turns", lambda t: t <= y)) % 2 == 1
    return point_in_edges(x, y, F.col("_edges")) != (F.col("_odd") != turned)


def _salted(many, few, row_key, salts):
    if salts <= 1:
        return many, few, ["_cx", "_cy"]
    many = many.withColumn("_salt", F.pmod(F.xxhash64(*row_key), F.lit(salts)).cast("int"))
    few = few.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    return many, few, ["_cx", "_cy", "_salt"]


def polygons_of(shapes):
    """The shape's polygons, or its rings as one polygon."""
    return F.col("polygons") if "polygons" in shapes.columns else F.array("rings")


def contains_join(fields, products, cell_size, salts=1, exact=True):
    """Field-product pairs where the product's footprint holds the whole field.

    A footprint that holds a field also holds the lower left corner of the field's box, so a field
    needs one cell only and every pair is met once: no distinct afterwards. Either side has its shape as ``polygons``, with
    parts and holes kept apart, or as ``rings`` of one polygon.
    """
    fields = fields.where("xmin IS NOT NULL").withColumns(
        {"_cx": cell_number("xmin", cell_size), "_cy": cell_number("ymin", cell_size)})
    keep = ["uuid", "p_xmin", "p_ymin", "p_xmax", "p_ymax"] + (["p_parts", "p_is_box"] if exact else [])
    footprints = products.withColumnsRenamed({"xmin": "p_xmin", "ymin": "p_ymin", "xmax": "p_xmax", "ymax": "p_ymax"})
    if exact:
        fields = fields.withColumns({"_parts": part_edges(polygons_of(fields)), "_points": inside_points(polygons_of(fields))})
        footprints = footprints.withColumns({"p_parts": part_edges(polygons_of(products)), "p_is_box": is_box(polygons_of(products))})
    footprints = footprints.select(*keep)
    footprints = cover_cells(footprints.where("p_xmin IS NOT NULL"), cell_size, ("p_xmin", "p_ymin", "p_xmax", "p_ymax"))
    many, few, on = _salted(fields, footprints, ["field_id"], salts)
    pairs = many.join(few, on).where(
        "p_xmin <= xmin AND p_ymin <= ymin AND p_xmax >= xmax AND p_ymax >= ymax")
    if exact:
        # the boxes were compared above
        pairs = pairs.where(F.col("p_is_box") | parts_within("_parts", "_points", "p_parts"))
    return pairs.select("field_id", "uuid")


def field_product_grid(fields, products, bands, cell_size, salts=1, exact=True):
    """Fields x products x bands, made from the containment pairs and the fixed list of bands."""
    pairs = contains_join(fields, products, cell_size, salts, exact)
    return pairs.withColumn("band", F.explode(F.array(*[F.lit(b) for b in bands])))


def clip_pixels(pixels, fields, cell_size, x="x", y="y", row_key=("uuid", "x", "y"), salts=1, keep_outside=True):
    """Pixels whose centre lies in the window of a field, with ``inside`` for the polygon itself.

    A pixel has one cell, so it meets a field once. ``keep_outside=False`` keeps the polygon only.
    """
    pixels = pixels.withColumns({"_cx": cell_number(x, cell_size), "_cy": cell_number(y, cell_size)})
    windows = local_edges(cover_cells(
        fields.where("xmin IS NOT NULL").select("field_id", "xmin", "ymin", "xmax", "ymax", edges("rings").alias("_edges")),
        cell_size), cell_size)
    many, few, on = _salted(pixels, windows, list(row_key), salts)
    met = many.join(few, on).where(
        (F.col(x) >= F.col("xmin")) & (F.col(x) <= F.col("xmax"))
        & (F.col(y) >= F.col("ymin")) & (F.col(y) <= F.col("ymax")))
    clipped = met.withColumn("inside", inside_cell(F.col(x), F.col(y))).drop(
        "_cx", "_cy", "_salt", "xmin", "ymin", "xmax", "ymax", "_edges", "_odd", "_turns")
    return clipped if keep_outside else clipped.where("inside")


# --- clipping tiles by scanline ---------------------------------------------

RUNS = "uuid string, band string, field_id string, px_row int, first_col int, last_col int, inside boolean"


def tile_field_pairs(tiles, fields, cell_size):
    """Tiles and fields whose boxes meet: uuid, band, the tile's grid, field_id, the field's box and _edges. Tile bytes are not read.

    Both sides cover grid cells; a pair is taken in the cell that holds the lower left corner of what they share, so it is met once.
    """
    grid = tiles.select("uuid", "band", "x0", "y0", "res", "width", "height").withColumns({
        "t_xmin": F.col("x0"), "t_xmax": F.col("x0") + F.col("width") * F.col("res"),
        "t_ymin": F.col("y0") - F.col("height") * F.col("res"), "t_ymax": F.col("y0")})
    shapes = fields.where("xmin IS NOT NULL").select("field_id", "xmin", "ymin", "xmax", "ymax", edges("rings").alias("_edges"))
    met = cover_cells(grid, cell_size, ("t_xmin", "t_ymin", "t_xmax", "t_ymax")).join(cover_cells(shapes, cell_size), ["_cx", "_cy"])
    met = met.where("xmin <= t_xmax AND t_xmin <= xmax AND ymin <= t_ymax AND t_ymin <= ymax")
    here = (F.col("_cx") == cell_number(F.greatest("xmin", "t_xmin"), cell_size)) & (
        F.col("_cy") == cell_number(F.greatest("ymin", "t_ymin"), cell_size))
    return met.where(here).select("uuid", "band", "x0", "y0", "res", "width", "height", "field_id", "xmin", "ymin", "xmax", "ymax", "_edges")


def scanline_runs(edge_list, x0, y0, res, width, height, box):
    """(row, first column, last column, inside) of the pixels whose centres lie in the box: runs of equal ``inside``, by the even-odd rule
    along each row's centre line."""
    xmin, ymin, xmax, ymax = box
    x = x0 + (np.arange(width) + 0.5) * res
    y = y0 - (np.arange(height) + 0.5) * res
    columns, found = np.flatnonzero((x >= xmin) & (x <= xmax)), []
    if not len(columns):
        return found
    x1, y1, x2, y2 = edge_list.T
    for row in np.flatnonzero((y >= ymin) & (y <= ymax)):
        on = (y1 <= y[row]) != (y2 <= y[row])
        at = np.sort(x1[on] + (y[row] - y1[on]) * (x2[on] - x1[on]) / (y2[on] - y1[on]))
        inside = (len(at) - np.searchsorted(at, x[columns], side="right")) % 2 == 1
        turns = np.flatnonzero(np.diff(inside)) + 1
        for lo, hi in zip(np.concatenate([[0], turns]), np.concatenate([turns, [len(columns)]])):
            found.append((int(row), int(columns[lo]), int(columns[hi - 1]), bool(inside[lo])))
    return found


def polygon_runs(pairs, keep_outside=True):
    """Runs of pixels of each pair of a tile and a field; pixels outside a field's box are in none."""

    def run(frames):
        for frame in frames:
            for row in frame.itertuples(index=False):
                lines = np.array([[e["x1"], e["y1"], e["x2"], e["y2"]] for e in row.edge_list], dtype=float).reshape(-1, 4)
                found = scanline_runs(lines, row.x0, row.y0, row.res, row.width, row.height, (row.xmin, row.ymin, row.xmax, row.ymax))
                made = pd.DataFrame([r for r in found if keep_outside or r[3]], columns=["px_row", "first_col", "last_col", "inside"])
                yield made.assign(uuid=row.uuid, band=row.band, field_id=row.field_id)[
                    ["uuid", "band", "field_id", "px_row", "first_col", "last_col", "inside"]]

    return pairs.withColumnRenamed("_edges", "edge_list").mapInPandas(run, RUNS)


def _sliced(batches):
    """Pixels of the runs that follow each tile, cut out of its bytes."""
    values, grid = None, None
    for batch in batches:
        rows = batch.to_pydict()
        parts = []
        for i, data in enumerate(rows["data"]):
            if data is not None:
                values = np.frombuffer(data, dtype=rows["dtype"][i]).reshape(rows["height"][i], rows["width"][i])
                grid = rows["x0"][i], rows["y0"][i], rows["res"][i]
                continue
            line, first, last = rows["px_row"][i], rows["first_col"][i], rows["last_col"][i]
            parts.append((rows["uuid"][i], rows["band"][i], rows["field_id"][i], line, first, rows["inside"][i],
                          values[line, first:last + 1].astype("float64"), *grid))
        if not parts:
            continue
        sizes = np.array([len(p[6]) for p in parts])
        spread = lambda k: np.repeat(np.array([p[k] for p in parts]), sizes)
        text = lambda k: pa.array([p[k] for p in parts], pa.string()).take(pa.array(np.repeat(np.arange(len(parts)), sizes)))
        line = spread(3)
        column = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + spread(4)
        yield pa.RecordBatch.from_arrays([
            text(0), text(1), pa.array(line, pa.int32()), pa.array(column, pa.int32()), pa.array(np.concatenate([p[6] for p in parts])),
            pa.array(spread(7) + (column + 0.5) * spread(9)), pa.array(spread(8) - (line + 0.5) * spread(9)), text(2), pa.array(spread(5))],
            names=["uuid", "band", "px_row", "px_col", "value", "x", "y", "field_id", "inside"])


def clip_tiles(tiles, fields, cell_size, keep_outside=True):
    """The rows of ``clip_pixels`` from raw tiles: uuid, band, px_row, px_col, value, x, y, field_id, inside.

    ``tiles``: uuid, band, dtype, data, height, width, x0, y0, res. A polygon becomes runs of pixels of a tile first, and only these are cut out of
    the tile's bytes: pixels outside every field's box are never rows. A tile is shuffled once, whatever the number of its fields.
    """
    runs = polygon_runs(tile_field_pairs(tiles, fields, cell_size), keep_outside)
    none = lambda **types: [F.lit(None).cast(t).alias(c) for c, t in types.items()]
    heads = tiles.join(runs.select("uuid", "band").distinct(), ["uuid", "band"], "left_semi").select(
        "uuid", "band", F.lit(0).alias("kind"), *none(field_id="string", px_row="int", first_col="int", last_col="int", inside="boolean"),
        "dtype", "data", F.col("height").cast("int"), F.col("width").cast("int"), *[F.col(c).cast("double") for c in ("x0", "y0", "res")])
    lines = runs.select("uuid", "band", F.lit(1).alias("kind"), "field_id", "px_row", "first_col", "last_col", "inside", *none(
        dtype="string", data="binary", height="int", width="int", x0="double", y0="double", res="double"))
    dealt = heads.unionByName(lines).repartition("uuid", "band").sortWithinPartitions("uuid", "band", "kind", "field_id", "px_row", "first_col")
    return dealt.mapInArrow(
        _sliced, "uuid string, band string, px_row int, px_col int, value double, x double, y double, field_id string, inside boolean")


def clip_all_fields(pixels, box, x="x", y="y"):
    """Pixels in one overall box: a plain filter, pushed to the scan."""
    xmin, ymin, xmax, ymax = box
    return pixels.where(F.col(x).between(xmin, xmax) & F.col(y).between(ymin, ymax))


def total_bounds(fields):
    """The box over all fields, as one row."""
    return fields.agg(
        F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"),
        F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"))


def pixel_index(tile_x0, tile_y0, res, x, y):
    """(row, col) of a map position in a grid whose outer upper left corner is (x0, y0)."""
    return (
        F.floor((F.col(tile_y0) - y) / F.col(res)).cast("int"),
        F.floor((x - F.col(tile_x0)) / F.col(res)).cast("int"),
    )


def pixel_at_point(points, pixels, tiles, fill=0, project=True):
    """Pixel values at points given as lon, lat.

    ``points``: point_id, field_id, lon, lat. ``tiles``: field_id, uuid, band, x0, y0, res, width,
    height. ``pixels``: field_id, uuid, band, px_row, px_col, value. A point off the crop gets ``fill``.
    """
    x, y = project_utm("lon", "lat") if project else (F.col("lon"), F.col("lat"))
    placed = points.withColumns({"_x": x, "_y": y}).join(tiles, "field_id")
    row, col = pixel_index("x0", "y0", "res", F.col("_x"), F.col("_y"))
    at = placed.select("point_id", "field_id", "uuid", "band", row.alias("px_row"), col.alias("px_col"))
    place = ["field_id", "uuid", "band", "px_row", "px_col"]
    # pixels meet the wanted places first, which are few and may be broadcast; the hits alone are joined back
    hits = pixels.select(*place, "value").join(at.select(*place).distinct(), place)
    return at.join(hits, place, "left").withColumn("value", F.coalesce("value", F.lit(fill)))


def pixel_series_at_point(points, pixels, tiles, clear, products, fill=0, project=True):
    """The same over the clear products of the field, in order of date."""
    wanted = tiles.join(clear.select("field_id", "uuid"), ["field_id", "uuid"], "left_semi")
    values = pixel_at_point(points, pixels, wanted, fill, project)
    return values.join(products.select("uuid", "generationdate"), "uuid").orderBy(
        "point_id", "band", "generationdate", "uuid")
