"""Joins, filters, spatial operators, set and reshape operators."""

from pyspark.sql import functions as F

from fieldlens.constants import ALL_BANDS, NON_ANALYSIS_BANDS, SCORE_COLUMNS, SUMMARY_BANDS
from fieldlens.functions.geometry import with_bbox
from fieldlens.functions.projection import project_utm
from fieldlens.operators import bandstats, clouds, spatial, stats, tables
from fieldlens.operators.band_search import item_subsets
from fieldlens.workload.cleaning import product_files_of, utm_cte
from fieldlens.workload.imagery import survey_of
from fieldlens.workload.registry import CLEAR, CORNERS, RATINGS, box_rings_of, query, rounded, survey_sql


# --- catalogue --------------------------------------------------------------

@query("search_catalogue", """
    SELECT uuid, generationdate, title, cloudcoverpercentage FROM fx_products
    WHERE xmin <= 76.9 AND xmax >= 76.8 AND ymin <= 15.2 AND ymax >= 15.12
      AND generationdate BETWEEN timestamp '1996-01-01' AND timestamp '2000-12-31'
      AND platformname = 'Sentinel-2' AND processinglevel = 'Level-2A' AND cloudcoverpercentage BETWEEN 0 AND 99
    ORDER BY generationdate, uuid""")
def _(t):
    found = tables.search_catalogue(t.products, (76.8, 15.12, 76.9, 15.2), "1996-01-01", "2000-12-31")
    return found.select("uuid", "generationdate", "title", "cloudcoverpercentage")


@query("order_by_date", "SELECT uuid, generationdate FROM fx_products ORDER BY generationdate, uuid")
def _(t):
    return tables.order_by_date(t.products.select("uuid", "generationdate"))


@query("granule_filter", """
    SELECT uuid, title FROM fx_products WHERE regexp_matches(title, '(?i)T43PFS|T43PGS')""")
def _(t):
    return tables.granule_filter(t.products.select("uuid", "title"))


@query("band_present", "SELECT uuid FROM fx_products WHERE cloudcoverpercentage < 60")
def _(t):
    return tables.band_present(tables.band_paths(product_files_of(t)), "B01_60m").select("uuid")


@query("usable_products", """
    SELECT uuid, title, concat('/root/', identifier, '.SAFE/GRANULE/L2A/IMG_DATA/R20m/T43_SCL_20m.jp2') AS SCL_20m,
           CASE WHEN cloudcoverpercentage < 60 THEN concat('/root/', identifier, '.SAFE/GRANULE/L2A/IMG_DATA/R60m/T43_B01_60m.jp2') END AS B01_60m
    FROM fx_products
    WHERE xmin <= 77 AND xmax >= 76 AND ymin <= 16 AND ymax >= 15 AND platformname = 'Sentinel-2' AND processinglevel = 'Level-2A'
      AND cloudcoverpercentage <= 99 AND regexp_matches(title, '(?i)T43PFS|T43PGS')
      AND generationdate BETWEEN timestamp '1990-01-01' AND timestamp '2030-01-01'""")
def _(t):
    from fieldlens.plans.catalogue import usable_products

    found = usable_products(t.products, product_files_of(t), (76.0, 15.0, 77.0, 16.0), "1990-01-01", "2030-01-01")
    return found.select("uuid", "title", "SCL_20m", "B01_60m")


@query("progress_counts", """
    SELECT count(*) AS available, count(*) FILTER (cloudcoverpercentage < 60) AS present,
           count(*) FILTER (cloudcoverpercentage >= 60) AS missing FROM fx_products""")
def _(t):
    present = t.products.where("cloudcoverpercentage < 60").select("identifier")
    return tables.progress_counts(t.products.select("identifier"), present)


# --- equi joins -------------------------------------------------------------

@query("attach_boundaries", """
    SELECT field_id, farm_name, CASE WHEN y0 < 15.2 THEN 5 END AS n_points FROM fx_fields""")
def _(t):
    shapes = t.shaped().where("y0 < 15.2")
    joined = tables.attach_boundaries(t.fields.select("field_id", "farm_name"), shapes)
    return joined.select("field_id", "farm_name", F.size(F.flatten("rings")).alias("n_points"))


@query("attach_soil", f"""
    WITH r AS ({RATINGS})
    SELECT f.field_id, f.farm_name, r.carbon_rating, r.nitrogen_rating, r.phosphorus_rating, r.potassium_rating
    FROM fx_fields f LEFT JOIN r ON r.field_id = f.field_id""")
def _(t):
    return tables.attach_soil(t.fields.select("field_id", "farm_name"), t.ratings)


@query("attach_soil_null_safe", """
    WITH f AS (SELECT field_id, CASE WHEN survey_date IS NOT NULL THEN field_id END AS k FROM fx_fields),
         s AS (SELECT CASE WHEN carbon_raw IS NOT NULL THEN field_id END AS k, nitrogen_raw FROM fx_soil)
    SELECT f.k AS field_id, s.nitrogen_raw FROM f LEFT JOIN s ON f.k IS NOT DISTINCT FROM s.k""")
def _(t):
    left = t.fields.select(F.when(F.col("survey_date").isNotNull(), F.col("field_id")).alias("field_id"))
    right = t.soil.select(F.when(F.col("carbon_raw").isNotNull(), F.col("field_id")).alias("field_id"), "nitrogen_raw")
    return tables.attach_soil(left, right, null_safe=True)


@query("duplicate_keys", """
    SELECT field_id, uuid, count(*) AS n_rows FROM fx_pixels GROUP BY field_id, uuid HAVING count(*) > 1""")
def _(t):
    return tables.duplicate_keys(t.pixels, ["field_id", "uuid"])


@query("not_yet_done", """
    SELECT uuid, title FROM fx_products WHERE uuid NOT IN (
        SELECT concat('P', cast(year(o_orderdate) * 100 + month(o_orderdate) AS string)) FROM orders WHERE o_totalprice > 495000)""")
def _(t):
    ledger = t.raw("orders").where("o_totalprice > 495000").select(F.concat(
        F.lit("P"), (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("string")).alias("uuid"))
    return tables.not_yet_done(t.products.select("uuid", "title"), ledger, ["uuid"])


@query("union_fields", """
    SELECT field_id, farm_name, survey_date, NULL AS field_boundary FROM fx_fields
    UNION ALL SELECT cast(c_custkey AS string), c_name, NULL, c_mktsegment FROM customer""")
def _(t):
    by_number = t.fields.select("field_id", "farm_name", "survey_date")
    by_id = t.raw("customer").select(
        F.col("c_custkey").alias("field_id"), F.col("c_name").alias("farm_name"), F.col("c_mktsegment").alias("field_boundary"))
    return tables.union_fields(by_number, by_id)


# --- filters ----------------------------------------------------------------

@query("tested_only", f"WITH r AS ({RATINGS}) SELECT * FROM r WHERE carbon_rating > 0")
def _(t):
    return tables.tested_only(t.ratings, "carbon_rating")


def frame_of(t, bands=None):
    """Analysis frame: surveyed fields with band means, indices and ratings."""
    bands = bands or ALL_BANDS
    survey = survey_of(t, bands)
    return tables.analysis_frame(tables.attach_soil(survey, t.ratings))


def frame_sql(bands):
    """CTEs ending in ``frame``."""
    return f"""{survey_sql(bands)}, r AS ({RATINGS}),
        frame AS (SELECT s.field_id, {', '.join('s.' + b for b in bands)},
                         (B08_10m - B04_10m) / nullif(B08_10m + B04_10m, 0) AS mean_ndvi,
                         (B03_20m - B8A_20m) / nullif(B03_20m + B8A_20m, 0) AS mean_ndwi,
                         r.carbon_rating, r.nitrogen_rating, r.potassium_rating, r.phosphorus_rating
                  FROM survey s LEFT JOIN r ON r.field_id = s.field_id WHERE s.B08_10m IS NOT NULL)"""


KEPT = [b for b in ALL_BANDS if b not in NON_ANALYSIS_BANDS]


@query("analysis_frame", f"""
    WITH {frame_sql(ALL_BANDS)}
    SELECT field_id, {', '.join(f'round({b}, 6) AS {b}' for b in KEPT)}, round(mean_ndvi, 6) AS mean_ndvi,
           round(mean_ndwi, 6) AS mean_ndwi, carbon_rating, nitrogen_rating, potassium_rating, phosphorus_rating FROM frame""")
def _(t):
    frame = frame_of(t).drop("survey_date", "nearest_product_uuid", "nearest_product_generationdate")
    return rounded(frame, 6, *KEPT, "mean_ndvi", "mean_ndwi")


# --- spatial ----------------------------------------------------------------

@query("contains_join", """
    SELECT f.field_id, p.uuid FROM fx_fields f JOIN fx_footprints p
      ON p.xmin <= f.x0 AND p.ymin <= f.y0 AND p.xmax >= f.x0 + 0.0024 AND p.ymax >= f.y0 + 0.0022""")
def _(t):
    footprints = box_rings_of(t.view("fx_footprints"))
    return spatial.contains_join(t.shaped(), footprints, cell_size=0.05, salts=2)


@query("field_product_grid", """
    SELECT f.field_id, p.uuid, b.band FROM fx_fields f JOIN fx_products p
      ON p.xmin <= f.x0 AND p.ymin <= f.y0 AND p.xmax >= f.x0 + 0.0024 AND p.ymax >= f.y0 + 0.0022,
      (VALUES ('TCI_20m'), ('SCL_20m'), ('TCI_10m'), ('SCL_60m')) b(band)""")
def _(t):
    return spatial.field_product_grid(t.shaped(), box_rings_of(t.products), SUMMARY_BANDS, cell_size=0.05, salts=2)


def _inside_sql():
    """Even-odd test on the four edges of a field."""
    ends = list(zip(CORNERS, CORNERS[1:] + CORNERS[:1]))
    crossings = []
    for (ax, ay), (bx, by) in ends:
        x1, y1, x2, y2 = f"(x0 + {ax!r})", f"(y0 + {ay!r})", f"(x0 + {bx!r})", f"(y0 + {by!r})"
        crossings.append(
            f"(CASE WHEN ({y1} <= y) <> ({y2} <= y) AND x < {x1} + (y - {y1}) * ({x2} - {x1}) / ({y2} - {y1}) THEN 1 ELSE 0 END)")
    return " + ".join(crossings)


@query("clip_pixels", f"""
    SELECT p.l_orderkey, p.l_linenumber, p.l_partkey, p.field_key, p.uuid, f.field_id, ({_inside_sql()}) % 2 = 1 AS inside
    FROM fx_pixels p JOIN (SELECT field_id, x0, y0 FROM fx_fields) f
      ON p.x >= f.x0 + 0.0 AND p.x <= f.x0 + 0.0024 AND p.y >= f.y0 + 0.0 AND p.y <= f.y0 + 0.0022""")
def _(t):
    scene = t.pixels.select("l_orderkey", "l_linenumber", "l_partkey", "field_key", "uuid", "x", "y")
    clipped = spatial.clip_pixels(scene, t.shaped(), cell_size=0.005, row_key=("l_orderkey", "l_linenumber"), salts=2)
    return clipped.drop("x", "y")


TILE_RES, TILE_ROWS, TILE_COLS = 0.00125, 7, 20


@query("clip_tiles", f"""
    WITH cell AS (SELECT l_orderkey % 50 AS tile, (l_linenumber - 1) % {TILE_ROWS} AS r, l_partkey % {TILE_COLS} AS c, max(l_partkey % 2000 + 100) AS v
                  FROM lineitem GROUP BY ALL),
         grid AS (SELECT tile, r, c FROM (SELECT DISTINCT tile FROM cell) t, range({TILE_ROWS}) r(r), range({TILE_COLS}) c(c)),
         px AS (SELECT g.tile, g.r, g.c, coalesce(v, 0)::double AS value,
                       (76.7E0 + (g.tile % 10) * 0.025E0) + (g.c + 0.5E0) * {TILE_RES}E0 AS x,
                       (15.104E0 + (g.tile // 10) * 0.03E0) - (g.r + 0.5E0) * {TILE_RES}E0 AS y
                FROM grid g LEFT JOIN cell USING (tile, r, c))
    SELECT concat('T', p.tile) AS uuid, f.field_id, p.r::int AS px_row, p.c::int AS px_col, p.value, ({_inside_sql()}) % 2 = 1 AS inside
    FROM px p JOIN (SELECT field_id, x0, y0 FROM fx_fields) f
      ON p.x >= f.x0 + 0.0 AND p.x <= f.x0 + 0.0024 AND p.y >= f.y0 + 0.0 AND p.y <= f.y0 + 0.0022""")
def _(t):
    place = ((F.col("l_linenumber") - 1) % TILE_ROWS * TILE_COLS + F.col("l_partkey") % TILE_COLS).cast("int")
    cells = t.raw("lineitem").groupBy((F.col("l_orderkey") % 50).alias("tile"), place.alias("place")).agg(F.max(F.col("l_partkey") % 2000 + 100).alias("v"))
    held = cells.groupBy("tile").agg(F.map_from_entries(F.collect_list(F.struct("place", "v"))).alias("m"))
    samples = F.transform(F.sequence(F.lit(0), F.lit(TILE_ROWS * TILE_COLS - 1)), lambda i: F.lpad(F.hex(F.coalesce(F.try_element_at(F.col("m"), i), F.lit(0))), 4, "0"))
    tiles = held.select(
        F.concat(F.lit("T"), "tile").alias("uuid"), F.lit("B04_10m").alias("band"), F.lit(">u2").alias("dtype"),
        F.unhex(F.array_join(samples, "")).alias("data"), F.lit(TILE_ROWS).alias("height"), F.lit(TILE_COLS).alias("width"),
        (F.lit(76.7) + F.col("tile") % 10 * F.lit(0.025)).alias("x0"), (F.lit(15.104) + F.floor(F.col("tile") / 10) * F.lit(0.03)).alias("y0"), F.lit(TILE_RES).alias("res"))
    clipped = spatial.clip_tiles(tiles, t.shaped(), cell_size=0.01)
    return clipped.select("uuid", "field_id", "px_row", "px_col", "value", "inside")


SHAPE = [[(0.0, 0.0), (0.06, 0.0), (0.06, 0.05), (0.036, 0.05), (0.036, 0.014), (0.024, 0.014), (0.024, 0.05), (0.0, 0.05)],
         [(0.004, 0.004), (0.014, 0.004), (0.014, 0.012), (0.004, 0.012)]]


@query("contains_join_shapes", """
    SELECT f.field_id, p.uuid
    FROM (SELECT field_id, x0, y0, x0 + 0.0024 AS x1, y0 + 0.0022 AS y1 FROM fx_fields) f JOIN fx_footprints p
      ON p.xmin <= f.x0 AND p.ymin <= f.y0 AND p.xmin + 0.06 >= f.x1 AND p.ymin + 0.05 >= f.y1
     AND NOT (f.x1 > p.xmin + 0.024 AND f.x0 < p.xmin + 0.036 AND f.y1 > p.ymin + 0.014)
     AND NOT (f.x1 > p.xmin + 0.004 AND f.x0 < p.xmin + 0.014 AND f.y1 > p.ymin + 0.004 AND f.y0 < p.ymin + 0.012)""")
def _(t):
    """Boxes of fields within footprints that have a hole and a notch."""
    ring = lambda points: F.array(*[F.struct((F.col("xmin") + F.lit(dx)).alias("x"), (F.col("ymin") + F.lit(dy)).alias("y")) for dx, dy in points + points[:1]])
    footprints = t.view("fx_footprints").select("uuid", F.array(F.array(*[ring(points) for points in SHAPE])).alias("polygons"))
    footprints = with_bbox(footprints.withColumn("rings", F.flatten("polygons")))
    return spatial.contains_join(box_rings_of(t.shaped().drop("rings")), footprints, cell_size=0.05, salts=2)


@query("clip_all_fields", """
    SELECT uuid, count(*) AS n_pixels, sum(B04_10m)::bigint AS total FROM fx_pixels
    WHERE x BETWEEN 76.7 AND 76.9 AND y BETWEEN 15.1 AND 15.25 GROUP BY uuid""")
def _(t):
    clipped = spatial.clip_all_fields(t.pixels, (76.7, 15.1, 76.9, 15.25))
    return clipped.groupBy("uuid").agg(F.count(F.lit(1)).alias("n_pixels"), F.sum("B04_10m").alias("total"))


POINT_LON = "x0 + 0.00004E0 + (field_key % 10) * 0.00009E0"
POINT_LAT = "y0 - 0.00004E0 - (field_key % 7) * 0.00009E0"
PIXEL_GRID = """grid AS (SELECT field_id, uuid, px_row, px_col, max(B04_10m) AS value FROM fx_pixels GROUP BY ALL)"""


def point_sql():
    corner = utm_cte("fx_fields", "x0", "y0", "field_id, field_key, x0, y0")
    point = utm_cte("fx_fields", f"({POINT_LON})", f"({POINT_LAT})", "field_id").replace("u0 AS", "v0 AS").replace(
        "FROM u0", "FROM v0").replace("utm AS", "pt AS")
    return f"""{corner}, {point}, {PIXEL_GRID},
        spot AS (SELECT u.field_id, cast(floor((u.northing - p.northing) / 10) AS int) AS px_row,
                      cast(floor((p.easting - u.easting) / 10) AS int) AS px_col
               FROM utm u JOIN pt p ON p.field_id = u.field_id)"""


def point_inputs(t):
    grid = t.pixels.groupBy("field_id", "uuid", "px_row", "px_col").agg(F.max("B04_10m").alias("value")).withColumn(
        "band", F.lit("B04_10m"))
    x, y = project_utm("x0", "y0")
    corners = t.fields.select("field_id", x.alias("x0"), y.alias("y0"), F.lit(10.0).alias("res"))
    tiles = t.pixels.select("field_id", "uuid").distinct().join(corners, "field_id").withColumn("band", F.lit("B04_10m"))
    points = t.fields.select(
        F.col("field_id").alias("point_id"), "field_id", F.expr(POINT_LON).alias("lon"), F.expr(POINT_LAT).alias("lat"))
    return points, grid, tiles


@query("pixel_at_point", f"""
    WITH {point_sql()}
    SELECT a.field_id AS point_id, a.field_id, t.uuid, 'B04_10m' AS band, a.px_row, a.px_col, coalesce(g.value, 0) AS value
    FROM spot a JOIN (SELECT DISTINCT field_id, uuid FROM fx_pixels) t ON t.field_id = a.field_id
    LEFT JOIN grid g ON g.field_id = a.field_id AND g.uuid = t.uuid AND g.px_row = a.px_row AND g.px_col = a.px_col""")
def _(t):
    points, grid, tiles = point_inputs(t)
    return spatial.pixel_at_point(points, grid, tiles)


@query("pixel_series_at_point", f"""
    WITH {point_sql()}, clear AS ({CLEAR})
    SELECT a.field_id AS point_id, a.field_id, t.uuid, p.generationdate, coalesce(g.value, 0) AS value
    FROM spot a JOIN clear t ON t.field_id = a.field_id JOIN fx_products p ON p.uuid = t.uuid
    LEFT JOIN grid g ON g.field_id = a.field_id AND g.uuid = t.uuid AND g.px_row = a.px_row AND g.px_col = a.px_col
    ORDER BY 1, 4, 3""")
def _(t):
    points, grid, tiles = point_inputs(t)
    series = spatial.pixel_series_at_point(points, grid, tiles, clouds.clear_pairs(t.pixels), t.products)
    return series.select("point_id", "field_id", "uuid", "generationdate", "value")


PIXEL_KEYS = ("field_id", "uuid", "l_orderkey", "l_linenumber", "l_partkey")


@query("stack_bands", f"""
    SELECT {', '.join(PIXEL_KEYS)}, max(B02_10m) AS B02_10m, max(B03_10m) AS B03_10m, max(B04_10m) AS B04_10m, max(B08_10m) AS B08_10m
    FROM fx_pixels GROUP BY ALL""")
def _(t):
    bands = ("B02_10m", "B03_10m", "B04_10m", "B08_10m")
    long = bandstats.wide_to_long(t.pixels, PIXEL_KEYS, bands + ("TCI_10m",))
    return bandstats.stack_bands(long, bands, PIXEL_KEYS)


@query("rgb_composite", f"""
    SELECT {', '.join(PIXEL_KEYS)}, max(B04_10m) AS red, max(B03_10m) AS green, max(B02_10m) AS blue
    FROM fx_pixels GROUP BY ALL""")
def _(t):
    long = bandstats.wide_to_long(t.pixels, PIXEL_KEYS, ("B02_10m", "B03_10m", "B04_10m"))
    return bandstats.rgb_composite(long, PIXEL_KEYS)


# --- reshape ----------------------------------------------------------------

@query("transpose_scores", " UNION ALL ".join(
    f"SELECT target, bands, '{c}' AS score_kind, round({c}, 6) AS score FROM fx_scores" for c in SCORE_COLUMNS))
def _(t):
    long = tables.unpivot_columns(t.view("fx_scores"), ["target", "bands"], SCORE_COLUMNS, "score_kind", "score")
    return rounded(long, 6, "score")


@query("unstack_matrix", " UNION ALL ".join(
    f"SELECT n_name AS row_name, '{c}' AS col_name, round(cast({e} AS double), 6) AS value FROM nation"
    for c, e in (("key", "n_nationkey"), ("region", "n_regionkey"), ("ratio", "n_nationkey / (n_regionkey + 1.0E0)"))))
def _(t):
    matrix = t.raw("nation").select(
        F.col("n_name").alias("row_name"), F.col("n_nationkey").cast("double").alias("key"),
        F.col("n_regionkey").cast("double").alias("region"), (F.col("n_nationkey") / (F.col("n_regionkey") + 1.0)).alias("ratio"))
    return rounded(tables.unpivot_columns(matrix, ["row_name"], ["key", "region", "ratio"], "col_name", "value"), 6, "value")


@query("row_mean", """
    SELECT target, bands, round((coalesce(scores_stratified_KFold, 0) + coalesce(scores_cross_val, 0) + coalesce(accuracy_score, 0))
           / (3 - (accuracy_score IS NULL)::int), 6) AS mean FROM fx_scores""")
def _(t):
    scored = t.view("fx_scores").withColumn("mean", stats.row_mean(SCORE_COLUMNS))
    return rounded(scored.select("target", "bands", "mean"), 6, "mean")


@query("top_band_sets", """
    WITH m AS (SELECT target, bands, (coalesce(scores_stratified_KFold, 0) + coalesce(scores_cross_val, 0) + coalesce(accuracy_score, 0))
                      / (3 - (accuracy_score IS NULL)::int) AS mean FROM fx_scores),
         r AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY mean DESC, bands) AS place FROM m)
    SELECT target, bands, round(mean, 6) AS mean, place FROM r WHERE place <= 10""")
def _(t):
    best = stats.top_band_sets(t.view("fx_scores"), SCORE_COLUMNS)
    return rounded(best.select("target", "bands", "mean", "place"), 6, "mean")


@query("band_subsets", """
    WITH items AS (SELECT 1 AS kind, r_name AS name FROM region UNION SELECT 2, o_orderpriority FROM orders
                   UNION SELECT 3, l_linestatus FROM lineitem),
         names AS (SELECT name, row_number() OVER (ORDER BY kind, name) - 1 AS bit FROM items),
         ids AS (SELECT unnest(generate_series(1, (1 << (SELECT count(*) FROM names)) - 1)) AS subset_id)
    SELECT subset_id, string_agg(name, ' ' ORDER BY bit) AS bands, cast(count(*) AS int) AS n_bands
    FROM ids JOIN names ON (subset_id >> bit) & 1 = 1 GROUP BY subset_id""")
def _(t):
    parts = ((1, "region", "r_name"), (2, "orders", "o_orderpriority"), (3, "lineitem", "l_linestatus"))
    items = [t.raw(table).select(F.lit(kind).alias("kind"), F.col(column).alias("name")).distinct() for kind, table, column in parts]
    return item_subsets(items[0].unionByName(items[1]).unionByName(items[2]), "name", ["kind", "name"])
