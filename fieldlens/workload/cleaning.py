"""Scalar cleaning functions, boundaries and projections."""

from pyspark.sql import functions as F

from fieldlens.constants import ALL_BANDS, NON_ANALYSIS_BANDS, resolution
from fieldlens.constants import (
    CENTRAL_MERIDIAN, FALSE_EASTING, SCALE_FACTOR,
)
from fieldlens.functions import geometry
from fieldlens.functions.dates import date_label, parse_date
from fieldlens.functions.projection import ALPHA, BETA, DELTA, ECCENTRICITY, RADIUS, project_utm, unproject_utm
from fieldlens.functions.text import canonical_field_id, list_to_text, rating_to_int, text_to_list
from fieldlens.operators import clouds, tables
from fieldlens.workload.registry import CLEAR, query, rounded

SHEET_HEADERS = {
    "field_id": " Field IDs ",
    "carbon_raw": "O.C. (1 = low;  2 = med; 3 = high)",
    "nitrogen_raw": "N(1 = Low; 2 = Med; 3 = High) ",
}


@query("sanitize_headers", """
    SELECT field_id AS "field_ids", carbon_raw AS "o.c._(1_=_low;__2_=_med;_3_=_high)",
           nitrogen_raw AS "n(1_=_low;_2_=_med;_3_=_high)" FROM fx_soil""")
def _(t):
    sheet = t.soil.select(*[F.col(c).alias(h) for c, h in SHEET_HEADERS.items()])
    return tables.sanitize_headers(sheet)


@query("rename_columns", "SELECT field_id, farm_name, survey_date AS date_of_survey FROM fx_fields")
def _(t):
    sheet = t.fields.select(
        F.col("field_id").alias("Sl.No"), F.col("farm_name").alias("Farmer name"), F.col("survey_date").alias("date_of_survey"))
    from fieldlens.constants import GNUM_RENAMES

    return tables.rename_columns(sheet, GNUM_RENAMES)


@query("canonical_field_id", r"""
    WITH ids AS (SELECT c_custkey, concat(substr(c_mktsegment, 1, 2), cast(c_custkey AS string), 'x') AS file_id FROM customer
                 UNION ALL SELECT s_suppkey, concat(cast(s_suppkey AS string), 'g') FROM supplier),
         d AS (SELECT c_custkey, file_id, regexp_extract(file_id, '^[A-Za-z]+([0-9]+)', 1) AS digits FROM ids)
    SELECT c_custkey, file_id, CASE WHEN digits <> '' THEN
           concat('G', CASE WHEN length(digits) < 3 THEN lpad(digits, 3, '0') ELSE digits END) END AS field_id FROM d""")
def _(t):
    ids = t.raw("customer").select("c_custkey", F.concat(
        F.substring("c_mktsegment", 1, 2), F.col("c_custkey").cast("string"), F.lit("x")).alias("file_id"))
    reversed_ids = t.raw("supplier").select(
        F.col("s_suppkey").alias("c_custkey"), F.concat(F.col("s_suppkey").cast("string"), F.lit("g")).alias("file_id"))
    return ids.unionByName(reversed_ids).withColumn("field_id", canonical_field_id(F.col("file_id")))


@query("rating_to_int", """
    SELECT field_id, cast(trunc(coalesce(carbon_raw + 0.9, 0)) AS bigint) AS carbon_rating FROM fx_soil""")
def _(t):
    return t.soil.select("field_id", rating_to_int(F.col("carbon_raw") + 0.9).alias("carbon_rating"))


@query("parse_dates", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'unknown' ELSE strftime(o_orderdate, '%d/%m/%Y') END AS gen_date,
           CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS generationdate FROM orders""")
def _(t):
    text = F.when(F.col("o_orderstatus") == "P", "unknown").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    raw = t.raw("orders").select("o_orderkey", text.alias("gen_date"))
    return raw.withColumn("generationdate", parse_date("gen_date", "dd/MM/yyyy"))


@query("date_label", """
    SELECT o_orderkey, concat(day(o_orderdate), '/', month(o_orderdate), '/', year(o_orderdate)) AS day FROM orders""")
def _(t):
    return t.raw("orders").select("o_orderkey", date_label("o_orderdate").alias("day"))


@query("drop_columns", "SELECT field_id, uuid, " + ", ".join(
    f"max({b}) AS {b}" for b in ALL_BANDS if b not in NON_ANALYSIS_BANDS) + " FROM fx_pixels GROUP BY field_id, uuid")
def _(t):
    # the dropped bands never reach the aggregate: Spark prunes their columns and sums
    wide = t.pixels.groupBy("field_id", "uuid").agg(*[F.max(b).alias(b) for b in ALL_BANDS])
    return tables.drop_columns(wide, NON_ANALYSIS_BANDS)


@query("list_to_text", f"""
    WITH clear AS ({CLEAR})
    SELECT field_id, string_agg(uuid, ' ' ORDER BY uuid) AS products, count(*) AS n_back FROM clear GROUP BY field_id
    UNION ALL SELECT field_id, '' AS products, 0 AS n_back FROM fx_fields WHERE field_id NOT IN (SELECT field_id FROM clear)""")
def _(t):
    lists = clouds.clear_pairs(t.pixels).groupBy("field_id").agg(F.array_sort(F.collect_list("uuid")).alias("l"))
    every = t.fields.select("field_id").join(lists, "field_id", "left").withColumn(
        "l", F.coalesce("l", F.array().cast("array<string>")))
    text = every.select("field_id", list_to_text("l").alias("products"))
    return text.withColumn("n_back", F.size(text_to_list("products")).cast("bigint"))


@query("band_paths", "SELECT uuid, " + ", ".join(
    f"concat('/root/', identifier, '.SAFE/GRANULE/L2A/IMG_DATA/R', '{resolution(b)}m/T43_{b}.jp2') AS {b}"
    if b != "B01_60m" else
    "CASE WHEN cloudcoverpercentage < 60 THEN concat('/root/', identifier, '.SAFE/GRANULE/L2A/IMG_DATA/R60m/T43_B01_60m.jp2') END AS B01_60m"
    for b in ALL_BANDS) + " FROM fx_products")
def _(t):
    return tables.band_paths(product_files_of(t))


def product_files_of(t, bands=ALL_BANDS):
    """Raster listing of every product; cloudier products lack the coastal band."""
    names = F.explode(F.array(*[F.struct(F.lit(b).alias("band"), F.lit(f"R{resolution(b)}m").alias("folder")) for b in bands]))
    files = t.products.select("uuid", "identifier", "cloudcoverpercentage", names.alias("b")).where(
        (F.col("b.band") != "B01_60m") | (F.col("cloudcoverpercentage") < 60))
    return files.select("uuid", F.concat(
        F.lit("/root/"), "identifier", F.lit(".SAFE/GRANULE/L2A/IMG_DATA/"), "b.folder", F.lit("/T43_"), "b.band", F.lit(".jp2")).alias("path"))


# --- geometry ---------------------------------------------------------------

def geometry_text():
    """GeoJSON text of a field: with height and a hole for some, as two parts for others, broken for a few."""
    x, y = F.col("x0"), F.col("y0")
    point = lambda dx, dy, z: F.concat(
        F.lit("["), (x + F.lit(dx)).cast("string"), F.lit(","), (y + F.lit(dy)).cast("string"), F.lit(",0]" if z else "]"))
    ring = lambda scale, z: F.concat(F.lit("["), F.concat_ws(
        ",", *[point(dx * scale, dy * scale, z) for dx, dy in ((0, 0), (.002, .0004), (.0024, .0022), (.0002, .0018), (0, 0))]), F.lit("]"))
    key = F.col("field_key") % 5
    polygon = lambda rings: F.concat(F.lit('{"type":"Polygon","coordinates":['), rings, F.lit("]}"))
    return (
        F.when(key == 0, polygon(F.concat(ring(1.0, True), F.lit(","), ring(0.5, True))))
        .when(key == 1, polygon(F.concat(ring(1.0, False), F.lit(","), ring(0.5, False))))
        .when(key == 2, F.concat(F.lit('{"type":"MultiPolygon","coordinates":[['), ring(1.0, False), F.lit("],["), ring(0.5, False), F.lit("]]}")))
        .when(key == 3, F.lit('{"type":"Polygon","coordinates":[[[76.7'))
        .otherwise(F.lit('{"type":"Point","coordinates":[76.7,15.1]}'))
    )


@query("parse_geometry", """
    SELECT field_id, CASE field_key % 5 WHEN 0 THEN 'Polygon' WHEN 1 THEN 'Polygon' WHEN 2 THEN 'MultiPolygon' END AS kind,
           CASE field_key % 5 WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 2 END AS n_parts,
           CASE field_key % 5 WHEN 0 THEN 10 WHEN 1 THEN 10 WHEN 2 THEN 10 END AS n_points FROM fx_fields""")
def _(t):
    parsed = t.fields.select("field_id", geometry.parse_geometry(geometry_text()).alias("g"))
    return parsed.select(
        "field_id", F.col("g.kind").alias("kind"), F.size("g.parts").alias("n_parts"),
        F.size(F.flatten(F.flatten("g.parts"))).alias("n_points"))


@query("force_2d", """
    SELECT field_id, CASE field_key % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 2 END AS n_rings,
           CASE WHEN field_key % 5 < 3 THEN round(x0 + 0.0024, 9) END AS xmax,
           CASE WHEN field_key % 5 < 3 THEN round(y0, 9) END AS ymin FROM fx_fields""")
def _(t):
    parsed = t.fields.select("field_id", geometry.parse_geometry(geometry_text()).alias("g"))
    flat = parsed.select("field_id", geometry.force_2d("g.parts").alias("rings"))
    boxed = geometry.with_bbox(flat)
    return rounded(boxed.select("field_id", F.size("rings").alias("n_rings"), "xmax", "ymin"), 9, "xmax", "ymin")


@query("total_bounds", """
    SELECT round(min(x0), 9) AS xmin, round(min(y0), 9) AS ymin, round(max(x0 + 0.0024), 9) AS xmax,
           round(max(y0 + 0.0022), 9) AS ymax FROM fx_fields""")
def _(t):
    from fieldlens.operators.spatial import total_bounds

    return rounded(total_bounds(t.shaped()), 9, "xmin", "ymin", "xmax", "ymax")


@query("bounds_wkt", """
    WITH b AS (SELECT round(min(x0), 6) AS x1, round(min(y0), 6) AS y1, round(max(x0 + 0.0024), 6) AS x2,
                      round(max(y0 + 0.0022), 6) AS y2 FROM fx_fields)
    SELECT concat('POLYGON ((', x2, ' ', y1, ', ', x2, ' ', y2, ', ', x1, ' ', y2, ', ', x1, ' ', y1, ', ', x2, ' ', y1, '))') AS wkt FROM b""")
def _(t):
    from fieldlens.operators.spatial import total_bounds

    box = rounded(total_bounds(t.shaped()), 6, "xmin", "ymin", "xmax", "ymax")
    return box.select(geometry.rings_to_wkt(geometry.box_rings("xmin", "ymin", "xmax", "ymax")).alias("wkt"))


def project_sql(lon, lat):
    """(easting, northing) SQL of the same series, written with complex-free recurrences."""
    lam = f"(radians({lon}) - radians({CENTRAL_MERIDIAN}))"
    sphi = f"sin(radians({lat}))"
    conf = f"sinh(atanh({sphi}) - {ECCENTRICITY!r} * atanh({ECCENTRICITY!r} * {sphi}))"
    xi0 = f"atan2({conf}, cos({lam}))"
    eta0 = f"asinh(sin({lam}) / sqrt(pow({conf}, 2) + pow(cos({lam}), 2)))"
    return xi0, eta0


def series_sql(first, second, coefficients, sign):
    xi = first + "".join(f" {sign} {c!r} * sin({2 * j} * {first}) * cosh({2 * j} * {second})" for j, c in enumerate(coefficients, 1))
    eta = second + "".join(f" {sign} {c!r} * cos({2 * j} * {first}) * sinh({2 * j} * {second})" for j, c in enumerate(coefficients, 1))
    return xi, eta


def utm_cte(source, lon, lat, columns):
    """CTE chain ``u0`` -> ``utm`` with columns easting and northing."""
    xi0, eta0 = project_sql(lon, lat)
    xi, eta = series_sql("xi0", "eta0", ALPHA, "+")
    scale = SCALE_FACTOR * RADIUS
    return f"""u0 AS (SELECT {columns}, {xi0} AS xi0, {eta0} AS eta0 FROM {source}),
        utm AS (SELECT *, {scale!r} * ({eta}) + {FALSE_EASTING} AS easting, {scale!r} * ({xi}) AS northing FROM u0)"""


@query("project_utm", f"""
    WITH {utm_cte('fx_pixels', 'x', 'y', 'l_orderkey, l_linenumber, l_partkey, field_key')}
    SELECT l_orderkey, l_linenumber, l_partkey, field_key, round(easting, 2) AS easting, round(northing, 2) AS northing FROM utm""")
def _(t):
    e, n = project_utm("x", "y")
    return t.pixels.select(
        "l_orderkey", "l_linenumber", "l_partkey", "field_key", F.round(e, 2).alias("easting"), F.round(n, 2).alias("northing"))


def _unproject_sql():
    scale = SCALE_FACTOR * RADIUS
    xi, eta = series_sql("xi", "eta", BETA, "-")
    phi = "chi" + "".join(f" + {d!r} * sin({2 * j} * chi)" for j, d in enumerate(DELTA, 1))
    return f"""
    WITH p AS (SELECT o_orderkey, 400000 + o_totalprice AS e, 1000000 + o_custkey * 100.0E0 AS n FROM orders),
         a AS (SELECT *, n / {scale!r} AS xi, (e - {FALSE_EASTING}) / {scale!r} AS eta FROM p),
         b AS (SELECT *, {xi} AS xi1, {eta} AS eta1 FROM a),
         c AS (SELECT *, asin(sin(xi1) / cosh(eta1)) AS chi FROM b)
    SELECT o_orderkey, round(degrees(atan2(sinh(eta1), cos(xi1))) + {CENTRAL_MERIDIAN}, 7) AS lon,
           round(degrees({phi}), 7) AS lat FROM c"""


@query("unproject_utm", _unproject_sql())
def _(t):
    lon, lat = unproject_utm(F.lit(400000) + F.col("o_totalprice"), F.lit(1000000) + F.col("o_custkey") * 100.0)
    return t.raw("orders").select("o_orderkey", F.round(lon, 7).alias("lon"), F.round(lat, 7).alias("lat"))
