"""Registry of queries and their SQL, and the shared views both sides start from.

A view is one SELECT that Spark and DuckDB both run. Placeholders: ``{ts}`` is the timestamp
type without zone, ``{e1}`` ... the n-th entry of the embedding, ``{table}`` a driver table.
"""

import re

from pyspark.sql import functions as F

from fieldlens.constants import ALL_BANDS
from fieldlens.session import METHOD_LIMIT

QUERIES = {}
ORACLES = {}

SOURCES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
           "embeddings", "pages", "benchmark", "labels", "conversations")


def field_id_sql(key):
    text = f"cast({key} AS string)"
    return f"concat('G', lpad({text}, cast(greatest(3, length({text})) AS int), '0'))"


def _band_sql(i, band):
    given = {
        "B02_10m": "floor(l_extendedprice / 20)",
        "B03_10m": "floor(l_quantity * 40) + l_linenumber * 10",
        "B04_10m": "l_partkey % 2000 + 100",
        "B08_10m": "floor(l_quantity * 100) + l_partkey % 500",
        "B8A_20m": "floor(l_quantity * 90) + l_partkey % 300",
        "B03_20m": "floor(l_quantity * 38) + l_partkey % 400",
        "SCL_20m": "l_partkey % 40",
        "SCL_60m": "l_partkey % 12",
        "TCI_10m": "l_partkey % 256",
        "TCI_20m": "l_orderkey % 256",
    }
    rule = f"floor(l_extendedprice / {15 + i}) + floor(l_quantity * {3 * i}) + l_partkey % {150 + 11 * i}"
    return f"cast({given.get(band, rule)} AS int) AS {band}"


VIEWS = {
    "fx_fields": f"""
        SELECT s_suppkey AS field_key, {field_id_sql('s_suppkey')} AS field_id, s_name AS farm_name,
               CASE WHEN s_suppkey % 10 = 7 THEN NULL
                    ELSE cast(cast('1996-01-01' AS date) + cast((s_suppkey * 37) % 1800 AS int) AS {{ts}}) END AS survey_date,
               76.7E0 + (s_suppkey % 25) * 0.01E0 AS x0,
               15.1E0 + (s_suppkey % 7) * 0.03E0 AS y0
        FROM {{supplier}}""",
    # suppliers in debt stand for fields whose samples never reached the laboratory
    "fx_soil": f"""
        SELECT {field_id_sql('s_suppkey')} AS field_id,
               CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE cast(s_suppkey % 4 AS double) END AS carbon_raw,
               cast((s_suppkey * 7) % 4 AS double) AS nitrogen_raw,
               cast((s_suppkey * 3) % 6 AS double) AS phosphorus_raw,
               cast((s_suppkey * 11) % 4 AS double) AS potassium_raw
        FROM {{supplier}} WHERE s_acctbal >= 0""",
    "fx_pixels": f"""
        SELECT l_suppkey AS field_key, {field_id_sql('l_suppkey')} AS field_id,
               concat('P', cast(year(l_shipdate) * 100 + month(l_shipdate) AS string)) AS uuid,
               l_orderkey, l_linenumber, l_partkey,
               l_linenumber AS px_row, cast(l_partkey % 10 AS int) AS px_col,
               76.7E0 + (l_partkey % 2500) * 0.0001E0 AS x,
               15.1E0 + (l_orderkey % 1900) * 0.0001E0 AS y,
               {', '.join(_band_sql(i, b) for i, b in enumerate(ALL_BANDS))}
        FROM {{lineitem}}""",
    "fx_products": """
        SELECT concat('P', cast(ym AS string)) AS uuid, cast(acq AS {ts}) AS generationdate,
               concat('S', cast(ym AS string)) AS identifier,
               CASE WHEN ym % 3 = 0 THEN 'L2A_T43PFT_X' WHEN ym % 3 = 1 THEN 'L2A_t43pfs_X' ELSE 'L2A_T43PGS_X' END AS title,
               n % 101 AS cloudcoverpercentage,
               CASE WHEN n % 5 = 0 THEN 'Sentinel-1' ELSE 'Sentinel-2' END AS platformname,
               CASE WHEN n % 7 = 0 THEN 'Level-1C' ELSE 'Level-2A' END AS processinglevel,
               76.69E0 + (ym % 5) * 0.055E0 AS xmin, 15.09E0 + (ym % 3) * 0.075E0 AS ymin,
               76.69E0 + (ym % 5) * 0.055E0 + 0.11E0 AS xmax, 15.09E0 + (ym % 3) * 0.075E0 + 0.12E0 AS ymax
        FROM (SELECT year(l_shipdate) * 100 + month(l_shipdate) AS ym,
                     make_date(year(l_shipdate), month(l_shipdate), 1) AS acq, count(*) AS n
              FROM {lineitem} GROUP BY 1, 2) t""",
    "fx_footprints": """
        SELECT n_name AS uuid,
               76.69E0 + (n_nationkey % 5) * 0.055E0 AS xmin, 15.09E0 + floor(n_nationkey / 5) * 0.045E0 AS ymin,
               76.69E0 + (n_nationkey % 5) * 0.055E0 + 0.06E0 AS xmax,
               15.09E0 + floor(n_nationkey / 5) * 0.045E0 + 0.05E0 AS ymax
        FROM {nation}""",
    "fx_samples": f"""
        SELECT vec_id, label, {', '.join(f'cast({{e{i}}} AS double) AS f{i}' for i in range(1, 13))}
        FROM {{embeddings}}""",
    "fx_margin": """
        SELECT c_custkey AS vec_id, cast(c_nationkey % 3 + 1 AS int) AS label,
               CASE c_nationkey % 3 WHEN 0 THEN 10.0E0 WHEN 1 THEN 0.0E0 ELSE -10.0E0 END + (c_custkey * 37 % 101) / 100.0E0 AS m1,
               CASE c_nationkey % 3 WHEN 0 THEN 0.0E0 WHEN 1 THEN 10.0E0 ELSE -10.0E0 END + (c_custkey * 53 % 103) / 100.0E0 AS m2,
               (c_custkey * 71 % 97) / 100.0E0 AS m3, (c_custkey * 29 % 89) / 100.0E0 AS m4
        FROM {customer}""",
    "fx_scores": """
        SELECT p_type AS target, concat(p_name, ' ', cast(p_partkey AS string)) AS bands,
               ((p_partkey * 37) % 1000) / 1000.0E0 AS scores_stratified_KFold,
               ((p_partkey * 91) % 777) / 777.0E0 AS scores_cross_val,
               CASE WHEN p_size = 1 THEN NULL ELSE p_size / 50.0E0 END AS accuracy_score
        FROM {part}""",
    "fx_predictions": """
        SELECT l_linenumber AS label, cast(l_partkey % 7 + 1 AS int) AS prediction FROM {lineitem}""",
}

CORNERS = ((0.0, 0.0), (0.002, 0.0004), (0.0024, 0.0022), (0.0002, 0.0018))


def _fill(template, ts, entry, table):
    text = template.replace("{ts}", ts)
    text = re.sub(r"\{e(\d+)\}", lambda m: entry(int(m.group(1))), text)
    return re.sub(r"\{(\w+)\}", lambda m: table(m.group(1)), text)


def oracle_view(name):
    return _fill(VIEWS[name], "timestamp", lambda i: f"embedding[{i}]", lambda t: t)


def with_views(sql):
    """The SQL with the views it mentions as WITH entries."""
    used = [name for name in VIEWS if re.search(rf"\b{name}\b", sql)]
    entries = [f"{name} AS ({oracle_view(name)})" for name in used]
    body = sql.strip()
    if not entries:
        return body
    for opening in ("WITH RECURSIVE ", "WITH "):
        if body.upper().startswith(opening):
            return f"{opening}{', '.join(entries)}, {body[len(opening):]}"
    return f"WITH {', '.join(entries)} {body}"


def query(name, sql=None):
    def add(fn):
        def run(spark, sf_dir):
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            spark.conf.set(*METHOD_LIMIT)
            return fn(Tables(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn

    return add


class Tables:
    """The driver tables of one folder and the views over them."""

    def __init__(self, spark, sf_dir):
        self.spark = spark
        self.sf_dir = sf_dir

    def raw(self, name):
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def view(self, name):
        used = sorted(set(re.findall(r"\{(\w+)\}", VIEWS[name])) & set(SOURCES))
        text = _fill(VIEWS[name], "timestamp_ntz", lambda i: f"embedding[{i - 1}]", lambda t: "{" + t + "}")
        return self.spark.sql(text, **{t: self.raw(t) for t in used})

    @property
    def fields(self):
        return self.view("fx_fields")

    @property
    def soil(self):
        return self.view("fx_soil")

    @property
    def pixels(self):
        return self.view("fx_pixels")

    @property
    def products(self):
        return self.view("fx_products")

    @property
    def ratings(self):
        from fieldlens.operators.tables import ratings_to_int

        return ratings_to_int(self.soil.withColumnsRenamed({
            "carbon_raw": "carbon_rating", "nitrogen_raw": "nitrogen_rating",
            "phosphorus_raw": "phosphorus_rating", "potassium_raw": "potassium_rating"}))

    def shaped(self, fields=None, extra=()):
        """Fields with their polygon and box."""
        from fieldlens.functions.geometry import with_bbox

        fields = self.fields if fields is None else fields
        ring = F.array(*[
            F.struct((F.col("x0") + F.lit(dx)).alias("x"), (F.col("y0") + F.lit(dy)).alias("y"))
            for dx, dy in CORNERS + CORNERS[:1]])
        return with_bbox(fields.select("field_id", "x0", "y0", F.array(ring).alias("rings"), *extra))


def box_rings_of(df):
    from fieldlens.functions.geometry import box_rings

    return df.withColumn("rings", box_rings("xmin", "ymin", "xmax", "ymax"))


def rounded(df, digits, *columns):
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


# --- SQL pieces shared by several oracles -----------------------------------

NOT_CLEAR = "(1, 3, 8, 9, 10)"
CLEAR = f"""SELECT field_id, uuid FROM fx_pixels GROUP BY field_id, uuid
            HAVING NOT bool_or(SCL_20m IN {NOT_CLEAR})"""
RATINGS = """SELECT field_id, cast(trunc(coalesce(carbon_raw, 0)) AS bigint) AS carbon_rating,
                    cast(trunc(coalesce(nitrogen_raw, 0)) AS bigint) AS nitrogen_rating,
                    cast(trunc(coalesce(phosphorus_raw, 0)) AS bigint) AS phosphorus_rating,
                    cast(trunc(coalesce(potassium_raw, 0)) AS bigint) AS potassium_rating FROM fx_soil"""


def crops_sql(bands):
    return (f"SELECT field_id, uuid, bool_or(SCL_20m IN {NOT_CLEAR}) AS cloudy, "
            + ", ".join(f"avg({b}) AS {b}" for b in bands) + " FROM fx_pixels GROUP BY field_id, uuid")


def survey_sql(bands, rejected=""):
    """CTEs ending in ``survey``: field, survey date, chosen product and date, band means."""
    cols = ", ".join(f"c.{b}" for b in bands)
    return f"""
        crops AS ({crops_sql(bands)}),
        ranked AS (
            SELECT f.field_id, c.uuid, p.generationdate, {cols},
                   row_number() OVER (PARTITION BY f.field_id ORDER BY abs(epoch_us(p.generationdate) - epoch_us(f.survey_date)),
                                      p.generationdate DESC, c.uuid) AS rn
            FROM fx_fields f JOIN crops c ON f.field_id = c.field_id AND NOT c.cloudy
                 JOIN fx_products p ON p.uuid = c.uuid
            WHERE f.survey_date IS NOT NULL {rejected}),
        survey AS (
            SELECT f.field_id, f.survey_date, c.uuid, c.generationdate, {cols}
            FROM fx_fields f LEFT JOIN ranked c ON c.field_id = f.field_id AND c.rn = 1)"""
