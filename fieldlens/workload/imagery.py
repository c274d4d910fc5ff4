"""Clear tests, band means, as-of choice, indices and the per-field series."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from fieldlens.constants import ALL_BANDS, CLOUD_ALERT, HISTOGRAM_BANDS, SUMMARY_BANDS
from fieldlens.functions.dates import date_label
from fieldlens.operators import asof, bandstats, clouds, stats, tables
from fieldlens.plans.survey import band_means_at_survey
from fieldlens.workload.registry import CLEAR, NOT_CLEAR, Tables, query, rounded, survey_sql

HAZY_BLUE = 2700
NDVI_SQL = "avg((B08_10m - B04_10m)::double / nullif(B08_10m + B04_10m, 0))"
NDWI_SQL = "avg((B03_10m - B08_10m)::double / nullif(B03_10m + B08_10m, 0))"


def pairs_of(t: Tables):
    return clouds.clear_pairs(t.pixels)


def rejected_of(t: Tables):
    """Chosen products whose blue band is too bright to be clear ground, as a reader would find."""
    survey = band_means_at_survey(t.fields, t.products, t.pixels, ("B02_10m",))
    return survey.where(f"B02_10m > {HAZY_BLUE}").select("field_id", F.col("nearest_product_uuid").alias("uuid"))


# --- clear test -------------------------------------------------------------

@query("cloud_flag", f"""
    SELECT field_id, uuid, bool_or(SCL_20m IN {NOT_CLEAR}) AS is_cloudy FROM fx_pixels GROUP BY field_id, uuid""")
def _(t):
    return clouds.cloud_flag(t.pixels)


@query("cloud_alert_label", f"""
    SELECT field_id, uuid, CASE WHEN bool_or(SCL_20m IN (8, 9, 10)) THEN '{CLOUD_ALERT}' ELSE 'Clear' END AS label
    FROM fx_pixels GROUP BY field_id, uuid""")
def _(t):
    return clouds.cloud_alert_label(t.pixels)


@query("clear_product_list", f"""
    WITH clear AS ({CLEAR})
    SELECT c.field_id, string_agg(c.uuid, ' ' ORDER BY p.generationdate, c.uuid) AS cloud_free_products
    FROM clear c JOIN fx_products p USING (uuid) GROUP BY c.field_id""")
def _(t):
    lists = clouds.clear_product_list(pairs_of(t), t.products)
    return lists.withColumn("cloud_free_products", F.array_join("cloud_free_products", " "))


@query("clear_product_table", f"""
    WITH clear AS ({CLEAR})
    SELECT c.field_id, c.uuid, n.n_pixels, p.generationdate, p.title
    FROM clear c JOIN (SELECT field_id, uuid, count(B04_10m) AS n_pixels FROM fx_pixels GROUP BY field_id, uuid) n
         USING (field_id, uuid) JOIN fx_products p ON p.uuid = c.uuid""")
def _(t):
    return clouds.clear_product_table(t.pixels, t.products).select(
        "field_id", "uuid", "n_pixels", "generationdate", "title")


@query("clear_products_of_field", f"""
    WITH clear AS ({CLEAR})
    SELECT c.field_id, p.uuid, p.title, p.generationdate FROM fx_products p JOIN clear c USING (uuid) WHERE NOT p.uuid LIKE '%1'""")
def _(t):
    listed = t.products.withColumn("B01_60m", F.when(F.endswith("uuid", F.lit("1")), F.lit(None)).otherwise(F.concat("uuid", F.lit("/B01_60m"))))
    return clouds.clear_products_of_field(listed, pairs_of(t), "B01_60m").select("field_id", "uuid", "title", "generationdate")


@query("exclude_products", f"""
    WITH clear AS ({CLEAR}),
         seen AS (SELECT field_id, uuid FROM fx_pixels GROUP BY field_id, uuid HAVING max(TCI_10m) > 240)
    SELECT field_id, uuid FROM clear ANTI JOIN seen USING (field_id, uuid)""")
def _(t):
    overexposed = t.pixels.groupBy("field_id", "uuid").agg(F.max("TCI_10m").alias("m")).where("m > 240")
    return tables.exclude_products(pairs_of(t), overexposed)


@query("missing_crops_out", f"""
    WITH crops AS (SELECT field_id, uuid FROM fx_pixels WHERE B02_10m > 3000)
    SELECT DISTINCT field_id, uuid FROM ({CLEAR}) SEMI JOIN crops USING (field_id, uuid)""")
def _(t):
    return tables.missing_crops_out(pairs_of(t), t.pixels.where("B02_10m > 3000"))


# --- band means -------------------------------------------------------------

@query("band_mean", """
    SELECT field_id, uuid, band, round(avg(value), 6) AS band_mean
    FROM (UNPIVOT (SELECT field_id, uuid, {bands} FROM fx_pixels) ON {bands} INTO NAME band VALUE value)
    GROUP BY field_id, uuid, band""".replace("{bands}", ", ".join(ALL_BANDS)))
def _(t):
    return rounded(bandstats.band_mean_of_wide(t.pixels), 6, "band_mean")


@query("band_mean_long", """
    SELECT field_id, uuid, band, round(avg(value), 6) AS band_mean
    FROM (UNPIVOT (SELECT field_id, uuid, {bands} FROM fx_pixels) ON {bands} INTO NAME band VALUE value)
    GROUP BY field_id, uuid, band""".replace("{bands}", ", ".join(SUMMARY_BANDS)))
def _(t):
    """The same from pixels that come in long form."""
    long = bandstats.wide_to_long(t.pixels, ["field_id", "uuid"], SUMMARY_BANDS)
    return rounded(bandstats.band_mean(long), 6, "band_mean")


@query("band_mean_wide", "SELECT field_id, uuid, " + ", ".join(
    f"round(avg({b}), 6) AS {b}" for b in ALL_BANDS) + " FROM fx_pixels GROUP BY field_id, uuid")
def _(t):
    return rounded(bandstats.band_mean_wide(t.pixels), 6, *ALL_BANDS)


@query("band_mean_zero_fill", """
    SELECT field_id, uuid, round(avg(CASE WHEN px_col > 2 THEN B04_10m ELSE 0 END), 6) AS with_fill,
           round(avg(CASE WHEN px_col > 2 THEN B04_10m END), 6) AS masked
    FROM fx_pixels GROUP BY field_id, uuid""")
def _(t):
    flagged = t.pixels.select("field_id", "uuid", "B04_10m", (F.col("px_col") > 2).alias("inside"))
    both = bandstats.band_mean_wide(
        flagged, ["B04_10m"], fill="zero", extra=(F.avg(F.when(F.col("inside"), F.col("B04_10m"))).alias("masked"),))
    return rounded(both.withColumnRenamed("B04_10m", "with_fill"), 6, "with_fill", "masked")


def survey_of(t, bands=ALL_BANDS, rejected=None):
    return band_means_at_survey(t.fields.select("field_id", "survey_date"), t.products, t.pixels, bands, rejected=rejected)


def _survey_select(bands):
    return ", ".join(f"round({b}, 6) AS {b}" for b in bands)


@query("band_means_at_survey", f"""
    WITH {survey_sql(ALL_BANDS)}
    SELECT field_id, survey_date, uuid AS nearest_product_uuid, generationdate AS nearest_product_generationdate,
           {_survey_select(ALL_BANDS)},
           round((B08_10m - B04_10m) / nullif(B08_10m + B04_10m, 0), 6) AS mean_ndvi,
           round((B03_20m - B8A_20m) / nullif(B03_20m + B8A_20m, 0), 6) AS mean_ndwi
    FROM survey""")
def flagship(t):
    return rounded(survey_of(t), 6, *ALL_BANDS, "mean_ndvi", "mean_ndwi")


@query("asof_nearest", f"""
    WITH {survey_sql(('B04_10m',))}
    SELECT field_id, survey_date, uuid, generationdate FROM survey""")
def _(t):
    dated = pairs_of(t).join(t.products.select("uuid", "generationdate"), "uuid")
    return asof.asof_nearest(t.fields.select("field_id", "survey_date"), dated)


@query("asof_next_nearest", f"""
    WITH {survey_sql(('B02_10m',))},
    again AS (SELECT * FROM ranked WHERE NOT (rn = 1 AND B02_10m > {HAZY_BLUE})),
    best AS (SELECT field_id, uuid, generationdate, row_number() OVER (PARTITION BY field_id ORDER BY rn) AS n FROM again)
    SELECT f.field_id, f.survey_date, b.uuid, b.generationdate
    FROM fx_fields f LEFT JOIN best b ON b.field_id = f.field_id AND b.n = 1""")
def _(t):
    dated = pairs_of(t).join(t.products.select("uuid", "generationdate"), "uuid")
    return asof.asof_next_nearest(t.fields.select("field_id", "survey_date"), dated, rejected_of(t))


@query("asof_nearest_series", """
    WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'error'),
         s AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'purchase'),
         r AS (SELECT p.event_id, s.ts AS t, s.event_id AS id,
                      row_number() OVER (PARTITION BY p.event_id ORDER BY abs(epoch_us(s.ts) - epoch_us(p.ts)), s.ts DESC, s.event_id) AS rn
               FROM p JOIN s USING (user_id))
    SELECT p.event_id AS probe_id, p.user_id, p.ts AS probe_ts, r.id AS nearest_event_id, r.t AS nearest_ts
    FROM p LEFT JOIN r ON r.event_id = p.event_id AND r.rn = 1""")
def _(t):
    events = t.raw("events")
    probes = events.where("event_type = 'error'").select(
        F.col("event_id").alias("probe_id"), "user_id", F.col("ts").alias("probe_ts"))
    series = events.where("event_type = 'purchase'").select("user_id", "ts", "event_id")
    return asof.asof_nearest_series(probes, series, "user_id", "probe_ts", "ts", "event_id", bucket_seconds=86400)


@query("chosen_product_crops", f"""
    WITH {survey_sql(('B08_10m',))}
    SELECT s.field_id, s.uuid, n.n_pixels, n.n_shown FROM survey s
    JOIN (SELECT field_id, uuid, count(*) AS n_pixels, count(TCI_10m) AS n_shown FROM fx_pixels GROUP BY field_id, uuid) n
      ON n.field_id = s.field_id AND n.uuid = s.uuid""")
def _(t):
    crops = t.pixels.groupBy("field_id", "uuid").agg(
        F.count(F.lit(1)).alias("n_pixels"), F.count("TCI_10m").alias("n_shown"))
    return tables.chosen_product_crops(survey_of(t, ("B08_10m",)), crops)


# --- indices ----------------------------------------------------------------

@query("ndvi_of_means", """
    SELECT field_id, uuid, round((avg(B08_10m) - avg(B04_10m)) / nullif(avg(B08_10m) + avg(B04_10m), 0), 6) AS mean_ndvi
    FROM fx_pixels GROUP BY field_id, uuid""")
def _(t):
    means = bandstats.band_mean_wide(t.pixels, ("B08_10m", "B04_10m"))
    return rounded(bandstats.index_of_means(means, "B08_10m", "B04_10m", "mean_ndvi"), 6, "mean_ndvi").drop("B08_10m", "B04_10m")


@query("ndwi_of_means", """
    SELECT field_id, uuid, round((avg(B03_20m) - avg(B8A_20m)) / nullif(avg(B03_20m) + avg(B8A_20m), 0), 6) AS mean_ndwi
    FROM fx_pixels GROUP BY field_id, uuid""")
def _(t):
    means = bandstats.band_mean_wide(t.pixels, ("B03_20m", "B8A_20m"))
    return rounded(bandstats.index_of_means(means, "B03_20m", "B8A_20m", "mean_ndwi"), 6, "mean_ndwi").drop("B03_20m", "B8A_20m")


@query("mean_ndvi", f"SELECT field_id, uuid, round({NDVI_SQL}, 6) AS mean_ndvi FROM fx_pixels GROUP BY field_id, uuid")
def _(t):
    return rounded(bandstats.mean_ndvi(t.pixels), 6, "mean_ndvi")


@query("mean_ndwi", f"SELECT field_id, uuid, round({NDWI_SQL}, 6) AS mean_ndwi FROM fx_pixels GROUP BY field_id, uuid")
def _(t):
    return rounded(bandstats.mean_ndwi(t.pixels), 6, "mean_ndwi")


@query("apply_index_all_fields", f"""
    WITH clear AS ({CLEAR})
    SELECT p.field_id, p.uuid, round({NDVI_SQL}, 6) AS mean_ndvi, round({NDWI_SQL}, 6) AS mean_ndwi, max(B02_10m) AS brightest
    FROM fx_pixels p SEMI JOIN clear c ON c.field_id = p.field_id AND c.uuid = p.uuid GROUP BY p.field_id, p.uuid""")
def _(t):
    from fieldlens.functions.spectral import normalized_difference

    out = bandstats.apply_index(
        t.pixels, pairs_of(t), mean_ndvi=F.avg(normalized_difference("B08_10m", "B04_10m")),
        mean_ndwi=F.avg(normalized_difference("B03_10m", "B08_10m")), brightest=F.max("B02_10m"))
    return rounded(out, 6, "mean_ndvi", "mean_ndwi")


def index_of(t):
    return bandstats.apply_index(
        t.pixels, pairs_of(t), mean_ndvi=F.avg(F.try_divide(
            (F.col("B08_10m") - F.col("B04_10m")).cast("double"), F.col("B08_10m") + F.col("B04_10m"))))


INDEX_SQL = f"""clear AS ({CLEAR}),
    idx AS (SELECT p.field_id, p.uuid, {NDVI_SQL} AS mean_ndvi FROM fx_pixels p
            SEMI JOIN clear c ON c.field_id = p.field_id AND c.uuid = p.uuid GROUP BY p.field_id, p.uuid)"""


@query("attach_field_index", f"""
    WITH {INDEX_SQL}
    SELECT p.uuid, p.title, i.field_id, round(i.mean_ndvi, 6) AS mean_ndvi
    FROM fx_products p LEFT JOIN idx i ON i.uuid = p.uuid""")
def _(t):
    joined = tables.attach_field_index(t.products.select("uuid", "title"), index_of(t))
    return rounded(joined, 6, "mean_ndvi")


@query("ndvi_series", f"""
    WITH {INDEX_SQL}
    SELECT i.field_id, p.generationdate, i.uuid, round(i.mean_ndvi, 6) AS mean_ndvi
    FROM idx i JOIN fx_products p ON p.uuid = i.uuid ORDER BY 1, 2, 3""")
def _(t):
    series = index_of(t).join(t.products.select("uuid", "generationdate"), "uuid")
    return rounded(series, 6, "mean_ndvi").orderBy("field_id", "generationdate", "uuid")


@query("summary_by_band", """
    WITH clear AS ({clear}),
         n AS ({counts})
    SELECT n.field_id, n.band, n.uuid, p.generationdate, n.n_pixels,
           concat(day(p.generationdate), '/', month(p.generationdate), '/', year(p.generationdate)) AS day
    FROM n JOIN clear c ON c.field_id = n.field_id AND c.uuid = n.uuid JOIN fx_products p ON p.uuid = n.uuid""".format(
    clear=CLEAR, counts=" UNION ALL ".join(
        f"SELECT field_id, uuid, '{b}' AS band, count({b}) AS n_pixels FROM fx_pixels GROUP BY field_id, uuid"
        for b in SUMMARY_BANDS)))
def _(t):
    counts = t.pixels.groupBy("field_id", "uuid").agg(
        F.bool_or(F.col("SCL_20m").isin(1, 3, 8, 9, 10)).alias("_cloudy"), *[F.count(b).alias(b) for b in SUMMARY_BANDS])
    clear = counts.where(~F.col("_cloudy"))
    dated = tables.unpivot_columns(clear, ["field_id", "uuid"], SUMMARY_BANDS, "band", "n_pixels").join(
        t.products.select("uuid", "generationdate"), "uuid")
    return dated.where("n_pixels > 0").withColumn("day", date_label("generationdate")).select(
        "field_id", "band", "uuid", "generationdate", "n_pixels", "day").orderBy("field_id", "band", "generationdate", "uuid")


@query("cloud_series", f"""
    SELECT a.field_id, a.uuid, a.n_shown, a.n_class, a.label, p.generationdate,
           concat(day(p.generationdate), '/', month(p.generationdate), '/', year(p.generationdate)) AS day
    FROM (SELECT field_id, uuid, count(TCI_10m) AS n_shown, count(SCL_20m) AS n_class,
                 CASE WHEN bool_or(SCL_20m IN (8, 9, 10)) THEN '{CLOUD_ALERT}' ELSE 'Clear' END AS label
          FROM fx_pixels GROUP BY field_id, uuid) a JOIN fx_products p ON p.uuid = a.uuid""")
def _(t):
    return clouds.dated_cloud_series(t.pixels, t.products)


@query("band_histogram", """
    WITH l AS (SELECT * FROM (UNPIVOT (SELECT field_id, uuid, {bands} FROM fx_pixels) ON {bands} INTO NAME band VALUE value)),
         r AS (SELECT field_id, uuid, CASE WHEN min(value) = max(value) THEN min(value) - 0.5 ELSE min(value) END AS lo,
                      CASE WHEN min(value) = max(value) THEN max(value) + 0.5 ELSE max(value) END AS hi
               FROM l GROUP BY field_id, uuid)
    SELECT l.field_id, l.uuid, l.band,
           cast(least(floor((l.value - r.lo)::double * 50 / (r.hi - r.lo)::double), 49) AS int) AS bin, count(*) AS n_pixels
    FROM l JOIN r USING (field_id, uuid) GROUP BY ALL""".replace("{bands}", ", ".join(HISTOGRAM_BANDS)))
def _(t):
    return stats.band_histogram(t.pixels, HISTOGRAM_BANDS)


# --- user functions ---------------------------------------------------------

def crop_summary(frame: pd.DataFrame) -> pd.DataFrame:
    """A user function over crops: mean and spread of the red band of each."""
    crops = frame.assign(total=frame["B04_10m"] * frame["n_pixels"]).groupby("group", sort=False)
    sums, spread = crops[["total", "n_pixels"]].sum(), crops["B04_10m"].agg(["min", "max"])
    places = frame.drop_duplicates("group")
    return pd.DataFrame({
        "field_id": places["field_id"].to_numpy(), "uuid": places["uuid"].to_numpy(),
        "mean_red": (sums["total"] / sums["n_pixels"]).round(6).to_numpy(),
        "red_range": (spread["max"] - spread["min"]).astype("Int64").array})


@query("apply_per_crop", """
    SELECT field_id, uuid, round(avg(B04_10m), 6) AS mean_red, cast(max(B04_10m) - min(B04_10m) AS bigint) AS red_range
    FROM fx_pixels GROUP BY field_id, uuid""")
def _(t):
    return bandstats.apply_per_crop(
        t.pixels, crop_summary, "field_id string, uuid string, mean_red double, red_range bigint", value_columns=("B04_10m",), together=True)


def falling_pixels(frame: pd.DataFrame) -> pd.DataFrame:
    """Own pixels of each block that are above their right neighbour."""
    place = ["group", "px_row", "px_col"]
    placed = frame.dropna(subset=place)
    own = placed[placed["own"].to_numpy(dtype=bool)]
    beside = own.assign(px_col=own["px_col"] + 1)[[*place, "value"]].merge(placed[[*place, "value"]], on=place, suffixes=("", "_beside"))
    falling = beside.loc[beside["value"] > beside["value_beside"], "group"]
    blocks = frame.drop_duplicates("group")
    return pd.DataFrame({"field_id": blocks["field_id"].to_numpy(), "n": np.bincount(falling, minlength=len(blocks))})


@query("apply_per_block", """
    WITH g AS (SELECT field_id, px_row, px_col, max(B04_10m) AS v FROM fx_pixels GROUP BY ALL)
    SELECT a.field_id, cast(sum(CASE WHEN a.v > b.v THEN 1 ELSE 0 END) AS bigint) AS n_falling
    FROM g a LEFT JOIN g b ON b.field_id = a.field_id AND b.px_row = a.px_row AND b.px_col = a.px_col + 1 GROUP BY a.field_id""")
def _(t):
    grid = t.pixels.groupBy("field_id", "px_row", "px_col").agg(F.max("B04_10m").alias("value"))
    blocks = bandstats.apply_per_block(grid, falling_pixels, "field_id string, n bigint", block=4, halo=1, keys=("field_id",), together=True)
    return blocks.groupBy("field_id").agg(F.sum("n").alias("n_falling"))


def row_label(frame: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"field_id": frame["field_id"], "label": frame["farm_name"].str.upper() + " " + frame["field_id"]})


@query("apply_per_row", "SELECT field_id, concat(upper(farm_name), ' ', field_id) AS label FROM fx_fields")
def _(t):
    return tables.apply_per_row(t.fields.select("field_id", "farm_name"), row_label, "field_id string, label string")


@query("map_column", """
    SELECT field_id, upper(farm_name) AS farm_name, length(field_id) AS id_length FROM fx_fields""")
def _(t):
    @F.pandas_udf("bigint")
    def text_length(col: pd.Series) -> pd.Series:
        return col.str.len()

    upper = tables.map_column(t.fields.select("field_id", "farm_name"), "farm_name", F.upper)
    return tables.map_column(upper, "field_id", text_length, "id_length")
