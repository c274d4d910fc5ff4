import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fieldlens.operators import asof, band_search, bandstats, clouds, knn, ranks, resample, spatial, stats, tables
from fieldlens.plans.survey import band_means_at_survey

DAY = dt.datetime(2022, 1, 10)


def day(n):
    return DAY + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def small(spark):
    fields = spark.createDataFrame(
        [("A", day(0)), ("B", None), ("C", day(0)), ("D", day(3))], "field_id string, survey_date timestamp_ntz")
    products = spark.createDataFrame(
        [("p1", day(-2)), ("p2", day(2)), ("p3", day(9))], "uuid string, generationdate timestamp_ntz")
    # A: p1 and p2 equally far; C: only cloudy crops; D: p2 clear
    pixels = spark.createDataFrame([
        ("A", "p1", 4, 10, 30, True), ("A", "p2", 4, 20, 60, True), ("A", "p2", 5, 0, 0, False), ("A", "p3", 4, 1, 1, True),
        ("B", "p1", 4, 7, 9, True), ("C", "p1", 9, 5, 5, True), ("C", "p2", 3, 5, 5, True), ("D", "p2", 4, 40, 40, True),
    ], "field_id string, uuid string, SCL_20m int, B04_10m int, B08_10m int, inside boolean")
    return fields, products, pixels


def test_survey_keeps_every_field_and_prefers_the_later_date(small):
    rows = {r["field_id"]: r for r in band_means_at_survey(*small, bands=("B04_10m", "B08_10m")).collect()}
    assert rows["A"]["nearest_product_uuid"] == "p2" and rows["A"]["B04_10m"] == 20.0 and rows["A"]["mean_ndvi"] == 0.5
    assert rows["B"]["nearest_product_uuid"] is None and rows["C"]["nearest_product_uuid"] is None
    assert rows["D"]["nearest_product_uuid"] == "p2" and set(rows) == {"A", "B", "C", "D"}


def test_zero_fill_counts_the_window(small):
    means = bandstats.band_mean_wide(small[2], ("B04_10m",), fill="zero").where("field_id = 'A' AND uuid = 'p2'")
    assert means.first()["B04_10m"] == 10.0


def test_rejected_products_are_replaced(spark, small):
    rejected = spark.createDataFrame([("A", "p2")], "field_id string, uuid string")
    rows = {r["field_id"]: r["nearest_product_uuid"] for r in band_means_at_survey(*small, bands=("B04_10m",), rejected=rejected).collect()}
    assert rows["A"] == "p1" and rows["D"] == "p2"


def test_clear_lists(small):
    lists = clouds.clear_product_list(clouds.clear_pairs(small[2]), small[1])
    got = {r["field_id"]: r["cloud_free_products"] for r in lists.collect()}
    assert got == {"A": ["p1", "p2", "p3"], "B": ["p1"], "D": ["p2"]}


def test_mean_of_ratios_skips_empty_pixels(spark):
    pixels = spark.createDataFrame([("A", "p", 0, 0), ("A", "p", 3, 1)], "field_id string, uuid string, B08_10m int, B04_10m int")
    assert bandstats.mean_ndvi(pixels).first()["mean_ndvi"] == 0.5


def test_both_asof_plans_agree(spark):
    rng = np.random.default_rng(3)
    probes = pd.DataFrame({"id": range(80), "k": rng.integers(0, 3, 80), "t": [day(int(d)) for d in rng.integers(0, 60, 80)]})
    series = pd.DataFrame({"sid": range(120), "k": rng.integers(0, 3, 120), "s": [day(int(d)) for d in rng.integers(-5, 70, 120)]})
    want = {}
    for r in probes.itertuples():
        mine = series[series.k == r.k]
        best = min(mine.itertuples(), key=lambda c: (abs(c.s - r.t), -(c.s - r.t), c.sid))
        want[r.id] = best.sid
    p, s = (spark.createDataFrame(f).withColumn(c, F.col(c).cast("timestamp_ntz")) for f, c in ((probes, "t"), (series, "s")))
    for bucket in (86400, 86400 * 10, 86400 * 1000):
        out = asof.asof_nearest_series(p, s, "k", "t", "s", "sid", bucket)
        assert {r["id"]: r["nearest_sid"] for r in out.collect()} == want
    single = asof.asof_nearest(p, s.join(p.select("id", "k"), "k"), probe_time="t", time="s", key="id", tie="sid")
    assert {r["id"]: r["sid"] for r in single.collect()} == want


def test_list_exclusion(spark):
    frame = spark.createDataFrame([("A", ["p", "q"], "q"), ("B", ["p"], None)], "field_id string, l array<string>, u string")
    assert [r["l"] for r in tables.exclude_from_list(frame, "l", "u").orderBy("field_id").collect()] == [["p"], ["p"]]


def test_wide_field_index(spark):
    products = spark.createDataFrame([("p",), ("q",)], "uuid string")
    index = spark.createDataFrame([("A", "p", .25)], "field_id string, uuid string, mean_ndvi double")
    rows = {r["uuid"]: r["A_mean_ndvi"] for r in tables.attach_field_index_wide(products, index, ["A"]).collect()}
    assert rows == {"p": .25, "q": None}


# --- spatial ----------------------------------------------------------------

def square(spark, rows):
    frame = spark.createDataFrame(rows, "field_id string, xmin double, ymin double, xmax double, ymax double")
    from fieldlens.functions.geometry import box_rings

    return frame.withColumn("rings", box_rings("xmin", "ymin", "xmax", "ymax"))


def test_clip_counts_the_area_whatever_the_cells(spark):
    pixels = spark.range(100).withColumns({"uuid": F.lit("p"), "x": F.col("id") % 10 + 0.5, "y": F.floor(F.col("id") / 10) + 0.5})
    fields = square(spark, [("A", 2.0, 2.0, 6.0, 5.0), ("B", 0.0, 0.0, 10.0, 10.0)])
    for size, salts in ((1.0, 1), (3.0, 4), (100.0, 2)):
        got = spatial.clip_pixels(pixels, fields, size, salts=salts, keep_outside=False).groupBy("field_id").count().collect()
        assert {r["field_id"]: r["count"] for r in got} == {"A": 12, "B": 100}


def test_contains_pairs_are_unique(spark):
    fields = square(spark, [("A", 1.0, 1.0, 2.0, 2.0), ("B", 8.0, 8.0, 12.0, 9.0)])
    scenes = square(spark, [("s", 0.0, 0.0, 10.0, 10.0), ("t", 1.5, 0.0, 20.0, 20.0)]).withColumnRenamed("field_id", "uuid")
    for size in (0.5, 4.0, 50.0):
        got = spatial.contains_join(fields, scenes, size, salts=3).collect()
        assert sorted((r["field_id"], r["uuid"]) for r in got) == [("A", "s"), ("B", "t")]


def test_spatial_joins_are_keyed(spark):
    pixels = spark.range(10).withColumns({"uuid": F.lit("p"), "x": F.col("id") + 0.5, "y": F.col("id") + 0.5})
    plan = spatial.clip_pixels(pixels, square(spark, [("A", 2.0, 2.0, 6.0, 5.0)]), 1.0)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text


# --- ranks and folds --------------------------------------------------------

def test_quantiles_are_exact(spark):
    rng = np.random.default_rng(5)
    frame = pd.DataFrame({"g": ["hot"] * 900 + ["cold"] * 7, "v": np.r_[rng.integers(0, 40, 900), rng.integers(0, 9, 7)].astype(float)})
    got = ranks.quantiles(spark.createDataFrame(frame), ["g"], "v", (0.25, 0.5, 0.9)).toPandas().set_index("g")
    for g, part in frame.groupby("g"):
        assert np.allclose(got.loc[g, ["q0", "q1", "q2"]].to_numpy(dtype=float), np.quantile(part["v"], (0.25, 0.5, 0.9)))


def reference_folds(y, order, k=5):
    """The published stratified layout: deal positions of the class-sorted order."""
    first = {}
    for i, c in enumerate(y):
        first.setdefault(c, i)
    codes = sorted(first, key=first.get)
    sorted_codes = np.sort([codes.index(c) for c in y])
    out = np.empty(len(y), dtype=int)
    for n, c in enumerate(codes):
        counts = [int((sorted_codes[i::k] == n).sum()) for i in range(k)]
        rows = [i for i in order if y[i] == c]
        out[rows] = np.repeat(np.arange(k), counts)
    return out


def test_folds(spark):
    rng = np.random.default_rng(1)
    y = rng.choice([1, 2, 3], 97, p=[.6, .3, .1]).tolist()
    frame = spark.createDataFrame([(i, c) for i, c in enumerate(y)], "id bigint, label int")
    plain = {r["id"]: r["fold"] for r in resample.contiguous_folds(frame, "label", "id").collect()}
    assert [plain[i] for i in range(97)] == reference_folds(y, range(97)).tolist()
    shuffled = resample.stratified_folds(frame, "label", "id").toPandas()
    assert len(shuffled) == 97 and sorted(shuffled["id"]) == list(range(97))
    shares = shuffled.groupby(["label", "fold"]).size().unstack(fill_value=0)
    assert (shares.max(axis=1) - shares.min(axis=1)).max() <= 1
    split = resample.train_test_split(frame, "id").toPandas()
    assert split["is_train"].sum() == 72 and len(split) == 97


def test_grouped_split(spark):
    frame = spark.range(200).withColumn("g", F.when(F.col("id") < 190, "hot").otherwise("cold"))
    got = resample.train_test_split(frame, "id", by=["g"]).where("is_train").groupBy("g").count().collect()
    assert {r["g"]: r["count"] for r in got} == {"hot": 142, "cold": 7}


# --- statistics -------------------------------------------------------------

def test_corr_with_gaps_and_constants(spark):
    rows = [(1.0, 2.0, 5.0), (2.0, None, 5.0), (3.0, 1.0, 5.0), (4.0, float("nan"), 5.0), (5.0, 4.0, 5.0)]
    matrix = stats.corr_matrix(spark.createDataFrame(rows, "a double, b double, c double"), ["a", "b", "c"])
    got = {(r["row_name"], r["col_name"]): r["corr"] for r in matrix.collect()}
    assert np.isclose(got["a", "b"], np.corrcoef([1, 3, 5], [2, 1, 4])[0, 1]) and got["a", "b"] == got["b", "a"]
    assert got["a", "c"] is None and np.isclose(got["a", "a"], 1.0)


def test_pearson_p(spark):
    # n = 4: the null density of r is flat, so p = 1 - |r|
    frame = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (3.0, 2.0), (4.0, 5.0)], "x double, y double")
    row = stats.pearson_test(frame, "x", "y").first()
    assert np.isclose(row["p_value"], 1 - abs(row["r"]))


def test_histogram_closes_the_last_edge(spark):
    pixels = spark.createDataFrame([("A", "p", v) for v in (0, 50, 100, 100)], "field_id string, uuid string, B02_10m int")
    got = {r["bin"]: r["n_pixels"] for r in stats.band_histogram(pixels, ["B02_10m"]).collect()}
    assert got == {0: 1, 25: 1, 49: 2}


def test_box_whiskers(spark):
    frame = spark.createDataFrame([("g", float(v)) for v in (1, 2, 3, 4, 100)], "g string, v double")
    row = stats.box_stats(frame, ["g"], "v").first()
    assert (row["q1"], row["med"], row["q3"], row["whisker_low"], row["whisker_high"]) == (2, 3, 4, 1, 4)


def test_knn_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    points = rng.normal(size=(400, 3)).round(1)
    frame = pd.DataFrame(points, columns=["a", "b", "c"]).assign(id=range(400), label=rng.integers(0, 3, 400))
    train, test = frame[frame.id >= 80], frame[frame.id < 80]
    near = knn.nearest_neighbours(
        spark.createDataFrame(train), spark.createDataFrame(test), ["a", "b", "c"], "id", "label", n_pivots=6, block_rows=20)
    got = near.toPandas().sort_values(["id", "place"]).groupby("id")["neighbour_id"].apply(list)
    for r in test.itertuples():
        d = sum((train[c] - getattr(r, c)) ** 2 for c in ("a", "b", "c"))
        assert got[r.id] == train.assign(d=d).sort_values(["d", "id"])["id"].head(5).tolist()


def search_frame(spark):
    rng = np.random.default_rng(4)
    n = 60
    data = pd.DataFrame(rng.normal(size=(n, 3)), columns=["a", "b", "c"]).assign(target="t", class_no=rng.integers(0, 3, n))
    data["is_train"] = np.arange(n) < 45
    data["fold_s"] = np.where(data.is_train, np.arange(n) % 5, 0)
    data["fold_c"] = np.where(data.is_train, np.arange(n) // 9, 0)
    return data, spark.createDataFrame(data)


def test_gram_search_equals_least_squares(spark):
    data, frame = search_frame(spark)
    got = band_search.search_gram(frame, ["a", "b", "c"], 3).groupBy("scheme", "fold", "subset_id").agg(
        F.sum("hits").alias("hits")).toPandas().set_index(["scheme", "fold", "subset_id"])["hits"]
    train = data[data.is_train]
    for subset in range(1, 8):
        bands = [b for i, b in enumerate("abc") if subset >> i & 1]
        for scheme, fold, fit, scored in [("holdout", 0, train, data[~data.is_train])] + [
                (s, i, train[train[s] != i], train[train[s] == i]) for s in ("fold_s", "fold_c") for i in range(5)]:
            design = lambda d: np.c_[np.ones(len(d)), d[bands]]
            signs = np.where(fit["class_no"].to_numpy()[:, None] == np.arange(3), 1.0, -1.0)
            w = np.linalg.lstsq(design(fit), signs, rcond=None)[0]
            assert got[scheme, fold, subset] == ((design(scored) @ w).argmax(axis=1) == scored["class_no"]).sum()


def test_hinge_search_has_no_row_limit(spark):
    _, frame = search_frame(spark)
    both = band_search.band_search(frame, ["a", "b", "c"], 3, solver="hinge").toPandas()
    assert len(both) == 7 and both["accuracy_score"].between(0, 1).all()


def test_scores_and_confusion(spark):
    frame = spark.createDataFrame([(1, 1), (1, 2), (2, 2)], "label int, prediction int")
    got = {r["label"]: (r["predicted_1"], r["predicted_2"], r["predicted_3"]) for r in stats.confusion_matrix(frame, [1, 2, 3]).collect()}
    assert got == {1: (1, 1, 0), 2: (0, 1, 0), 3: (0, 0, 0)}


# --- rows without a label, group or order -----------------------------------

def test_rows_with_null_keys_stay(spark):
    from fieldlens.operators import resample

    rows = [(i, None if i % 4 == 0 else i % 3, None if i % 5 == 0 else i, None if i % 6 == 0 else "g") for i in range(40)]
    df = spark.createDataFrame(rows, "id int, label int, pos int, grp string")
    shuffled = resample.stratified_folds(df, "label", "id").toPandas()
    assert len(shuffled) == 40 and shuffled[shuffled.label.isna()].fold.isna().all() and shuffled[shuffled.label.notna()].fold.notna().all()
    ordered = resample.contiguous_folds(df, "label", "id", "pos").toPandas()
    assert len(ordered) == 40 and ordered[ordered.label.notna()].fold.notna().all()
    weights = resample.balanced_weights(df, "label").toPandas()
    assert len(weights) == 40 and weights.weight.isna().sum() == 10
    split = resample.train_test_split(df, "id", by=["grp"]).toPandas()
    assert len(split) == 40 and split.groupby("grp", dropna=False).is_train.sum().to_dict() != {}


def test_field_flush_with_every_border_is_inside(spark):
    from fieldlens.functions.geometry import box_rings, with_bbox
    from fieldlens.operators.spatial import contains_join

    boxes = spark.createDataFrame([("all", 0.0, 0.0, 4.0, 4.0), ("upper", 2.0, 2.0, 4.0, 4.0), ("lower", 0.0, 0.0, 1.0, 1.0), ("out", 3.0, 3.0, 5.0, 4.0)],
                                  "field_id string, xmin double, ymin double, xmax double, ymax double")
    shaped = boxes.withColumn("rings", box_rings("xmin", "ymin", "xmax", "ymax"))
    product = shaped.where("field_id = 'all'").withColumnRenamed("field_id", "uuid")
    found = contains_join(with_bbox(shaped.select("field_id", "rings")), product, 1.5)
    assert {r.field_id for r in found.collect()} == {"all", "upper", "lower"}


def test_nan_rating_is_zero(spark):
    from fieldlens.functions.text import rating_to_int

    values = spark.createDataFrame([(float("nan"),), (None,), (2.9,)], "x double").select(rating_to_int("x").alias("r"))
    assert [r.r for r in values.collect()] == [0, 0, 2]


def test_crop_without_class_pixels_is_neither(spark):
    from fieldlens.streaming.ingest import crop_partials, merge_partials

    pixels = spark.createDataFrame([("a", "p", None, 1), ("a", "q", 4, 1), ("a", "r", 8, 1)], "field_id string, uuid string, SCL_20m int, B04_10m int")
    merged = merge_partials(crop_partials(pixels, ["B04_10m"]), ["B04_10m"])
    assert {r.uuid: r.is_cloudy for r in merged.collect()} == {"p": None, "q": False, "r": True}


def test_multipolygon_survives_the_round_trip(spark, tmp_path):
    from fieldlens.functions.geometry import polygons_to_wkt
    from fieldlens.sinks.tables import write_geojson
    from fieldlens.sources.boundaries import read_geojson

    two = '{"type":"MultiPolygon","coordinates":[[[[0.0,0.0],[1.0,0.0],[1.0,1.0],[0.0,0.0]]],[[[5.0,5.0],[6.0,5.0],[6.0,6.0],[5.0,5.0]]]]}'
    one = '{"type":"Polygon","coordinates":[[[0.0,0.0],[4.0,0.0],[4.0,4.0],[0.0,0.0]],[[1.0,0.5],[2.0,0.5],[2.0,1.0],[1.0,0.5]]]}'
    rows = [('{"type":"Feature","geometry":' + g + ',"properties":{"k":"%s"}}' % k,) for k, g in (("two", two), ("one", one), ("none", "null"))]
    spark.createDataFrame(rows, "value string").write.text(f"{tmp_path}/in")
    read = read_geojson(spark, f"{tmp_path}/in", {"k": "string"})
    write_geojson(read.select("k", "polygons", "rings"), f"{tmp_path}/out")
    back = read_geojson(spark, f"{tmp_path}/out", {"k": "string"})
    got = {r.k: (r.geometry_text, r.polygons) for r in back.collect()}
    assert got["two"][0] == two and got["one"][0] == one and got["none"][1] is None
    wkt = {r.k: r.w for r in back.select("k", polygons_to_wkt("polygons").alias("w")).collect()}
    assert wkt["two"].startswith("MULTIPOLYGON (((0.0 0.0") and wkt["one"].startswith("POLYGON ((0.0 0.0")


def test_neighbours_of_clusters_compare_few_pairs(spark):
    import numpy as np

    from fieldlens.operators.knn import compared_share, nearest_neighbours

    def clustered(n, seed):
        rng = np.random.default_rng(seed)
        centre = rng.integers(0, 12, n)
        xy = np.stack([centre % 4 * 50.0, centre // 4 * 50.0], axis=1) + rng.normal(size=(n, 2)) * 3
        return spark.createDataFrame([(i, int(c), float(a), float(b)) for i, (c, (a, b)) in enumerate(zip(centre, xy))],
                                     "field_id int, label int, a double, b double"), xy

    test, to = clustered(200, 1)
    shares = []
    for n in (500, 4000):
        train, at = clustered(n, 2)
        shares.append(compared_share(train, test, ["a", "b"], block_rows=64))
    assert shares[1] < shares[0] < 0.5
    got = nearest_neighbours(train, test, ["a", "b"], block_rows=64).toPandas().sort_values(["field_id", "place"])
    order = np.argsort(((to[:, None] - at[None]) ** 2).sum(axis=2), axis=1, kind="stable")[:, :5]
    assert (got["neighbour_id"].to_numpy().reshape(-1, 5) == order).all()


def test_knn_visits_few_blocks_without_clusters(spark):
    from fieldlens.operators.knn import compared_share, nearest_neighbours

    rng = np.random.default_rng(5)
    points = rng.random((4000, 3))
    frame = pd.DataFrame(points, columns=["a", "b", "c"]).assign(field_id=range(4000), label=0)
    train, test = spark.createDataFrame(frame[frame.field_id >= 100]), spark.createDataFrame(frame[frame.field_id < 100])
    assert compared_share(train, test, ["a", "b", "c"], block_rows=64) < 0.15
    got = nearest_neighbours(train, test, ["a", "b", "c"], block_rows=64).toPandas().sort_values(["field_id", "place"])
    order = np.argsort(((points[:100, None] - points[None, 100:]) ** 2).sum(axis=2), axis=1, kind="stable")[:, :5] + 100
    assert (got["neighbour_id"].to_numpy().reshape(-1, 5) == order).all()


def test_knn_of_copies_and_few_rows(spark):
    columns = "field_id int, label int, a double"
    train = spark.createDataFrame([(i, i % 2, 1.0) for i in range(50)] + [(90, 0, 7.0), (91, 0, None)], columns)
    test = spark.createDataFrame([(200, None, 1.0), (201, None, 7.0), (202, None, None)], columns)
    got = knn.nearest_neighbours(train, test, ["a"], n_pivots=8, block_rows=4).toPandas().sort_values(["field_id", "place"])
    assert got.groupby("field_id")["neighbour_id"].apply(list).to_dict() == {200: [0, 1, 2, 3, 4], 201: [90, 0, 1, 2, 3]}


def test_band_means_of_many_bands_are_formed_in_passes(spark, monkeypatch):
    rows = [(None if i % 7 == 0 else f"f{i % 5}", None if i % 4 == 0 else f"p{i % 3}", None if i % 6 == 0 else i * i % 97, i % 11, i % 2 == 0)
            for i in range(200)]
    pixels = spark.createDataFrame(rows, "field_id string, uuid string, a int, b int, inside boolean")
    listed = lambda frame: sorted(((*r,) for r in frame.collect()), key=str)
    whole = {}
    for r in rows:
        whole.setdefault(r[:2], []).append(r[2:])
    mean = lambda values: sum(values) / len(values) if values else None
    wanted = sorted(((*k, mean([a for a, _, i in v if i and a is not None]), mean([b for _, b, i in v if i])) for k, v in whole.items()), key=str)
    monkeypatch.setattr(bandstats, "BANDS_PER_PASS", 1)
    means = bandstats.band_mean_wide(pixels, ("a", "b"))
    # a task holds the sums of one share of the crops at a time
    assert means._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 2
    assert listed(means) == wanted
    assert len(listed(bandstats.band_mean_of_wide(pixels, ("a", "b")))) == 2 * len(wanted)
    assert listed(bandstats.band_mean_wide(pixels, ("a", "b"), passes=1)) == wanted
