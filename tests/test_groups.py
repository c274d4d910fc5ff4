"""User functions over crops and blocks, many in a call, and small tiles decoded together."""

import numpy as np
import pandas as pd
import pytest

from fieldlens.operators import bandstats
from fieldlens.sources import rasters
from fieldlens.workload import imagery


def test_whole_groups_cut_frames_at_keys():
    rows = pd.DataFrame({"a": ["p", "p", "q", "q", "q", None, None, "r"], "b": [1, 1, 1, 1, 2, 2, 2, 2], "v": range(8)})
    for size in (1, 2, 3, 8):
        frames = [rows.iloc[lo:lo + size] for lo in range(0, len(rows), size)]
        found = list(bandstats.whole_groups(frames, ["a", "b"]))
        assert [v for f in found for v in f["v"]] == list(range(8))
        assert [list(part["v"]) for f in found for _, part in f.groupby("group")] == [[0, 1], [2, 3], [4], [5, 6], [7]]


@pytest.fixture
def pixels(spark):
    rng = np.random.default_rng(3)
    frame = pd.DataFrame({"field_id": [f"G{i % 40:03}" for i in range(2000)], "uuid": [f"P{i % 7}" for i in range(2000)],
                          "value": rng.integers(0, 9, 2000), "px_row": rng.integers(0, 11, 2000), "px_col": rng.integers(0, 11, 2000)})
    return spark.createDataFrame(frame.drop_duplicates(["field_id", "uuid", "px_row", "px_col"]))


def test_crops_together_and_alone(pixels):
    schema = "field_id string, uuid string, n bigint, calls bigint"

    def alone(frame):
        return pd.DataFrame({"field_id": frame["field_id"].iloc[:1], "uuid": frame["uuid"].iloc[:1], "n": int(frame["n_pixels"].sum()), "calls": 1})

    def many(frame):
        found = frame.groupby(["field_id", "uuid", "group"], as_index=False)["n_pixels"].sum()
        return found.assign(n=found["n_pixels"], calls=[1] + [0] * (len(found) - 1))[["field_id", "uuid", "n", "calls"]]

    one = bandstats.apply_per_crop(pixels, alone, schema).toPandas()
    together = bandstats.apply_per_crop(pixels, many, schema, together=True).toPandas()
    rows = lambda f: sorted(map(tuple, f[["field_id", "uuid", "n"]].to_numpy().tolist()))
    assert rows(one) == rows(together) and len(one) == 280
    # a call takes many crops
    assert one["calls"].sum() == 280 and together["calls"].sum() <= 8


def test_blocks_together(pixels):
    grid = pixels.where("uuid = 'P1'").select("field_id", "px_row", "px_col", "value")
    found = [bandstats.apply_per_block(grid, imagery.falling_pixels, "field_id string, n bigint", block=block, halo=1, keys=("field_id",),
                                       together=True).groupBy("field_id").sum("n").toPandas() for block in (2, 4, 64)]
    frame = grid.toPandas()
    right = frame.assign(px_col=frame["px_col"] - 1).rename(columns={"value": "beside"})
    met = frame.merge(right, on=["field_id", "px_row", "px_col"], how="left")
    want = (met["value"] > met["beside"]).groupby(met["field_id"]).sum().to_dict()
    for table in found:
        assert dict(zip(table["field_id"], table["sum(n)"])) == want


def test_small_tiles_are_decoded_together():
    assert list(rasters._tiles_together([">u2"] * 5 + ["<f4"], [4] * 6)) == [(0, 5), (5, 6)]
    assert list(rasters._tiles_together([">u2"] * 3, [60_000, 60_000, 300_000])) == [(0, 1), (1, 2), (2, 3)]


def test_tiles_of_several_types_and_sizes(spark):
    made = [("A", ">u2", 2, 3), ("B", ">u2", 1, 1), ("C", "<f4", 3, 2), ("D", ">u2", 0, 4), ("E", ">u2", 500, 401)]
    rng = np.random.default_rng(5)
    values = {name: rng.integers(0, 5000, (h, w)).astype(kind) for name, kind, h, w in made}
    tiles = spark.createDataFrame(
        [(name, "B", float(i), 9.0, 2.0, w, h, kind, bytearray(values[name].tobytes())) for i, (name, kind, h, w) in enumerate(made)],
        "uuid string, band string, x0 double, y0 double, res double, width int, height int, dtype string, data binary").coalesce(1)
    found = rasters.tiles_to_pixels(tiles).toPandas()
    assert len(found) == sum(v.size for v in values.values())
    for i, (name, _, h, w) in enumerate(made):
        mine = found[found["uuid"] == name]
        assert (mine["value"].to_numpy() == values[name].ravel()).all()
        assert (mine["px_row"].to_numpy() * max(w, 1) + mine["px_col"].to_numpy() == np.arange(h * w)).all()
        assert np.allclose(mine["x"], i + (mine["px_col"] + 0.5) * 2.0) and np.allclose(mine["y"], 9.0 - (mine["px_row"] + 0.5) * 2.0)
    short = tiles.selectExpr("uuid", "band", "x0", "y0", "res", "width + 1 AS width", "height", "dtype", "data")
    with pytest.raises(Exception, match="samples"):
        rasters.tiles_to_pixels(short).count()


def test_wide_crops_are_written_as_long_ones(spark, pixels, tmp_path):
    from fieldlens.sinks import tables as sinks

    wide = pixels.selectExpr("field_id", "uuid", "px_row", "px_col", "value AS B02_10m", "IF(value > 4, NULL, value * 2) AS B03_10m")
    bands, columns = ("B02_10m", "B03_10m"), ["band", "field_id", "uuid", "px_row", "px_col", "value"]
    sinks.write_crops(bandstats.wide_to_long(wide, ["field_id", "uuid", "px_row", "px_col"], bands), str(tmp_path / "long"))
    kept = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    sinks.write_crops(wide, str(tmp_path / "wide"), bands=bands)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == kept
    rows = lambda name: sorted(map(str, spark.read.parquet(str(tmp_path / name)).select(*columns).collect()))
    assert rows("wide") == rows("long") and len(rows("wide")) == 2 * pixels.count()
    for file in (tmp_path / "wide" / "band=B02_10m").glob("*.parquet"):
        found = pd.read_parquet(file, columns=["field_id", "uuid"])
        assert (found.sort_values(["field_id", "uuid"], kind="stable").index == found.index).all()


def test_survey_means_shuffle_the_chosen_crops_alone(spark):
    from fieldlens.plans.survey import band_means_at_survey

    fields = spark.createDataFrame([("G001", "2020-01-10"), ("G002", None), ("G003", "2020-01-10")], "field_id string, day string").selectExpr(
        "field_id", "cast(day AS timestamp_ntz) AS survey_date")
    products = spark.createDataFrame([("P1", "2020-01-01"), ("P2", "2020-01-12"), ("P3", "2020-01-11")], "uuid string, day string").selectExpr(
        "uuid", "cast(day AS timestamp_ntz) AS generationdate")
    pixels = spark.createDataFrame([("G001", "P1", 4, 10), ("G001", "P2", 4, 30), ("G001", "P2", 4, 50), ("G001", "P3", 8, 70), ("G002", "P1", 4, 5),
                                    ("G003", "P3", 9, 5)], "field_id string, uuid string, SCL_20m int, B02_10m int")
    found = band_means_at_survey(fields, products, pixels, ("B02_10m",))
    rows = {r["field_id"]: (r["nearest_product_uuid"], r["B02_10m"]) for r in found.collect()}
    assert rows == {"G001": ("P2", 40.0), "G002": (None, None), "G003": (None, None)}
    # the pixels that reach the means are those of the chosen crops
    assert "LeftSemi" in found._jdf.queryExecution().executedPlan().toString()


def test_summary_of_crops_together():
    # a pixel without a value counts in the mean's pixels
    frame = pd.DataFrame({"field_id": ["A", "A", None, None], "uuid": ["P", "P", "P", "P"], "B04_10m": [10, 4, 7, None], "n_pixels": [1, 3, 2, 2],
                          "group": [0, 0, 1, 1]})
    found = imagery.crop_summary(frame)
    assert found["mean_red"].tolist() == [5.5, 3.5] and found["red_range"].tolist() == [6, 0] and found["field_id"].tolist() == ["A", None]
