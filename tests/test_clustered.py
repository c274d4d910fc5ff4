"""The clustered pixel table: order, rows, and the row groups that a box filter leaves."""

import glob

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from fieldlens.operators.spatial import clip_all_fields
from fieldlens.sinks.tables import morton_key, write_clustered


def plain_key(column, row, bits=20):
    return sum((column >> i & 1) << 2 * i | (row >> i & 1) << (2 * i + 1) for i in range(bits))


def test_key_is_the_bits_in_turn(spark):
    cells = [(0, 0), (1, 0), (0, 1), (5, 9), (2 ** 20 - 1, 2 ** 20 - 1), (123_456, 987_654), (2 ** 19, 3)]
    points = spark.createDataFrame([(i, (c + 0.5) / 2 ** 20, (r + 0.5) / 2 ** 20) for i, (c, r) in enumerate(cells)] + [(90, -5.0, 0.0), (91, 7.0, 9.0)],
                                   "i int, x double, y double")
    got = {r.i: r.k for r in points.select("i", morton_key("x", "y", (0, 0, 1, 1)).alias("k")).collect()}
    assert [got[i] for i in range(len(cells))] == [plain_key(*c) for c in cells]
    assert got[90] == 0 and got[91] == plain_key(2 ** 20 - 1, 2 ** 20 - 1)


def test_a_box_reads_few_row_groups(spark, tmp_path):
    """One percent of the area reads under five percent of the row groups."""
    pixels = spark.range(400_000).select(
        F.col("id"), (F.rand(1) * 1000).alias("x"), (F.rand(2) * 1000).alias("y"), *[F.rand(i).alias(f"b{i}") for i in range(3, 9)])
    path = str(tmp_path / "pixels")
    write_clustered(pixels, path, parts=16, group_bytes=64 << 10)
    box = (300.0, 400.0, 400.0, 500.0)
    groups = met = 0
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = {meta.schema.column(i).name: i for i in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            x, y = (meta.row_group(g).column(at[c]).statistics for c in "xy")
            groups += 1
            met += x.min <= box[2] and x.max >= box[0] and y.min <= box[3] and y.max >= box[1]
    assert groups >= 200 and 0 < met < 0.05 * groups
    back = spark.read.parquet(path)
    assert back.count() == 400_000 and set(back.columns) == set(pixels.columns)
    clipped = clip_all_fields(back, box)
    assert "PushedFilters: [IsNotNull(x), IsNotNull(y), GreaterThanOrEqual(x" in clipped._jdf.queryExecution().executedPlan().toString()
    want = pixels.where(F.col("x").between(300, 400) & F.col("y").between(400, 500)).agg(F.count(F.lit(1)), F.sum("id")).first()
    assert tuple(clipped.agg(F.count(F.lit(1)), F.sum("id")).first()) == tuple(want) and abs(want[0] / 400_000 - 0.01) < 0.002


def test_clustered_edge_cases(spark, tmp_path):
    one = spark.createDataFrame([(1, 2.0, 3.0), (2, 2.0, 3.0), (3, None, 1.0)], "id long, x double, y double")
    write_clustered(one, str(tmp_path / "a"))
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "a")).collect()) == [1, 2, 3]
    write_clustered(one.limit(0), str(tmp_path / "b"))
    assert spark.read.schema(one.schema).parquet(str(tmp_path / "b")).count() == 0
    assert np.isclose(one.agg(F.max("x")).first()[0], 2.0)
