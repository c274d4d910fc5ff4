"""Merging of ingested batches, with a crash after every step."""

import pytest
from pyspark.sql import functions as F

from fieldlens.streaming import ingest, segments


def add_batch(spark, out, number):
    rows = spark.range(3).select(F.concat(F.lit("f"), F.col("id")).alias("field_id"), F.lit("p").alias("uuid"), F.lit(1).cast("long").alias("n_scl"),
                                 F.lit(0).cast("long").alias("n_unclear"), F.lit(1).cast("long").alias("n_b"), F.lit(float(number)).alias("sum_b"))
    rows.coalesce(1).write.mode("overwrite").parquet(segments.batch_folder(out, number))


def total(spark, out):
    row = ingest.add_partials(spark.read.parquet(*segments.live_folders(spark, out))).agg(F.sum("n_b"), F.sum("sum_b")).first()
    return row[0], row[1]


def test_folders_stay_few_and_sums_whole(spark, tmp_path):
    out = str(tmp_path)
    for n in range(40):
        add_batch(spark, out, n)
        segments.merge_segments(spark, out, ingest.add_partials, below=n, fanout=3)
        if n % 9 == 0:
            assert total(spark, out) == (3 * (n + 1), 3.0 * n * (n + 1) / 2)
    folders = segments.live_folders(spark, out)
    assert len(folders) <= 3 * 4 and total(spark, out) == (120, 3.0 * 780)
    left = [p for kind in ("batches", "segments") for p in segments.finished(spark, f"{out}/{kind}")]
    assert len(left) == len(folders) and len(segments.finished(spark, f"{out}/manifest")) <= 2
    # a batch that is repeated though it was merged counts once
    add_batch(spark, out, 5)
    assert total(spark, out) == (120, 3.0 * 780)


class Crash(Exception):
    pass


@pytest.mark.parametrize("step", ["publish", "sweep", "drop"])
def test_a_crash_loses_and_doubles_nothing(spark, tmp_path, monkeypatch, step):
    out = str(tmp_path)
    for n in range(4):
        add_batch(spark, out, n)
    real, calls = getattr(segments, step), []

    def crash(*args):
        calls.append(args)
        if step == "drop" and len(calls) < 2:
            return real(*args)  # the first of several deletions gets through
        raise Crash

    with monkeypatch.context() as patch:
        patch.setattr(segments, step, crash)
        with pytest.raises(Crash):
            segments.merge_segments(spark, out, ingest.add_partials, below=3, fanout=3)
    assert total(spark, out) == (12, 18.0)
    segments.merge_segments(spark, out, ingest.add_partials, below=3, fanout=3)
    assert total(spark, out) == (12, 18.0)
    segments.sweep(spark, out)
    assert total(spark, out) == (12, 18.0) and segments.newest_manifest(spark, out)[1] == [(0, 2)]
