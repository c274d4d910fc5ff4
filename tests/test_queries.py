"""A core of the registered queries beside their SQL on the smallest tables."""

import os

import pytest

from check_oracle import connect, differences
from fieldlens.workload import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
CORE = (
    "band_means_at_survey", "asof_next_nearest", "asof_nearest_series", "clear_product_list", "band_histogram", "clip_pixels",
    "contains_join", "pixel_series_at_point", "corr_matrix", "box_stats", "train_test_split", "stratified_folds", "contiguous_folds",
    "read_geojson", "ingest_new_products",
)

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not here")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", CORE)
def test_query_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, FOLDER).toPandas(), con.execute(ORACLES[name]).df()) is None


def test_every_sql_has_its_query():
    assert set(ORACLES) <= set(QUERIES)
