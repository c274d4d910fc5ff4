"""Correlations by moments and densities by bins beside direct sums."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fieldlens.operators import stats


def holed(seed, n):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=n)
    frame = pd.DataFrame({"a": base, "b": base + rng.normal(size=n), "c": 1e9 + rng.normal(size=n), "d": rng.integers(0, 3, n).astype(float), "e": 7.25})
    for c in "abcd":
        frame.loc[rng.random(n) < 0.2, c] = np.nan
    return frame.assign(f=np.nan, g=np.where(rng.random(n) < 0.3, None, rng.choice(["x", "y"], n)))


@pytest.mark.parametrize("parts", [1, 7])
@pytest.mark.parametrize("held", [256, 1])
def test_correlations_are_pairwise_complete(spark, monkeypatch, parts, held):
    monkeypatch.setattr(stats, "GROUPS_HELD", held)
    frame = holed(3, 500)
    table = spark.createDataFrame(frame.astype({"g": object}).where(frame.notna(), None), "a double, b double, c double, d double, e double, f double, g string")
    names = list("abcdef")
    for by in ((), ("g",)):
        got = stats.corr_matrix(table.repartition(parts), names, by).toPandas()
        groups = [((), frame)] if not by else [((k,), part) for k, part in frame.groupby(frame.g.fillna("none"))]
        assert len(got) == len(groups) * 36
        for key, part in groups:
            mine = got if not by else got[got.g.fillna("none") == key[0]]
            want = part[names].corr()
            for r in mine.itertuples():
                expected = want.loc[r.row_name, r.col_name] if "e" not in (r.row_name, r.col_name) else math.nan
                assert (math.isnan(expected) and pd.isna(r.corr)) or abs(r.corr - expected) < 1e-7


def test_moments_merge_like_one_batch():
    rng = np.random.default_rng(2)
    values = rng.normal(3_000, 2, (400, 4))
    values[rng.random(values.shape) < 0.3] = np.nan
    values[:200, 3] = np.nan
    whole = stats.pair_moments(values)
    cut = stats.merged_moments(stats.merged_moments(stats.pair_moments(values[:150]), stats.pair_moments(values[150:160])), stats.pair_moments(values[160:]))
    assert np.allclose(whole, cut, rtol=1e-9, atol=1e-6)


def test_correlation_rows_do_not_grow_with_the_table(spark):
    made = spark.range(20_000).select(*[F.rand(i).alias(f"x{i}") for i in range(6)])
    plan = stats.corr_matrix(made, [f"x{i}" for i in range(6)])._jdf.queryExecution().optimizedPlan().toString()
    # what is exploded are the pairs' results, not the rows
    assert plan.index("Generate") < plan.index("Aggregate") < plan.index("MapInArrow")


@pytest.mark.parametrize("n,kind", [(5, "normal"), (400, "normal"), (3_000, "heavy"), (2_000, "few")])
def test_density_equals_the_exact_sum(spark, n, kind):
    rng = np.random.default_rng(n)
    x = {"normal": rng.normal(3_000, 400, n), "heavy": rng.standard_t(1.5, n), "few": rng.integers(0, 5, n).astype(float)}[kind]
    table = spark.createDataFrame(pd.DataFrame({"x": x, "y": np.where(rng.random(n) < 0.1, np.nan, x * 2), "z": 1.0}))
    got = stats.density_grid(table, ["x", "y", "z"], gridsize=50).orderBy("variable", "point").toPandas()
    for name in ("x", "y"):
        values = table.select(name).toPandas()[name].dropna().to_numpy()
        h = len(values) ** -0.2 * values.std(ddof=1)
        mine = got[got.variable == name]
        grid = np.linspace(values.min() - 3 * h, values.max() + 3 * h, 50)
        exact = np.exp(-0.5 * ((grid[:, None] - values[None]) / h) ** 2).sum(axis=1) / (len(values) * h * math.sqrt(2 * math.pi))
        assert len(mine) == 50 and np.allclose(mine.x, grid) and np.abs(mine.density - exact).max() < 1e-12 * exact.max()
    assert set(got.variable) == {"x", "y"}
