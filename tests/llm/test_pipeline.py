"""The pipeline beside a brute-force version, and the registered queries beside their SQL."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import plain
from check_oracle import connect, differences
from fieldlens.llm import workload
from fieldlens.session import written
from test_text_operators import ODD, prose

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents():
    item = " ".join(f"omega{i}" for i in range(14))
    docs = [(1000 + i, prose(i, 60 + i % 9) + "\nClick here to go on\n" + prose(400 + i, 6), "abc"[i % 3]) for i in range(120)]
    docs += [(2000 + i, docs[i % 5][1] + (" end" if i % 2 else ""), "c") for i in range(20)]
    docs += [(3000, prose(71, 70) + " " + item, "a"), (3001, prose(72, 70) + ' token = "0123456789abcdef0123456789abcdef" ' + prose(73, 9), "b")]
    docs += [(3002, prose(74, 70), "a"), (3002, prose(75, 70), "a"), (3003, prose(76, 70), "b"), (3003, prose(76, 70), "b")]
    return [(d, t, "en", s, len(t or "")) for d, t, s in docs + ODD], [(1, item), (2, None)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    docs, items = documents()
    spark.createDataFrame(docs, SCHEMA).withColumn("spans", F.lit("x")).withColumn("removed", F.lit(1)).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_equal_brute_force(spark, folder):
    docs, items = documents()
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    columns = frame.columns

    def stage(i):
        nonlocal frame
        frame = corpus_pipeline.materialize(corpus_pipeline.STAGES[i][1](spark, frame, folder), "test-stage")
        return sorted(((r.doc_id, r.text, r.source) for r in frame.collect()), key=repr)

    judged = plain.quality([(d, t, s) for d, t, _, s, _ in docs])
    kept = sorted(((d, judged[d, t, s][1], s) for d, t, _, s, _ in docs if judged[d, t, s][0]), key=repr)
    assert stage(0) == kept and frame.columns == columns
    assert frame.filter("n_chars <> length(text)").count() == 0

    groups = {}
    for row, c in zip(kept, plain.components([plain.fingerprint(t) for _, t, _ in kept]), strict=True):
        groups.setdefault(c, []).append(row)
    first = []
    for rows in groups.values():
        ids = [d for d, _, _ in rows if d is not None]
        first.append(min((r for r in rows if r[0] == (min(ids) if ids else None)), key=lambda r: r[1]))
    second = stage(1)
    # of several rows of one id in different components the first text stays
    assert {d for d, _, _ in second} == {d for d, _, _ in first} and len({d for d, _, _ in second}) == len(second)
    assert set(second) <= set(first)

    third = [r for r in second if not plain.contamination(r[1], items)[1]]
    assert stage(2) == sorted(third, key=repr) and 3000 not in {d for d, _, _ in third}

    fourth = stage(3)
    assert [d for d, _, _ in fourth] == [d for d, _, _ in sorted(third, key=repr)]
    changed = {d: t for (d, t, _), (_, before, _) in zip(fourth, sorted(third, key=repr), strict=True) if t != before}
    assert list(changed) == [3001] and "<secret>" in changed[3001] and "0123456789abcdef" not in changed[3001]

    last = corpus_pipeline.STAGES[4][1](spark, frame, folder).toPandas()
    assert set(last.doc_id.dropna()) <= {d for d, _, _ in fourth} and (last.taken > 0).all()
    want = plain.targets({s: sum(len(plain.words(t)) for _, t, x in fourth if x == s) for s in {s for _, _, s in fourth}})
    for s, group in last.groupby("source"):
        assert abs(group.taken.sum() - want[s]) < 0.05 * want[s] + 100


def test_run_repeats_and_takes_empty_tables(spark, folder, tmp_path):
    once, again = (sorted(map(tuple, corpus_pipeline.run(spark, folder).select("doc_id", "taken").collect()), key=repr) for _ in range(2))
    assert once == again and once
    before = len(written(spark))
    corpus_pipeline.run(spark, folder)
    # what is left: the last stage's input and what its own result is read from
    left = written(spark)[before:]
    assert [p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in left][0] == "stage-secret-scans"
    assert all(p.rsplit("/", 1)[1].startswith("mixing") for p in left[1:])
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not here")
@pytest.mark.parametrize("name", sorted(workload.ORACLES))
def test_query_equals_sql(spark, name):
    assert differences(workload.QUERIES[name](spark, FOLDER).toPandas(), connect(FOLDER).execute(workload.ORACLES[name]).df()) is None
