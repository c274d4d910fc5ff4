"""Five stages from raw documents to a mixed corpus. Each is written as Parquet and read again as the next one's input.

All stages but the last return the columns of their input, whatever these are; the last one adds what the mix takes. Null and
empty texts have no words and are rejected by the first stage. Null ids and sources are values like others; of repeated rows one
is left by the second stage, and of rows that share an id the one with the least text. Columns other than doc_id, text, source and
n_chars are handed on, whatever their names. Empty tables give empty results.
"""

import os
import sys

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fieldlens.llm import credentials, decontaminate, mixing, quality, simhash  # noqa: E402
from fieldlens.session import materialize, remove_tables, written  # noqa: E402


def _with_text(docs, new):
    """The columns of ``docs``, its text replaced by column ``new`` and n_chars counted again."""
    return [F.col(new).alias("text") if c == "text" else F.length(new).cast("long").alias("n_chars") if c == "n_chars"
            else F.col(f"`{c}`") for c in docs.columns]


def _same_row():
    """Join condition of a result (columns __llm_id, __llm_key) with the rows it was made from."""
    return F.col("doc_id").eqNullSafe(F.col("__llm_id")) & (F.xxhash64("text") == F.col("__llm_key"))


def _results(found, *columns):
    """One result per id and text: rows that a table repeats have the same."""
    keys = [F.col("doc_id").alias("__llm_id"), F.col("text_key").alias("__llm_key")]
    return found.groupBy(*keys).agg(*[F.first(c).alias(f"__llm_{c}") for c in columns]) if columns else found.select(*keys).distinct()


def quality_stage(spark, docs, sf_dir):
    """Rejected documents go; the others lose the lines that the method removes."""
    judged = quality.quality_rules(docs, with_lines=True).filter("kept")
    found = judged.groupBy(F.col("doc_id").alias("__llm_id"), F.col("text_key").alias("__llm_key"), F.col("host").alias("__llm_host")).agg(
        F.first("removed").alias("__llm_removed"))
    same = _same_row() & F.col("source").eqNullSafe(F.col("__llm_host"))
    both = docs.join(found, same).withColumn("__llm_text", F.expr(quality.without_lines("text", "__llm_removed")))
    return both.select(*_with_text(docs, "__llm_text"))


def near_duplicate_stage(spark, docs, sf_dir):
    """One document of each component stays, the one with the smallest id; of several rows with that id one stays."""
    found = materialize(simhash.near_duplicates(docs, width=3, distance=2), "pipeline-components")
    first = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    groups = first.groupBy("doc_id").count()
    single = groups.filter("count = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("__llm_id"))
    several = materialize(groups.filter("count > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("__llm_id")), "pipeline-repeated")
    kept = docs.join(single, F.col("doc_id") == F.col("__llm_id"), "left_semi")
    # ids that several rows carry, and rows without an id: one row per text, then the first text of an id
    rest = docs.join(several, F.col("doc_id").eqNullSafe(F.col("__llm_id")), "left_semi").withColumn("__llm_row", F.struct("*"))
    named = rest.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min_by("__llm_row", "text").alias("__llm_row")).select("__llm_row.*")
    unnamed = rest.filter("doc_id IS NULL").groupBy(F.xxhash64("text")).agg(F.min_by("__llm_row", "text").alias("__llm_row")).select("__llm_row.*")
    return kept.unionByName(named).unionByName(unnamed)


def decontamination_stage(spark, docs, sf_dir):
    """Documents with a window of a benchmark item go, and those that have all its words close together in another order."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contamination(docs, items, window=10).filter("contaminated OR n_near > 0")
    found = materialize(_results(found), "pipeline-contaminated")
    return docs.join(found, _same_row(), "left_anti")


def secret_stage(spark, docs, sf_dir):
    """Secrets are replaced by a mark."""
    found = materialize(_results(credentials.secret_spans(docs).filter(F.size("spans") > 0), "spans"), "pipeline-secrets")
    both = docs.join(found, _same_row(), "left")
    marked = F.when(F.col("__llm_spans").isNull(), F.col("text")).otherwise(
        credentials.redact(F.col("text"), F.col("__llm_spans")))
    return both.withColumn("__llm_text", marked).select(*_with_text(docs, "__llm_text"))


def mixing_stage(spark, docs, sf_dir):
    """Documents that the mix takes words of, with the number of words it takes."""
    return mixing.mix_sources(docs, carry=docs.columns).filter("taken > 0")


STAGES = [
    ("quality rules", quality_stage),
    ("simhash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scans", secret_stage),
    ("mixing sources", mixing_stage),
]

# SimHash, the randomness tests and the seeded choice of blocks have no SQL form; tests/llm holds brute-force checks.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``; every stage starts from the written rows of the one before.

    Once a stage's rows are written, what it and the stage before it have left in the shared folder is removed.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), len(written(spark))
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, "stage-" + name.replace(" ", "-"))
            remove_tables(spark, since=before, keep=1)
    return docs
