"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

A source's documents lie in a seeded order in shards of similar size; a shard's words are cut into blocks of
``block_words``, fewer where the smallest target would not hold ``MIN_BLOCKS`` of them. Highest quotients (w / 1, w / 3, w / 5 ...) first
give every source its number of blocks, then every bundle of a source's shards, then every shard its integer quota. A quota of at least one whole pass takes every document that often; the blocks left
over follow from a seeded starting block on, in the shard's cyclic order. Blocks are counted, never listed, so their
number costs nothing.
"""

import heapq

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from fieldlens.llm.common import WORD, keep, materialize, need

WEIGHTS = (5, 2, 1)
BLOCK_WORDS = 32
MIN_BLOCKS = 100
SHARD_DOCS = 1_000
BUNDLE_SHARDS = 1_000
MAX_REPEATS = 3


def sainte_lague(weights, seats, caps):
    """Seats of each party by the highest quotients weight / (2 k + 1), none above its cap; ties go to the first.

    Starts from the rounded quotas, which are themselves such an allotment of their own sum, and adds or takes back
    single seats until ``seats`` are given or all are at their cap.
    """
    weights, caps = np.asarray(weights, dtype="float64"), np.asarray(caps, dtype="int64")
    caps = np.where(weights > 0, caps, 0)
    total = weights.sum()
    if total <= 0 or seats <= 0:
        return np.zeros(len(weights), dtype="int64")
    given = np.minimum(np.floor(weights * seats / total + 0.5).astype("int64"), caps)
    left = min(int(seats), int(caps.sum())) - int(given.sum())
    if left < 0:
        heap = [(weights[i] / (2 * given[i] - 1), -i) for i in np.flatnonzero(given)]
        heapq.heapify(heap)
        for _ in range(-left):
            i = -heap[0][1]
            given[i] -= 1
            if given[i]:
                heapq.heapreplace(heap, (weights[i] / (2 * given[i] - 1), -i))
            else:
                heapq.heappop(heap)
    else:
        heap = [(-weights[i] / (2 * given[i] + 1), i) for i in np.flatnonzero(given < caps)]
        heapq.heapify(heap)
        for _ in range(left):
            i = heap[0][1]
            given[i] += 1
            if given[i] < caps[i]:
                heapq.heapreplace(heap, (-weights[i] / (2 * given[i] + 1), i))
            else:
                heapq.heappop(heap)
    return given


def source_targets(sized, source="source", size="size", weights=WEIGHTS, max_repeats=MAX_REPEATS):
    """One row per source: its number by code point (null last), documents, words and target.

    Targets share all words by weight and stop at ``max_repeats`` times the source's words; what is cut goes to the others
    by weight until none is above. In the order of cap / weight the capped sources come first, so one running sum finds
    the level that the others share. The two windows hold one row per source.
    """
    sources = sized.groupBy(source).agg(F.count(F.lit(1)).alias("n_docs"), F.sum(size).alias("source_size"))
    every = Window.orderBy(F.col(source).asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("source_no") % len(weights) + 1).cast("int"))
    sources = sources.withColumn("source_no", F.row_number().over(every) - 1).withColumn("weight", weight)
    sources = sources.withColumn("most", F.col("source_size") * max_repeats)
    by_need = Window.orderBy(F.col("most") / F.col("weight"), "source_no")
    before, all_rows = by_need.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    sources = sources.withColumn("level", (
        F.sum("source_size").over(all_rows) - F.coalesce(F.sum("most").over(before), F.lit(0))
    ) / (F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    fits = F.col("most") / F.col("weight") >= F.col("level")
    level = F.min(F.when(fits, F.struct("most_by_weight", "source_no", "level"))).over(all_rows)["level"]
    sources = sources.withColumn("most_by_weight", F.col("most") / F.col("weight"))
    target = F.least(F.col("most").cast("double"), F.col("weight") * F.coalesce(level, F.col("level")))
    return sources.select(source, "source_no", "n_docs", "source_size", target.alias("target"))


def _source_seats(block_words, max_repeats):
    def seats(frame):
        frame = frame.sort_values("source_no")
        n = int(np.floor(frame["source_size"].sum() / block_words + 0.5))
        most = -(-frame["source_size"].to_numpy("int64") * max_repeats // block_words)
        frame["seats"] = sainte_lague(frame["target"], n, most)
        return frame[["source_no", "seats"]]

    return seats


def _quotas(max_repeats, unit):
    """Function from the rows (``unit``, size, blocks, seats) of one source or bundle to their quotas of its seats."""

    def quotas(frame):
        frame = frame.sort_values(unit)
        caps = frame["blocks"].to_numpy("int64") * max_repeats
        frame["quota"] = sainte_lague(frame["shard_size"], int(frame["seats"].iloc[0]), caps)
        return frame

    return quotas


def mix_sources(docs, text="text", source="source", doc_id="doc_id", carry=(), weights=WEIGHTS, max_repeats=MAX_REPEATS,
                block_words=BLOCK_WORDS, shard_docs=SHARD_DOCS, seed=7):
    """One row per row of ``docs``: doc_id, the columns in ``carry``, size, source_size, target, taken.

    size: words of the whole text (null or empty: 0). taken: words the mix takes of the document, repeats counted, at most
    ``max_repeats`` times its size. Blocks have ``block_words`` words, or so many fewer that the smallest target holds 100. Null sources are one source, the last. Documents with a null id, repeated rows and ties
    keep their own places in the seeded order; rows that agree in all of it are interchangeable. A carried
    column with the name of a result makes way for it; other columns are not read. An empty table gives an empty result.
    """
    need(docs, doc_id, text, source, *carry)
    made = {doc_id.lower(), "size", "source_size", "target", "taken"}
    carry = [c for c in dict.fromkeys(carry) if c.lower() not in made]
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    read = keep(docs, *dict.fromkeys([doc_id, source, text, *carry]))
    rows = read.select(F.col(doc_id).alias("__id"), F.col(source).alias("__source"), size.alias("size"),
                       *([F.struct(*[F.col(f"`{c}`") for c in carry]).alias("__row")] if carry else []))
    sized = materialize(rows.select("__id", "__source", "size"), "mixing-sizes")
    if not carry:
        rows = sized

    sources = materialize(source_targets(sized, "__source", "size", weights, max_repeats), "mixing-targets")
    least = sources.filter("target > 0").agg(F.min("target")).first()[0]
    block_words = max(1, min(block_words, int((least or 0) // MIN_BLOCKS)))
    seats = sources.groupBy().applyInPandas(_source_seats(block_words, max_repeats), "source_no int, seats long")
    sources = materialize(sources.join(seats, "source_no").withColumn(
        "n_shards", F.ceil(F.col("n_docs") / shard_docs)).withColumnRenamed("__source", "__name"), "mixing-sources")

    def placed(frame):
        with_source = frame.join(sources, F.col("__source").eqNullSafe(F.col("__name"))).drop("__name", "n_docs")
        return with_source.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "__id"), F.col("n_shards")))

    shards = placed(sized).groupBy("source_no", "shard").agg(
        F.sum("size").alias("shard_size"), F.first("seats").alias("seats")
    ).withColumn("blocks", F.ceil(F.col("shard_size") / block_words))
    # a source may have very many shards: bundles of them share its seats first
    shards = materialize(shards.withColumn("bundle", F.floor(F.col("shard") / BUNDLE_SHARDS)), "mixing-shards")
    bundles = shards.groupBy("source_no", "bundle").agg(
        F.sum("shard_size").alias("shard_size"), F.sum("blocks").alias("blocks"), F.first("seats").alias("seats"))
    bundles = bundles.groupBy("source_no").applyInPandas(
        _quotas(max_repeats, "bundle"), "source_no int, bundle long, shard_size long, blocks long, seats long, quota long")
    shards = shards.drop("seats").join(bundles.select("source_no", "bundle", F.col("quota").alias("seats")), ["source_no", "bundle"])
    quotas = materialize(shards.groupBy("source_no", "bundle").applyInPandas(
        _quotas(max_repeats, "shard"), "source_no int, bundle long, shard long, shard_size long, blocks long, seats long, quota long").select(
            "source_no", "shard", "shard_size", "blocks", "quota"), "mixing-quotas")

    order = Window.partitionBy("source_no", "shard").orderBy(
        F.xxhash64(F.lit(seed + 1), "__id"), "__id", "size").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("size").over(order), F.lit(0))
    found = placed(rows).withColumn("__start", start).join(quotas, ["source_no", "shard"])

    # the quota's rest: blocks first .. first + rest - 1, in cyclic order
    rest, blocks = F.expr("quota % greatest(blocks, 1)"), F.greatest("blocks", F.lit(1))
    first = F.pmod(F.xxhash64(F.lit(seed + 2), "source_no", "shard"), blocks)
    found = found.withColumns({"__rest": rest, "__first": first})
    end = F.col("__start") + F.col("size")

    def overlap(lower, upper):
        upper, lower = F.least(upper * block_words, F.col("shard_size")), lower * block_words
        return F.greatest(F.lit(0), F.least(end, upper) - F.greatest(F.col("__start"), lower))

    part = overlap(F.col("__first"), F.col("__first") + F.col("__rest")) + F.when(
        F.col("__first") + F.col("__rest") > F.col("blocks"),
        overlap(F.lit(0), F.col("__first") + F.col("__rest") - F.col("blocks"))).otherwise(0)
    passes = F.expr("quota div greatest(blocks, 1)")
    taken = (passes * F.col("size") + part).cast("long").alias("taken")
    return found.select(F.col("__id").alias(doc_id), *(["__row.*"] if carry else []), "size", "source_size", "target", taken)
