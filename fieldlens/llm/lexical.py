"""Ranked lexical search with a document FP-tree and branch and bound.

1. Every document is read once: its length, and how often it holds each term of the items. These restricted vectors are
   written; the corpus counts (documents, terms, documents a term is in) come from all of them.
2. A part of the documents becomes a tree. Each vector lists its terms from the most frequent of the corpus to the rarest,
   so documents with the same frequent terms share a path from the root. Branches of few documents are buckets.
3. A node holds the greatest tf of every term below it and the least m. The score of a document grows with tf and falls with
   m, so the two give a bound for every document below the node.
4. For an item the tree is searched depth first, best bound first. A branch whose bound can't reach the k-th score found so
   far is left out whole; a bucket that can is scored exactly. What a task has found goes on from tree to tree.

All numbers but the weights' logarithm are 64-bit integers. Items come in blocks of bounded size, and each block reads the
documents for itself, so what a task holds of the items is bounded.
"""

import math
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from fieldlens.llm.common import keep, materialize

# Terms of the items (repeats counted) in one block, sent to every task.
BLOCK_TERMS = 200_000
# Documents of a tree, and terms in all their vectors (one document more may pass it).
TREE_DOCS = 4_096
TREE_ENTRIES = 2_000_000
BUCKET_DOCS = 32
# Bytes that part terms: ASCII other than digits and letters; capitals become small letters.
_PART = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in _PART)


def terms_of(text):
    """The terms of a text as UTF-8 bytes; null has none."""
    return (text or "").encode().translate(_FOLD).split()


# --- restricted vectors -----------------------------------------------------

def restricted_vectors(docs, vocabulary, text="text", doc_id="doc_id"):
    """A row per document with terms: id, n (its terms), ids and tfs (its terms of the vocabulary, a dictionary from term to number)."""
    id_field = docs.schema[doc_id]
    schema = f"id {id_field.dataType.simpleString()}, n long, ids array<int>, tfs array<long>"

    def read(batches):
        known = vocabulary.value
        for batch in batches:
            rows, sizes, ids, tfs = [], [], [], []
            for i, value in enumerate(batch.column(text)):
                found = terms_of(value.as_py())
                if found:
                    counts = Counter(found)
                    mine = sorted((known[t], n) for t, n in counts.items() if t in known)
                    rows.append(i)
                    sizes.append(len(found))
                    ids.append([t for t, _ in mine])
                    tfs.append([n for _, n in mine])
            yield pa.RecordBatch.from_arrays([
                batch.column(doc_id).take(pa.array(rows, pa.int64())), pa.array(sizes, pa.int64()), pa.array(ids, pa.list_(pa.int32())),
                pa.array(tfs, pa.list_(pa.int64()))], names=["id", "n", "ids", "tfs"])

    return keep(docs, doc_id, text).withColumn(text, F.col(text).cast("string")).mapInArrow(read, schema)


def term_weight(documents, df):
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def length_factors(n, documents, total):
    """m of documents with n terms."""
    return 100 - 75 + (75 * n * documents) // total


def saturated(tf, m):
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


# --- tree -------------------------------------------------------------------

class Node:
    __slots__ = ("lo", "hi", "terms", "parts", "least_id", "children")

    def __init__(self, lo, hi, children=()):
        self.lo, self.hi, self.children = lo, hi, children


class Tree:
    """FP-tree of documents given as ids, m, the number of their terms, and all terms' ranks (ascending in each document) with their tf."""

    def __init__(self, ids, m, sizes, ranks, tf, bucket=BUCKET_DOCS):
        starts = np.concatenate([[0], np.cumsum(sizes)])
        # four bytes a rank, the highest first: such paths sort as the ranks do
        path = ranks.astype(">u4").tobytes()
        paths = [path[4 * a:4 * b] for a, b in zip(starts[:-1], starts[1:], strict=True)]
        order = np.array(sorted(range(len(ids)), key=paths.__getitem__), dtype="int64")
        self.ids, self.m, self.paths, self.bucket = [ids[i] for i in order], m[order], [paths[i] for i in order], bucket
        sizes = sizes[order]
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        moved = np.arange(self.starts[-1]) + np.repeat(starts[order] - self.starts[:-1], sizes)
        self.terms, self.tf = ranks[moved], tf[moved]
        self.parts = saturated(self.tf, np.repeat(self.m, sizes))
        self.root = self._node(0, len(ids), 0) if ids else None

    def _node(self, lo, hi, depth):
        """Node of the documents lo..hi, which share their first ``depth`` terms."""
        children, paths = [], self.paths

        def term(i):
            return paths[i][4 * depth:4 * depth + 4]  # empty where the path has ended

        if hi - lo > self.bucket:
            # what all share goes into the path of this node
            while term(lo) and term(lo) == term(hi - 1):
                depth += 1
            at, small = lo, lo
            while at < hi:
                low, high, branch = at, hi, term(at)
                while high - low > 1:  # the last document of the branch
                    middle = (low + high) // 2
                    low, high = (middle, high) if term(middle) == branch else (low, middle)
                end = high
                if end - at > self.bucket and end - at < hi - lo:
                    if at > small:
                        children.append(self._bound(Node(small, at)))
                    children.append(self._node(at, end, depth + 1) if branch else self._bound(Node(at, end)))
                    small = end
                elif end - small > self.bucket:  # small branches side by side share a bucket
                    if at > small:
                        children.append(self._bound(Node(small, at)))
                    small = at
                at = end
            if hi > small and (children or small > lo):
                children.append(self._bound(Node(small, hi)))
        return self._bound(Node(lo, hi, tuple(children)))

    def _bound(self, node):
        """What each term below the node is worth at most, by its greatest tf and the least m; least id (a null id is none)."""
        lo, hi = self.starts[node.lo], self.starts[node.hi]
        terms, tf = self.terms[lo:hi], self.tf[lo:hi]
        order = np.argsort(terms, kind="stable")
        node.terms, at = np.unique(terms[order], return_index=True)
        most = np.maximum.reduceat(tf[order], at) if len(at) else np.zeros(0, "int64")
        node.parts = saturated(most, self.m[node.lo:node.hi].min())
        node.least_id = min((i for i in self.ids[node.lo:node.hi] if i is not None), default=None)
        return node

    @staticmethod
    def bound(node, worth):
        """No document below the node scores more for the item, of which ``worth`` has the weight of every term."""
        return int((worth[node.terms] * node.parts).sum())

    def scores(self, lo, hi, worth):
        """Exact scores of the documents lo..hi."""
        starts = self.starts[lo:hi + 1]
        sums = np.zeros(starts[-1] - starts[0] + 1, dtype="int64")
        np.cumsum(worth[self.terms[starts[0]:starts[-1]]] * self.parts[starts[0]:starts[-1]], out=sums[1:])
        return np.diff(sums[starts - starts[0]])

    def search(self, worth, best, k):
        """Add to ``best``, the first k (-score, id is null, id) so far in order, what the tree has for the item."""
        stack = [(self.bound(self.root, worth), self.root)] if self.root else []
        while stack:
            bound, node = stack.pop()
            if bound <= 0:
                continue
            if len(best) == k:
                score, null, last = -best[-1][0], best[-1][1], best[-1][2]
                if bound < score or bound == score and not null and (node.least_id is None or node.least_id >= last):
                    continue
            if node.children:
                stack.extend(sorted(((self.bound(c, worth), c) for c in node.children), key=lambda b: b[0]))
                continue
            scores = self.scores(node.lo, node.hi, worth)
            bar = -best[-1][0] if len(best) == k else 1
            for i in np.flatnonzero(scores >= bar):
                name = self.ids[node.lo + i]
                best.append((-int(scores[i]), name is None, name))
            best.sort(key=lambda b: (b[0], b[1], b[2] or 0))
            del best[k:]


def tree_search(vectors, query, k, tree_docs=TREE_DOCS, bucket=BUCKET_DOCS):
    """The first k documents of each item among the vectors of each task: (item, id, score).

    ``query`` (broadcast): rank of each term by falling document frequency, weight of each rank, the corpus counts and the items.
    """
    id_type = vectors.schema["id"].dataType

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        ranks, weights, documents, total, items = query.value
        asked = []
        for item, counts in items:
            terms = ranks[np.array(list(counts), dtype="int64")]
            asked.append((item, terms, weights[terms] * np.array(list(counts.values()), dtype="int64"), []))
        worth = np.zeros(len(ranks), dtype="int64")
        held, n_held = [], 0

        def grow():
            ids = [i for part in held for i in part[0]]
            n, sizes, found, tf = (np.concatenate([part[c] for part in held]) for c in range(1, 5))
            rank = ranks[found]
            order = np.lexsort((rank, np.repeat(np.arange(len(sizes)), sizes)))
            tree = Tree(ids, length_factors(n, documents, total), sizes, rank[order], tf[order], bucket)
            for _, terms, weight, best in asked:
                worth[terms] = weight
                tree.search(worth, best, k)
                worth[terms] = 0

        for batch in batches:
            sizes = np.diff(batch.column("ids").offsets.to_numpy()).astype("int64")
            entries = np.cumsum(sizes)
            lo = 0
            while lo < batch.num_rows:
                # as many documents as a tree may still take, by number and by entries
                before = entries[lo] - sizes[lo]
                hi = max(lo + 1, min(lo + tree_docs - n_held, int(np.searchsorted(entries, before + TREE_ENTRIES, "right"))))
                part = batch.slice(lo, hi - lo)
                flat = [part.column(c).flatten().to_numpy(zero_copy_only=False).astype("int64") for c in ("ids", "tfs")]
                held.append((part.column("id").to_pylist(), part.column("n").to_numpy(), sizes[lo:hi], *flat))
                n_held += hi - lo
                if n_held >= tree_docs or sum(len(part[3]) for part in held) >= TREE_ENTRIES:
                    grow()
                    held, n_held = [], 0
                lo = hi
        if held:
            grow()
        rows = [(item, name, -score) for item, _, _, best in asked for score, _, name in best]
        yield pa.RecordBatch.from_arrays([
            pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], to_arrow_type(id_type)),
            pa.array([r[2] for r in rows], pa.int64())], names=["item", "id", "score"])

    return vectors.mapInArrow(run, f"item long, id {id_type.simpleString()}, score long")


# --- search -----------------------------------------------------------------

def _search_block(docs, block, k, text, doc_id, tree_docs, bucket):
    """First k of each item of one block: (item, id, score) rows of every task."""
    spark = docs.sparkSession
    counted = [(r["item"], Counter(terms_of(r["text"]))) for r in block]
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, c in counted for t in c}))}
    vectors = materialize(restricted_vectors(docs, spark.sparkContext.broadcast(vocabulary), text, doc_id), "restricted-vectors")
    documents, total = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    # one row per term of the block
    df = np.zeros(len(vocabulary), dtype="int64")
    for term, n in vectors.select(F.explode("ids").alias("term")).groupBy("term").count().collect():
        df[term] = n
    order = np.lexsort((np.arange(len(df)), -df))
    ranks = np.empty(len(df), dtype="int64")
    ranks[order] = np.arange(len(df))
    weights = np.array([term_weight(documents, int(df[t])) for t in order], dtype="int64")
    items = [(item, {vocabulary[t]: n for t, n in c.items()}) for item, c in counted]
    query = spark.sparkContext.broadcast((ranks, weights, documents, max(total, 1), items))
    return tree_search(vectors, query, k, tree_docs, bucket)


def ranked_search(docs, items, k=10, text="text", doc_id="doc_id", item_text="text", item_id="item_id", block_terms=BLOCK_TERMS,
                  tree_docs=TREE_DOCS, bucket=BUCKET_DOCS):
    """(item_id, rank, doc_id, score): the ``k`` documents that score highest for every item, score above 0.

    A term weighs floor(1000 ln((2 N + 2) / (2 df + 1))); a document's score is the sum of weight * (10^9 tf div (1000 tf + 8 m)) over the
    item's terms, repeats included, with m = 25 + 75 n N div L. Equal scores by ascending doc_id, a null id last; ranks are unique. Every
    row is a document, repeated rows each. Null texts and texts without terms have no score; an item without terms has no
    rows. Equal item rows are one item, other texts under the same id are ranked for themselves. Whole texts count;
    other columns are not read. Empty documents or items give an empty result.

    Items are dealt by hash into blocks of about ``block_terms`` terms; each block reads the documents once.
    """
    tests = keep(items, item_id, item_text).select(F.col(item_id).alias("item_id"), F.col(item_text).cast("string").alias("text")).distinct()
    tests = materialize(tests.withColumn("item", F.xxhash64("item_id", "text")), "search-items")
    # a bound of the terms: every other byte
    size = tests.agg(F.sum(F.octet_length("text") / 2 + 1)).first()[0] or 0
    blocks = max(1, math.ceil(size / block_terms))
    near = []
    for b in range(blocks):
        block = tests.filter(F.pmod(F.col("item"), F.lit(blocks)) == b).select("item", "text").collect()
        if block:
            near.append(_search_block(docs, block, k, text, doc_id, tree_docs, bucket))
    if not near:
        kind = docs.schema[doc_id].dataType.simpleString()
        near = [docs.sparkSession.createDataFrame([], f"item long, id {kind}, score long")]
    found = reduce(lambda a, b: a.unionByName(b), near).filter("score > 0")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    first = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return first.join(tests.select("item", "item_id"), "item").select("item_id", "rank", F.col("id").alias("doc_id"), "score")
