"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on each document. Expectation-maximisation over the counts of all
vote patterns (of all documents) estimates how often each labeller votes what under either class, and the posterior of each
pattern. A linear scorer over hashed shapes of the text is trained on these posteriors and judges every document, also
where no labeller votes.
"""

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.llm.common import keep, materialize, seeded_first, text_groups

GOOD, BAD, NONE = "1", "0", "-"
SYMBOLS = re.compile(r"[#*$%&|<>~^\\{}]")
SENTENCE = re.compile(r"[.!?]")
RUN = re.compile(r"([^\w\s.\-])\1\1")
LETTERS = re.compile(r"[^\W\d_]+")
CAPITALS = re.compile(r"[A-ZÀ-ÖØ-Þ]+")
# Bounds of the sample the scorer is trained on: documents and characters of one document.
TRAIN_DOCS, TRAIN_DOC_CHARS = 6_000, 30_000
FEATURES = 1 << 16
KNOWN_WORDS = 400_000

_KNOWN = {}


def _vote(x, bad_above=None, good_below=None, bad_below=None, good_above=None):
    if (bad_above is not None and x > bad_above) or (bad_below is not None and x < bad_below):
        return BAD
    if (good_below is not None and x <= good_below) or (good_above is not None and x >= good_above):
        return GOOD
    return NONE


def reading(text):
    """What labellers and scorer both look at: words, how often each occurs, pairs of neighbours, lines with a word."""
    words = (text or "").split()
    return words, Counter(words), set(zip(words, words[1:], strict=False)), [line for line in (text or "").split("\n") if line.strip()]


def measures(text, read=None):
    """Numbers that the labellers look at."""
    words, counts, pairs, lines = read or reading(text)
    n = len(words)
    letters, upper = (sum(map(len, kind.findall(text))) for kind in (LETTERS, CAPITALS))
    return {
        "words": n, "symbols": len(SYMBOLS.findall(text)) / max(n, 1), "upper": upper / max(letters, 1),
        "runs": len(RUN.findall(text)) / max(n, 1), "shouts": text.count("!!") / max(n, 1), "distinct": len(counts) / max(n, 1),
        "top": max(counts.values()) / n if n else 0.0, "pairs": len(pairs) / max(n - 1, 1),
        "copied_lines": 1 - len(set(lines)) / max(len(lines), 1), "sentences": len(SENTENCE.findall(text)) / max(n, 1),
        "single": sum(len(w) == 1 for w in words) / max(n, 1), "mean": sum(map(len, words)) / max(n, 1),
    }


# Each labeller looks at its own measure and says nothing between its limits.
LABELLERS = (
    ("symbols", lambda m: _vote(m["symbols"], bad_above=0.15, good_below=0.02)),
    ("capitals", lambda m: _vote(m["upper"], bad_above=0.5, good_below=0.15)),
    ("symbol runs", lambda m: _vote(m["runs"], bad_above=0.1, good_below=0.01)),
    ("shouting", lambda m: _vote(m["shouts"], bad_above=0.1, good_below=0.0)),
    ("same word", lambda m: _vote(m["top"], bad_above=0.3, good_below=0.15) if m["words"] >= 10 else NONE),
    ("same pairs", lambda m: _vote(m["pairs"], bad_below=0.5, good_above=0.85) if m["words"] >= 20 else NONE),
    ("few words", lambda m: _vote(m["distinct"], bad_below=0.15, good_above=0.4) if m["words"] >= 20 else NONE),
    ("same lines", lambda m: _vote(m["copied_lines"], bad_above=0.4, good_below=0.1)),
    ("fragments", lambda m: _vote(m["single"], bad_above=0.3, good_below=0.15)),
    ("sentences", lambda m: _vote(m["sentences"], bad_above=0.6, bad_below=0.005, good_below=0.4) if m["words"] >= 20 else NONE),
)


def votes(text, read=None):
    """A character per labeller; a text without words gets no votes."""
    if not text or not text.strip():
        return NONE * len(LABELLERS)
    m = measures(text, read)
    return "".join(f(m) for _, f in LABELLERS)


def fit_votes(patterns, rounds=200, tolerance=1e-9):
    """({pattern: posterior of good}, prior, accuracies (labeller, class)) from {pattern: documents}.

    Starts from the belief that a pattern is bad if any labeller says so, which also fixes which class is which; votes count
    by class, silence carries no evidence. Half a vote is added to each count.
    """
    if not patterns:
        return {}, 0.5, None
    names = sorted(patterns)
    n = np.array([patterns[p] for p in names], dtype="float64")
    vote = np.array([list(p) for p in names])
    good, bad = vote == GOOD, vote == BAD
    post = np.where(bad.any(axis=1), 0.1, np.where(good.any(axis=1), 0.9, 0.5))
    prior, right = 0.5, None
    for _ in range(rounds):
        weight = np.stack([n * (1 - post), n * post])
        yes = weight @ good + 0.5
        right = np.stack([1 - yes[0] / (weight[0] @ (good | bad) + 1), yes[1] / (weight[1] @ (good | bad) + 1)])
        prior = (weight[1].sum() + 0.5) / (n.sum() + 1)
        log1 = np.log(prior) + good @ np.log(right[1]) + bad @ np.log(1 - right[1])
        log0 = np.log(1 - prior) + good @ np.log(1 - right[0]) + bad @ np.log(right[0])
        new = 1 / (1 + np.exp(np.clip(log0 - log1, -60, 60)))
        moved, post = np.abs(new - post).max(initial=0.0), new
        if moved < tolerance:
            break
    return dict(zip(names, post.tolist(), strict=True)), float(prior), right


def _shape(word):
    """Letters of a kind become one mark: ``Word's`` is ``Aa'a``."""
    kind = "".join("A" if c.isupper() else "a" if c.isalpha() else "9" if c.isdigit() else c for c in word)
    return re.sub(r"(.)\1+", r"\1", kind)


def shape_ids(words, known):
    """Feature of each word's shape, remembered by word."""
    if len(known) > KNOWN_WORDS:
        known.clear()
    found = list(map(known.get, words))
    if None in found:
        for i, f in enumerate(found):
            if f is None:
                w = words[i]
                found[i] = known.setdefault(w, zlib.crc32(_shape(w).encode()) % FEATURES) if len(w) <= 40 else zlib.crc32(_shape(w).encode()) % FEATURES
    return found


def features(text, known, read=None):
    """(features, values): shares of word shapes and of pairs of them, share of words seen before by tenths, length. A text
    without words has none."""
    words, counts, word_pairs, lines = read or reading(text)
    if not words:
        return np.zeros(0, "int64"), np.zeros(0)
    ids = np.array(shape_ids(words, known), dtype="int64")
    pairs = (ids[1:] * 31 + ids[:-1]) % FEATURES
    found, count = np.unique(np.concatenate([ids, pairs]), return_counts=True)
    repeated = 1 - len(counts) / len(words)
    pair_repeats = 1 - len(word_pairs) / max(len(words) - 1, 1)
    line_repeats = 1 - len(set(lines)) / max(len(lines), 1)
    extra = [f"{name}{int(value * 10)}".encode() for name, value in (
        ("words", repeated), ("pairs", pair_repeats), ("lines", line_repeats), ("size", min(np.log10(len(words)), 5) / 5))]
    own = np.array([zlib.crc32(e) % FEATURES for e in extra])
    return np.concatenate([found, own]), np.concatenate([np.sqrt(count / len(words)), np.ones(len(own))])


def fit_scorer(rows, target, rounds=150, rate=0.5, decay=1e-5):
    """Weights (the last is the bias) of a logistic regression on soft targets, by adaptive gradient steps."""
    row = np.repeat(np.arange(len(rows)), [len(f) for f, _ in rows])
    col = np.concatenate([f for f, _ in rows]) if rows else np.zeros(0, dtype="int64")
    value = np.concatenate([v for _, v in rows]) if rows else np.zeros(0)
    weights, squares = np.zeros(FEATURES + 1), np.full(FEATURES + 1, 1e-6)
    for _ in range(rounds if rows else 0):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, weights=weights[col] * value, minlength=len(rows)) + weights[-1], -40, 40)))
        gap = (target - p) / len(rows)
        gradient = np.append(np.bincount(col, weights=gap[row] * value, minlength=FEATURES), gap.sum()) - decay * weights
        squares += gradient ** 2
        weights += rate * gradient / np.sqrt(squares)
    return weights.astype("float32")


def document_table(docs, text="text", doc_id="doc_id"):
    """doc_id, votes, and features and values for the scorer of each row. A text is read once for both; null texts and
    texts without words have no votes and no features, an empty table gives an empty one."""
    read = keep(docs, doc_id, text).select(doc_id, F.col(text).cast("string").alias("__text"))
    names = {"votes": T.StringType(), "features": T.ArrayType(T.IntegerType()), "shares": T.ArrayType(T.FloatType())}
    schema = T.StructType([read.schema[doc_id], *[T.StructField(c, t) for c, t in names.items()]])

    def run(batches):
        known = _KNOWN.setdefault("shapes", {})
        for batch in batches:
            column = batch.column("__text")
            for a, b in text_groups(column):
                voted, found, shares = [], [], []
                for t in column.slice(a, b - a).to_pylist():
                    seen = reading(t)
                    voted.append(votes(t, seen))
                    f, v = features(t, known, seen)
                    found.append(f)
                    shares.append(v)
                ends = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype("int32")
                listed = lambda parts, kind: pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts).astype(kind)))
                yield pa.RecordBatch.from_arrays([
                    batch.column(doc_id).slice(a, b - a), pa.array(voted, pa.string()), listed(found, "int32"), listed(shares, "float32")],
                    names=[doc_id, *names])

    return read.mapInArrow(run, schema)


def scored(table, weights, doc_id="doc_id"):
    """doc_id, votes and score (0 to 1; null for texts without words) of each row of a document table, by a trained scorer."""
    schema = T.StructType([table.schema[doc_id], table.schema["votes"], T.StructField("score", T.DoubleType())])
    shared = table.sparkSession.sparkContext.broadcast(weights)  # 2 ** 16 numbers

    def run(batches):
        w = shared.value
        for batch in batches:
            column = batch.column("features")
            ends = column.offsets.to_numpy()
            parts = w[column.flatten().to_numpy()].astype("float64") * batch.column("shares").flatten().to_numpy()
            sums = np.concatenate([[0.0], np.cumsum(parts)])
            z = sums[ends[1:] - ends[0]] - sums[ends[:-1] - ends[0]] + float(w[-1])
            yield pa.RecordBatch.from_arrays([
                batch.column(doc_id), batch.column("votes"), pa.array(1 / (1 + np.exp(-np.clip(z, -60, 60))), mask=np.diff(ends) == 0)],
                names=[doc_id, "votes", "score"])

    return table.mapInArrow(run, schema)


def label_model(voted):
    """``fit_votes`` over all rows of a vote table; at most 3 to the power of the labellers patterns reach the driver."""
    return fit_votes({r.votes: r.n for r in voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()})


def train_scorer(docs, posteriors, text="text", doc_id="doc_id", train_docs=TRAIN_DOCS, doc_chars=TRAIN_DOC_CHARS):
    """Scorer trained on a bounded sample: the first ``train_docs`` whole texts of at most ``doc_chars`` characters in a
    seeded order, with the posteriors of their votes."""
    fit = keep(docs, doc_id, text).filter(F.length(text).between(1, doc_chars)).withColumn("__all", F.lit(1))
    chosen = seeded_first(fit, "__all", train_docs, 3, doc_id, text)
    texts = [r[0] for r in chosen.select(text, "__place").orderBy("__place").collect()]
    known = {}
    return fit_scorer([features(t, known) for t in texts], np.array([posteriors.get(votes(t), 0.5) for t in texts]))


def quality_classifier(docs, text="text", doc_id="doc_id", keep_from=0.5, **bounds):
    """One row per row of ``docs``: doc_id, posterior (of the votes), score (of the trained scorer), both 0 to 1, kept
    (score of at least ``keep_from``).

    Null texts and texts without words have no votes, the prior as posterior, and aren't kept, score 0; a text with words is
    scored whatever the labellers say. Whole texts are read, once. Other columns aren't read; repeated rows and null ids are judged each;
    an empty table gives an empty result.
    """
    spark = docs.sparkSession
    table = materialize(document_table(docs, text, doc_id), "quality-documents")
    posteriors, prior, _ = label_model(table)
    known = spark.createDataFrame(sorted(posteriors.items()) or [(NONE * len(LABELLERS), 0.5)], "votes string, posterior double")
    weights = train_scorer(docs, posteriors, text, doc_id, **bounds)
    found = scored(table, weights, doc_id).join(F.broadcast(known), "votes")  # a row per pattern
    final = F.coalesce("score", F.lit(0.0))
    return found.select(doc_id, "posterior", final.alias("score"), (F.col("score").isNotNull() & (final >= keep_from)).alias("kept"))
