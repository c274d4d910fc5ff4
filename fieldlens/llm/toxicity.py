"""Toxicity by a linear-chain conditional random field over the words of a sentence, with two states.

Labels come by document. Tokens of the learning sample are labelled from them: in a toxic document a word is toxic if the
word itself or one of its beginnings goes with toxic documents beyond chance; every other token is not. On these sequences
the field is fitted by maximum likelihood; forward-backward gives each token's marginal. A document's score comes from its
marginals by a logistic regression on the largest one, the expected number of toxic tokens and the length; tokens with a marginal
of at least one half are its offending offsets.

Recursions run over all sentences of a batch at once, one step per token position. A long sentence lies in stretches; a
stretch is first run by itself and then, until nothing changes any more, from the message that its neighbour hands over, so
its marginals are those of the whole sentence.
"""

import math
import re
import sys
import uuid
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.llm.common import keep, need, seeded_first, text_groups

# Bounds of the labelled sample: documents of each label, and characters of a document that may be learnt from.
TRAIN_TOXIC, TRAIN_CLEAN, TRAIN_DOC_CHARS = 1_200, 2_400, 20_000
PREDICT_FROM = 0.7
# A token: letters and digits, or an end of a sentence.
TOKEN = re.compile(r"[^\W_]+|[.!?\n]")
ENDS = frozenset(".!?\n")
# Tokens of a stretch, and the change of a message below which what follows from it stays as it is.
STRETCH = 512
SETTLED = 1e-13
FEATURES = 1 << 18
PREFIXES = range(3, 8)
# A beginning goes with toxic documents if the log-likelihood ratio says so and its share there is so many times larger.
MIN_EVIDENCE, MIN_RATIO, MIN_DOCS = 25.0, 8.0, 3
KNOWN_WORDS = 500_000
# Numbers that a document's score is made of.
SUMMARIES = 4

_KNOWN = {}


def names(word):
    """Features of a token: the word and its beginnings."""
    return [word + "$", *(word[:n] for n in PREFIXES if n <= len(word))]


def feature_ids(word):
    """Hashes of the features, which take less memory than their texts."""
    return [zlib.crc32(f.encode()) for f in names(word)]


def buckets(word):
    return [f % FEATURES for f in feature_ids(word)]


def evidence(a, b, n_toxic, n_clean):
    """Log-likelihood ratio of a feature in ``a`` of the toxic and ``b`` of the clean documents."""
    def part(k, n, p):
        return (k * math.log(p) if k else 0.0) + ((n - k) * math.log(1 - p) if n - k else 0.0)

    p = (a + b) / (n_toxic + n_clean)
    if p in (0.0, 1.0):
        return 0.0
    return 2 * (part(a, n_toxic, a / n_toxic) + part(b, n_clean, b / n_clean) - part(a, n_toxic, p) - part(b, n_clean, p))


def toxic_features(tokens, labels, families):
    """Hashes of the features that go with toxic documents. Documents of one family (copies) count once per label."""
    members = {}
    for i, key in enumerate(zip(labels, families, strict=True)):
        members.setdefault(key, []).append(i)
    seen = {0: Counter(), 1: Counter()}
    # toxic families first: of the others only features that may be toxic are counted
    for (label, _), docs in sorted(members.items(), key=lambda m: -m[0][0]):
        words = set().union(*(tokens[i] for i in docs)) - ENDS
        features = {f for w in words for f in feature_ids(w)}
        seen[label].update(features if label else features & seen[1].keys())
    n1 = sum(label for label, _ in members)
    n0 = len(members) - n1
    found = set()
    for f, a in seen[1].items():
        b = seen[0][f]
        if a >= MIN_DOCS and a * n0 >= MIN_RATIO * max(b, 0.5) * n1 and evidence(a, b, n1, n0) >= MIN_EVIDENCE:
            found.add(f)
    return found


def sentences(is_end, doc_sizes):
    """(starts, lengths, tokens, before): stretches of the sentences in a flat token array, longest first, and the stretch that each
    goes on from (-1: none); tokens that end a sentence are in none."""
    n = len(is_end)
    first = np.zeros(n + 1, dtype=bool)
    first[np.cumsum(doc_sizes)[:-1]] = True
    first[0] = True
    first[1:] |= is_end
    first = first[:n]
    index = np.flatnonzero(~is_end)
    group = np.cumsum(first)[index]
    if not len(index):
        return np.zeros(0, dtype="int64"), np.zeros(0, dtype="int64"), index, np.zeros(0, dtype="int64")
    opens = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    lengths = np.diff(np.append(opens, len(index)))
    parts = -(-lengths // STRETCH)
    inner = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    starts = np.repeat(opens, parts) + inner * STRETCH
    sizes = np.minimum(np.repeat(lengths, parts) - inner * STRETCH, STRETCH)
    order = np.argsort(-sizes, kind="stable")
    place = np.empty(len(order), dtype="int64")
    place[order] = np.arange(len(order))
    before = np.where(inner > 0, np.concatenate([[-1], place[:-1]]), -1)
    return starts[order], sizes[order], index, before[order]


def forward_backward(e, starts, sizes, move, before=None):
    """(a, b): log-odds messages of state 1 against 0; a + b is the logit of a token's marginal.

    ``e``: log-odds of the tokens. ``move``: start log-odds and the scores of 0-0, 0-1, 1-0, 1-1. ``before``: see ``sentences``.
    """
    begin, m00, m01, m10, m11 = move
    a, b = np.empty_like(e), np.zeros_like(e)
    if not len(starts):
        return a, b

    def onward(x, at):
        return np.clip(e[at] + np.logaddexp(m01, m11 + x) - np.logaddexp(m00, m10 + x), -60, 60)

    def backward(at):
        x = e[at] + b[at]
        return np.clip(np.logaddexp(m10, m11 + x) - np.logaddexp(m00, m01 + x), -60, 60)

    longest = int(sizes[0])
    active = np.searchsorted(-sizes, -np.arange(1, longest + 1), side="right")
    a[starts] = begin + e[starts]
    for t in range(1, longest):
        at = starts[:active[t]] + t
        a[at] = onward(a[at - 1], at)
    for t in range(longest - 1, 0, -1):
        at = starts[:active[t]] + t
        b[at - 1] = backward(at)
    if before is None or not (before >= 0).any():
        return a, b
    after = np.full(len(starts), -1)
    after[before[before >= 0]] = np.flatnonzero(before >= 0)
    # what a stretch is handed changes it from its border on, until a message stays as it was
    lanes = np.flatnonzero(before >= 0)
    while len(lanes):
        t, rows, reached = 0, lanes, np.zeros(0, dtype="int64")
        while len(rows):
            at = starts[rows] + t
            new = onward(a[at - 1], at)  # a sentence's stretches lie side by side
            moved = np.abs(new - a[at]) > SETTLED
            a[at] = new
            t += 1
            reached = np.concatenate([reached, rows[moved & (sizes[rows] == t)]])
            rows = rows[moved & (sizes[rows] > t)]
        lanes = after[reached][after[reached] >= 0]
    lanes = np.flatnonzero(after >= 0)
    while len(lanes):
        t, rows, reached = 0, lanes, np.zeros(0, dtype="int64")
        while len(rows):
            at = starts[rows] + sizes[rows] - t
            new = backward(at)
            moved = np.abs(new - b[at - 1]) > SETTLED
            b[at - 1] = new
            t += 1
            reached = np.concatenate([reached, rows[moved & (sizes[rows] == t)]])
            rows = rows[moved & (sizes[rows] > t)]
        lanes = before[reached][before[reached] >= 0]
    return a, b


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def fit_field(words, labels, doc_sizes, rounds=60, rate=0.3, decay=1e-6):
    """(weights, move) by maximum likelihood on labelled sequences, by adaptive gradient steps over the whole sample."""
    kinds = sorted(set(words))
    number = {w: i for i, w in enumerate(kinds)}
    ids = np.fromiter(map(number.__getitem__, words), dtype="int64", count=len(words))
    is_end = np.array([w in ENDS for w in kinds])[ids]
    starts, sizes, index, before = sentences(is_end, np.asarray(doc_sizes))
    ids, y = ids[index], np.asarray(labels, dtype="float64")[index]
    feats = [buckets(w) for w in kinds]
    row = np.repeat(np.arange(len(kinds)), [len(f) for f in feats])
    col = np.concatenate([np.asarray(f, dtype="int64") for f in feats])
    weights, move = np.zeros(FEATURES), np.zeros(5)
    squares, move_squares = np.full(FEATURES, 1e-8), np.full(5, 1e-8)
    opens = starts[before < 0]
    later = np.ones(len(ids), dtype=bool)
    later[opens] = False
    later = np.flatnonzero(later)
    real = np.array([y[opens].sum(), *[((y[later - 1] == i) & (y[later] == j)).sum() for i in (0, 1) for j in (0, 1)]])
    for _ in range(rounds):
        e = np.bincount(row, weights=weights[col], minlength=len(kinds))[ids]
        a, b = forward_backward(e, starts, sizes, move, before)
        p = sigmoid(a + b)
        gradient = np.bincount(col, weights=np.bincount(ids, weights=y - p, minlength=len(kinds))[row], minlength=FEATURES)
        gradient -= decay * len(ids) * weights
        x, nxt = a[later - 1], e[later] + b[later]
        pair = np.stack([np.full(len(x), move[1]), move[2] + nxt, x + move[3], x + move[4] + nxt])
        pair = np.exp(pair - pair.max(axis=0))
        expected = np.array([p[opens].sum(), *(pair / pair.sum(axis=0)).sum(axis=1)])
        step = real - expected
        squares += gradient ** 2
        move_squares += step ** 2
        weights += rate * gradient / np.sqrt(squares)
        move += rate * step / np.sqrt(move_squares)
    return weights, move


class Scorer:
    """Emissions by word, remembered, and scores of whole texts."""

    def __init__(self, weights, move, link):
        self.weights, self.move, self.link = weights, move, link
        self.known = dict.fromkeys(ENDS, math.nan)

    def emissions(self, words):
        if len(self.known) > KNOWN_WORDS:
            self.known = dict.fromkeys(ENDS, math.nan)
        known = self.known
        found = list(map(known.get, words))
        if None in found:
            for i, e in enumerate(found):
                if e is None:
                    w = words[i]
                    if w not in known:
                        known[w] = float(self.weights[buckets(w.lower())].sum())
                    found[i] = known[w]
        return found

    def marginals(self, texts):
        """(marginals, tokens per text): ends of sentences have marginal 0."""
        flat, sizes = [], np.zeros(len(texts), dtype="int64")
        for i, text in enumerate(texts):
            if text:
                found = self.emissions(TOKEN.findall(text))
                flat.append(np.array(found))
                sizes[i] = len(found)
        e = np.concatenate(flat) if flat else np.zeros(0)
        is_end = np.isnan(e)
        p = np.zeros(len(e))
        if len(e):
            starts, lengths, index, before = sentences(is_end, sizes)
            a, b = forward_backward(e[index], starts, lengths, self.move, before)
            p[index] = sigmoid(a + b)
        return p, sizes

    def summaries(self, p, sizes):
        """Per text: logit of its largest marginal, logs of one more than its expected toxic tokens and than its tokens.

        Marginals below 0.01 don't count in the sum: those of clean words are small but not zero, and thousands of
        them would make a long clean text look like one with a few toxic words.
        """
        top, total = np.full(len(sizes), 1e-9), np.zeros(len(sizes))
        filled = np.flatnonzero(sizes)
        if len(filled):
            opens = (np.cumsum(sizes) - sizes)[filled]
            top[filled] = np.clip(np.maximum.reduceat(p, opens), 1e-9, 1 - 1e-9)
            total[filled] = np.add.reduceat(np.where(p >= 0.01, p, 0.0), opens)
        return np.stack([np.ones(len(sizes)), np.log(top / (1 - top)), np.log1p(total), np.log1p(sizes)], axis=1)

    def scores(self, texts):
        p, sizes = self.marginals(texts)
        return sigmoid(self.summaries(p, sizes) @ self.link), p, sizes

    def spans(self, text, p, level=0.5):
        """(start, end) of runs of tokens with a marginal of at least ``level``; code points, ends exclusive."""
        found = []
        places, last = [m.span() for m in TOKEN.finditer(text)], None
        for k in np.flatnonzero(p >= level).tolist():
            if last == k - 1 and found:
                found[-1] = (found[-1][0], places[k][1])
            else:
                found.append(places[k])
            last = k
        return found


def fit_link(x, y, rounds=30, decay=1e-2):
    """Logistic regression by Newton's steps."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = sigmoid(x @ w)
        h = (x * (p * (1 - p))[:, None]).T @ x + decay * np.eye(len(w)) * len(y) / 100
        w += np.linalg.solve(h, x.T @ (y - p) - decay * w * len(y) / 100)
    return w


def labelled_sample(docs, labels, text="text", doc_id="doc_id", label="toxic", learn=None, toxic=TRAIN_TOXIC, clean=TRAIN_CLEAN,
                    doc_chars=TRAIN_DOC_CHARS):
    """[(text, label)] of a bounded sample: at most ``toxic`` and ``clean`` documents, first in a seeded order of the ids
    among those that ``learn`` (a condition on the id) allows, whole texts of at most ``doc_chars`` characters."""
    rows = keep(labels, doc_id, label).filter(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
    if learn is not None:
        rows = rows.filter(learn)
    ids = seeded_first(rows.distinct(), label, {0: clean, 1: toxic}, 2, doc_id).select(
        F.col(doc_id).alias("__id"), F.col(label).cast("int").alias("__label"))
    found = keep(docs, doc_id, text).filter(F.length(text).between(1, doc_chars)).join(
        F.broadcast(ids), F.col(doc_id) == F.col("__id"))  # at most toxic + clean rows
    return [(r[0], r[1]) for r in found.select(text, "__label").orderBy("__id", text).collect()]


def train(sample):
    """(weights, move, link) from [(text, label)]; None if one of the labels is missing."""
    texts, labels = [t for t, _ in sample], [y for _, y in sample]
    if len(set(labels)) < 2:
        return None
    tokens = [[sys.intern(w.lower()) for w in TOKEN.findall(t)] for t in texts]
    families = [hash(max(t.split("\n"), key=lambda line: (len(line), line))) for t in texts]
    marked = toxic_features(tokens, labels, families)
    toxic_words = {w for words in tokens for w in words if w not in ENDS and any(f in marked for f in feature_ids(w))}
    token_labels = [int(y == 1 and w in toxic_words) for words, y in zip(tokens, labels, strict=True) for w in words]
    weights, move = fit_field([w for words in tokens for w in words], token_labels, [len(words) for words in tokens])
    scorer = Scorer(weights, move, np.zeros(SUMMARIES))
    x = np.concatenate([scorer.summaries(*scorer.marginals(texts[i:i + 500])) for i in range(0, len(texts), 500)])
    return weights.astype("float32"), move, fit_link(x, np.asarray(labels, dtype="float64"))


def tag(docs, model, text="text", doc_id="doc_id", level=0.5):
    """One row per row of ``docs``: doc_id, score (0 to 1), spans (start, end of offending runs, code points).

    Texts are split into tokens as they are and each token is lower-cased, so offsets are those of the text; whole texts are read,
    a sentence of any length is one chain. An empty table gives an empty result. Null and empty texts have no spans and the score of a text without toxic tokens. Without a model (no documents of one of
    the labels to learn from) every score is 0. Other columns aren't read; repeated rows and null ids are scored each.
    """
    found = keep(docs, doc_id, text).withColumn(text, F.col(text).cast("string"))
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    schema = T.StructType([found.schema[doc_id], T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(span))])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** 18 weights
    key = uuid.uuid4().hex
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        if _KNOWN.get("key") != key:
            _KNOWN["scorer"], _KNOWN["key"] = shared.value and Scorer(*shared.value), key
        scorer = _KNOWN["scorer"]
        for batch in batches:
            column = batch.column(text)
            for a, b in text_groups(column):
                texts = column.slice(a, b - a).to_pylist()
                spans = [[] for _ in texts]
                scores = np.zeros(len(texts))
                if scorer:
                    scores, p, sizes = scorer.scores(texts)
                    ends = np.cumsum(sizes)
                    owner = np.repeat(np.arange(len(texts)), sizes)
                    for i in np.unique(owner[p >= level]).tolist():
                        own = scorer.spans(texts[i], p[ends[i] - sizes[i]:ends[i]], level)
                        spans[i] = [{"start": s, "end": e} for s, e in own]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(doc_id).slice(a, b - a), pa.array(scores), pa.array(spans, span_type)], names=[doc_id, "score", "spans"])

    return found.mapInArrow(run, schema)


def toxicity(docs, labels, text="text", doc_id="doc_id", label="toxic", folds=3, held_out=1, **bounds):
    """``tag`` with a model learnt from labelled documents whose crc32(doc_id as text) mod ``folds`` isn't ``held_out``,
    with held_out (it is; false for a null id) and predicted (score of at least PREDICT_FROM)."""
    need(labels, doc_id, label)
    part = F.crc32(F.col(doc_id).cast("string")) % folds
    model = train(labelled_sample(docs, labels, text, doc_id, label, part != held_out, **bounds))
    found = tag(docs, model, text, doc_id)
    return found.select(doc_id, F.coalesce(part == held_out, F.lit(False)).alias("held_out"), "score",
                        (F.col("score") >= PREDICT_FROM).cast("int").alias("predicted"), "spans")
