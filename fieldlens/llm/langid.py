"""Language identification by cross-parsing.

A suffix automaton of labelled text per language knows every substring of that text. A document is parsed greedily: from
each place the longest match is one phrase, the next phrase starts behind it. The language that needs the fewest phrases,
normalised by log2 of its training length and the document's length (bits a symbol), wins.

Texts are lower-cased; letters are symbols, any run of other characters is one separator. Texts are cut into blocks of
symbols, so that numpy moves thousands of blocks one symbol at a time. A block is first parsed from the automaton's root, as
if a phrase began there; then from the state that the block before it ends in, up to the place where both ways are in the same
state, from which on they agree. So phrases run on across blocks, and a text's parse is that of the whole text.
"""

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.llm.common import keep, seeded_first, text_groups

UNDETERMINED = "und"
# Bounds of the labelled sample of a language: documents, characters of one document, symbols learnt in all.
TRAIN_DOCS, TRAIN_DOC_CHARS, TRAIN_SYMBOLS = 400, 20_000, 32_000
BLOCK = 512
# Transitions of a language that are held as a full table; an automaton with more is held as a sorted list of them.
DENSE_CELLS = 4_000_000
# Each letter of the samples has a symbol of its own; letters that no sample has share one that no automaton knows.
SEPARATOR, UNKNOWN = 0, 1

_MODELS = {}


def suffix_automaton(symbols):
    """Transitions of the suffix automaton of a sequence: a dictionary {symbol: state} per state."""
    step, link, length, last = [{}], [-1], [0], 0
    for c in symbols:
        cur = len(step)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = cur
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(step)
                step.append(dict(step[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return step


class Dense:
    """Moves of an automaton by a table over the symbols that the language has; a column for all others."""

    def __init__(self, step, own, size):
        # a symbol that the language doesn't know is a phrase by itself: a state that leads nowhere
        table = np.full((len(step) + 1, len(own) + 1), -1, dtype="int32")
        column = {c: i for i, c in enumerate(own)}
        for state, moves in enumerate(step):
            for c, to in moves.items():
                table[state, column[c]] = to
        table[0] = np.where(table[0] >= 0, table[0], len(step))
        # where there is no way on, a phrase ends: go on as from the root, marked by the bits' complement
        width, root = table.shape[1], table[0]
        self.table = np.where(table >= 0, table * width, ~(root * width)[None, :]).astype("int32").ravel()
        self.column = np.full(size, len(own), dtype="int32")
        self.column[own] = np.arange(len(own), dtype="int32")

    def symbols(self, turned):
        return self.column[turned]

    def move(self, state, symbol):
        return self.table[state + symbol]


class Sparse:
    """The same moves by binary search among the transitions there are, for large alphabets."""

    def __init__(self, step, own, size):
        self.size = size
        moves = [(state * size + c, to) for state, found in enumerate(step) for c, to in found.items()]
        moves = np.array(sorted(moves), dtype="int64").reshape(-1, 2)
        self.keys, self.to = moves[:, 0].copy(), moves[:, 1].astype("int32")
        self.root = np.full(size, len(step), dtype="int32")
        for c, to in step[0].items():
            self.root[c] = to

    def symbols(self, turned):
        return turned

    def move(self, state, symbol):
        wanted = state.astype("int64") * self.size + symbol
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        root = self.root[symbol]
        return np.where(self.keys[at] == wanted, self.to[at], np.where(state == 0, root, ~root))


def letters():
    """Which code points are letters."""
    if "letters" not in _MODELS:
        _MODELS["letters"] = np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), dtype=bool, count=sys.maxunicode + 1)
    return _MODELS["letters"]


def code_points(text):
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="uint32")


class CrossParser:
    """Automata of all languages over a common alphabet, from {language: labelled text}."""

    def __init__(self, samples):
        self.languages = sorted(samples)
        points = {lang: code_points(samples[lang].lower()) for lang in self.languages}
        seen = np.concatenate([*points.values(), np.zeros(0, dtype="uint32")])
        values = np.unique(seen[letters()[seen]])
        size = 2 + len(values)
        self.dtype = np.min_scalar_type(size)
        self.symbol = np.where(letters(), UNKNOWN, SEPARATOR).astype(self.dtype)
        self.symbol[values] = np.arange(2, size)
        self.automata, self.cost = [], []
        for lang in self.languages:
            learnt = self.symbols(points[lang])
            own = np.unique(learnt)
            step = suffix_automaton(learnt.tolist())
            form = Dense if not len(own) or (len(step) + 1) * (len(own) + 1) <= DENSE_CELLS else Sparse
            self.automata.append(form(step, own.tolist(), size))
            self.cost.append(math.log2(len(learnt) + 2))

    def symbols(self, points):
        found = self.symbol[points]
        if len(found):
            found = found[np.concatenate(([True], (found[1:] != SEPARATOR) | (found[:-1] != SEPARATOR)))]
        return found

    def phrases(self, blocks, sizes, before):
        """Phrase ends in each block in each language: blocks (n, BLOCK) of symbols, sizes descending, ``before``: the block
        that a block goes on from, -1 for a text's first."""
        turned = np.ascontiguousarray(blocks.T)
        active = np.searchsorted(-sizes, -np.arange(1, BLOCK + 1), side="right")
        out = np.empty((len(self.automata), len(sizes)), dtype="int64")
        every = np.arange(len(sizes))
        for k, automaton in enumerate(self.automata):
            own = automaton.symbols(turned)
            states = np.zeros((BLOCK + 1, len(sizes)), dtype="int32")
            ends = np.zeros((BLOCK + 1, len(sizes)), dtype="int16")
            for t in range(BLOCK):
                n = active[t]
                if not n:
                    break
                to = automaton.move(states[t, :n], own[t, :n])
                miss = to >> 31
                ends[t + 1, :n] = ends[t, :n] - miss
                states[t + 1, :n] = to ^ miss
            left, entry = states[sizes, every], np.zeros(len(sizes), dtype="int32")
            again = np.flatnonzero((before >= 0) & (left[before] != entry))
            while len(again):
                entry[again] = left[before[again]]
                state, count, rows = entry[again], np.zeros(len(again), dtype="int16"), again
                for t in range(BLOCK):
                    on = sizes[rows] > t
                    if not on.all():
                        state, count, rows = state[on], count[on], rows[on]
                    if not len(rows):
                        break
                    to = automaton.move(state, own[t, rows])
                    miss = to >> 31
                    count, state = (count - miss).astype("int16"), to ^ miss
                    met = state == states[t + 1, rows]
                    if met.any():
                        ends[t + 1:, rows[met]] += (count[met] - ends[t + 1, rows[met]])[None, :]
                        state, count, rows = state[~met], count[~met], rows[~met]
                    states[t + 1, rows], ends[t + 1, rows] = state, count
                left = states[sizes, every]
                again = np.flatnonzero((before >= 0) & (left[before] != entry))
            out[k] = ends[sizes, every]
        return out

    def predict(self, texts):
        """(language, score) of each text."""
        each = [self.symbols(code_points(t.lower())) if t else np.zeros(0, dtype=self.dtype) for t in texts]
        sizes = np.array([len(s) for s in each], dtype="int64")
        has_letter = np.array([bool((s != SEPARATOR).any()) for s in each])
        label = [UNDETERMINED] * len(texts)
        score = np.zeros(len(texts))
        if not self.languages or not has_letter.any():
            return label, score
        per = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(each)), per)
        blocks = np.zeros((int(per.sum()), BLOCK), dtype=self.dtype)
        lengths = np.empty(len(blocks), dtype="int64")
        row = 0
        for s in each:
            for a in range(0, len(s), BLOCK):
                part = s[a:a + BLOCK]
                blocks[row, :len(part)] = part
                lengths[row] = len(part)
                row += 1
        order = np.argsort(-lengths, kind="stable")
        place = np.empty(len(order), dtype="int64")
        place[order] = np.arange(len(order))
        first = np.concatenate([[True], owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, bool)
        before = np.where(first, -1, np.concatenate([[-1], place[:-1]]) if len(place) else place)[order]
        found = self.phrases(blocks[order], lengths[order], before)
        bits = np.zeros((len(self.languages), len(texts)))
        for k, cost in enumerate(self.cost):
            bits[k] = (np.bincount(owner[order], weights=found[k], minlength=len(texts)) + 1) * cost
        best = bits.argmin(axis=0)
        # share of the winner if a quarter of the code length counts as evidence
        score = np.where(has_letter, 1 / np.exp2(np.maximum((bits.min(axis=0) - bits) / 4, -1000)).sum(axis=0), 0.0)
        return [self.languages[b] if ok else UNDETERMINED for b, ok in zip(best.tolist(), has_letter.tolist(), strict=True)], score


def labelled_sample(docs, text="text", lang="lang", doc_id="doc_id", train_docs=TRAIN_DOCS, doc_chars=TRAIN_DOC_CHARS,
                    symbols=TRAIN_SYMBOLS):
    """{language: text} of whole documents in seeded order, at most ``symbols`` characters a language.

    A bounded sample: ``train_docs`` documents of at most ``doc_chars`` characters each are looked at. If even the first is
    longer than ``symbols`` it alone is taken.
    """
    fit = keep(docs, doc_id, text, lang).filter(F.col(lang).isNotNull() & F.length(text).between(1, doc_chars))
    chosen = seeded_first(fit, lang, train_docs, 5, doc_id, text).select(F.col(lang).alias("lang"), F.col(text).alias("text"), "__place")
    samples, sizes = {}, {}
    for r in sorted(chosen.collect(), key=lambda r: (r["lang"], r["__place"])):
        if not any(c.isalpha() for c in r["text"]):
            continue
        if sizes.get(r["lang"], 0) + len(r["text"]) <= symbols or r["lang"] not in samples:
            samples.setdefault(r["lang"], []).append(r["text"])
            sizes[r["lang"]] = sizes.get(r["lang"], 0) + len(r["text"])
    return {k: "\n".join(v) for k, v in samples.items()}


def identify(docs, samples, text="text", doc_id="doc_id"):
    """One row per row of ``docs``: doc_id, lang_pred, score (0 to 1), from {language: labelled text}.

    ``und`` with score 0 for null texts, texts without a letter, and if there are no samples. Of languages that need the
    same the first by code point wins. Whole texts are parsed, however long. Other columns aren't read, repeated rows and null ids are
    judged each; an empty table gives an empty result.
    """
    found = keep(docs, doc_id, text).withColumn(text, F.col(text).cast("string"))
    schema = T.StructType([found.schema[doc_id], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(samples)  # at most TRAIN_SYMBOLS characters a language

    def run(batches):
        key = tuple(sorted(shared.value.items()))
        if _MODELS.get("key") != key:
            _MODELS["parser"], _MODELS["key"] = CrossParser(shared.value), key
        parser = _MODELS["parser"]
        for batch in batches:
            column = batch.column(text)
            for a, b in text_groups(column):
                label, score = parser.predict(column.slice(a, b - a).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(doc_id).slice(a, b - a), pa.array(label, pa.string()), pa.array(score)],
                                                 names=[doc_id, "lang_pred", "score"])

    return found.mapInArrow(run, schema)


def language_id(docs, text="text", lang="lang", doc_id="doc_id", folds=5, **bounds):
    """``identify`` with samples of the documents whose crc32(doc_id as text) mod ``folds`` isn't 0, and held_out (it is).

    Rows without id are neither learnt from nor held out.
    """
    part = F.crc32(F.col(doc_id).cast("string")) % folds
    samples = labelled_sample(docs.filter(part != 0), text, lang, doc_id, **bounds)
    found = identify(docs, samples, text, doc_id)
    return found.select(doc_id, F.coalesce(part == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")
