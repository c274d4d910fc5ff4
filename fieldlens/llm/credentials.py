"""Secret scans: fixed patterns, and a battery of randomness tests with control of false discoveries.

Candidates are runs of 20 or more characters of encoded data. The smallest alphabet that holds a run is its encoding. The
battery looks at the run's symbols in that alphabet: chi-squared test of equal shares, runs test about the middle symbol,
serial correlation of neighbours. A random string passes all three (Fisher's combination).

Passing is no proof for a short run, so each candidate is also tested against ordinary text: how small its chi-squared
statistic is for letters as frequent as in the whole corpus, and how often it changes between lower case, upper case,
digits and signs compared with the corpus. These p-values go through Benjamini and Hochberg's procedure in strata of length,
since long runs carry more proof than short ones. What is rejected as text and passes as random is reported.
"""

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.llm.common import keep, materialize, text_groups

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
# Runs that are long enough; a shorter run never holds a longer one, so the length may stand in the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}")

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# name -> alphabet, smallest first; symbols count in the order given
ENCODINGS = {
    "decimal": DIGITS, "hex": DIGITS + LOWER[:6], "hex_upper": DIGITS + UPPER[:6], "lower": LOWER, "upper": UPPER,
    "base32": UPPER + "234567", "base36": DIGITS + LOWER, "base36_upper": DIGITS + UPPER, "letters": UPPER + LOWER,
    "base62": UPPER + LOWER + DIGITS, "base64": UPPER + LOWER + DIGITS + "+/", "base64url": UPPER + LOWER + DIGITS + "-_",
    "mixed": UPPER + LOWER + DIGITS + "+/-_",
}
SYMBOLS = ENCODINGS["mixed"]
# classes whose changes are counted
CLASS = np.full(128, -1, dtype="int8")
for _k, _set in enumerate((LOWER, UPPER, DIGITS, "+/_-")):
    CLASS[[ord(c) for c in _set]] = _k

RANDOM_LEVEL = 0.001
DISCOVERY_RATE = 0.01
# p-values are counted in bins of a 50th of a power of ten
BINS_A_DECADE, MAX_BIN = 50, 5_000

FOUND = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                                  T.StructField("end", T.IntegerType())]))
RUNS = T.ArrayType(T.StructType([
    T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("encoding", T.StringType()),
    T.StructField("chi2", T.DoubleType()), T.StructField("changes", T.IntegerType()), T.StructField("p_random", T.DoubleType())]))


def upper_tail(z):
    return 0.5 * math.erfc(z / math.sqrt(2))


def chi2_tail(x, df):
    """P(chi-squared with df degrees >= x), by Wilson and Hilferty's cube root."""
    if df <= 0:
        return 1.0
    return upper_tail(((max(x, 0.0) / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)))


def fisher(ps):
    """Combined p-value of independent tests (chi-squared with 2 n degrees, an even number: a finite sum)."""
    half = -sum(math.log(max(p, 1e-300)) for p in ps)
    return min(1.0, math.exp(-half) * sum(half ** k / math.factorial(k) for k in range(len(ps))))


def infer_encoding(run):
    chars = set(run)
    for name, alphabet in ENCODINGS.items():
        if chars <= set(alphabet):
            return name
    return None


def battery(run, encoding):
    """(chi-squared statistic, p-value of the combined randomness tests) of a run in its encoding."""
    alphabet = ENCODINGS[encoding]
    x = np.array([alphabet.index(c) for c in run], dtype="float64")
    n, k = len(x), len(alphabet)
    counts = np.bincount(x.astype("int64"), minlength=k)
    chi2 = float(((counts - n / k) ** 2).sum() * k / n)
    p_uniform = chi2_tail(chi2, k - 1)
    high = x >= k / 2
    n1 = int(high.sum())
    n0 = n - n1
    if n1 and n0:
        mean = 2 * n1 * n0 / n + 1
        var = max((mean - 1) * (mean - 2) / (n - 1), 1e-9)
        runs = 1 + int((high[1:] != high[:-1]).sum())
        p_runs = 2 * upper_tail(abs(runs - mean) / math.sqrt(var))
    else:
        p_runs = 2.0 ** (1 - n)
    d = x - x.mean()
    spread = float((d * d).sum())
    r = float((d[1:] * d[:-1]).sum()) / spread if spread else 1.0
    p_serial = 2 * upper_tail(abs(r * n + 1) / math.sqrt(n))
    return chi2, fisher([p_uniform, min(p_runs, 1.0), min(p_serial, 1.0)])


def base_spans(text):
    """(start, end, kind) of the fixed patterns, leftmost and non-overlapping for each kind; failing matches are dropped."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def candidate_runs(text):
    """Statistics of each run; runs of one symbol class that can't be told from words keep their place in the control."""
    for m in CANDIDATE.finditer(text):
        run = m.group()
        encoding = infer_encoding(run)
        chi2, p = battery(run, encoding)
        classes = CLASS[np.frombuffer(run.encode(), dtype="uint8")]
        yield {"start": m.start(), "end": m.end(), "encoding": encoding, "chi2": chi2,
               "changes": int((classes[1:] != classes[:-1]).sum()), "p_random": p}


def _symbol_counts(texts):
    """Counts of the symbols, of neighbouring pairs of symbols and of class changes between them, over whole texts."""
    data = np.frombuffer("\n".join(texts).encode(), dtype="uint8")
    counts = np.bincount(data, minlength=128)[:128]
    classes = np.where(data < 128, CLASS[data & 127], -1)
    pair = (classes[1:] >= 0) & (classes[:-1] >= 0)
    return [int(counts[ord(c)]) for c in SYMBOLS] + [int(pair.sum()), int((pair & (classes[1:] != classes[:-1])).sum())]


def scan(docs, text="text", doc_id="doc_id"):
    """Per row: id, key (hash of the text), base spans, candidate runs, and on the first row of a batch its symbol counts."""
    read = keep(docs, doc_id, text).select(
        F.col(doc_id).alias("id"), F.xxhash64(text).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    schema = T.StructType([read.schema["id"], T.StructField("key", T.LongType()), T.StructField("base", FOUND),
                           T.StructField("runs", RUNS), T.StructField("symbols", T.ArrayType(T.LongType()))])
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            column = batch.column("text")
            for a, b in text_groups(column):
                texts = column.slice(a, b - a).to_pylist()
                base = [[{"kind": k, "start": s, "end": e} for s, e, k in base_spans(t)] for t in texts]
                runs = [list(candidate_runs(t)) for t in texts]
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").slice(a, b - a), batch.column("key").slice(a, b - a), pa.array(base, arrow.field("base").type),
                    pa.array(runs, arrow.field("runs").type),
                    pa.array([_symbol_counts(texts)] + [None] * (len(texts) - 1), arrow.field("symbols").type)], names=arrow.names)

    return read.mapInArrow(run, schema)


def corpus_frequencies(scanned):
    """({symbol: count}, share of class changes) over all texts; 68 sums reach the driver."""
    sums = scanned.filter(F.col("symbols").isNotNull()).select(F.posexplode("symbols").alias("i", "n")).groupBy("i").agg(
        F.sum("n").alias("n")).collect()
    n = dict.fromkeys(range(len(SYMBOLS) + 2), 0) | {r.i: r.n for r in sums}
    counts = {c: n[i] for i, c in enumerate(SYMBOLS)}
    return counts, (n[len(SYMBOLS) + 1] + 1) / (n[len(SYMBOLS)] + 2)


def text_moments(counts):
    """{encoding: (a, b, v)}: under letters as in the corpus, the chi-squared statistic of n symbols has mean a + b n and
    variance near v (of its first-order term, times n, and of the chi-squared itself)."""
    out = {}
    for name, alphabet in ENCODINGS.items():
        f = np.array([counts[c] + 1.0 for c in alphabet])
        f /= f.sum()
        k = len(alphabet)
        mean0 = k * float((f * (1 - f)).sum())
        slope = k * float(((f - 1 / k) ** 2).sum())
        linear = 4 * k * k * (float((f * (f - 1 / k) ** 2).sum()) - float((f * (f - 1 / k)).sum()) ** 2)
        out[name] = (mean0, slope, linear, 2 * k * k * float((f ** 2).sum()))
    return out


def text_p_values(scanned, moments, change):
    """A row per candidate run: id, key, start, end, encoding, p_random, p_text, stratum (power of two of the length)."""
    runs = scanned.filter(F.size("runs") > 0).select("id", "key", F.explode("runs").alias("r")).select("id", "key", "r.*")
    schema = T.StructType([*runs.schema, T.StructField("p_text", T.DoubleType()), T.StructField("stratum", T.IntegerType())])

    def run(batches):
        for batch in batches:
            n = np.asarray(batch.column("end")) - np.asarray(batch.column("start"))
            ps = []
            for size, encoding, chi2, changes in zip(
                    n.tolist(), batch.column("encoding").to_pylist(), batch.column("chi2").to_pylist(),
                    batch.column("changes").to_pylist(), strict=True):
                mean0, slope, linear, own = moments[encoding]
                z = (chi2 - mean0 - slope * size) / math.sqrt(max(linear * size + own, 1e-9))
                expected = (size - 1) * change
                # a normal tail with continuity correction; a Poisson-like spread keeps rare changes honest
                z_changes = (changes - 0.5 - expected) / math.sqrt(max(expected, 1.0))
                ps.append(max(fisher([upper_tail(-z), upper_tail(z_changes)]), 1e-100))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(ps, pa.float64()), pa.array(np.log2(n).astype("int32"))], names=[*batch.schema.names, "p_text", "stratum"])

    return runs.mapInArrow(run, schema)


def discovery_limits(tested, rate=DISCOVERY_RATE):
    """(stratum, most): the largest p-value that Benjamini and Hochberg's procedure rejects in each stratum of length.

    p-values are counted by bin over all candidates and a bin is judged by its upper end, so a limit is never too high.
    """
    binned = tested.select("stratum", F.least(F.floor(-F.log10("p_text") * BINS_A_DECADE), F.lit(MAX_BIN)).alias("bin")).groupBy("stratum", "bin").count()
    limits = []
    by = {}
    for r in binned.collect():  # at most 5,001 bins in each of some 30 strata
        by.setdefault(r.stratum, []).append((r.bin, r["count"]))
    for stratum, bins in by.items():
        m, so_far, best = sum(c for _, c in bins), 0, 0.0
        for b, c in sorted(bins, reverse=True):
            so_far += c
            upper = 10.0 ** (-b / BINS_A_DECADE)
            if upper <= rate * so_far / m:
                best = upper
        limits.append((stratum, best))
    return dict(limits)


def secret_spans(docs, text="text", doc_id="doc_id", rate=DISCOVERY_RATE, random_level=RANDOM_LEVEL):
    """One row per row of ``docs``: doc_id, text_key (hash of the text), base (spans of the fixed patterns) and spans (these and
    the method's, of kind ``random``), arrays of (kind, start, end) by start, then kind as listed.

    Offsets are code points of the whole text, ends exclusive. The method adds runs that touch no base span. Null and empty
    texts have no spans. Rows with null ids and repeated rows are scanned each. Other columns aren't read. An empty table
    gives an empty result.
    """
    scanned = materialize(scan(docs, text, doc_id), "secret-scan")
    counts, change = corpus_frequencies(scanned)
    tested = materialize(text_p_values(scanned, text_moments(counts), change), "secret-runs")
    limits = discovery_limits(tested, rate)
    limit = F.coalesce(*[F.when(F.col("stratum") == s, F.lit(p)) for s, p in sorted(limits.items())], F.lit(0.0))
    chosen = tested.filter((F.col("p_text") <= limit) & (F.col("p_random") >= random_level)).groupBy("id", "key").agg(
        F.collect_set(F.struct(F.lit("random").alias("kind"), "start", "end")).alias("added")).withColumnsRenamed(
        {"id": "__id", "key": "__key"})
    out = scanned.join(chosen, F.col("id").eqNullSafe(F.col("__id")) & (F.col("key") == F.col("__key")), "left")
    clear = F.filter(F.coalesce("added", F.array().cast(FOUND)), lambda r: ~F.exists(
        "base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))
    rank = F.create_map(*[x for i, k in enumerate((*KINDS, "random")) for x in (F.lit(k), F.lit(i))])
    every = F.array_sort(F.transform(F.concat("base", clear), lambda s: F.struct(
        s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))
    spans = F.transform(every, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return out.select(F.col("id").alias(doc_id), F.col("key").alias("text_key"), "base", spans.alias("spans"))


def joined(spans):
    """kind:start:end of an array of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text, spans, mark="<secret>"):
    """The text with every stretch that spans cover replaced by ``mark``; overlapping spans are one stretch."""
    step = F.aggregate(
        F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))),
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda acc, s: F.struct(
            F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark)))
            .otherwise(acc["out"]).alias("out"),
            F.greatest(acc["at"], s["end"]).alias("at")))
    return F.concat(step["out"], F.substring(text, step["at"] + 1, F.length(text)))
