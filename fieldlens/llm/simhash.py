"""SimHash near-duplicates by the generalised pigeonhole principle.

A fingerprint takes, of each of its 64 bits, the majority over the hashes of a text's word shingles. Two fingerprints at
most ``distance`` bits apart are linked. If the bits are cut into m parts with thresholds t_i (at least -1) that add up to
distance - m + 1, a linked pair lies within t_i bits in some part i. Bits that go together over the corpus share a part; the
thresholds are found by dynamic programming on the candidate counts expected from the counts of all parts' values. A part
with t_i = 0 is probed by its value, with t_i = 1 also by the values one bit away, with t_i = -1 not at all; candidates are
verified on the whole fingerprint.

Values that more than ``crowd`` fingerprints share are not paired off. Their members go by another exact way: two
fingerprints are at most two bits apart just if one fingerprint lies at most one bit from both, so every member is linked to
the least member around each of its 65 neighbours. That gives the same components from 65 rows a member, and at most 65
members meet at one key.
"""

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.llm.common import keep, materialize, text_groups
from fieldlens.llm.components import components

BITS = 64
CROWD = 64
# Cost of one probe and of one verified candidate, in the same unit: both are one row through a shuffle.
PROBE_COST, CANDIDATE_COST = 1.0, 1.0

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz     ")
# byte -> eight counters of eight bits, one per bit of the byte
_LANES = np.array([sum(((b >> k) & 1) << (8 * k) for k in range(8)) for b in range(256)], dtype="uint64")


def shingle_hashes(text, width, seed, digest):
    """Hashes of the shingles of a text, repeats included; none for a text without words."""
    words = text.encode().translate(_LOWER).split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= width:
        return [digest(joined, seed)]
    ends = np.cumsum(np.fromiter(map(len, words), dtype="int64", count=len(words)) + 1)
    starts = np.concatenate(([0], ends[:-width])).tolist()
    return [digest(joined[s:e], seed) for s, e in zip(starts, (ends[width - 1:] - 1).tolist(), strict=True)]


def majority_bits(hashes, sizes):
    """Fingerprint of each run of ``sizes`` hashes: a bit is set if it is in over half of them; an empty run gives 0."""
    out = np.zeros(len(sizes), dtype="uint64")
    filled = np.flatnonzero(sizes)
    if not len(filled):
        return out
    sizes = sizes[filled]
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    # chunks of at most 255 hashes, so that eight-bit counters hold
    per = -(-sizes // 255)
    first = np.concatenate(([0], np.cumsum(per)[:-1]))
    chunk = np.repeat(starts - 255 * first, per) + 255 * np.arange(per.sum())
    parts = hashes.view("uint8").reshape(-1, 8)
    counts = np.empty((len(chunk), BITS), dtype="int64")
    for j in range(8):
        counts[:, 8 * j: 8 * j + 8] = np.add.reduceat(_LANES[parts[:, j]], chunk).view("uint8").reshape(-1, 8)
    bits = np.add.reduceat(counts, first, axis=0) * 2 > sizes[:, None]
    out[filled] = np.packbits(bits, axis=1, bitorder="little").view("uint64").ravel()
    return out


def fingerprints(docs, text="text", doc_id="doc_id", width=3, seed=42):
    """doc_id and fp (the fingerprint's 64 bits as a long) for each row; null and empty texts have fingerprint 0."""
    found = keep(docs, doc_id, text).withColumn(text, F.col(text).cast("string"))
    schema = T.StructType([found.schema[doc_id], T.StructField("fp", T.LongType())])

    def run(batches):
        import xxhash

        digest = xxhash.xxh64_intdigest
        for batch in batches:
            ids, column = batch.column(doc_id), batch.column(text)
            for a, b in text_groups(column):
                each = [shingle_hashes(t or "", width, seed, digest) for t in column.slice(a, b - a).to_pylist()]
                sizes = np.fromiter(map(len, each), dtype="int64", count=len(each))
                hashes = np.fromiter(itertools.chain.from_iterable(each), dtype="uint64", count=int(sizes.sum()))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array(majority_bits(hashes, sizes).view("int64"))], names=[doc_id, "fp"])

    return found.mapInArrow(run, schema)


def _bit_counts(batches):
    total = np.zeros((BITS, BITS), dtype="int64")
    n = 0
    for batch in batches:
        values = np.ascontiguousarray(batch.column("fp").to_numpy())
        for a in range(0, len(values), 65_536):
            bits = np.unpackbits(values[a:a + 65_536].view("uint8").reshape(-1, 8), axis=1, bitorder="little").astype("float32")
            total += np.rint(bits.T @ bits).astype("int64")
            n += len(bits)
    if n:
        i, j = np.triu_indices(BITS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(i, -1).astype("int32")), pa.array(np.append(j, -1).astype("int32")), pa.array(np.append(total[i, j], n))],
            names=["i", "j", "n"])


def bit_correlations(classes):
    """(share of set bits, matrix of absolute correlations) over all fingerprints: 2,080 sums reach the driver."""
    sums = classes.select("fp").mapInArrow(_bit_counts, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    both, n = np.zeros((BITS, BITS)), 1
    for r in sums:
        if r.i < 0:
            n = r.n
        else:
            both[r.i, r.j] = both[r.j, r.i] = r.n
    p = np.diag(both) / n
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    return p, np.abs((both / n - np.outer(p, p)) / np.outer(spread, spread))


def group_bits(correlation, m):
    """Bits in m parts of about equal width; a part grows by the bit that goes best with those it has."""
    left, parts = set(range(BITS)), []
    for k in range(m):
        width = (BITS - sum(map(len, parts))) // (m - k)
        order = sorted(left)
        sub = correlation[np.ix_(order, order)] - 2 * np.eye(len(order))
        part = [order[int(np.argmax(sub)) // len(order)]]
        while len(part) < width:
            rest = sorted(left - set(part))
            part.append(max(rest, key=lambda b: (correlation[b, part].sum(), -b)))
        parts.append(sorted(part))
        left -= set(part)
    return parts


def _ball(width, t):
    return sum(math.comb(width, k) for k in range(t + 1))


def allocate(parts, same, share, n, distance):
    """(cost, thresholds) of the cheapest thresholds of the parts, by dynamic programming.

    ``same[i]``: pairs of fingerprints with equal value in part i, counted. Pairs one or two bits apart there are estimated
    from them and the share of each bit.
    """
    differ = 2 * share * (1 - share)
    odds = differ / np.maximum(1 - differ, 1e-6)

    def cost(i, t):
        if t < 0:
            return 0.0
        o = odds[parts[i]]
        near = [1.0, o.sum(), (o.sum() ** 2 - (o ** 2).sum()) / 2][: t + 1]
        return PROBE_COST * n * (1 + _ball(len(parts[i]), t)) + CANDIDATE_COST * (same[i] + 1) * sum(near)

    best = {0: (0.0, [])}
    for i in range(len(parts)):
        step = {}
        for total, (c, chosen) in best.items():
            for t in range(-1, distance + 1):
                found = (c + cost(i, t), [*chosen, t])
                if total + t not in step or found < step[total + t]:
                    step[total + t] = found
        best = step
    return best[distance - len(parts) + 1]


def _signed(mask):
    return mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask


def _mask(bits):
    return _signed(sum(1 << b for b in bits))


def choose_parts(classes, distance):
    """[(bits, threshold)] of the cheapest plan among ``distance`` and ``distance`` + 1 parts, from counts over all
    fingerprints."""
    share, correlation = bit_correlations(classes)
    options = [group_bits(correlation, m) for m in sorted({max(distance, 1), distance + 1})]
    keys = F.array(*[F.struct(F.lit(o).alias("o"), F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(_mask(bits))).alias("value"))
                     for o, parts in enumerate(options) for i, bits in enumerate(parts)])
    counts = classes.select(F.explode(keys).alias("k")).select("k.*").groupBy("o", "i", "value").count()
    pairs = {(r.o, r.i): (float(r.pairs), r.n) for r in counts.groupBy("o", "i").agg(
        F.sum(F.col("count") * (F.col("count") - 1) / 2).alias("pairs"), F.sum("count").alias("n")).collect()}
    plans = []
    for o, parts in enumerate(options):
        same = [pairs.get((o, i), (0.0, 0))[0] for i in range(len(parts))]
        plans.append((*allocate(parts, same, share, pairs.get((o, 0), (0.0, 0))[1], distance), o))
    _, thresholds, o = min(plans)
    return list(zip(options[o], thresholds, strict=True))


def _flips(bits):
    return [_signed(1 << b) for b in bits]


def linked_pairs(classes, distance=2, crowd=CROWD):
    """Edges (u, v) whose components are those of all links between the distinct fingerprints of ``classes``."""
    parts = [(i, bits, t) for i, (bits, t) in enumerate(choose_parts(classes, distance)) if t >= 0]

    def keyed(reach):
        found = []
        for i, bits, t in parts:
            own = F.col("fp").bitwiseAND(F.lit(_mask(bits)))
            ways = [F.lit(0).cast("long")]
            if reach:
                for r in range(1, t + 1):
                    ways += [F.lit(sum(c)).cast("long") for c in itertools.combinations(_flips(bits), r)]
            found += [F.struct(F.lit(i).alias("part"), own.bitwiseXOR(w).alias("value")) for w in ways]
        return classes.select("fp", F.explode(F.array(*found)).alias("k")).select("fp", "k.part", "k.value")

    stored = materialize(keyed(False), "simhash-values")
    probes = keyed(True) if any(t for _, _, t in parts) else stored
    crowded = materialize(stored.groupBy("part", "value").count().filter(F.col("count") > crowd).select("part", "value"), "simhash-crowds")

    data = stored.join(crowded, ["part", "value"], "left_anti").withColumnRenamed("fp", "v")
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance
    pairs = probes.withColumnRenamed("fp", "u").join(data, ["part", "value"]).filter("u < v").filter(near).select("u", "v")

    members = probes.join(crowded, ["part", "value"], "left_semi").select("fp").distinct()
    return pairs.union(crowd_links(members, distance))


def crowd_links(members, distance):
    """Edges from each fingerprint to the least one that shares one of its neighbours; at most 65 share one."""
    if distance == 2:
        keys = [F.struct(F.lit(-1).alias("b"), F.col("fp").bitwiseXOR(F.lit(w).cast("long")).alias("value")) for w in [0, *_flips(range(BITS))]]
    elif distance == 1:
        keys = [F.struct(F.lit(b).alias("b"), F.col("fp").bitwiseAND(F.lit(_signed((1 << BITS) - 1 - (1 << b)))).alias("value")) for b in range(BITS)]
    else:
        keys = [F.struct(F.lit(-1).alias("b"), F.col("fp").alias("value"))]
    around = members.select("fp", F.explode(F.array(*keys)).alias("k"))
    least = F.min("fp").over(Window.partitionBy("k"))
    return around.select(F.col("fp").alias("u"), least.alias("v")).filter("u <> v").distinct()


def near_duplicates(docs, text="text", doc_id="doc_id", width=3, distance=2, seed=42, crowd=CROWD):
    """One row per row of ``docs``: doc_id, fingerprint (16 lower-case hex digits), component_id (the smallest doc_id
    reachable over links, its own included).

    Texts are read with A-Z lower-cased as words between ASCII white space; ``width``-word shingles with repeats, the whole
    sequence if there are fewer words, fingerprint 0 for null or wordless texts, which are linked like others. ``distance``
    is 0, 1 or 2 bits. Rows with a null id take part and join components but name none; a component of such rows alone has
    a null id. Repeated rows and ids are kept. Other columns aren't read. An empty table gives an empty result.
    """
    if distance not in (0, 1, 2):
        raise ValueError("distance must be 0, 1 or 2")
    prints = materialize(fingerprints(docs, text, doc_id, width, seed), "simhash-prints")
    classes = materialize(prints.groupBy("fp").agg(F.min(doc_id).alias("first_id"), F.count(F.lit(1)).alias("n")), "simhash-classes")
    roots = components(linked_pairs(classes, distance, crowd))
    # classes of one document without a link name themselves
    joined = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "first_id", "n", F.coalesce("root", "fp").alias("root"), F.col("root").isNotNull().alias("linked"))
    joined = materialize(joined.filter("linked OR n > 1"), "simhash-groups")
    names = joined.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = joined.join(names, "root").select(F.col("fp").alias("__fp"), "component_id", F.lit(True).alias("__grouped"))
    named = materialize(named, "simhash-components")
    out = prints.join(named, F.col("fp") == F.col("__fp"), "left")
    return out.select(doc_id, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                      F.when(F.col("__grouped"), F.col("component_id")).otherwise(F.col(doc_id)).alias("component_id"))
