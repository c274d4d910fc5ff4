"""Lexical search, conversation repair and exact top-k beside their brute-force versions, and on odd input."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

import plain
from fieldlens.llm import conversations, lexical, topk

FOLDER = "/root/testdata/sf0.001"


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


# --- ranked lexical search --------------------------------------------------

def ranked(docs, items, k):
    """(item, rank, doc, score) by scoring every pair."""
    found = [(d, Counter(t), len(t)) for d, t in ((d, plain.terms(t)) for d, t in docs) if t]
    n, total = len(found), sum(size for _, _, size in found)
    df = Counter(t for _, c, _ in found for t in c)
    out = []
    for item, text in set(items):
        scores = []
        for d, counts, size in found:
            m = 25 + 75 * size * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * counts[t] // (1000 * counts[t] + 8 * m))
                        for t in plain.terms(text) if counts[t])
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, i + 1, s[3], -s[0]) for i, s in enumerate(sorted(scores, key=lambda s: s[:3])[:k])]
    return sorted(out, key=repr)


def collection(seed, n):
    rng = random.Random(seed)
    common, rare = [f"w{i}" for i in range(12)], [f"Rare{i}x" for i in range(150)]
    docs = []
    for i in range(n):
        size = rng.choice([3, 8, 20, 60])
        docs.append((i, " ".join(rng.choice(common if rng.random() < 0.7 else rare) for _ in range(size)) + rng.choice([".", "!", " é"])))
    docs += [(n + i, docs[5][1]) for i in range(40)]  # copies: ties by id
    docs += [(3, docs[3][1]), (3, "another text under the same id w1"), (None, docs[5][1]), (None, "w1 w2"), (900, None), (901, ""), (902, " .,;\n")]
    docs += [(903, "w1 RARE3X " * 20_000)]
    items = [(i, " ".join(rng.choice(common + rare) for _ in range(rng.choice([1, 4, 30])))) for i in range(12)]
    items += [(20, docs[5][1]), (20, docs[5][1]), (21, "nowhere at all"), (22, None), (23, ""), (None, "w1 w1 rare3x"), (24, "w3"), (24, "w4 w4")]
    return docs, items


@pytest.mark.parametrize("tree_docs,bucket,block_terms", [(4096, 32, 200_000), (64, 2, 40), (7, 1, 10_000)])
def test_search_equals_scoring_every_document(spark, tree_docs, bucket, block_terms):
    docs, items = collection(1, 260)
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    for c in ("id", "n", "tfs", "rank", "score", "item", "Term"):
        table = table.withColumn(c, F.lit("x"))
    tests = spark.createDataFrame(items, "item_id long, text string").withColumn("item", F.lit("x"))
    got = lexical.ranked_search(table, tests, k=10, tree_docs=tree_docs, bucket=bucket, block_terms=block_terms)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows(got) == ranked(docs, items, 10)


def test_search_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.ranked_search(docs.limit(0), items).count() == 0
    assert lexical.ranked_search(docs, items.limit(0)).count() == 0
    assert lexical.ranked_search(docs.withColumn("text", F.lit(None)), items).count() == 0


def test_bounds_hold_below_every_node():
    rng = np.random.default_rng(4)
    n, terms = 300, 40
    lists = [np.sort(rng.choice(terms, rng.integers(0, 12), replace=False)) for _ in range(n)]
    sizes = np.array([len(x) for x in lists])
    tree = lexical.Tree(list(range(n)), rng.integers(25, 300, n), sizes, np.concatenate(lists), rng.integers(1, 9, sizes.sum()), bucket=4)
    worth = np.where(rng.random(terms) < 0.3, rng.integers(1, 9_000, terms), 0)
    seen = []

    def walk(node):
        assert tree.scores(node.lo, node.hi, worth).max() <= tree.bound(node, worth)
        if node.children:
            assert [c.lo for c in node.children] + [node.hi] == [node.lo] + [c.hi for c in node.children]
            for c in node.children:
                walk(c)
        else:
            seen.extend(range(node.lo, node.hi))

    walk(tree.root)
    assert seen == list(range(n)) and tree.root.children


# --- conversation repair ----------------------------------------------------

def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        name = lambda v: " " if v is None else str(v)
        role, text = name(role), name(text)
        kind = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        if kind:
            text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
            out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(codes):
    """(cost, least audit) by looking at every edit of every row."""
    @lru_cache(None)
    def rest(i, state, inserts):
        if i == len(codes):
            return {"": (0, ""), "s": (6, "II"), "u": (3, "I"), "a": (0, "")}[state]
        role, fault = codes[i]
        found = [(4 + rest(i + 1, state, 0)[0], "D" + rest(i + 1, state, 0)[1])]
        turn = "a" if state == "u" else "u"
        if inserts < 3:
            cost, audit = rest(i, turn, inserts + 1)
            found.append((3 + cost, "I" + audit))
        if fault not in ("blank", "duplicate"):
            more = 3 if fault == "truncated" else 0
            if role and state + role in ("s", "u", "su", "ua", "au"):
                cost, audit = rest(i + 1, role, 0)
                found.append((more + cost, "K" + audit))
            cost, audit = rest(i + 1, turn, 0)
            found.append((more + 3 + cost, "R" + audit))
        return min(found)

    return rest(0, "", 0)


def report(rows, originals):
    """A row per conversation, each judged by itself."""
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn is not None, turn or 0, role, text, turn))
    out = []
    for conv in {r[0] for r in originals}:
        mine, seen, codes = sorted(groups[conv], key=lambda r: r[:4]), set(), []
        for _, _, role, text, _ in mine:
            last = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
            codes.append((role[:1], "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else None))
            seen.add((role, text))
        turns = [r[4] for r in mine if r[4] is not None]
        cost, audit = cheapest(tuple(codes)) if codes else (0, "")
        at, state, fixed = 0, "", []
        for edit in audit:
            turn = "a" if state == "u" else "u"
            if edit == "I":
                state = turn
                fixed.append({"u": "user", "a": "assistant"}[turn] + ":")
                continue
            if edit != "D":
                state = turn if edit == "R" else codes[at][0]
                fixed.append(({"u": "user", "a": "assistant"}[turn] if edit == "R" else mine[at][2]) + ":" + mine[at][3])
            at += 1
        faults = Counter(f for _, f in codes)
        roles = [r for r, _ in codes]
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults["blank"], faults["duplicate"],
                    faults["truncated"], sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:])), cost, audit,
                    hashlib.sha256("\n".join(fixed).encode()).hexdigest()))
    return sorted(out, key=repr)


CONVERSATIONS = "conv_id long, turn long, role string, text string"
SAYINGS = ["Yes.", "No!", "Why?", "open end", "", " \n", "Fine. \t", "a.b", "Ünï!", "x\n."]


def talks(seed, n, most):
    rng = random.Random(seed)
    out = []
    for conv in range(n):
        for turn in range(rng.randint(1, most)):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.3 else ["user", "assistant"][turn % 2]
            role = rng.choice(["system", "tool", "Usher", "", None]) if rng.random() < 0.1 else role
            text = rng.choice(SAYINGS) if rng.random() < 0.4 else f"Saying {conv} {turn}."
            out.append((conv, None if rng.random() < 0.05 else turn * rng.choice([1, 1, 1, 3]), role, None if rng.random() < 0.05 else text))
    out += [(None, 0, "user", "Hi."), (None, 1, "assistant", "Ho."), (None, None, None, None), (7000, None, "user", "Lost?"), (7000, None, "user", "Lost?")]
    out += [(7001, 5, "assistant", "long text. " * 50_000), (7002, 3, "user", "same."), (7002, 3, "user", "same."), (7002, 3, "assistant", "other.")]
    return out


@pytest.mark.parametrize("bits", [0, 1, 12])
def test_repair_equals_every_edit(spark, monkeypatch, bits):
    monkeypatch.setattr(conversations, "CHUNK_BITS", bits)
    made = talks(bits, 60, 14) + [(9000, i, "user" if i % 7 else "system", f"Line {i % 90}" + "." * (i % 3)) for i in range(200)]
    table = spark.createDataFrame(made, CONVERSATIONS).repartition(3)
    for c in ("pos", "edit", "chunk", "audit", "state", "codes", "cost", "nth"):
        table = table.withColumn(c, F.lit("x"))
    found = conversations.damage(table)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(damaged(made), key=repr)
    assert rows(conversations.repair_report(found, table)) == report(damaged(made), made)


def test_repair_of_nothing(spark):
    empty = spark.createDataFrame([], CONVERSATIONS)
    assert conversations.repair_report(empty, empty).count() == 0
    once = spark.createDataFrame([(1, 1, "user", "Yes.")], CONVERSATIONS)
    got = conversations.repair_report(empty, once).collect()
    assert tuple(got[0]) == (1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_speculative_vectors_converge(spark, monkeypatch):
    """Chunks of two rows of one long conversation come to the costs of the whole."""
    monkeypatch.setattr(conversations, "CHUNK_BITS", 1)
    rng = random.Random(8)
    made = [(1, i, rng.choice(["user", "assistant", "system"]), f"Line {i}" + rng.choice(["", "."])) for i in range(301)]
    found, edits = conversations.repair(spark.createDataFrame(made, CONVERSATIONS))
    codes = "".join(r[:1] if t.endswith(".") else r[:1].upper() for _, _, r, t in made)
    costs, total = conversations.backward(codes, conversations.END_COSTS)
    row = found.first()
    assert (row.cost, row.audit) == (costs[0][0] + total, conversations.trace(codes, costs, conversations.START, True)[0])
    assert "".join(r.edit for r in edits.orderBy("pos", "nth").collect()) == row.audit


@pytest.mark.skipif(not __import__("os").path.isdir(FOLDER), reason="test tables not here")
def test_repair_query_equals_brute_force(spark):
    from fieldlens.llm import workload

    made = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows(workload.QUERIES["op12_conversation_repair"](spark, FOLDER)) == report(damaged(made), made)


# --- exact top-k ------------------------------------------------------------

def nearest(table, step, k):
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in table if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for query, v in {(i, tuple(v)) for i, v in whole if i is not None and i % step == 0}:
        scores = [(-sum(a * b for a, b in zip(v, w)), i is None, i or 0, i) for i, w in whole if i != query and len(w) == len(v)]
        out += [(query, n + 1, s[3], -s[0]) for n, s in enumerate(sorted(scores, key=lambda s: s[:3])[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_rows,chunk,bits", [(8192, 1024, 6), (50, 3, 2), (7, 1000, 1)])
def test_top_k_equals_every_pair(spark, block_rows, chunk, bits):
    rng = np.random.default_rng(block_rows)
    table = [(i, rng.normal(0, 0.12, 16).astype("float32").tolist()) for i in range(400)]
    table += [(1000 + i, table[0][1]) for i in range(30)]  # ties by id
    table += [(2000 + i, [float(i)] * 3) for i in range(20)] + [(3000, []), (3001, []), (3010, []), (4000, [0.0] * 16)]
    table += [(5000, None), (5010, [None] * 16), (5020, [math.nan] * 16), (5030, [math.inf] * 16), (None, table[0][1]), (None, table[1][1])]
    table += [table[10], table[10], (20, table[11][1]), (6000, [1e6] * 16), (6010, [-1e6, 1e-3] * 8)]
    frame = spark.createDataFrame(table, "vec_id long, embedding array<float>").repartition(3)
    frame = frame.withColumns({c: F.lit("x") for c in ("id", "slot", "chunk", "score", "label", "rank")})
    got = topk.exact_top_k(frame, lambda i: i % 10 == 0, k=5, block_rows=block_rows, chunk_queries=chunk, bits=bits)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    as_float = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in table]
    assert rows(got) == nearest(as_float, 10, 5)


def test_top_k_of_nothing_and_too_large(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert topk.exact_top_k(empty, lambda i: i % 10 == 0).count() == 0
    alone = spark.createDataFrame([(10, [1.0])], "vec_id long, embedding array<double>")
    assert topk.exact_top_k(alone, lambda i: i % 10 == 0).count() == 0
    huge = spark.createDataFrame([(10, [1e15]), (11, [1e15])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64-bit"):
        topk.exact_top_k(huge, lambda i: i % 10 == 0).count()


def test_bitmaps_add_and_compare():
    rng = np.random.default_rng(2)
    numbers = rng.integers(0, 2 ** 40, (25, 130)).astype("uint64")

    def bitmap(bits):
        return np.packbits(np.concatenate([bits, np.zeros(192 - len(bits), bool)]), bitorder="little").view("<u8")

    planes = {b: np.stack([bitmap((row >> np.uint64(b) & np.uint64(1)).astype(bool)) for row in numbers]) for b in range(40)}
    sums, valid = topk.add_bitmaps(planes), bitmap(np.ones(130, bool))
    want = numbers.sum(axis=0)
    got = [sum(1 << p for p, s in enumerate(sums) if s is not None and int(s[i >> 6]) >> (i & 63) & 1) for i in range(130)]
    assert got == [int(w) for w in want]
    for k in (1, 5, 130, 500):
        assert topk.kth_value(sums, valid, k) == sorted(got, reverse=True)[min(k, 130) - 1]
    for bar in (0, got[7], got[7] + 1, max(got), max(got) + 1, 2 ** 60):
        kept = np.unpackbits(topk.at_least(sums, valid, bar).view("u1"), bitorder="little")[:130]
        assert [bool(b) for b in kept] == [g >= bar for g in got]
