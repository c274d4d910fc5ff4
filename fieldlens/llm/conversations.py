"""Conversation structure repair by a Viterbi search whose chunks run in parallel.

A repaired conversation alternates user and assistant after at most one system row, and ends with an assistant; it may be
empty. Its cheapest edits are a shortest path over four states: nothing yet, after the system row, after a user, after an
assistant. Long conversations are cut into chunks of rows:

1. Rows are range-partitioned by conversation and turn and get their positions there, so no conversation is sorted in one task.
2. Every chunk is searched backward from a cost vector: the last one of a conversation from the true costs of its end, the
   others from a speculative one.
3. Fix-up passes: a chunk takes the vector that its successor came to. If that differs from what the chunk started from only
   by a constant, the chunk's costs differ by that constant and stand; else it runs again. Passes end when all chunks stand.
4. The stitched backward costs say which edits are cheapest from any state on. Every chunk traces, for each state it may be
   entered in, the least audit string of cheapest edits; the states are then chained along the chunks.

A row is one letter during the search, so what a conversation's chunks gather is small beside its texts.
"""

import hashlib
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from fieldlens.llm.common import keep, materialize

BLANKS = " \t\n\x0b\x0c\r"
ROLES = {"u": "user", "a": "assistant"}
KEEP_COST, REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 3, 4, 3, 3
# Rows of a chunk: positions that agree above so many bits.
CHUNK_BITS = 12
MAX_PASSES = 1_000

# --- states: 0 nothing yet, 1 after system, 2 after user, 3 after assistant ---
START, SYSTEM, USER, ASSISTANT = range(4)
END_COSTS = (0, 2 * INSERT_COST, INSERT_COST, 0)
# the state that a row with the role's first letter leads to
NEXT = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
# the one role that a changed or inserted row can have in a state, and where it leads
TURN = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
LETTER = {USER: "u", ASSISTANT: "a"}


@lru_cache(maxsize=4096)
def _step(code, after):
    """(relative costs, their least) before a row, from the costs ``after`` it. ``code``: first letter of the role, in capitals if the row is truncated;
    x or X for any other letter; - for a row that must go."""
    cost = [DELETE_COST + c for c in after]
    if code != "-":
        extra, role = (TRUNCATED_COST, code.lower()) if code.isupper() else (0, code)
        for state in range(4):
            cost[state] = min(cost[state], extra + REROLE_COST + after[TURN[state]])
            kept = NEXT.get((role, state))
            if kept is not None:
                cost[state] = min(cost[state], extra + KEEP_COST + after[kept])
    user, assistant = cost[USER], cost[ASSISTANT]
    cost[USER], cost[ASSISTANT] = min(user, INSERT_COST + assistant), min(assistant, INSERT_COST + user)
    cost[START], cost[SYSTEM] = min(cost[START], INSERT_COST + cost[USER]), min(cost[SYSTEM], INSERT_COST + cost[USER])
    least = min(cost)
    return tuple(c - least for c in cost), least


def backward(codes, end):
    """Cost vectors before every row and after the last, from the costs ``end``; a constant in them changes nothing else.

    Costs are kept relative to their least, whose sum is the second result, so long chunks need no large numbers.
    """
    costs, total = [end], 0
    for code in reversed(codes):
        relative, least = _step(code, costs[-1])
        costs.append(relative)
        total += least
    return costs[::-1], total


def trace(codes, costs, state, last):
    """(audit, state after): the least string of cheapest edits from ``state`` on. ``costs``: relative vectors of ``backward``.

    D, I, K and R are tried in this order; a letter is right if it keeps to the cheapest cost, and then says what follows.
    """
    audit = []
    for i, code in enumerate(codes):
        before, after = costs[i], costs[i + 1]
        least = _step(code, after)[1]  # what the vector before the row was reduced by
        extra, role = (TRUNCATED_COST, code.lower()) if code.isupper() else (0, code)
        while True:
            cost = before[state] + least
            if cost == DELETE_COST + after[state]:
                audit.append("D")
                break
            if before[state] == INSERT_COST + before[TURN[state]]:
                audit.append("I")
                state = TURN[state]
                continue
            kept = NEXT.get((role, state)) if code != "-" else None
            if kept is not None and cost == extra + KEEP_COST + after[kept]:
                audit.append("K")
                state = kept
            else:
                audit.append("R")
                state = TURN[state]
            break
    while last and state not in (START, ASSISTANT):
        audit.append("I")
        state = TURN[state]
    return "".join(audit), state


# --- rows, faults, chunks ---------------------------------------------------

def _text(name):
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damage(rows, conv_id="conv_id", turn="turn", role="role", text="text"):
    """The rows with faults put in by crc32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties its text, 2 takes its
    sentence ends away, 3 repeats it, 4 makes it the user's. Nulls of roles and texts, and of the hashed key, read as one blank."""
    read = keep(rows, conv_id, turn, role, text).select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), _text(role).alias("role"), _text(text).alias("text"))
    kind = F.crc32(F.concat_ws(":", _text("conv_id"), _text("turn")).cast("binary")) % 20
    hurt = read.withColumn("__kind", kind).filter("__kind <> 0").withColumns({
        "text": F.when(F.col("__kind") == 1, "").when(F.col("__kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")),
        "role": F.when(F.col("__kind") == 4, "user").otherwise(F.col("role"))})
    return hurt.withColumn("__copy", F.explode(F.expr("sequence(1, if(__kind = 3, 2, 1))"))).drop("__kind", "__copy")


def positions(rows):
    """The rows (conv_id, turn, role, text) with ``pos``, which rises in each conversation by turn (nulls first), then role and
    text. Written, as all later steps go by these positions.

    The range partitions are bounded by whole rows and a row number, so neither a long conversation nor many equal rows
    have to share a task.
    """
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text"), F.asc("__row")]
    dealt = rows.withColumn("__row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(dealt.drop("__row").withColumn("pos", F.monotonically_increasing_id()), "conversation-rows")


def faults(placed):
    """A row per position: conv_id, chunk, pos, first letter of the role, fault (blank, duplicate, truncated or null).

    A row is a duplicate if its role and text stand earlier in the conversation. The first place of each comes from an
    aggregate, and meets the rows by position, so a text that is repeated all over has no task of its own.
    """
    last = F.right(F.rtrim(F.col("text"), F.lit(BLANKS)), F.lit(1))
    seen = placed.select("conv_id", "pos", F.left("role", F.lit(1)).alias("initial"),
                         F.sha2(F.concat(F.length("role"), F.lit(":"), "role", "text"), 256).alias("key"),
                         (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("open"))
    first = seen.groupBy("conv_id", "key").agg(F.min("pos").alias("first")).select("first")
    both = seen.join(first, F.col("pos") == F.col("first"), "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("open"), "truncated")
    return both.select("conv_id", F.shiftright("pos", CHUNK_BITS).alias("chunk"), "pos", "initial", fault.alias("fault"))


def chunks(judged):
    """A row per chunk: conv_id, chunk, codes (a letter per row), n_illegal (pairs of neighbours, that with the chunk before
    included), is_last, following (the next chunk). The window holds one row per chunk of a conversation."""
    known = F.col("initial").isin("s", "u", "a")
    role = F.when(known, F.col("initial")).otherwise("x")
    code = F.when(F.col("fault").isin("blank", "duplicate"), "-").when(F.col("fault") == "truncated", F.upper(role)).otherwise(role)
    rows = judged.select("conv_id", "chunk", F.struct("pos", code.alias("code"), role.alias("role")).alias("row"))
    made = rows.groupBy("conv_id", "chunk").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    of = lambda field: F.array_join(F.transform("rows", lambda r: r[field]), "")
    made = made.select("conv_id", "chunk", of("code").alias("codes"), of("role").alias("roles"))
    order = Window.partitionBy("conv_id").orderBy("chunk")
    made = made.withColumns({"before": F.lag(F.right("roles", F.lit(1))).over(order), "following": F.lead("chunk").over(order)})
    return made.withColumn("roles", F.concat(F.coalesce("before", F.lit("")), "roles")).select(
        "conv_id", "chunk", "codes", "following", F.expr(
            "cast(size(filter(sequence(1, length(roles)), i -> i < length(roles) AND substring(roles, i, 2) NOT IN ('su', 'ua', 'au'))) AS long)"
        ).alias("n_illegal"))


VECTORS = "conv_id {0}, chunk long, codes string, following long, ended array<long>, started array<long>, total long, ran boolean"


def _searched(batches):
    """Search the chunks whose vector ``found`` at the end is another than the one they ran from."""
    for frame in batches:
        out = []
        for codes, ended, started, total, found in zip(frame["codes"], frame["ended"], frame["started"], frame["total"], frame["found"]):
            found = tuple(int(v) for v in found)
            ran = started is None or tuple(ended) != found
            if ran:
                costs, total = backward(codes, found)
                started = costs[0]
            out.append((list(found), list(started), total, ran))
        made = pd.DataFrame(out, columns=["ended", "started", "total", "ran"], index=frame.index)
        yield pd.concat([frame[["conv_id", "chunk", "codes"]], frame["following"].astype("Int64"), made], axis=1)


def converged(parts):
    """Chunks with the relative costs after their last row (ended) and before their first (started), and the total of what
    these were reduced by. Passes run until every chunk ran from what its successor came to, up to a constant."""
    schema = VECTORS.format(parts.schema["conv_id"].dataType.simpleString())
    none = F.lit(None)
    end = F.when(F.col("following").isNull(), F.array(*[F.lit(c).cast("long") for c in END_COSTS])).otherwise(
        F.array(*[F.lit(0).cast("long")] * 4))
    state = parts.select("conv_id", "chunk", "codes", "following", none.cast("array<long>").alias("ended"),
                         none.cast("array<long>").alias("started"), F.lit(0).cast("long").alias("total"), end.alias("found"))
    state = materialize(state.mapInPandas(_searched, schema), "viterbi")
    whole = state.filter("following IS NULL")  # these ran from true costs
    open_ = state.filter("following IS NOT NULL")
    for _ in range(MAX_PASSES):
        if open_.filter("ran").isEmpty():
            return whole.unionByName(open_)
        came = whole.unionByName(open_).select(F.col("conv_id").alias("__conv"), F.col("chunk").alias("__chunk"), F.col("started").alias("found"))
        met = open_.join(came, F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("following") == F.col("__chunk")))
        open_ = materialize(met.select(*[c for c in open_.columns if c != "ran"], "found").mapInPandas(_searched, schema), "viterbi")
    raise RuntimeError(f"cost vectors were not settled after {MAX_PASSES} passes")


def _traced(batches):
    """Audit and last state of each chunk for every state it may be entered in (first chunks: the one)."""
    for frame in batches:
        audits, states = [], []
        for codes, ended, following, first in zip(frame["codes"], frame["ended"], frame["following"], frame["is_first"]):
            costs, _ = backward(codes, tuple(int(v) for v in ended))
            found = [trace(codes, costs, s, pd.isna(following)) for s in ((START,) if first else range(4))]
            audits.append([a for a, _ in found])
            states.append([s for _, s in found])
        yield frame[["conv_id", "chunk"]].assign(audits=audits, states=states)


def audits(searched):
    """A row per chunk: conv_id, chunk, state (on entry), audit. What is chained along a conversation is four numbers a chunk."""
    firsts = searched.groupBy("conv_id").agg(F.min("chunk").alias("first")).select(F.col("conv_id").alias("__conv"), "first")
    known = searched.join(firsts, F.col("conv_id").eqNullSafe(F.col("__conv"))).withColumn("is_first", F.col("chunk") == F.col("first"))
    kind = searched.schema["conv_id"].dataType.simpleString()
    traced = materialize(known.select("conv_id", "chunk", "codes", "ended", "following", "is_first").mapInPandas(
        _traced, f"conv_id {kind}, chunk long, audits array<string>, states array<int>"), "audits")
    chain = traced.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("chunk", "states"))).alias("links"))
    entered = _chained(chain, kind)
    both = traced.join(entered, F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("chunk") == F.col("__chunk")))
    return both.select("conv_id", "chunk", "state", F.element_at("audits", F.least(F.col("state") + 1, F.size("audits"))).alias("audit"))


def _chained(chain, kind):
    """(__conv, __chunk, state): the state in which each chunk is entered."""

    def run(batches):
        for frame in batches:
            out = []
            for conv, links in zip(frame["conv_id"], frame["links"]):
                state = START
                for link in links:
                    out.append((conv, link["chunk"], state))
                    state = int(link["states"][min(state, len(link["states"]) - 1)])
            yield pd.DataFrame(out, columns=["__conv", "__chunk", "state"])

    return chain.mapInPandas(run, f"__conv {kind}, __chunk long, state int")


# --- repaired rows ----------------------------------------------------------

def _replayed(conv_type):
    """Function from sorted rows of chunks, each led by its audit, to the edits in order."""
    names = ["conv_id", "pos", "nth", "edit", "role", "text"]
    types = [conv_type, pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()]

    def replay(batches):
        audit, at, tail, state, conv, pos = "", 0, 0, START, None, 0
        for batch in batches:
            out = []

            def insert():
                nonlocal at, state
                nth = 0
                while at < len(audit) and audit[at] == "I":
                    state = TURN[state]
                    out.append((conv, pos, nth, "I", ROLES[LETTER[state]], ""))
                    at += 1
                    nth += 1
                return nth

            columns = [batch.column(c).to_pylist() for c in ("conv_id", "pos", "audit", "state", "role", "text")]
            for conv_, pos_, audit_, state_, role, text in zip(*columns, strict=True):
                if audit_ is not None:
                    conv, audit, at, tail, state = conv_, audit_, 0, len(audit_.rstrip("I")), state_
                    continue
                pos = pos_
                nth = insert()
                edit = audit[at]
                at += 1
                if edit == "D":
                    out.append((conv, pos, nth, edit, None, None))
                else:
                    if edit == "R":
                        state = TURN[state]
                        role = ROLES[LETTER[state]]
                    else:
                        state = NEXT[role[:1], state]
                    out.append((conv, pos, nth, edit, role, text))
                # what stands after a chunk's last row
                if tail == at < len(audit):
                    held, first = len(out), nth + 1
                    insert()
                    out[held:] = [(c, p, first + i, *rest) for i, (c, p, _, *rest) in enumerate(out[held:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 6, types, strict=True)], names=names)

    return replay


def repaired_rows(placed, found):
    """The edits in order: conv_id, pos and nth (their order), edit (K, R, D or I), role, text (both null for D).

    Chunks are dealt out whole, so a long conversation is replayed by many tasks.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = placed.schema["conv_id"].dataType
    rows = placed.select("conv_id", F.shiftright("pos", CHUNK_BITS).alias("chunk"), "pos", F.lit(None).cast("string").alias("audit"),
                         F.lit(None).cast("int").alias("state"), "role", "text")
    heads = found.select("conv_id", "chunk", F.lit(-1).cast("long").alias("pos"), "audit", "state",
                         F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    dealt = rows.unionByName(heads).repartition("conv_id", "chunk").sortWithinPartitions("conv_id", "chunk", "pos")
    return dealt.mapInArrow(_replayed(to_arrow_type(kind)), f"conv_id {kind.simpleString()}, pos long, nth int, edit string, role string, text string")


def _digested(conv_type):
    """Function from a partition's edits, sorted by conversation, to the digest of each: texts stream through, none is held."""

    def digest(batches):
        held, conv, started, some = hashlib.sha256(), None, False, False
        for batch in batches:
            done = []
            for c, role, text in zip(*[batch.column(x).to_pylist() for x in ("conv_id", "role", "text")], strict=True):
                if started and c != conv:
                    done.append((conv, held.hexdigest()))
                    held, some = hashlib.sha256(), False
                conv, started = c, True
                if role is not None:
                    held.update((("\n" if some else "") + role + ":" + text).encode())
                    some = True
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], conv_type), pa.array([d[1] for d in done], pa.string())],
                                             names=["conv_id", "repaired_sha256"])
        if started:
            yield pa.RecordBatch.from_arrays([pa.array([conv], conv_type), pa.array([held.hexdigest()], pa.string())],
                                             names=["conv_id", "repaired_sha256"])

    return digest


def conversation_digests(edits):
    """(conv_id, repaired_sha256) of the repaired rows ``role:text``, joined by newlines. A digest reads its conversation in
    order, so that one step is a stream per conversation; it holds one batch of rows."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = edits.schema["conv_id"].dataType
    dealt = edits.select("conv_id", "pos", "nth", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "pos", "nth")
    return dealt.mapInArrow(_digested(to_arrow_type(kind)), f"conv_id {kind.simpleString()}, repaired_sha256 string")


def repair(rows, conv_id="conv_id", turn="turn", role="role", text="text"):
    """(conversations, edits) of the rows. conversations: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.
    edits: conv_id, pos, nth, edit, role, text, the repaired conversation's rows in the order of pos and nth, with the deleted ones.

    Rows of a conversation are taken by turn (nulls first), equal turns by role and text. Null roles and texts read as one blank; a role
    that doesn't begin with s, u or a, the empty one too, can't be kept. Null
    conversation ids are one conversation. Repeated rows are duplicates. Whole texts are read. Other columns are not. An empty table
    gives two empty results.
    """
    named = keep(rows, conv_id, turn, role, text).select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), _text(role).alias("role"), _text(text).alias("text"))
    placed = positions(named)
    judged = materialize(faults(placed), "faults")
    parts = materialize(chunks(judged), "chunks")
    searched = converged(parts)
    found = materialize(audits(searched), "chunk-audits")

    def n(fault):
        return F.count(F.when(F.col("fault") == fault, 1)).alias(fault)

    counts = judged.groupBy("conv_id").agg(n("blank"), n("duplicate"), n("truncated"))
    turns = placed.groupBy("conv_id").agg(F.coalesce(
        F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"))
    pairs = parts.groupBy("conv_id").agg(F.sum("n_illegal").alias("illegal"))
    # the first chunk is entered with nothing yet
    started = F.min(F.struct("chunk", F.element_at("started", START + 1).alias("cost")))
    costs = searched.groupBy("conv_id").agg((started["cost"] + F.sum("total")).alias("cost"))
    letters = found.groupBy("conv_id").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("chunk", "audit"))), lambda c: c["audit"]), "").alias("audit"))
    out = turns
    for other in (counts, pairs, costs, letters):
        renamed = other.withColumnRenamed("conv_id", "__conv")
        out = out.join(renamed, F.col("conv_id").eqNullSafe(F.col("__conv"))).drop("__conv")
    return out.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"), repaired_rows(placed, found)


REPORT = {"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "",
          "repaired_sha256": hashlib.sha256(b"").hexdigest()}


def repair_report(rows, originals, conv_id="conv_id"):
    """One row per conversation of ``originals``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256. Conversations without rows have zeros, an empty audit and the digest of nothing; see ``repair``."""
    found, edits = repair(rows, conv_id)
    digests = conversation_digests(edits)
    every = keep(originals, conv_id).distinct().withColumnRenamed(conv_id, "__every")
    out = every.join(found, F.col("__every").eqNullSafe(F.col("conv_id")), "left")
    out = out.join(digests.withColumnRenamed("conv_id", "__conv"), F.col("__every").eqNullSafe(F.col("__conv")), "left")
    return out.select(F.col("__every").alias(conv_id), *[F.coalesce(c, F.lit(v)).alias(c) for c, v in REPORT.items()])
