"""Exact top-k search by inner product over a bit-sliced index.

1. Vectors become integers, floor(scale * x), and are dealt to blocks of rows. A block keeps its whole vectors and, for each
   component, the highest bits of the distance from the block's least value as slices: one bitmap per bit, a bit per row.
2. Queries lie in chunks. Every chunk meets every block in a cell of its own; no pair of vectors is a row.
3. For one query a slice counts once for every one bit of its component's weight, at the place of both bits; a negative
   weight takes the complement. Bitmaps of the same place are added three at a time: sum and carry, until a place holds one.
   So the block's sums are again slices.
4. From the most significant slice down, the rows that must be among the first k are parted from those that still tie.
   The k-th sum less the error of the cut bits is the bar; a comparison with it on the same slices leaves the boundary rows.
5. These are scored exactly. The first k of each block and query then meet by query.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from fieldlens.llm.common import keep, materialize

BLOCK_ROWS = 8_192
CHUNK_QUERIES = 1_024
SLICE_BITS = 6
# Partitions of the index at most; beyond so many blocks a partition holds several.
INDEX_PARTS = 4_096
WHOLE = "slot long, dims int, low binary, cut binary, slices binary, ids binary, vectors binary, n_rows int"


# --- bitmap arithmetic ------------------------------------------------------

def add_bitmaps(planes):
    """Bitmaps by place (lists of arrays, place j counts 2^j each) to one bitmap per place: the sums in binary."""
    planes, out, place = dict(planes), [], 0
    while place <= max(planes, default=-1):
        rows, carries = planes.pop(place, None), []
        if rows is None:
            out.append(None)
            place += 1
            continue
        while len(rows) > 2:
            third = len(rows) // 3
            a, b, c, rest = rows[:third], rows[third:2 * third], rows[2 * third:3 * third], rows[3 * third:]
            half = a ^ b
            carries.append((a & b) | (half & c))
            rows = np.concatenate([half ^ c, rest])
        if len(rows) == 2:
            carries.append(rows[:1] & rows[1:])
            rows = rows[:1] ^ rows[1:]
        out.append(rows[0])
        if carries:
            if place + 1 in planes:
                carries.append(planes[place + 1])
            planes[place + 1] = np.concatenate(carries)
        place += 1
    return out


def kth_value(sums, valid, k):
    """The k-th largest sum (the least one, if there are fewer rows), by going down the slices."""
    surely, tied, value = np.zeros_like(valid), valid, 0
    need = min(k, int(np.bitwise_count(valid).sum()))
    for place in range(len(sums) - 1, -1, -1):
        slice_ = sums[place]
        if slice_ is None:
            continue
        both = tied & slice_
        n = int(np.bitwise_count(surely).sum()) + int(np.bitwise_count(both).sum())
        if n >= need:
            tied, value = both, value + (1 << place)
        else:
            surely, tied = surely | both, tied & ~slice_
    return value


def at_least(sums, valid, bar):
    """Bitmap of the rows whose sum is at least ``bar``."""
    if bar <= 0:
        return valid
    if bar >> len(sums):
        return np.zeros_like(valid)
    above, tied = np.zeros_like(valid), valid
    for place in range(len(sums) - 1, -1, -1):
        slice_ = sums[place]
        if bar >> place & 1:
            tied = tied & slice_ if slice_ is not None else np.zeros_like(valid)
        elif slice_ is not None:
            above, tied = above | (tied & slice_), tied & ~slice_
    return above | tied


class Block:
    """Slices of up to ``BLOCK_ROWS`` integer vectors of one length."""

    def __init__(self, low, cut, slices, ids, vectors):
        self.low, self.cut, self.slices, self.ids, self.vectors = low, cut, slices, ids, vectors
        self.n = len(vectors)
        self.words = -(-max(self.n, 1) // 64)
        bits = np.zeros(self.words * 64, dtype=bool)
        bits[:self.n] = True
        self.valid = np.packbits(bits, bitorder="little").view("<u8")
        self.largest = np.abs(vectors).max(axis=0).astype("float64") if self.n and vectors.shape[1] else np.zeros(vectors.shape[1])

    @classmethod
    def build(cls, ids, vectors, bits=SLICE_BITS):
        n, dims = vectors.shape
        low = vectors.min(axis=0) if dims else np.zeros(0, "int64")
        above = (vectors - low).astype("uint64")
        width = np.array([int(v).bit_length() for v in above.max(axis=0)] if dims else [], dtype="int64")
        cut = np.maximum(0, width - bits)
        padded = np.zeros((-(-n // 64) * 64, dims), dtype="uint64")
        padded[:n] = above >> cut.astype("uint64")
        slices = np.stack([np.packbits((padded >> np.uint64(b) & np.uint64(1)).astype(bool), axis=0, bitorder="little").T.copy().view("<u8")
                           for b in range(bits)], axis=1) if dims else np.zeros((0, bits, len(padded) // 64), "<u8")
        return cls(low, cut, slices, ids, vectors)

    def best(self, query, k, own):
        """Places in the block of the k highest inner products with ``query``, and these; rows of id ``own`` are left out."""
        bits = self.slices.shape[1]
        weight = np.abs(query)
        if float((np.abs(query).astype("float64") * np.maximum(self.largest, 1)).sum()) >= 2.0 ** 62:
            raise ValueError("inner products beyond 64-bit integers")
        valid = self.valid
        mine = np.flatnonzero(self.ids == own) if own is not None else ()
        if len(mine):
            valid = valid.copy()
            for i in mine:
                valid[i >> 6] &= ~np.uint64(1 << int(i & 63))
        planes, falling = {}, query < 0
        for bit in range(int(weight.max()).bit_length() if len(weight) else 0):
            on = np.flatnonzero(weight >> bit & 1)
            for cut in np.unique(self.cut[on]):
                picked = on[self.cut[on] == cut]
                # all ones for a falling component turn its slices into their complement
                flip = np.where(falling[picked], np.uint64(2 ** 64 - 1), np.uint64(0))[:, None]
                for place in range(bits):
                    planes.setdefault(int(bit + cut + place), []).append(self.slices[picked, place] ^ flip)
        sums = add_bitmaps({p: np.concatenate(parts) for p, parts in planes.items()})
        # the bits that were cut are worth at most 2^cut - 1 each
        error = int((weight * ((1 << self.cut) - 1)).sum()) if len(weight) else 0
        left = at_least(sums, valid, kth_value(sums, valid, k) - error)
        rows = np.flatnonzero(np.unpackbits(left.view("u1"), bitorder="little")[:self.n])
        scores = self.vectors[rows] @ query
        return rows, scores


# --- index and search -------------------------------------------------------

def integer_vectors(table, vector="embedding", vec_id="vec_id", scale=256):
    """(id, vector) of the rows that take part: vectors without null or non-finite components, as integers."""
    whole = F.col(vector).isNotNull() & ~F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    to_int = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return keep(table, vec_id, vector).filter(whole).select(F.col(vec_id).alias("id"), to_int.alias("vector"))


def _matrices(batch):
    """(rows, matrix) of each vector length in an Arrow batch of (id, vector)."""
    column = batch.column("vector")
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    for dims in np.unique(sizes):
        rows = np.flatnonzero(sizes == dims)
        yield rows, flat[starts[rows][:, None] + np.arange(dims)].reshape(len(rows), int(dims)).astype("int64")


# A null id, as the block's arrays hold it.
NO_ID = np.iinfo("int64").min


def _ids(column):
    return column.fill_null(int(NO_ID)).to_numpy(zero_copy_only=False).astype("int64")


def _build_blocks(block_rows, bits):
    """Function from batches of a partition to its blocks; a partition's number is its blocks' slot."""

    def out(slot, dims, ids, vectors):
        block = Block.build(ids, vectors, bits)
        made = [slot, dims, block.low.tobytes(), block.cut.tobytes(), block.slices.tobytes(), ids.tobytes(), vectors.tobytes(), len(ids)]
        types = [pa.int64(), pa.int32(), *[pa.binary()] * 5, pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(made, types, strict=True)], names=[c.split()[0] for c in WHOLE.split(", ")])

    def build(batches):
        slot, held = TaskContext.get().partitionId(), {}
        for batch in batches:
            ids = _ids(batch.column("id"))
            for rows, matrix in _matrices(batch):
                parts = held.setdefault(matrix.shape[1], [])
                parts.append((ids[rows], matrix))
                if sum(len(p[0]) for p in parts) >= block_rows:
                    every, whole = (np.concatenate(x) for x in zip(*parts, strict=True))
                    full = len(every) // block_rows * block_rows
                    for lo in range(0, full, block_rows):
                        yield out(slot, matrix.shape[1], every[lo:lo + block_rows], whole[lo:lo + block_rows])
                    held[matrix.shape[1]] = [(every[full:], whole[full:])]
        for dims, parts in held.items():
            ids, vectors = (np.concatenate(x) for x in zip(*parts, strict=True))
            if len(ids):
                yield out(slot, dims, ids, vectors)

    return build


def bit_sliced_index(vectors, rows=None, block_rows=BLOCK_ROWS, bits=SLICE_BITS):
    """(index, slots): the written blocks of (id, vector) rows and the number of slots they lie in. Rows are dealt out evenly,
    whatever their ids, so a vector that is repeated often doesn't fill a block's task."""
    rows = vectors.count() if rows is None else rows
    slots = int(min(INDEX_PARTS, max(1, -(-rows // block_rows))))
    return materialize(vectors.repartition(slots).mapInArrow(_build_blocks(block_rows, bits), WHOLE), "bit-slices"), slots


def _pack(batches):
    number = TaskContext.get().partitionId()
    for batch in batches:
        ids = _ids(batch.column("id"))
        for rows, matrix in _matrices(batch):
            made = [number, matrix.shape[1], ids[rows].tobytes(), matrix.tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(
                made, [pa.int64(), pa.int32(), pa.binary(), pa.binary()], strict=True)], names=["chunk", "dims", "ids", "vectors"])


def _search(k, bits):
    """Function from a cell's query chunks and blocks to the first k of each query in each block."""

    def cell(chunks, blocks):
        found = {"query_id": [], "query_key": [], "vec_id": [], "score": []}
        # one block is unpacked at a time
        for b in range(blocks.num_rows):
            row = {c: blocks.column(c)[b].as_py() for c in blocks.column_names}
            dims, n = row["dims"], row["n_rows"]
            slices = np.frombuffer(row["slices"], "<u8").reshape(dims, bits, -(-n // 64))
            block = Block(np.frombuffer(row["low"], "int64"), np.frombuffer(row["cut"], "int64"), slices,
                          np.frombuffer(row["ids"], "int64"), np.frombuffer(row["vectors"], "int64").reshape(n, dims))
            for c in range(chunks.num_rows):
                if chunks.column("dims")[c].as_py() != dims:
                    continue
                ids = np.frombuffer(chunks.column("ids")[c].as_py(), "int64")
                queries = np.frombuffer(chunks.column("vectors")[c].as_py(), "int64").reshape(len(ids), dims)
                for own, query in zip(ids, queries, strict=True):
                    rows, scores = block.best(query, k, own)
                    # a null id comes last among equals
                    names = block.ids[rows]
                    first = np.lexsort((names, names == NO_ID, -scores))[:k]
                    found["query_id"].append(np.full(len(first), own))
                    found["query_key"].append(np.full(len(first), np.uint64(xxhash.xxh64_intdigest(query.tobytes())).view("int64")))
                    found["vec_id"].append(names[first])
                    found["score"].append(scores[first])
        done = {name: np.concatenate(parts).astype("int64") if parts else np.zeros(0, "int64") for name, parts in found.items()}
        ids = pa.array(done["vec_id"], pa.int64(), mask=done["vec_id"] == NO_ID)
        return pa.table({"query_id": done["query_id"], "query_key": done["query_key"], "vec_id": ids, "score": done["score"]})

    return cell


def exact_top_k(table, queries, k=5, vector="embedding", vec_id="vec_id", scale=256, block_rows=BLOCK_ROWS,
                chunk_queries=CHUNK_QUERIES, bits=SLICE_BITS):
    """(query_id, rank, vec_id, score): the ``k`` rows of the table with the highest integer inner product for every row that
    the condition ``queries`` (on vec_id) picks; equal scores by smaller vec_id, ranks are unique.

    Components count as floor(scale * x). Vectors that are null or hold a null or non-finite component take no part; a query is compared with
    vectors of its own length, an empty one scores 0 with every empty one. Rows with the query's id are the query itself and no candidates;
    rows with a null id are candidates, last among equal scores, and never queries. Repeated rows are candidates each; rows
    that repeat a query's id and vector are one query, another vector under the same id is ranked for itself. Other columns are not read. With
    fewer than k candidates all are listed; an empty table gives an empty result. Inner products beyond 64 bits raise.
    """
    vectors = materialize(integer_vectors(table, vector, vec_id, scale), "integer-vectors")
    asked = materialize(vectors.filter(F.col("id").isNotNull() & queries(F.col("id"))).distinct(), "queries")
    index, slots = bit_sliced_index(vectors, block_rows=block_rows, bits=bits)
    chunks = int(max(1, -(-asked.count() // chunk_queries)))
    packed = asked.repartition(chunks).mapInArrow(_pack, "chunk long, dims int, ids binary, vectors binary")
    cells = int(min(slots * chunks, 100_000))
    left = packed.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1)))).withColumn("slot", F.col("slot").cast("long"))
    right = index.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))).withColumn("chunk", F.col("chunk").cast("long"))
    near = left.repartition(cells, "slot", "chunk").groupBy("slot", "chunk").cogroup(
        right.repartition(cells, "slot", "chunk").groupBy("slot", "chunk")).applyInArrow(
            _search(k, bits), "query_id long, query_key long, vec_id long, score long")
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
