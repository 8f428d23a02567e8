"""Exact top-k inner products over a bit-sliced index of quantised vectors."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seasonstar.llm.common import store

#: Rows of an index block, on average.
BLOCK_ROWS = 1 << 14
#: Queries whose hits leave a task together.
CHUNK_QUERIES = 512
#: Bits that a score may have.
SCORE_BITS = 62

_INDEX = "dims int, block long, n long, vec_ids binary, low binary, bits int, slices binary, values binary"
_HITS = "query_id long, query_no long, vec_id long, score long"


def quantise(vectors: DataFrame, scale: int) -> DataFrame:
    """floor(scale * x) of each component, as whole numbers; vectors null, or with a null or non-finite component, go."""
    doubles = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")) & ~F.isnan(x))
    values = F.transform(doubles, lambda x: F.floor(x * scale).cast("long"))
    usable = vectors.filter(F.col("embedding").isNotNull() & F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False)))
    return usable.select(F.col("vec_id").cast("long").alias("vec_id"), values.alias("v")).distinct()


def slice_block(values: np.ndarray) -> tuple[np.ndarray, int, np.ndarray]:
    """The smallest value of each component, the bits that hold what lies above, and one bitmap per component and bit."""
    low = values.min(axis=0)
    above = (values - low).astype(np.uint64)
    bits = max(1, int(above.max(initial=0)).bit_length())
    rows = -(-len(values) // 64) * 64
    padded = np.zeros((values.shape[1], rows), np.uint64)
    padded[:, : len(values)] = above.T
    planes = [np.packbits((padded >> np.uint64(b) & np.uint64(1)).astype(np.uint8), axis=1, bitorder="little") for b in range(bits)]
    return low, bits, np.stack(planes, axis=1).view("<u8")


def _narrow(values: np.ndarray) -> str:
    """The smallest whole-number type that holds the values."""
    return next(t for t in ("<i2", "<i4", "<i8") if np.array_equal(values.astype(t), values))


def build_index(quantised: DataFrame) -> DataFrame:
    """Blocks of rows of the same dimension, dealt by a hash of the id, each with its bit slices and its own numbers."""
    rows = quantised.withColumn("dims", F.size("v"))
    blocks = max(1, -(-quantised.count() // BLOCK_ROWS))

    def block(table: pa.Table) -> pa.Table:
        dims = table.column("dims")[0].as_py()
        ids = table.column("vec_id").to_numpy()
        values = table.column("v").combine_chunks().values.to_numpy().reshape(len(ids), dims)
        order = np.lexsort((*values.T[::-1], ids))
        ids, values = ids[order], values[order]
        low, bits, slices = slice_block(values) if dims else (np.empty(0, np.int64), 1, np.empty((0, 1, -(-len(ids) // 64)), "<u8"))
        row = {
            "dims": dims, "block": table.column("block")[0].as_py(), "n": len(ids), "vec_ids": ids.astype("<i8").tobytes(),
            "low": low.astype("<i8").tobytes(), "bits": bits, "slices": slices.tobytes(), "values": values.astype(_narrow(values)).tobytes(),
        }
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.binary()]
        return pa.table([pa.array([v], k) for v, k in zip(row.values(), kinds)], names=list(row))

    placed = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    return placed.groupBy("dims", "block").applyInArrow(block, _INDEX)


def _compress(stack: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Bitmaps of one weight, three at a time, become a sum of that weight and a carry of the next."""
    n = len(stack) // 3
    a, b, c = stack[:n], stack[n : 2 * n], stack[2 * n : 3 * n]
    half = a ^ b
    return [half ^ c, stack[3 * n :]], [(a & b) | (c & half)]


def add_weighted(slices: np.ndarray, factors: np.ndarray) -> list[np.ndarray]:
    """Bit slices, lowest first, of the sum over components of factor times value, for factors of 0 or more.

    A set bit j of a factor puts slice i of its component among the bitmaps of weight i + j; the bitmaps of each weight are
    added by carry-save steps until one is left, the carries going to the next weight.
    """
    components, bits, words = slices.shape
    factor_bits = int(factors.max(initial=0)).bit_length()
    chosen = [np.flatnonzero(factors >> j & 1) for j in range(factor_bits)]
    carries: list[np.ndarray] = []
    out, weight = [], 0
    while weight < bits + factor_bits or carries:
        mine = [slices[chosen[j], weight - j] for j in range(max(0, weight - bits + 1), min(factor_bits, weight + 1))]
        parts = mine + carries
        stack, carries = np.concatenate(parts) if parts else np.empty((0, words), np.uint64), []
        while len(stack) > 2:
            kept, carry = _compress(stack)
            stack = np.concatenate(kept)
            carries += carry
        if len(stack) == 2:
            carries.append((stack[0] & stack[1])[None])
            stack = (stack[0] ^ stack[1])[None]
        out.append(stack[0] if len(stack) else np.zeros(words, np.uint64))
        weight += 1
    return out


def largest(slices: list[np.ndarray], candidates: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest sums among the candidates, from the highest slice down.

    Rows are certain once more of them than needed cannot share their leading bits. Rows equal to the last bit are
    the boundary: the smallest positions of them fill up.
    """
    sure, equal = np.zeros_like(candidates), candidates
    for plane in slices[::-1]:
        more = equal & plane
        n = int(np.bitwise_count(sure).sum() + np.bitwise_count(more).sum())
        if n > k:
            equal = more
        else:
            sure, equal = sure | more, equal & ~plane
            if n == k:
                equal = np.zeros_like(equal)
                break

    def positions(bitmap: np.ndarray, most: int | None = None) -> np.ndarray:
        words = np.flatnonzero(bitmap)[:most]
        found = np.unpackbits(bitmap[words].view(np.uint8).reshape(len(words), 8), axis=1, bitorder="little")
        row, bit = np.nonzero(found)
        return (words[row] * 64 + bit)[:most]

    certain = positions(sure)
    return np.concatenate([certain, positions(equal, k - len(certain))])


class Block:
    """An index block, ready to be searched."""

    def __init__(self, row: dict):
        self.dims, self.n = row["dims"], row["n"]
        self.ids = np.frombuffer(row["vec_ids"], "<i8")
        self.low = np.frombuffer(row["low"], "<i8")
        self.slices = np.frombuffer(row["slices"], "<u8").reshape(self.dims, row["bits"], -(-self.n // 64))
        self.flipped = ~self.slices
        self.bits = row["bits"]
        size = len(row["values"]) // max(1, self.n * self.dims)
        self.values = np.frombuffer(row["values"], f"<i{size or 8}").reshape(self.n, self.dims)
        every = np.zeros(-(-self.n // 64) * 64, np.uint8)
        every[: self.n] = 1
        self.every = np.packbits(every, bitorder="little").view("<u8")

    def search(self, query_id: int, vector: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact scores of the block's best rows for the query, its own row left out.

        A negative factor takes the flipped slices, which count down from the top; what this adds is the same for all
        rows, so the order stays.
        """
        reach = sum(abs(int(q)) * max(abs(int(lo)), abs(int(lo) + (1 << self.bits))) for q, lo in zip(vector, self.low))
        if reach.bit_length() > SCORE_BITS:
            raise OverflowError("a score does not fit into 64 bits")
        candidates = self.every.copy()
        at = np.searchsorted(self.ids, query_id)
        while at < self.n and self.ids[at] == query_id:
            if np.array_equal(self.values[at], vector):
                candidates[at // 64] &= ~np.uint64(1 << (at % 64))
            at += 1
        signed = np.where((vector < 0)[:, None, None], self.flipped, self.slices)
        best = largest(add_weighted(signed, np.abs(vector)), candidates, k)
        return self.ids[best], self.values[best].astype(np.int64) @ vector


def search(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The k best rows of the index for each query, as query_id, rank, vec_id, score.

    Every query goes to every block of its dimension. A task reads a block, then the queries sent to it one batch after the
    other, and gives the block's k best per query; these few rows are ranked by score and id.
    """
    numbered = queries.withColumn("query_no", F.xxhash64("vec_id", "v")).withColumn("dims", F.size("v"))
    places = index.select("dims", "block")
    sent = numbered.join(places, "dims").select(*places.columns, "vec_id", "query_no", "v")
    both = index.withColumn("is_query", F.lit(False)).unionByName(sent.withColumn("is_query", F.lit(True)), allowMissingColumns=True)
    dealt = both.repartition("dims", "block").sortWithinPartitions("dims", "block", "is_query")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, columns = None, ([], [], [], [])

        def hits() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "query_no", "vec_id", "score"])
            for c in columns:
                c.clear()
            return out

        for batch in batches:
            ids, numbers, asks = (batch.column(c).to_pylist() for c in ("vec_id", "query_no", "is_query"))
            vectors = batch.column("v")
            for i, ask in enumerate(asks):
                if not ask:
                    block = Block(batch.slice(i, 1).to_pylist()[0])
                    continue
                found, scores = block.search(ids[i], vectors[i].values.to_numpy(), k)
                for column, more in zip(columns, ([ids[i]] * len(found), [numbers[i]] * len(found), found.tolist(), scores.tolist())):
                    column += more
                if len(columns[0]) >= k * CHUNK_QUERIES:
                    yield hits()
        if columns[0]:
            yield hits()

    best = Window.partitionBy("query_id", "query_no").orderBy(F.desc("score"), "vec_id")
    ranked = dealt.mapInArrow(run, _HITS).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def top_k(vectors: DataFrame, is_query, k: int = 5, scale: int = 256) -> DataFrame:
    """The k highest integer inner products of each query row with all other rows, ties to the smaller id.

    `vectors` needs `vec_id` and `embedding`; other columns are ignored. Vectors null, or with a null or non-finite
    component, and rows without an id take no part. Equal rows count once; different vectors with one id are rows of
    their own. Only vectors of the same dimension are compared; empty ones have score 0. A score beyond 62 bits raises
    an error. No rows give no rows.
    """
    quantised = store(quantise(vectors, scale), "quantised")
    index = store(build_index(quantised), "slices")
    return search(index, quantised.filter(is_query), k)


TOP_K_SQL = """
WITH usable AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (
  SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM usable),
scores AS (
  SELECT q.vec_id AS query_id, r.vec_id, sum(q.x * r.x)::BIGINT AS score
  FROM parts q JOIN parts r ON q.i = r.i AND q.vec_id <> r.vec_id WHERE q.vec_id % 50 = 0 GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
