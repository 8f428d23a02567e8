"""Token ids of documents, written in order to compressed files and read back."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonstar.llm.ans import Table, decode_block, encode_block, scaled
from seasonstar.llm.common import store, text_slices
from seasonstar.llm.encoding import ENCODED_BYTES, closed_ids, encoder
from seasonstar.sources.scratch import scratch_path

#: Ids after which a block is closed at the next end of a document.
BLOCK_IDS = 1 << 19

_IDS = "part int, seq long, doc_id long, start long, n_tokens long, ids binary"
_IDS_ARROW = pa.schema(
    [("part", pa.int32()), *((c, pa.int64()) for c in ("seq", "doc_id", "start", "n_tokens")), ("ids", pa.binary())]
)
_COUNTS = "id long, n long"
_BLOCKS = "first_index long, n_ids long, doc_ids array<long>, n_tokens array<long>, data binary"
_BLOCKS_ARROW = pa.schema(
    [("first_index", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())), ("data", pa.binary())]
)
_READ = "doc_id long, start long, n_tokens long, ids binary"
_READ_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def encode_ids(docs: DataFrame, path: str, units: str, end_id: int) -> DataFrame:
    """Ids of each document, closed by the end id, as 16-bit little-endian numbers where the vocabulary allows it.

    Rows are dealt by ranges of `doc_id` (repeats by a hash of their text, nulls first), so `part` and `seq` are the
    order of the whole table; `start` counts the ids before the document within its part.
    """
    wide = _number_type(path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, seq, before = encoder(path, units), TaskContext.get().partitionId(), 0, 0
        for batch in text_slices(batches, limit=ENCODED_BYTES):
            ids, ends = closed_ids(enc, batch.column("text").to_pylist(), end_id)
            data, starts = ids.astype(wide).tobytes(), np.concatenate([[0], ends[:-1]])
            size = np.dtype(wide).itemsize
            pieces = [data[size * a : size * b] for a, b in zip(starts.tolist(), ends.tolist())]
            n = len(ends)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, part, np.int32)), pa.array(np.arange(seq, seq + n)), batch.column("doc_id"),
                    pa.array(before + starts), pa.array(ends - starts), pa.array(pieces, pa.binary()),
                ],
                schema=_IDS_ARROW,
            )
            seq, before = seq + n, before + int(ends[-1])

    order = [F.col("doc_id"), F.xxhash64("text")]
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return dealt.repartitionByRange(*order).sortWithinPartitions(*order, "text").mapInArrow(run, _IDS)


def _number_type(path: str) -> str:
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"


def id_counts(ids: DataFrame, wide: str, end_id: int) -> DataFrame:
    """How often each id occurs. One row per id and task is shuffled."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(end_id + 1, np.int64)
        for batch in text_slices(batches, "ids"):
            values = np.frombuffer(b"".join(batch.column("ids").to_pylist()), wide)
            some = np.bincount(values, minlength=len(counts))
            counts = some + np.pad(counts, (0, len(some) - len(counts)))
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["id", "n"])

    return ids.select("ids").mapInArrow(run, _COUNTS).groupBy("id").agg(F.sum("n").alias("n"))


def write_ids(docs: DataFrame, path: str, out: str, units: str = "words", end_id: int = 1) -> None:
    """Write the ids of all documents to `out`, in ascending order of `doc_id`, as range-coded blocks.

    Two passes: the ids are made and kept in the shared folder; their counts over all documents (one number per id of the
    vocabulary) become the shared frequency table and the lengths of the parts (one per shuffle partition) the places of
    the blocks; then every task codes the parts it reads. `out/table` holds the frequencies, `out/blocks` one row
    per block: index of its first id, its documents with their lengths, and the coded ids. A block ends with a document.

    `docs` needs `doc_id` and `text`; other columns are ignored. A null text is empty and has the end id alone; a null
    `doc_id` comes first; rows with the same `doc_id` stay apart, in the order of a hash of their text. No rows give
    an empty set of blocks.
    """
    spark, wide = docs.sparkSession, _number_type(path)
    ids = store(encode_ids(docs, path, units, end_id), "ids")
    counts = {r["id"]: r["n"] for r in id_counts(ids, wide, end_id).collect()}
    lengths = {r["part"]: r["n"] for r in ids.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()}
    dense = np.zeros(max(counts, default=0) + 1, np.int64)
    dense[list(counts)] = list(counts.values())
    freq = scaled(dense)
    before, total = {}, 0
    for part in sorted(lengths):
        before[part], total = total, total + lengths[part]
    shared = spark.sparkContext.broadcast((freq, before))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        freq, before = shared.value
        table, held = Table(freq), []

        def block() -> pa.RecordBatch:
            data = np.frombuffer(b"".join(x[4] for x in held), wide).astype(np.uint32)
            first = before[held[0][0]] + held[0][3]
            row = [first], [len(data)], [[x[2] for x in held]], [[x[5] for x in held]], [encode_block(data, table)]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, _BLOCKS_ARROW)], schema=_BLOCKS_ARROW)

        n = 0
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("part", "seq", "doc_id", "start", "ids", "n_tokens"))
            for row in zip(*columns):
                if held and (n >= BLOCK_IDS or row[0] != held[-1][0] or row[1] != held[-1][1] + 1):
                    yield block()
                    n = 0
                held.append(row)
                n += row[5]
        if held:
            yield block()

    ids.mapInArrow(run, _BLOCKS).write.option("compression", "none").parquet(f"{out}/blocks")
    rows = [(int(i), int(freq[i])) for i in np.flatnonzero(freq)]
    spark.createDataFrame(rows, "id long, freq long").coalesce(1).write.parquet(f"{out}/table")


def read_ids(spark: SparkSession, out: str) -> DataFrame:
    """Documents of written files: `doc_id`, `start` (ids of all documents before it), `n_tokens`, `ids` (32-bit, little-endian).

    Blocks are decoded on their own, in any order; a wrong checksum raises an error.
    """
    pairs = spark.read.schema("id long, freq long").parquet(f"{out}/table").collect()
    freq = np.zeros(max((r["id"] for r in pairs), default=0) + 1, np.int64)
    freq[[r["id"] for r in pairs]] = [r["freq"] for r in pairs]
    shared = spark.sparkContext.broadcast(freq)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(shared.value)
        for batch in batches:
            for first, docs, lengths, data in zip(*(batch.column(c) for c in ("first_index", "doc_ids", "n_tokens", "data"))):
                ids = decode_block(data.as_py(), table).astype("<u4").tobytes()
                ends = np.cumsum(lengths.values.to_numpy())
                starts = np.concatenate([[0], ends[:-1]])
                pieces = [ids[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [docs.values, pa.array(starts + first.as_py()), lengths.values, pa.array(pieces, pa.binary())],
                    schema=_READ_ARROW,
                )

    return spark.read.schema(_BLOCKS).parquet(f"{out}/blocks").mapInArrow(run, _READ)


def round_trip(docs: DataFrame, path: str, units: str = "words", end_id: int = 1) -> DataFrame:
    """Write to a new folder in the shared scratch place and read back."""
    out = scratch_path(docs.sparkSession, "token-files")
    write_ids(docs, path, out, units, end_id)
    return read_ids(docs.sparkSession, out)
