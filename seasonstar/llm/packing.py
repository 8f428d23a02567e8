"""Packing of documents into sequences of a fixed length by the sum-of-squares rule."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from seasonstar.llm.common import text_slices
from seasonstar.llm.encoding import ENCODED_BYTES, closed_ids, encoder

PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
_ARROW = pa.schema(
    [(c, pa.int64()) for c in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset")] + [("ids", pa.binary())]
)


class Packer:
    """The open sequences of one task, by fill level.

    `level[h]` counts the open sequences with h tokens. An item of s tokens goes where the sum of the squared
    counts over all partial levels is smallest afterwards: on a level h it takes a sequence from `level[h]` and adds one
    to `level[h + s]`, and a full sequence counts nowhere. Ties go to the fuller level, a new sequence is level 0.
    """

    def __init__(self, size: int, first_id: int):
        self.size, self.next_id = size, first_id
        self.level = np.zeros(size + 1, np.int64)
        self.open: list[list[tuple[int, list]]] = [[] for _ in range(size)]

    def new(self) -> int:
        self.next_id += 1
        return self.next_id - 1

    def place(self, length: int, piece) -> tuple[int, int, list | None]:
        """Sequence and offset of the item; third, the pieces of the sequence when it is now full."""
        size, level = self.size, self.level
        h = np.arange(0, size - length + 1)
        after = level[length : size + 1]
        change = 2 * after + 1  # (n + 1)^2 - n^2
        change = change - np.where(h == 0, 0, 2 * level[: size - length + 1] - 1)
        if length <= size:
            change[-1] -= 2 * after[-1] + 1  # a full sequence is no partial level
        usable = (level[: size - length + 1] > 0) | (h == 0)
        best = np.flatnonzero(usable)
        at = int(best[::-1][np.argmin(change[best][::-1])])
        if at:
            sequence, pieces = self.open[at].pop()
            level[at] -= 1
        else:
            sequence, pieces = self.new(), []
        pieces.append(piece)
        if at + length < size:
            level[at + length] += 1
            self.open[at + length].append((sequence, pieces))
        return sequence, at, pieces if at + length == size else None

    def rest(self) -> list[list]:
        """The pieces of all sequences still open, fullest first."""
        return [pieces for stack in self.open[::-1] for _, pieces in stack]


def _cuts(total: int, size: int) -> list[int]:
    """Lengths of the last sequences: whole ones, then the binary parts of what remains, which need no padding."""
    tail = total % size
    return [size] * (total // size) + [1 << b for b in range(tail.bit_length() - 1, -1, -1) if tail >> b & 1]


def pack_batches(batches: Iterable[pa.RecordBatch], path: str, units: str, size: int, end_id: int) -> Iterator[pa.RecordBatch]:
    """Pieces of the documents of one task; the task's place makes its sequence numbers its own."""
    enc = encoder(path, units)
    packer = Packer(size, TaskContext.get().partitionId() << 40)
    rows: list[tuple] = []

    def put(piece, sequence, offset):
        doc, start, length, total, data = piece
        rows.append((doc, start, length, total, sequence, offset, data))

    def put_all(pieces, sequence):
        offset = 0
        for piece in pieces:
            put(piece, sequence, offset)
            offset += piece[2]

    def out():
        cols = list(zip(*rows))
        rows.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _ARROW)], schema=_ARROW)

    for batch in text_slices(batches, limit=ENCODED_BYTES):
        ids, ends = closed_ids(enc, batch.column("text").to_pylist(), end_id)
        data, first = ids.astype("<u4").tobytes(), 0
        for doc, end in zip(batch.column("doc_id").to_pylist(), ends.tolist()):
            total = end - first
            whole = total - total % size
            for start in range(0, whole, size):
                put((doc, start, size, total, data[4 * (first + start) : 4 * (first + start + size)]), packer.new(), 0)
            if total > whole:
                piece = (doc, whole, total - whole, total, data[4 * (first + whole) : 4 * end])
                sequence, _, full = packer.place(total - whole, piece)
                if full:
                    put_all(full, sequence)
            first = end
        if rows:
            yield out()
    rest = [piece for pieces in packer.rest() for piece in pieces]
    lengths = iter(_cuts(sum(piece[2] for piece in rest), size))
    room = sequence = taken = 0
    for doc, start, length, total, data in rest:
        at = 0
        while at < length:
            if not room:
                taken = room = next(lengths)
                sequence = packer.new()
            some = min(room, length - at)
            put((doc, start + at, some, total, data[4 * at : 4 * (at + some)]), sequence, taken - room)
            at, room = at + some, room - some
    if rows:
        yield out()


def pack(docs: DataFrame, path: str, units: str = "spaced", size: int = 1024, end_id: int = 0) -> DataFrame:
    """Pieces of documents laid gapless into sequences of at most `size` tokens.

    A document is its ids and the end id. Its whole sequences are cut off first; what remains, less than a sequence,
    is one item of the sum-of-squares rule (`Packer`). The few sequences still open at the end of a task are joined
    end to end, and the last of them is cut into powers of two, so nothing is padded. Each task packs the documents
    it reads: nothing is shuffled, and memory holds the open tails only. Tails of varied lengths keep few sequences open;
    tails that are all of one length over half a sequence, as in a large group of copies, stay open each, so
    the bound is the task's input.

    `docs` needs `doc_id` and `text`; other columns are ignored. A null text is empty and has the end id alone. A null
    or repeated `doc_id` is kept as it is, each row a document. No rows give no pieces. Sequence numbers are unique
    and depend on the order and split of the input files only.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return pack_batches(batches, path, units, size, end_id)

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)
