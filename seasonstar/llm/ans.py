"""Static range asymmetric numeral coding of id streams, in independent interleaved blocks.

One frequency table serves all blocks. A block deals its ids over lanes, one coder state each; the lanes share one stream of
32-bit words. At every checkpoint a block notes the lane states, the place in the stream and the checksum of the ids
that follow, so each stretch between checkpoints can be decoded and checked on its own.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

#: Bits of the frequency scale. States lie in [2^31, 2^63) and are renewed by 32 bits at a time.
SCALE_BITS = 20
LOW = np.uint64(1 << 31)
LANES, FEW_LANES = 1024, 16
#: Steps, of one id per lane, between checkpoints.
CHECKPOINT_STEPS = 256

_MAGIC = b"RANS"
_HEAD = struct.Struct("<4sHHIQI")  # magic, version, lanes, checkpoints, ids, words
_MARK = struct.Struct("<II")  # place in the words, checksum of the stretch


def scaled(counts: np.ndarray, bits: int = SCALE_BITS) -> np.ndarray:
    """Frequencies that add up to 2^bits, at least 1 for each id that occurs."""
    total, out = int(counts.sum()), np.zeros(len(counts), np.int64)
    seen = np.flatnonzero(counts)
    if not len(seen):
        return out
    room = (1 << bits) - len(seen)
    share = [int(c) * room // total for c in counts[seen]]
    out[seen] = np.array(share, np.int64) + 1
    out[seen[np.argmax(counts[seen])]] += (1 << bits) - int(out.sum())
    return out


class Table:
    """Frequencies with what coding and decoding look up."""

    def __init__(self, freq: np.ndarray, bits: int = SCALE_BITS):
        self.bits = np.uint64(bits)
        self.mask = np.uint64((1 << bits) - 1)
        self.freq = freq.astype(np.uint64)
        self.base = (np.cumsum(freq) - freq).astype(np.uint64)
        self.limit = self.freq << np.uint64(63 - bits)
        self._symbols: np.ndarray | None = None

    @property
    def symbols(self) -> np.ndarray:
        """The id of each slot of the scale."""
        if self._symbols is None:
            self._symbols = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        return self._symbols


def encode_block(ids: np.ndarray, table: Table) -> bytes:
    lanes = LANES if len(ids) >= 16 * LANES else FEW_LANES
    steps = -(-len(ids) // lanes)
    state = np.full(lanes, LOW)
    words: list[np.ndarray] = [np.empty(0, np.uint32)] * steps
    states: dict[int, np.ndarray] = {}
    for step in range(steps - 1, -1, -1):
        some = ids[step * lanes : (step + 1) * lanes]
        x, f = state[: len(some)], table.freq[some]
        over = x >= table.limit[some]
        words[step] = x[over].astype(np.uint32)
        x = np.where(over, x >> np.uint64(32), x)
        whole = x // f
        state[: len(some)] = (whole << table.bits) + (x - whole * f) + table.base[some]
        if step % CHECKPOINT_STEPS == 0:
            states[step] = state.copy()
    place = np.concatenate([[0], np.cumsum([len(w) for w in words])]) if steps else np.zeros(1)
    marks = sorted(states)
    out = [_HEAD.pack(_MAGIC, 1, lanes, len(marks), len(ids), int(place[-1]))]
    for step in marks:
        stretch = ids[step * lanes : (step + CHECKPOINT_STEPS) * lanes]
        out += [_MARK.pack(int(place[step]), zlib.crc32(stretch.astype("<u4").tobytes())), states[step].astype("<u8").tobytes()]
    return b"".join([*out, *(w.astype("<u4").tobytes() for w in words)])


def stretches(block: bytes) -> int:
    """How many stretches of the block can be decoded apart."""
    return _HEAD.unpack_from(block)[3]


def decode_stretch(block: bytes, number: int, table: Table) -> np.ndarray:
    """The ids between two checkpoints. A wrong checksum raises an error."""
    magic, _, lanes, marks, total, n_words = _HEAD.unpack_from(block)
    if magic != _MAGIC:
        raise ValueError("not a block of ids")
    size = _MARK.size + 8 * lanes
    at = _HEAD.size + number * size
    place, want = _MARK.unpack_from(block, at)
    state = np.frombuffer(block, "<u8", lanes, at + _MARK.size).astype(np.uint64)
    words = np.frombuffer(block, "<u4", n_words, _HEAD.size + marks * size)
    first = number * CHECKPOINT_STEPS * lanes
    out = np.empty(min(total - first, CHECKPOINT_STEPS * lanes), np.uint32)
    for at in range(0, len(out), lanes):
        x = state[: len(out) - at]
        slot = x & table.mask
        some = table.symbols[slot]
        out[at : at + lanes] = some
        x = table.freq[some] * (x >> table.bits) + slot - table.base[some]
        short = x < LOW
        n = int(np.count_nonzero(short))
        x[short] = (x[short] << np.uint64(32)) | words[place : place + n]
        state[: len(x)] = x
        place += n
    if zlib.crc32(out.astype("<u4").tobytes()) != want:
        raise ValueError(f"checksum of stretch {number} differs")
    return out


def decode_block(block: bytes, table: Table) -> np.ndarray:
    parts = [decode_stretch(block, k, table) for k in range(stretches(block))]
    return np.concatenate(parts) if parts else np.empty(0, np.uint32)
