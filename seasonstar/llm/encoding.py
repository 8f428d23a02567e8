"""Token ids of whole texts, with the units that texts share encoded once per worker.

A text is cut where no pre-token can reach across, so the ids of a text are the ids of its units in order.
Units and pre-tokens are kept in bounded stores; when the units' store is full, the less used half goes.
"""

from __future__ import annotations

import os
import re
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Distinct units and distinct pre-tokens that a worker keeps between slices, their bytes, and the bytes of a long one.
KEPT_UNITS = 200_000
KEPT_PIECES = 400_000
KEPT_BYTES = 16_000_000
LONG = 256
#: Text bytes that are encoded at once: the more, the fewer units are new to a slice.
ENCODED_BYTES = 8_000_000
#: Pre-tokens whose tokens are library objects at once.
_TOKENIZED = 20_000

_TWO_WHITE = re.compile(r"\s\s")
_SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")
_ID = attrgetter("id")
_workers: dict[tuple[str, str], "Encoder"] = {}


def word_units(texts: list[str | None]) -> pa.ListArray:
    """For vocabularies that drop white space: the stretches between ASCII white space of each text, empty ones at its ends."""
    return pc.ascii_split_whitespace(pa.array([t or "" for t in texts], pa.string()))


def spaced_units(texts: list[str | None]) -> pa.ListArray:
    """For byte-level vocabularies, whose pre-tokens may start with one space.

    A space is cut before where it stands between two characters that are no white space. A single line break is a
    pre-token of its own, so a cut before it is safe as well. A text with a null character is one unit.
    """
    def marked(text: str) -> str:
        if _TWO_WHITE.search(text):
            return _SAFE_SPACE.sub("\0 ", text)
        return text.replace("\n", "\0\n").replace(" ", "\0 ")

    whole = {i: t for i, t in enumerate(texts) if t and "\0" in t}
    if not whole:
        return pc.split_pattern(pa.array([marked(t or "") for t in texts], pa.string()), "\0")
    return pa.array([[t] if i in whole else marked(t or "").split("\0") for i, t in enumerate(texts)], pa.list_(pa.string()))


#: How texts are cut; pre-tokens of units made of ASCII and Latin-1 letters only. Other units take the library's own path.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
KINDS = {
    "words": (
        word_units, re.compile(rf"[^\0!-~{_LETTERS}]"), str.lower,
        re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\s\0{_LETTERS}0-9]+|\0"),
    ),
    "spaced": (
        spaced_units, re.compile(rf"[^\0 \n!-~{_LETTERS}]|[ \n](?=[ \n\0]|$)"), str,
        re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s\0{_LETTERS}0-9]+|[\s\0]"),
    ),
}


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself if visible in Latin-1, else one from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def joined(strings: pa.Array) -> str:
    """The strings in a row, with a null character between."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(strings)], pa.int32()), strings), "\0")[0].as_py()


class Store:
    """Numbered strings with the values of each, bounded, as Arrow and numpy arrays.

    The strings asked for are coded together with the strings held, so a string becomes a Python object only when it is
    new. Past the limit of strings, of their bytes or of values, the less used half goes, and all long strings.
    """

    def __init__(self, limit: int):
        self.limit = limit
        self._clear()

    def _clear(self) -> None:
        self.keys = pa.array([], pa.string())
        self.flat = np.empty(1 << 16, np.uint32)
        self.start, self.count, self.used = (np.zeros(0, np.int64) for _ in range(3))
        self.filled = 0

    def values(self, which: np.ndarray) -> np.ndarray:
        lengths = self.count[which]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.start[which] - ends + lengths, lengths) + np.arange(total)]

    def add(self, keys: pa.Array, values: np.ndarray, lengths: np.ndarray, used: np.ndarray | None = None) -> None:
        while self.filled + len(values) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        self.flat[self.filled : self.filled + len(values)] = values
        self.start = np.concatenate([self.start, self.filled + np.cumsum(lengths) - lengths])
        self.count = np.concatenate([self.count, lengths])
        self.used = np.concatenate([self.used, np.zeros(len(keys), np.int64) if used is None else used])
        self.keys = pa.concat_arrays([self.keys, keys])
        self.filled += len(values)

    def look_up(self, keys: pa.Array, learn) -> np.ndarray:
        """The numbers of the keys; `learn(distinct new keys)` gives the values and lengths of keys not held yet."""
        if len(self.keys) > self.limit or self.keys.nbytes > KEPT_BYTES or self.filled > KEPT_BYTES:
            self._forget()
        held = len(self.keys)
        coded = pa.concat_arrays([self.keys, keys]).dictionary_encode()
        which = coded.indices.to_numpy()[held:]
        new = coded.dictionary[held:]
        if len(new):
            self.add(new, *learn(new))
        self.used += np.bincount(which, minlength=len(self.keys))
        return which

    def _forget(self) -> None:
        """Keep the keys used more than the median key and no longer than `LONG`."""
        keep = (self.used > np.median(self.used)) & (pc.binary_length(self.keys).to_numpy() <= LONG)
        which = np.flatnonzero(keep)
        kept = self.keys.filter(pa.array(keep)), self.values(which), self.count[which], self.used[which]
        self._clear()
        self.add(*kept)


class Encoder:
    """Ids by a vocabulary file of the tokenizers library, as `encode(text, add_special_tokens=False)` gives them."""

    def __init__(self, path: str, kind: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cut, self.odd, self.fold, self.pieces = KINDS[kind]
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = byte_letters()
        self.units, self.known = Store(KEPT_UNITS), Store(KEPT_PIECES)

    def _piece_ids(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens, by the library's merges."""
        written = joined(pieces).encode().decode("latin-1").translate(self.letters).split(self.letters[0])
        ids, lengths = [], []
        for i in range(0, len(written), _TOKENIZED):
            tokens = list(map(self.tokenizer.model.tokenize, written[i : i + _TOKENIZED]))
            lengths.append(np.fromiter(map(len, tokens), np.int64, len(tokens)))
            ids.append(np.fromiter(map(_ID, chain.from_iterable(tokens)), np.uint32, int(lengths[-1].sum())))
        return np.concatenate(ids), np.concatenate(lengths)

    def _unit_ids(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        whole = joined(units)
        usual = np.ones(len(units), bool)
        lengths = np.zeros(len(units), np.int64)
        strange = whole.count("\0") != len(units) - 1 or "\0\0" in whole or whole[:1] == "\0" or whole[-1:] in ("", "\0")
        if strange or self.odd.search(whole) or any(x in whole for x in self.special):
            texts = units.to_pylist()
            odd = [not t or "\0" in t or bool(self.odd.search(t)) or any(x in t for x in self.special) for t in texts]
            usual = ~np.array(odd)
            whole = "\0".join([t for t, o in zip(texts, odd) if not o])
        pieces = pa.array(self.pieces.findall(self.fold(whole)), pa.string())
        borders = pc.equal(pieces, "\0").to_numpy(zero_copy_only=False)
        which = self.known.look_up(pieces.filter(pa.array(~borders)), self._piece_ids)
        ids = self.known.values(which)
        owner = np.cumsum(borders)[~borders]
        n = int(usual.sum())
        lengths[usual] = np.bincount(owner, self.known.count[which], minlength=n).astype(np.int64)[:n]
        if usual.all():
            return ids, lengths
        others = [self.tokenizer.encode(t, add_special_tokens=False).ids for t, o in zip(texts, odd) if o]
        lengths[~usual] = [len(x) for x in others]
        out = np.empty(int(lengths.sum()), np.uint32)
        mine = np.repeat(usual, lengths)
        out[mine], out[~mine] = ids, np.fromiter(chain.from_iterable(others), np.uint32)
        return out, lengths

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the number of ids of each text. A null text is empty."""
        which, numbers = numbered(self.cut(texts), self.units, self._unit_ids)
        sums = np.concatenate([[0], np.cumsum(self.units.count[which])])
        ends = np.cumsum(numbers)
        return self.units.values(which), sums[ends] - sums[ends - numbers]


def numbered(units: pa.ListArray, known: Store, learn) -> tuple[np.ndarray, np.ndarray]:
    """The store's numbers of all units in a row, and how many each text has."""
    return known.look_up(units.flatten(), learn), pc.list_value_length(units).to_numpy().astype(np.int64)


def encoder(path: str, kind: str) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    key = (path, kind)
    if key not in _workers:
        _workers[key] = Encoder(path, kind)
    return _workers[key]


def closed_ids(enc: Encoder, texts: list[str | None], end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, each text closed by the end id; where each text's ids end."""
    ids, sizes = enc.encode(texts)
    ends = np.cumsum(sizes + 1)
    out = np.empty(len(ids) + len(texts), np.uint32)
    inner = np.ones(len(out), bool)
    inner[ends - 1] = False
    out[inner] = ids
    out[ends - 1] = end_id
    return out, ends
