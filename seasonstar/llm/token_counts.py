"""Unigram token counts with forward scores shared along a trie of pre-tokens."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator
from math import log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from seasonstar.llm.common import text_slices
from seasonstar.llm.encoding import KEPT_UNITS, Store, numbered, word_units

#: What a word starts with in the vocabulary, for the white space before it.
SPACE = "▁"
#: Costs are whole millionths, so that sums are exact in any order. A byte outside the vocabulary costs so much.
UNIT = 1_000_000
BYTE_COST = 20 * UNIT
#: Nodes after which the trie starts anew; counts already stored stay. What a word has beyond its first characters gets no
#: nodes: its scores go on from the last of them in a window as long as the longest piece.
MAX_NODES = 250_000
DEEPEST = 200

_COUNTS = "doc_id long, n_words long, n_tokens long"
_workers: dict[str, "Counter"] = {}


def piece_costs(path: str) -> dict[str, int]:
    """Cost of each piece of a vocabulary file: the log of its rank, as pieces by Zipf's law have it."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    return {piece: round(UNIT * log(rank + 2)) for rank, piece in enumerate(plain)}


class Trie:
    """Pre-tokens by their characters. Each node knows the cheapest way to cut the string that leads to it.

    Words with a common start pass the same nodes, so the score of a start is computed once, from the nodes above it.
    Of equally cheap ways the one with the longest last piece counts.
    """

    def __init__(self, costs: dict[str, int]):
        self.costs = costs
        self.longest = max(map(len, costs), default=1)
        self.clear()

    def clear(self) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.way: list[tuple[int, int]] = [(0, 0)]

    def count(self, word: str) -> int:
        """Tokens of a word; the word is inserted."""
        if len(self.way) > MAX_NODES:
            self.clear()
        node, ways = 0, [self.way[0]]
        for end, letter in enumerate(word[:DEEPEST], 1):
            below = self.next[node].get(letter)
            if below is None:
                below = len(self.way)
                self.next[node][letter] = below
                self.next.append({})
                self.way.append(self._cheapest(word, end, ways))
            node = below
            ways.append(self.way[node])
        if len(word) > DEEPEST:
            ways = deque(ways, self.longest)
            for end in range(DEEPEST + 1, len(word) + 1):
                ways.append(self._cheapest(word, end, ways))
        return ways[-1][1]

    def _cheapest(self, word: str, end: int, ways) -> tuple[int, int]:
        """Cost and tokens of the cheapest way to cut the first `end` characters; `ways` are those of the starts before."""
        best = None
        for back in range(min(end, self.longest), 0, -1):
            piece = self.costs.get(word[end - back : end])
            if piece is not None and (best is None or ways[-back][0] + piece < best[0]):
                best = ways[-back][0] + piece, ways[-back][1] + 1
        letter = word[end - 1]
        if letter not in self.costs:
            raw = len(letter.encode("utf-8", "surrogatepass"))
            spelled = ways[-1][0] + raw * BYTE_COST
            if best is None or spelled < best[0]:
                best = spelled, ways[-1][1] + raw
        return best


class Counter:
    """Counts of pre-tokens of one worker: the trie, and the counts at the ends of words."""

    def __init__(self, path: str):
        self.trie, self.ends = Trie(piece_costs(path)), Store(KEPT_UNITS)

    def learn(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        counts = [self.trie.count(SPACE + w) if w else 0 for w in words.to_pylist()]
        return np.array(counts, np.uint32), np.ones(len(words), np.int64)

    def count(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Words and tokens of each text."""
        units = word_units(texts)
        which, numbers = numbered(units, self.ends, self.learn)
        ends = np.cumsum(numbers)
        filled = pc.not_equal(pc.binary_length(units.flatten()), 0).to_numpy(zero_copy_only=False)

        def totals(values: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
            return sums[ends] - sums[ends - numbers]

        return totals(filled), totals(self.ends.flat[self.ends.start[which]])


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_words and n_tokens of each row under a unigram model.

    A text is cut at ASCII white space; a word with the mark for the space before it is cut into the cheapest pieces of the
    vocabulary, characters outside it into bytes. Each worker inserts the distinct words of what it reads into a trie,
    and keeps their counts in a bounded store, so nothing is shuffled and memory is bounded, also for a text that is one
    word of millions of characters; a word that is met again after it left the store is counted again, with the same result.

    `docs` needs `doc_id` and `text`; other columns are ignored. Null, empty and blank texts have 0 words and tokens;
    each row, repeated or with a null id, is a row of the result.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _workers:
            _workers[path] = Counter(path)
        counter = _workers[path]
        for batch in text_slices(batches):
            n_words, n_tokens = counter.count(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words), pa.array(n_tokens)], names=["doc_id", "n_words", "n_tokens"]
            )

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, _COUNTS)
