"""Toxicity by a learned weighted lexicon, matched by Aho-Corasick on folded texts."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from math import exp, log, sqrt

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonstar.llm.common import store, text_slices

#: Labelled documents that a lexicon is learned from at most (in expectation; chosen by a hash of the id).
MAX_LABELLED = 20_000
#: Every fifth id, by its CRC-32, is held out.
HELD_OUT = 5
#: Terms are whole words and starts of words of so many characters; longer words are no terms.
SHORTEST, LONGEST, LONGEST_WORD = 3, 8, 40
#: A term has been met between so many different neighbours in toxic texts, and so much more often there than elsewhere.
MIN_PLACES, MIN_RATIO = 4, 8
#: An exception has been met in so many texts that are not toxic. Terms and exceptions of a lexicon at most, the best first.
MIN_CLEAN, MAX_TERMS, MAX_EXCEPTIONS = 3, 2000, 2000
LONGEST_EXCEPTION = 2 * LONGEST_WORD + 3
#: Words added to a text's length, so that one match in a very short text is not taken for a density.
EXTRA_WORDS = 10

# Cyrillic and Greek letters each before the Latin letter it looks like, characters without width, and
# digits and signs each before the letter it is written for.
_LOOK_ALIKES = """
аa вb сc ԁd еe ёe һh нh іi їi јj кk ӏl мm оo рp ԛq ѕs тt уy ԝw хx
αa βb εe ηn ιi κk νv οo ρp τt υu χx ωw
"""
_NO_WIDTH = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
_WRITTEN_FOR = "0o 1i 3e 4a 5s 7t @a $s !i |l"

_LETTERS = str.maketrans(dict(_LOOK_ALIKES.split()) | dict.fromkeys(_NO_WIDTH))
_WRITTEN = str.maketrans(dict(_WRITTEN_FOR.split()))
_BETWEEN = re.compile(r"(?<=[^\W\d_])[013457@$!|]+(?=[^\W\d_])|(?<![\w@$!|])[013457@$]+(?=[^\W\d_][\w@$!|])")
_OTHER = re.compile(r"[\W\d_]+")


def fold(text: str | None) -> str:
    """The words of a text between single spaces, one at either end: lower case, look-alikes as Latin letters.

    Digits and signs count as letters between letters, or at the start of a word of letters; all else but letters parts words.
    """
    text = text or ""
    if not text.isascii():
        if not unicodedata.is_normalized("NFKC", text):
            text = unicodedata.normalize("NFKC", text)
        text = text.lower().translate(_LETTERS)
    else:
        text = text.lower()
    text = _BETWEEN.sub(lambda m: m[0].translate(_WRITTEN), text)
    return _OTHER.sub(" ", f" {text} ")


def _terms(word: str) -> list[str]:
    """What a lexicon may hold of a word: it, and its starts. A space stands for the border of a word."""
    if len(word) > LONGEST_WORD:
        return []
    return [" " + word[:n] for n in range(SHORTEST, min(len(word), LONGEST + 1))] + [f" {word} "]


@dataclass
class Lexicon:
    """Weights of terms, phrases that excuse the terms in them, and the weights of the score."""

    terms: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    weights: list[float] = field(default_factory=lambda: [-log(1e6), 0.0, 0.0])

    def automaton(self) -> ahocorasick.Automaton | None:
        found = ahocorasick.Automaton()
        for phrase in self.exceptions:
            found.add_word(phrase, (len(phrase), None))
        for term, weight in self.terms.items():
            if term not in found:
                found.add_word(term, (len(term), weight))
        if not len(found):
            return None
        found.make_automaton()
        return found


def hits(automaton: ahocorasick.Automaton | None, folded: str) -> dict[int, float]:
    """The weight of each word that matches, by its place: its heaviest term counts, in an exception none does."""
    heavy: dict[int, float] = {}
    excused: list[tuple[int, int]] = []
    for end, (size, weight) in automaton.iter(folded) if automaton else ():
        start = end - size + 1
        if weight is None:
            excused.append((start, end))
        elif weight > heavy.get(start, 0.0):
            heavy[start] = weight
    for start, end in excused:
        for place in range(start, end):  # as long as an exception, `LONGEST_EXCEPTION` at most
            heavy.pop(place, None)
    return heavy


def features(matched: float, n_words: int) -> list[float]:
    """The weight of what matched, by the length of the text and by its square root."""
    return [1.0, matched / (n_words + EXTRA_WORDS), matched / sqrt(n_words + EXTRA_WORDS)]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.01) -> np.ndarray:
    """Weights of a logistic regression by Newton's method."""
    weights = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - y) + ridge * weights
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(weights)), slope)
        weights -= step
        if np.abs(step).max() < 1e-10:
            break
    return weights


def held_out(doc_id: Column) -> Column:
    """Whether the CRC-32 of the id as text divides by `HELD_OUT`; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % HELD_OUT == 0


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The texts to learn from: text, toxic (0 or 1), one of each labelled id that is not held out.

    An id with several labels is toxic if one says so; of several texts the one of the greatest hash counts.
    """
    known = labels.where("toxic is not null and doc_id is not null").where(~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    share = min(1.0, MAX_LABELLED / max(1, known.count()))
    chosen = known.where(F.pmod(F.xxhash64("id", F.lit("toxicity")), F.lit(1 << 30)) < int(share * (1 << 30)))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    both = texts.join(F.broadcast(chosen), texts["doc_id"] == chosen["id"])  # at most MAX_LABELLED pairs of numbers
    return both.groupBy("id", "toxic").agg(F.max_by("text", F.xxhash64("text")).alias("text"))


def _places(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Terms of toxic texts with a hash of the words around them, terms of others with their number, and words of either."""
    for batch in text_slices(batches):
        near: set[tuple[str, int]] = set()
        clean: Counter[str] = Counter()
        n_words = [0, 0]
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            words = fold(text).split()
            n_words[toxic] += len(words)
            if toxic:
                for before, word, after in zip(["", *words], words, [*words[1:], ""]):
                    context = _hash(before, after)
                    near.update((term, context) for term in _terms(word))
            else:
                for word, n in Counter(words).items():
                    for term in _terms(word):
                        clean[term] += n
        rows = [(t, c, 0) for t, c in near] + [(t, None, n) for t, n in clean.items()] + [("", None, n_words[0]), (" ", None, n_words[1])]
        columns = zip(*rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(next(columns), pa.string()), pa.array(next(columns), pa.int64()), pa.array(next(columns), pa.int64())],
            names=["term", "context", "n"],
        )


def _hash(*words: str) -> int:
    return xxhash.xxh64_intdigest(" ".join(words).encode("utf-8", "surrogatepass")) >> 1


def learn_terms(texts: DataFrame) -> dict[str, float]:
    """Weights of the terms: the log of how much more often they stand in toxic texts.

    Equal neighbours count once there, so copies of a toxic text do not make its other words terms. A start of a word goes
    where a longer term has nearly all of its places.
    """
    counted = store(
        texts.mapInArrow(_places, "term string, context long, n long")
        .groupBy("term").agg(F.count_distinct("context").alias("toxic"), F.sum("n").alias("clean"))
        .where((F.col("toxic") >= MIN_PLACES) | F.col("term").isin("", " ")),
        "terms",
    )
    totals = {r["term"]: r["clean"] for r in counted.where(F.col("term").isin("", " ")).collect()}
    if not totals.get(" "):
        return {}
    weight = F.log((F.col("toxic") + 0.5) / totals[" "]) - F.log((F.col("clean") + 0.5) / max(1, totals.get("", 0)))
    found = counted.where("toxic > 0").withColumn("weight", weight).where(F.col("weight") >= log(MIN_RATIO))
    best = found.orderBy((F.col("weight") * F.col("toxic")).desc(), "term").limit(MAX_TERMS).collect()
    places = {r["term"]: r["toxic"] for r in best}
    shorter = {t[:n] for t, m in places.items() for n in range(SHORTEST + 1, len(t)) if m >= 0.9 * places.get(t[:n], m + 1 << 30)}
    return {r["term"]: r["weight"] for r in best if r["term"] not in shorter}


def learn_exceptions(texts: DataFrame, terms: dict[str, float]) -> list[str]:
    """Words, and pairs of words, that hold a term but are more usual in texts that are not toxic."""
    lexicon = Lexicon(terms)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in text_slices(batches):
            found: Counter[tuple[str, int]] = Counter()
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                folded, phrases = fold(text), set()
                for start in hits(automaton, folded):
                    end = folded.index(" ", start + 1)
                    before = folded.rfind(" ", 0, start) if start else -1
                    after = folded.find(" ", end + 1)
                    around = (start, end), (before, end), (start, after)
                    phrases |= {folded[a : b + 1] for a, b in around if a >= 0 and b >= 0 and b - a < LONGEST_EXCEPTION}
                found.update((p, toxic) for p in phrases)
            rows = [(p, toxic, n) for (p, toxic), n in found.items()] or [("", 0, 0)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["phrase", "toxic", "n"])

    n_toxic, n_clean = texts.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()
    toxic = F.coalesce(F.sum(F.when(F.col("toxic") == 1, F.col("n"))), F.lit(0)).alias("toxic")
    clean = F.coalesce(F.sum(F.when(F.col("toxic") == 0, F.col("n"))), F.lit(0)).alias("clean")
    counted = texts.mapInArrow(run, "phrase string, toxic long, n long").groupBy("phrase").agg(toxic, clean)
    usual = (F.col("clean") + 0.5) / (n_clean + 1) > (F.col("toxic") + 0.5) / (n_toxic + 1)
    found = counted.where((F.col("clean") >= MIN_CLEAN) & usual & (F.length(F.trim("phrase")) > 0))
    return [r["phrase"] for r in found.orderBy(F.col("clean").desc(), "phrase").limit(MAX_EXCEPTIONS).collect()]


def _matched(lexicon: Lexicon, texts: Iterable[str | None]) -> Iterator[tuple[float, int]]:
    """The weight of what matches in each text, and its words."""
    automaton = _automaton(tuple(lexicon.terms.items()), tuple(lexicon.exceptions))
    for text in texts:
        folded = fold(text)
        found = hits(automaton, folded)
        yield sum(found[p] for p in sorted(found)), folded.count(" ") - 1


@lru_cache(2)
def _automaton(terms: tuple, exceptions: tuple) -> ahocorasick.Automaton | None:
    return Lexicon(dict(terms), list(exceptions)).automaton()


def learn(docs: DataFrame, labels: DataFrame) -> Lexicon:
    """A lexicon from the labelled documents that are not held out, `MAX_LABELLED` at most; only texts and labels are used."""
    texts = store(labelled(docs, labels), "labelled")
    lexicon = Lexicon(learn_terms(texts))
    if not lexicon.terms:
        return lexicon
    lexicon.exceptions = learn_exceptions(texts, lexicon.terms)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            found = zip(*_matched(lexicon, batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([*map(pa.array, found), batch.column("toxic")], names=["matched", "n_words", "toxic"])

    rows = texts.mapInArrow(run, "matched double, n_words long, toxic int").collect()  # MAX_LABELLED rows of three numbers
    rows = sorted(tuple(r) for r in rows)
    x, y = np.array([features(s, n) for s, n, _ in rows]), np.array([r[2] for r in rows], float)
    lexicon.weights = logistic(x, y).tolist()
    return lexicon


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id, held_out, score, predicted of each row.

    `docs` needs `doc_id` and `text`; other columns are ignored. The weights of the words that match a term, but for
    those in an exception, are divided by the length of the text and by its square root; a logistic function of both
    is the score (0 to 1), and `predicted` is 1 from 0.5. Null, empty and blank texts have the score of a text
    without matches. Each row, repeated or with a null id, is a row of the result; without labels no text is toxic.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            found = _matched(lexicon, batch.column("text").to_pylist())
            sums = [sum(w * x for w, x in zip(lexicon.weights, features(*m))) for m in found]
            scores = [1 / (1 + exp(-max(-30.0, min(30.0, s)))) for s in sums]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    rows = docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, "doc_id long, score double")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
