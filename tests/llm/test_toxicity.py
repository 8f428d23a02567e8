"""Toxicity: folding, matching against plain search, and held-out accuracy on planted insults."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from seasonstar.llm import toxicity

DOCS = "doc_id long, text string, score string, toxic int, id long"  # the last three clash
INSULTS = ["dolt", "nitwit", "scoundrel", "blockhead"]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "s", 1, 7) for r in rows], DOCS)


@pytest.mark.parametrize(
    ("text", "folded"),
    [
        (None, " "), ("", " "), (" \t\n", " "), ("An IDIOT!", " an idiot "), ("1d10t id1ot", " idiot idiot "),
        ("іdiоt", " idiot "), ("ｉｄｉｏｔ", " idiot "), ("i​di­ot", " idiot "), ("$tupid st@pid sh!t", " stupid stapid shit "),
        ("room 101, 4 of 7", " room of "), ("word$$$ of%%%", " word of "), ("Straße été", " straße été "), ("_a_", " a "),
    ],
)
def test_fold(text, folded):
    assert toxicity.fold(text) == folded


def test_hits_against_plain_search():
    rng = np.random.default_rng(11)
    for _ in range(200):
        terms = {" " + "".join(rng.choice(list("abc"), int(rng.integers(1, 4)))) + " " * int(rng.integers(0, 2)): float(rng.integers(1, 9)) for _ in range(6)}
        exceptions = [" " + "".join(rng.choice(list("abc "), int(rng.integers(1, 5)))).strip() + " " for _ in range(3)]
        exceptions = [e for e in exceptions if e.strip() and "  " not in e]
        folded = toxicity.fold(" ".join("".join(rng.choice(list("abc"), int(rng.integers(1, 5)))) for _ in range(int(rng.integers(0, 30)))))
        want = {}
        for term, weight in terms.items():
            for m in re.finditer(f"(?={re.escape(term)})", folded):
                if term not in exceptions:
                    want[m.start()] = max(weight, want.get(m.start(), 0))
        for phrase in exceptions:
            for m in re.finditer(f"(?={re.escape(phrase)})", folded):
                for place in range(m.start(), m.start() + len(phrase) - 1):
                    want.pop(place, None)
        assert toxicity.hits(toxicity.Lexicon(terms, exceptions).automaton(), folded) == want
    assert toxicity.hits(toxicity.Lexicon().automaton(), " abc ") == {}


@pytest.fixture(scope="module")
def corpus():
    """1,500 texts, a third toxic. One insult stands harmless before one word; the toxic ones are disguised now and then."""
    rng = np.random.default_rng(3)
    vocabulary = ["".join(rng.choice(list("abcdefghijklmnop"), 6)) for _ in range(400)]
    rows, labels = [], []
    for i in range(1500):
        words = [vocabulary[j] for j in rng.integers(0, 400, int(rng.integers(20, 300)))]
        toxic = i % 3 == 0
        if toxic:
            for _ in range(max(2, len(words) // 40)):
                insult = INSULTS[rng.integers(4)]
                words.insert(int(rng.integers(len(words))), [insult, insult.upper(), insult.replace("o", "0"), insult.replace("i", "і")][i % 4])
        elif i % 20 == 1:
            words[3:3] = ["blockhead", "island"]
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    rows += [(5000 + i, rows[0][1] + f" copy {i}") for i in range(40)]  # copies of a toxic text
    return rows, labels + [(5000 + i, 1) for i in range(40)]


def test_held_out_texts_are_judged_right(spark, corpus):
    rows, labels = corpus
    noise = [(None, 1), (1, None), (99_999, 1), (2, 0), (2, 0)]
    marked = spark.createDataFrame(labels + noise, "doc_id long, toxic int").withColumn("text", F.lit("x"))
    lexicon = toxicity.learn(frame(spark, rows), marked)
    assert {t.strip() for t in lexicon.terms} <= {w[:n] for w in INSULTS for n in range(3, len(w) + 1)}
    assert any("blockhead island" in e for e in lexicon.exceptions)
    got = {r["doc_id"]: r for r in toxicity.score(frame(spark, rows), lexicon).collect()}
    kept = dict(labels)
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(got[i]["predicted"] == kept[i] for i in got if got[i]["held_out"])
    again = toxicity.learn(frame(spark, rows[::-1]).repartition(3), marked)
    assert again.terms == lexicon.terms and again.exceptions == lexicon.exceptions
    assert again.weights == pytest.approx(lexicon.weights)


def test_held_out_labels_teach_nothing(spark, corpus):
    rows, labels = corpus
    flipped = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in labels]
    docs = frame(spark, rows)
    a, b = (toxicity.learn(docs, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, flipped))
    assert a == b


def test_odd_rows_and_no_labels(spark, corpus):
    rows, labels = corpus
    lexicon = toxicity.Lexicon({" dolt ": 5.0, " nitw": 4.0}, [" dolt island "], [-3.0, 8.0, 3.0])
    odd = [(1, None), (2, ""), (3, " \n"), (None, "a dolt"), (4, "dolt " * 50_000), (4, "dolt " * 50_000), (5, "dolt island"), (6, "nitwits")]
    got = [(r["doc_id"], r["score"]) for r in toxicity.score(frame(spark, odd), lexicon).collect()]
    assert len(got) == len(odd)
    scores = dict(got)
    nothing = 1 / (1 + np.exp(3))
    assert scores[1] == scores[2] == scores[3] == scores[5] == pytest.approx(nothing) and scores[4] > 0.99
    assert scores[None] > scores[6] > nothing
    none = frame(spark, [])
    assert toxicity.score(none, lexicon).collect() == []
    unlabelled = spark.createDataFrame([], "doc_id long, toxic int")
    for docs, known in ((frame(spark, rows), unlabelled), (none, spark.createDataFrame(labels, "doc_id long, toxic int"))):
        assert toxicity.learn(docs, known).terms == {}
    clean = spark.createDataFrame([(i, 0) for i, _ in rows], "doc_id long, toxic int")
    assert all(r["predicted"] == 0 for r in toxicity.score(frame(spark, rows), toxicity.learn(frame(spark, rows), clean)).collect())
