"""The stages of the corpus pipeline and the whole run on odd rows, against plain Python."""

from __future__ import annotations

import collections
import re

import pytest
import xxhash

import corpus_pipeline as pipeline
from seasonstar.llm import mixing
from tests.llm.test_operators import BASE, brute_components, brute_spans, brute_statistics, shingle_print

CLASHING = ["_spans", "_copy", "_row_hash", "text_hash", "row_id", "row_hash", "spans", "times", "copy", "of_id", "kept", "taken", "size"]
LONG = " ".join(f"item{i}of{i * 7 % 91}" for i in range(4000))
ROWS = [
    (1, BASE, "a"), (2, BASE, "b"), (3, BASE.replace("word5x5 ", "changed "), "a"), (4, None, "a"), (5, "", None), (6, " \n\t", "c"),
    (7, "too short", "c"), (8, "the same words " * 60, "c"), (9, LONG, "hot"), (9, LONG, "hot"), (9, LONG + " other text", "hot"),
    (10, "write to a.b@example.com or 10.0.0.1 now. " + " ".join(f"plain{i}" for i in range(80)), "a"),
    (None, " ".join(f"noid{i}" for i in range(70)), None), (None, " ".join(f"nobody{i}" for i in range(70)), "b"),
    *((20 + i, " ".join(f"t{i}w{j}" for j in range(50 + i)), "hot") for i in range(12)),
]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    schema = "doc_id long, text string, source string, lang string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)
    rows = [(d, t, s, "en", None if t is None else len(t), *["mine"] * len(CLASHING)) for d, t, s in ROWS]
    folder = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{folder}/labels.parquet")
    return spark.read.parquet(f"{folder}/documents.parquet"), str(folder)


def good(text):
    n, _, _, _, repeats = brute_statistics(text)
    return n >= 50 and 100 * repeats <= 50 * n


def redacted(text):
    spans, out, at = brute_spans(text), "", 0
    for start, kind, stop in spans:
        out += text[at:start] + "[" + ("EMAIL", "IP", "CARD", "PHONE")[kind] + "]"
        at = stop
    return out + text[at:]


def listed(df):
    assert all(r[c] == "mine" for r in df.select(*(f"`{c}`" for c in CLASHING)).collect() for c in CLASHING)
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)


def stage(name):
    return dict(pipeline.STAGES)[name]


def test_quality_stage(spark, docs):
    kept = stage("quality rules")(spark, *docs)
    assert kept.columns == docs[0].columns
    assert listed(kept) == sorted(((d, t) for d, t, _ in ROWS if good(t)), key=repr)


def test_near_duplicate_stage(spark, docs):
    kept = stage("simhash near-dedup")(spark, *docs)
    assert kept.columns == docs[0].columns
    roots = brute_components(sorted({shingle_print(t) for _, t, _ in ROWS}))
    group = {(d, t): roots[shingle_print(t)] for d, t, _ in ROWS}
    members = collections.defaultdict(list)
    for (d, t), g in group.items():
        text_hash = 42 if t is None else (xxhash.xxh64_intdigest(t.encode(), 42) + (1 << 63)) % (1 << 64) - (1 << 63)
        members[g].append((d is None, d or 0, text_hash, (d, t)))
    assert listed(kept) == sorted((min(m)[-1] for m in members.values()), key=repr)


def test_personal_data_stage(spark, docs):
    out = stage("personal data")(spark, *docs)
    assert out.columns == docs[0].columns
    assert listed(out) == sorted(((d, t if t is None else redacted(t)) for d, t, _ in ROWS), key=repr)
    assert all(r["n_chars"] == len(r["text"]) for r in out.collect() if r["text"] is not None)


def test_mix_stage(spark, docs):
    """Equal rows get the larger of their numbers each, so they are left out where words are counted."""
    single = docs[0].dropDuplicates(["doc_id", "text"])
    out = stage("source mix")(spark, single, docs[1])
    assert out.columns == docs[0].columns
    got = collections.Counter(listed(out))
    times = {}
    for r in mixing.decide(single).collect():
        if r["taken"]:
            times[r["doc_id"], r["source"], r["text_hash"]] = r["taken"] // r["size"]
    assert sorted(got.values()) == sorted(times.values()) and set(got.values()) <= {1, 2}
    size = {(d, t): brute_statistics(t)[0] for d, t, _ in ROWS}
    assert sum(n * size[k] for k, n in got.items()) <= 1.5 * sum(size.values())
    assert len(listed(stage("source mix")(spark, *docs))) >= len(listed(out))


def test_run(spark, docs):
    _, folder = docs
    pieces = pipeline.run(spark, folder).collect()
    kept = {d for d, t, _ in ROWS if good(t)} - {2}  # a copy of document 1
    assert pieces and {r["doc_id"] for r in pieces} <= kept
    per_sequence = collections.Counter()
    for r in pieces:
        per_sequence[r["sequence_id"]] += r["length"]
    assert all(n <= 1024 and n & (n - 1) == 0 for n in per_sequence.values())
    assert re.fullmatch("[a-z0-9 -]+", " ".join(name for name, _ in pipeline.STAGES))


def test_empty_tables(spark, docs):
    frame, folder = docs
    for _, run in pipeline.STAGES:
        assert run(spark, frame.limit(0), folder).collect() == []
