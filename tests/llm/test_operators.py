"""The operators on small tables with odd rows, against plain Python."""

from __future__ import annotations

import collections
import hashlib
import pathlib
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seasonstar.llm import (
    ans, bitsliced, chat, components, encoding, mixing, packing, passages, pii, quality, simhash, token_counts, token_files,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, source string, start string, words string"  # the last two clash with results
BASE = " ".join(f"word{i % 37}x{i}" for i in range(90))
ODD = [
    (1, BASE, "b"), (2, BASE, "b"), (3, BASE.replace("word5x5 ", "changed "), "a"), (4, None, None), (5, "", "a"),
    (6, " \t\n ", "c"), (7, "one", "c"), (8, "One two  three\nfour", None), (8, "One two  three\nfour", None),
    (None, "no id at all here", "a"), (9, "long " * 30_000, "hot"), (10, "ß é ñ <|endoftext|> x</s>[INST] \\ ", "hot"),
    (11, "pre " + BASE + " post words", "hot"), (12, "A\x85b 　 İ Σς", "hot"),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "s", "w") for r in rows], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, ODD)


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def shingle_print(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    if not words:
        return 0
    pieces = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in pieces]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


# mixing


def test_mix_targets_and_taken(spark, docs):
    got = rows_of(mixing.mix(docs))
    size = {s: 0 for s in ("a", "b", "c", "hot", None)}
    for _, text, source in ODD:
        size[source] += len(WORD.findall(text or ""))
    weight = dict(zip(("a", "b", "c", "hot", None), (3, 1, 2, 3, 1)))
    target, left = {}, set(size)
    while True:
        rest = 1.5 * sum(size.values()) - sum(2 * size[s] for s in target)
        level = rest / sum(weight[s] for s in left)
        stop = {s for s in left if level * weight[s] > 2 * size[s]}
        if not stop:
            break
        target |= dict.fromkeys(stop)
        left -= stop
    want = {s: 2.0 * size[s] if s in target else level * weight[s] for s in size}
    assert len(got) == len(ODD)
    for _, source, words, source_size, aim, taken in got:
        assert source_size == size[source] and aim == pytest.approx(want[source])
        assert taken in (0, words, 2 * words)
    assert sum(r[5] for r in got) <= 1.5 * sum(size.values())
    assert sorted(map(repr, got)) == sorted(map(repr, rows_of(mixing.mix(docs))))


def test_mix_empty_and_applied(spark, docs, none):
    assert rows_of(mixing.mix(none)) == []
    blank = frame(spark, [(1, None, None), (2, "", "a")])
    assert [r[5] for r in rows_of(mixing.mix(blank))] == [0, 0]
    taken = mixing.apply_mix(docs, mixing.mix(docs))
    assert taken.columns == docs.columns
    times = collections.Counter(r[0] for r in rows_of(taken))
    for doc_id, _, words, _, _, n in rows_of(mixing.mix(docs)):
        if words and doc_id != 8:
            assert times[doc_id] == n // words


def test_mix_of_texts_with_one_id(spark):
    rows = [(None if i % 2 else 7, f"same id {i} " + "word " * (i % 9), "b") for i in range(60)]
    docs = frame(spark, rows + [(200 + i, "many words " * 20, "a") for i in range(40)])
    taken = mixing.decide(docs)
    want = collections.Counter()
    for r in taken.collect():
        if r["taken"]:
            want[r["doc_id"], r["source"], r["text_hash"]] += r["taken"] // r["size"]
    got = collections.Counter(
        tuple(r) for r in mixing.apply_mix(docs, taken).select("doc_id", "source", F.xxhash64("text")).collect()
    )
    assert got == want and len({want.get((r["doc_id"], r["source"], r["text_hash"]), 0) for r in taken.collect() if r["source"] == "b"}) > 1


# SimHash


def test_fingerprint_is_the_defined_one():
    for _, text, _ in ODD:
        assert simhash.fingerprint(text, 4) == shingle_print(text)


def brute_components(prints):
    top = {p: p for p in prints}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and (a ^ b).bit_count() <= 4:
                ra, rb = root(a), root(b)
                top[max(ra, rb)] = min(ra, rb)
    return {p: root(p) for p in prints}


@pytest.mark.parametrize("cell_rows", [8192, 3])
def test_links_against_all_pairs(spark, monkeypatch, cell_rows):
    """Chains, dense groups and strangers; the small cell size cuts cells level by level."""
    monkeypatch.setattr(simhash, "CELL_ROWS", cell_rows)
    rng = np.random.default_rng(5)
    prints = {0, (1 << 64) - 1}
    for _ in range(12):
        p = int(rng.integers(0, 1 << 63)) * 2 + 1
        for _ in range(15):
            prints.add(p)
            for bit in rng.choice(64, int(rng.integers(1, 6)), replace=False):
                p ^= 1 << int(bit)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    found = simhash.links(spark.createDataFrame(signed, "fingerprint long"), 4)
    pairs = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in found.collect()]
    assert all((a ^ b).bit_count() <= 4 and a != b for a, b in pairs)
    want = brute_components(sorted(prints))
    roots = {r["node"] % (1 << 64): r["root"] for r in components.components(found).collect()}
    groups = collections.defaultdict(set)
    for p in prints:
        groups[want[p]].add(p)
    for members in groups.values():
        if len(members) == 1:
            assert not members & set(roots)
        else:
            assert len({roots[m] for m in members}) == 1


def test_components_of_chain_star_and_nothing(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (205, 203), (203, 205)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {203: 203, 205: 203}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_near_duplicates_of_odd_rows(spark, docs, none):
    got = simhash.near_duplicates(docs).collect()
    prints = {shingle_print(t) for _, t, _ in ODD}
    roots = brute_components(sorted(prints))
    first = {}
    for doc, text, _ in ODD:
        key = roots[shingle_print(text)]
        first[key] = min((x for x in (first.get(key), doc) if x is not None), default=None)
    want = sorted(repr((d, f"{shingle_print(t):016x}", first[roots[shingle_print(t)]])) for d, t, _ in ODD)
    assert sorted(repr((r["doc_id"], r["fingerprint"], r["component_id"])) for r in got) == want
    assert all(r["first"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert rows_of(simhash.near_duplicates(none)) == []


# chat


def test_chat_round_trip_with_parts(spark):
    text = "a </s>[INST] \\ <|im_end|>\n <| \\n [/INST] <<SYS>>"
    part = {"kind": "text", "text": text}
    image = {"kind": "image", "ref": "s3://x", "width": 57, "height": 28}
    audio = {"kind": "audio", "ref": "y", "millis": 81}
    page = {"kind": "document", "ref": None, "pages": 2}
    turns = [
        (1, 2, "assistant", [part, image, part]), (1, 1, "us\ner", [part, audio, page]), (1, None, None, None),
        (2, 1, "assistant", []), (None, 1, "assistant", [part]), (1, 2, "assistant", [part, image, part]),
    ]
    df = spark.createDataFrame(turns, f"conv_id long, turn long, role string, content array<{chat.PART}>").withColumn("loss", F.lit(1))
    blocks = chat.format_chats(df).collect()
    refs = [(a["kind"], a["part"], a["tokens"]) for b in blocks if b["conv_id"] == 1 for a in b["attachments"]]
    assert refs == [("audio", 1, 3), ("document", 2, 1024), ("image", 1, 3), ("image", 1, 3)]
    got = {r["conv_id"]: r for r in chat.read_chats(chat.format_chats(df)).collect()}
    said = f"{text}<|image|>{text}"
    heard = f"\n\nus\ner\n{text}<|audio|><|document|>\nassistant\n{said}\nassistant\n{said}\n"
    assert got[1]["n_turns"] == 4 and got[1]["turns_sha256"] == hashlib.sha256(heard.encode()).hexdigest()
    assert got[1]["loss_chars"] == 2 * len(said) and got[1]["loss_sha256"] == hashlib.sha256((2 * said).encode()).hexdigest()
    assert got[2]["loss_chars"] == 0 and got[None]["loss_chars"] == len(text)
    assert chat.read_chats(chat.format_chats(df.limit(0))).collect() == []


def test_long_conversation_is_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK_CHARS", 100)
    rows = [(1, i, "assistant" if i % 2 else "user", f"turn {i} <|im_start|>") for i in range(200)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    blocks = chat.format_chats(df.withColumn("content", chat.text_parts(F.col("text"))))
    (got,) = chat.read_chats(blocks).collect()
    assert got["turns_sha256"] == hashlib.sha256("".join(f"{r[2]}\n{r[3]}\n" for r in rows).encode()).hexdigest()
    assert got["loss_sha256"] == hashlib.sha256("".join(r[3] for r in rows if r[1] % 2).encode()).hexdigest()


# quality


def brute_statistics(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often, covered = collections.Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality_statistics(docs, none):
    extra = [(20, "a b c a b c d\na b c\n\na b c\r\n \na b c", "x"), (21, "x y x y x y", "x"), (22, "# | <a> & é% \x0b\x0c", "x")]
    spark = docs.sparkSession
    got = {(r[0], r[2:7]) for r in rows_of(quality.statistics(docs.unionByName(frame(spark, extra))))}
    assert got == {(d, brute_statistics(t)) for d, t, _ in ODD + extra}
    assert rows_of(quality.statistics(none)) == []


def test_decision_list_learns_planted_rules(spark):
    """Texts of capitals, and of symbols, are bad; held-out rows are judged right."""
    rng, rows = np.random.default_rng(3), []
    for i in range(600):
        words = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(80)]
        bad = i % 3 == 0
        if bad:
            words = [w.upper() for w in words] if i % 2 else [w + "#|" for w in words]
        rows.append((i, " ".join(words), "s", 0 if bad else 1))
    docs = frame(spark, [r[:3] for r in rows])
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows if r[0] < 450] + [(None, 1), (3, None), (9999, 0)], "doc_id long, quality int")
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(docs, labels).collect()}
    assert all(kept[r[0]] == bool(r[3]) for r in rows if r[0] >= 450)
    nothing = {r["doc_id"]: r["kept"] for r in quality.judge(docs, labels.limit(0)).collect()}
    assert all(nothing.values())


# top-k


def brute_top(vectors, k):
    good = {(i, tuple(int(np.floor(256 * x)) for x in v)) for i, v in vectors if v is not None and i is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for q, v in good:
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if (i, w) != (q, v) and len(w) == len(v))
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def test_top_k_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(bitsliced, "BLOCK_ROWS", 40)
    rng = np.random.default_rng(2)
    vectors = [(i, rng.normal(0, 0.3, 7).tolist()) for i in range(260)]
    vectors += [(300 + i, vectors[50][1]) for i in range(30)] + [(50, vectors[50][1])] * 2
    vectors += [(400, None), (450, [1.0, None] + [0.0] * 5), (500, [float("nan")] * 7), (550, [float("inf")] * 7), (None, [0.0] * 7)]
    vectors += [(600, [0.0] * 7), (650, [1.5, -2.0]), (651, [2.0, 3.0]), (700, [-3.0] * 7), (750, [])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumn("block", F.lit(1))
    got = sorted(rows_of(bitsliced.top_k(df, F.col("vec_id") % 50 == 0, k=5)))
    assert got == brute_top(vectors, 5)
    assert rows_of(bitsliced.top_k(df.limit(0), F.col("vec_id") % 50 == 0)) == []


# token counts


def test_trie_counts_against_plain_search(docs, none):
    path = public_tokenizers.path("piece_bpe_32k.model")
    costs = token_counts.piece_costs(path)

    def count(word):
        word, best = token_counts.SPACE + word, [(0, 0)]
        for end in range(1, len(word) + 1):
            ways = [(best[s][0] + costs[word[s:end]], s, best[s][1] + 1) for s in range(max(0, end - 60), end) if word[s:end] in costs]
            if word[end - 1] not in costs:
                n = len(word[end - 1].encode())
                ways.append((best[end - 1][0] + n * token_counts.BYTE_COST, end, best[end - 1][1] + n))
            cost, _, tokens = min(ways)
            best.append((cost, tokens))
        return best[-1][1]

    want = [(d, len(WORD.findall(t or "")), sum(map(count, WORD.findall(t or "")))) for d, t, _ in ODD]
    assert sorted(map(repr, rows_of(token_counts.token_counts(docs, path)))) == sorted(map(repr, want))
    assert rows_of(token_counts.token_counts(none, path)) == []


def test_trie_starts_anew_when_full(monkeypatch):
    costs = {c: 5 + i for i, c in enumerate("abc")} | {"ab": 6, "abc": 13, "ca": 9}
    words = ["".join(p) for p in np.random.default_rng(1).choice(list("abcd"), (300, 7))]
    whole = token_counts.Trie(costs)
    want = [whole.count(w) for w in words]
    monkeypatch.setattr(token_counts, "MAX_NODES", 20)
    small = token_counts.Trie(costs)
    assert [small.count(w) for w in words] == want
    monkeypatch.setattr(token_counts, "DEEPEST", 3)
    short = token_counts.Trie(costs)
    assert [short.count(w) for w in words] == want


def test_huge_words_get_few_nodes():
    trie = token_counts.Trie({"a": 3, "b": 4, "ab": 5, "bab": 6})
    assert trie.count("ab" * 100_000) == 100_000
    assert trie.count("ab" * 100_000 + "é") == 100_002
    assert len(trie.way) <= token_counts.DEEPEST + 1


def test_store_forgets_long_strings(monkeypatch):
    monkeypatch.setattr(encoding, "KEPT_BYTES", 3_000)
    held = encoding.Store(1_000)

    def learn(keys):
        return pc.binary_length(keys).to_numpy().astype(np.uint32), np.ones(len(keys), np.int64)

    for keys in (["a", "bb", "a", "x" * 5_000], ["a", "ccc", "", "x" * 5_000, "a"], ["x" * 5_000, "bb", "a"]):
        assert held.values(held.look_up(pa.array(keys), learn)).tolist() == list(map(len, keys))
        assert held.keys.nbytes < 6_000


# passages


def test_compact_windows_cover_each_stretch_once():
    rng = np.random.default_rng(4)
    for n, top in ((30, 1000), (40, 5), (12, 1), (7, 9)):
        h = rng.integers(0, top, n).astype(np.uint64)
        windows = list(zip(*(x.tolist() for x in passages.compact_windows(h, 8))))
        for i in range(n):
            for j in range(i + 7, n):
                mine = [c for left, c, right in windows if left <= i <= c <= j <= right]
                assert mine == [i + int(np.argmin(h[i : j + 1]))]


def test_planted_passages_are_found(spark, none):
    rng = np.random.default_rng(6)

    def text(n):
        return ["".join(rng.choice(list("abcdefghij"), 7)) for _ in range(n)]

    shared, near = text(60), text(120)
    edited = near[:60] + ["edit"] + near[61:]
    rows = [(i, " ".join(text(150) + shared + text(int(rng.integers(0, 200)))), "s") for i in range(30)]
    rows += [(40, " ".join(text(80) + near + text(70)), "s"), (41, " ".join(edited), "s")]
    rows += [(50 + i, " ".join(text(300)), "s") for i in range(20)] + [(80, " ".join(shared[:49] + text(90)), "s")]
    rows += [(90, rows[0][1], "s"), (90, rows[0][1], "s"), (None, rows[1][1], "s"), (91, None, "s"), (92, "", "s"), (93, "a " * 4000, "s")]
    found = passages.near_duplicate_passages(frame(spark, rows)).collect()
    words = collections.defaultdict(list)
    for d, t, _ in rows:
        words[d].append((t or "").split())

    def shingles(d, start, n):
        part = words[d][0][start : start + n]
        return {tuple(part[i : i + 5]) for i in range(len(part) - 4)}

    linked = set()
    for r in found:
        a, b = shingles(r["doc_id"], r["start"], r["n_words"]), shingles(r["of_doc_id"], r["of_start"], r["of_n_words"])
        assert len(a & b) / len(a | b) == pytest.approx(r["similarity"]) and r["similarity"] >= 0.8 and r["n_words"] >= 50
        linked |= {r["doc_id"], r["of_doc_id"]}
    assert linked == {*range(30), 40, 41, 90, None}
    assert rows_of(passages.near_duplicate_passages(none)) == []


def test_passages_meet_behind_shortened_versions(spark):
    rng = np.random.default_rng(21)

    def text(n):
        return ["".join(rng.choice(list("abcdefghij"), 7)) for _ in range(n)]

    def key(t):
        return int(np.uint64(xxhash.xxh64_intdigest(t.encode(), 42)).astype(np.int64))

    shared = text(60)
    whole = sorted((" ".join(text(60) + shared + text(60)) for _ in range(40)), key=key)[-2:]
    parts = [" ".join(text(60) + shared[i % 17 : i % 17 + 44] + text(60)) for i in range(408)]  # all kinds in each task
    parts = [p for p in parts if key(p) < key(whole[0])]  # they sort first in each group
    assert len(parts) > 100
    rows = [(i, t, "s") for i, t in enumerate(parts + whole)]
    found = passages.near_duplicate_passages(frame(spark, rows)).collect()
    ends = {len(parts), len(parts) + 1}
    assert [{r["doc_id"], r["of_doc_id"]} for r in found] == [ends]
    assert (found[0]["start"], found[0]["n_words"], found[0]["similarity"]) == (60, 60, 1.0)


def test_texts_with_a_short_stretch_in_common_are_not_paired(spark, monkeypatch):
    rng = np.random.default_rng(44)

    def text(n):
        return ["".join(rng.choice(list("abcdefghij"), 7)) for _ in range(n)]

    verify, counts = passages.verify, []

    def counting(pairs, *args):
        counts[-1] += pairs.select("a", "b").distinct().count()
        return verify(pairs, *args)

    monkeypatch.setattr(passages, "verify", counting)
    short = text(44)
    for n in (150, 600):
        counts.append(0)
        rows = [(i, " ".join(text(70) + short + text(70)), "s") for i in range(n)]
        assert rows_of(passages.near_duplicate_passages(frame(spark, rows))) == []
    assert counts[0] <= 4 * 150 and counts[1] <= 4 * 600


def test_classes_with_a_short_stretch_in_common_are_not_paired(spark, monkeypatch):
    rng = np.random.default_rng(45)

    def text(n):
        return ["".join(rng.choice(list("abcdefghij"), 7)) for _ in range(n)]

    verify, counts = passages.verify, []

    def counting(pairs, *args):
        counts[-1] += pairs.select("a", "b").distinct().count()
        return verify(pairs, *args)

    monkeypatch.setattr(passages, "verify", counting)
    menu = text(30)
    for n in (40, 160):  # two texts of a kind have a passage beside the menu that all texts have
        counts.append(0)
        passages_of_kinds = [text(60) for _ in range(n)]
        rows = [(i, " ".join(text(60) + menu + text(3) + passages_of_kinds[i // 2] + text(60)), "s") for i in range(2 * n)]
        found = passages.near_duplicate_passages(frame(spark, rows)).collect()
        assert {frozenset((r["doc_id"], r["of_doc_id"])) for r in found} == {frozenset((2 * i, 2 * i + 1)) for i in range(n)}
    assert counts[0] <= 8 * 40 and counts[1] <= 8 * 160


def test_common_passages_are_the_same_by_places_and_by_codes():
    rng = np.random.default_rng(46)

    def text(n):
        return rng.integers(1, 1 << 62, n).astype(np.uint64)

    found = 0
    for _ in range(400):
        base = text(int(rng.integers(50, 160)))
        a, b = base.copy(), np.concatenate([text(int(rng.integers(0, 40))), base[: int(rng.integers(30, 160))], text(20)])
        for x in (a, b):
            changed = rng.random(len(x)) < rng.choice([0, 0.05, 0.15])
            x[changed] = text(int(changed.sum()))
        both = passages._Repeating(a, b)
        by_codes = passages.passages_of(both if both.possible else None, len(a), len(b))
        assert passages.common_passages(a, b) == by_codes
        found += bool(by_codes)
    assert 100 < found < 300


def test_recall_against_all_pairs(spark):
    rng = np.random.default_rng(77)

    def text(n):
        return ["".join(rng.choice(list("abcdefghij"), 7)) for _ in range(n)]

    rows, chains, menu = [], [], text(30)
    for i in range(60):  # the third resembles the second, but mostly not the first
        n = int(rng.integers(52, 160))
        p = text(n)
        q = p[: n // 3] + text(1) + p[n // 3 + 1 :]
        r = q[: n // 2] + text(1) + q[n // 2 + 1 :]
        chains.append([len(rows) + k for k in range(3)])
        rows += [(len(rows) + k, " ".join(text(60) + menu + text(20) + x + text(60)), "s") for k, x in enumerate((p, q, r))]
    sequences = [passages.shingles(np.array([xxhash.xxh64_intdigest(w) for w in t.split()], np.uint64)) for _, t, _ in rows]
    similar = {(a, b) for c in chains for a in c for b in c if a < b and passages.common_passages(sequences[a], sequences[b])}
    found = passages.near_duplicate_passages(frame(spark, rows)).collect()
    class_of = {i: i for i in range(len(rows))}
    for r in found:
        a, b = class_of[r["doc_id"]], class_of[r["of_doc_id"]]
        class_of = {k: b if v == a else v for k, v in class_of.items()}
    assert len(similar) > 100
    assert sum(class_of[a] == class_of[b] for a, b in similar) >= 0.99 * len(similar)
    assert {i // 3 for r in found for i in (r["doc_id"], r["of_doc_id"]) if r["doc_id"] // 3 != r["of_doc_id"] // 3} == set()


def test_crowded_groups_lose_no_link(spark):
    rng = np.random.default_rng(64)

    def text(n):
        return ["".join(rng.choice(list("abcdefghij"), 7)) for _ in range(n)]

    def edited(t, places):
        return [text(1)[0] if i in places else w for i, w in enumerate(t)]

    rows, base = [], text(52)
    for _ in range(150):  # pairs of versions, each too far from the other pairs, that share signatures with most of them
        p = edited(base, set(rng.choice(52, 3, replace=False).tolist()))
        for x in (p, edited(p, {int(rng.integers(20, 32))})):
            rows.append((len(rows), " ".join(text(60) + x + text(60)), "s"))
    sequences = [passages.shingles(np.array([xxhash.xxh64_intdigest(w, 42) for w in t.split()], np.uint64)) for _, t, _ in rows]
    groups = collections.defaultdict(set)
    for i, sh in enumerate(sequences):
        for sig in passages.anchors(sh)[0].tolist():
            groups[sig].add(i)
    assert max(map(len, groups.values())) > 64
    met = {(a, b) for g in groups.values() for a in g for b in g if a < b}
    similar = {(a, b) for a, b in met if passages.common_passages(sequences[a], sequences[b])}
    assert len(similar) > 100
    class_of = list(range(len(rows)))
    for r in passages.near_duplicate_passages(frame(spark, rows)).collect():
        a, b = class_of[r["doc_id"]], class_of[r["of_doc_id"]]
        class_of = [b if c == a else c for c in class_of]
    assert [(a, b) for a, b in similar if class_of[a] != class_of[b]] == []


def test_rest_pairs_join_all_classes_of_a_crowded_group(spark):
    rows = [(7, k // 2, k, False) for k in range(200)] + [(8, 0, k, k < 3) for k in range(200)]
    members = spark.createDataFrame(rows, "sig long, root long, key long, open boolean")
    found = {(r["a"], r["b"]) for r in passages.rest_pairs(members).collect()}
    assert found == {(a, b) for a in range(200) for b in range(a) if a // 2 != b // 2} | {(1, 0), (2, 0), (2, 1)}


def test_passages_leave_no_shuffle_files_of_stored_steps(spark):
    rng = np.random.default_rng(12)

    def text(n):
        return ["".join(rng.choice(list("abcdefghij"), 7)) for _ in range(n)]

    env, key = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def files():
        folders = env.blockManager().diskBlockManager().localDirsString()
        return {str(p) for d in folders for p in pathlib.Path(d).rglob("shuffle_*.data")}

    shared = text(60)
    docs = frame(spark, [(i, " ".join(text(60) + shared + text(60)), "s") for i in range(20)])
    before, setting = files(), spark.conf.get(key, None)
    found = passages.near_duplicate_passages(docs)  # runs all stored steps; files go in the background
    for _ in range(100):
        left = files() - before
        if not left:
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(key, None) == setting
    assert found.select("doc_id").distinct().count() == 19


def test_close_passages_that_lie_apart_in_the_other_text():
    rng = np.random.default_rng(31)

    def text(n):
        return rng.integers(1, 1 << 62, n).astype(np.uint64)

    def edited(p):
        return np.concatenate([p[:30], text(1), p[31:]])

    def spans(a, b):
        return [(x, y) for x, _, y, _, _ in sorted(passages.common_passages(passages.shingles(a), passages.shingles(b)))]

    p, q, short = text(60), text(60), text(24)
    a, b = np.concatenate([text(90), p, q, text(90)]), np.concatenate([text(90), edited(p), text(70), edited(q), text(90)])
    assert spans(a, b) == [(90, 90), (150, 220)]
    assert spans(b, a) == [(90, 90), (220, 150)]
    # other shared wording nearer than the gap, before the passage in one text and after it in the other
    a, b = np.concatenate([text(90), p, text(6), short, text(90)]), np.concatenate([text(90), short, text(6), edited(p), text(90)])
    assert len(spans(a, b)) == len(spans(b, a)) == 1
    # nearer than the changed word within the passage
    a, b = np.concatenate([text(90), p, short, text(90)]), np.concatenate([text(90), short, edited(p), text(90)])
    assert len(spans(a, b)) == len(spans(b, a)) == 1
    # every stretch of b counts once a part of a is left
    a, b = np.concatenate([p, q]), np.concatenate([q, text(40), p, text(40), q])
    assert [x for x, _ in spans(a, b)] == [0, 60]


def test_short_near_passages_share_a_signature():
    rng = np.random.default_rng(5)

    def text(n):
        return rng.integers(1, 1 << 62, n).astype(np.uint64)

    shared = 0
    for _ in range(1000):
        p = text(50)
        q = np.concatenate([p[:25], text(1), p[26:]])
        a, b = (passages.anchors(passages.shingles(np.concatenate([text(150), x, text(150)])))[0] for x in (p, q))
        shared += bool(np.isin(a, b).any())
    assert shared >= 985


# token files


@pytest.mark.parametrize("n", [0, 1, 15, 5000, 300_000])
def test_coder_round_trip(n):
    ids = (np.random.default_rng(n).zipf(1.3, n) % 5000).astype(np.uint32)
    table = ans.Table(ans.scaled(np.bincount(ids, minlength=5001)))
    block = ans.encode_block(ids, table)
    assert np.array_equal(ans.decode_block(block, table), ids)
    if n == 300_000:
        last = ans.stretches(block) - 1
        assert np.array_equal(ans.decode_stretch(block, last, table), ids[last * ans.CHECKPOINT_STEPS * ans.LANES :])
        broken = bytearray(block)
        broken[-40] ^= 1
        with pytest.raises(ValueError):
            ans.decode_block(bytes(broken), table)


@pytest.mark.parametrize(("name", "kind"), [("word_bpe_49k.json", "words"), ("byte_bpe_50k.json", "spaced")])
def test_encoder_gives_the_library_ids(monkeypatch, name, kind):
    monkeypatch.setattr(encoding, "KEPT_UNITS", 40)
    monkeypatch.setattr(encoding, "KEPT_PIECES", 20)
    tokenizer, enc = Tokenizer.from_file(public_tokenizers.path(name)), encoding.Encoder(public_tokenizers.path(name), kind)
    texts = [t for _, t, _ in ODD] + [" lead", "trail ", "a\n\nb", "\n", "x \ny", "a\0b \0 c", "\0", "x\ty", "a'S 'Re I'LL ª µ ½ b²", "e ́x", "\nx", "x\n", "\x1c a \x1c"]
    for _ in range(2):
        ids, sizes = enc.encode(texts)
        want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert sizes.tolist() == list(map(len, want)) and ids.tolist() == [i for w in want for i in w]


def test_token_files(docs, none, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 50)
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    got = sorted(rows_of(token_files.round_trip(docs, path)), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((d for d, _, _ in ODD), key=lambda d: (d is not None, d))
    place = 0
    for doc, start, n, ids in got:
        text = next(t for d, t, _ in ODD if d == doc)
        want = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        assert (start, n, np.frombuffer(ids, "<u4").tolist()) == (place, len(want), want)
        place += n
    assert rows_of(token_files.round_trip(none, path)) == []


# packing


def test_packing(docs, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    docs = docs.filter("doc_id is null or doc_id <> 8").coalesce(1)
    want = {d: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for d, t, _ in ODD if d != 8}
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for doc, start, length, total, sequence, offset, ids in rows_of(packing.pack(docs, path)):
        assert total == len(want[doc]) and np.frombuffer(ids, "<u4").tolist() == want[doc][start : start + length]
        pieces[doc].append((start, length))
        sequences[sequence].append((offset, length))
    for found in (*pieces.values(), *sequences.values()):
        place = 0
        for start, length in sorted(found):
            assert start == place and length > 0
            place += length
    assert {d: sum(n for _, n in p) for d, p in pieces.items()} == {d: len(w) for d, w in want.items()}
    sizes = [sum(n for _, n in s) for s in sequences.values()]
    assert max(sizes) <= 1024 and all(s & (s - 1) == 0 for s in sizes)
    assert rows_of(packing.pack(none, path)) == []


def test_sum_of_squares_rule():
    """Each item goes where the sum of squared counts of partial levels is smallest."""
    packer, rng = packing.Packer(16, 0), np.random.default_rng(0)
    for length in rng.integers(1, 16, 300).tolist():
        before = packer.level.copy()

        def after(at):
            level = before.copy()
            if at:
                level[at] -= 1
            if at + length < 16:
                level[at + length] += 1
            return int((level * level).sum())

        least = min(after(at) for at in range(0, 17 - length) if at == 0 or before[at])
        packer.place(length, (0, 0, length))
        assert int((packer.level * packer.level).sum()) == least


# personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text):
    def good(kind, match):
        digits = re.sub("[^0-9]", "", match)
        if kind == "ip":
            return all(int(p) <= 255 for p in match.split("."))
        if kind == "card":
            total = sum((2 * int(c) - 9 * (int(c) > 4)) if i % 2 else int(c) for i, c in enumerate(digits[::-1]))
            return 14 <= len(digits) <= 19 and total % 10 == 0
        return kind != "phone" or 10 <= len(digits) <= 15

    return sorted((m.start(), i, m.end()) for i, (k, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text or "") if good(k, m[0]))


PERSONAL = [
    "mail a.b+c@x-y.example.com, or a@b.c@d.e and é@x.y z%q@a.b%c@d.e. @x.y a@b", "1.2.3.4 256.1.1.1 0001.02.3.255 1.2.3.4.5.6.7.8 9.9.9",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112, 0 0", "+1 (656) 555-6510. +12 +49.30.1234567- ++1 234 567 890 12 345 678",
    "ñ" * 50 + "x@y.zz" + "1" * 3000 + "." + "a" * 3000 + "@", None, "", "9" * 20_000 + " 1-" * 9000, "a@" + "b." * 9000 + "c",
]


def test_base_spans(spark):
    docs = spark.createDataFrame(list(enumerate(PERSONAL)) + [(3, PERSONAL[3]), (None, PERSONAL[0])], "doc_id long, text string")
    for row in pii.find(docs.withColumn("base", F.lit(1))).collect():
        text = PERSONAL[row["doc_id"] or 0]
        assert [tuple(s)[:3] for s in row["base"]] == brute_spans(text)
    assert pii.find(docs.limit(0)).collect() == []


def test_contexts_discover_identifiers_and_redact(spark):
    rows = [(i, f"reach me, my contact is user{i}@mail.example.com today") for i in range(40)]
    rows += [(100, "my contact is AB-771-4432 today"), (101, "in version 12345678 of it"), (102, "room 12 on floor 3")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in pii.find(docs).collect()}
    assert [(s["start"], s["stop"]) for s in found[100]["spans"]] == [(14, 25)]
    assert not found[101]["spans"] and not found[102]["spans"]
    joined = pii.find(docs).join(docs, "doc_id")
    clean = {r["doc_id"]: r["t"] for r in joined.select("doc_id", pii.redact(F.col("text"), F.col("spans")).alias("t")).collect()}
    assert clean[100] == "my contact is [ID] today" and clean[3] == "reach me, my contact is [EMAIL] today"
    assert clean[102] == "room 12 on floor 3"


def test_contexts_add_unseen_kinds_and_spare_the_rest(spark):
    rng = np.random.default_rng(3)
    hexes = ["".join(rng.choice(list("0123456789abcdef"), 30)) + "0a1b2c3d4e" for _ in range(60)]
    rows = [(i, f'some words, token = "{h}" and more') for i, h in enumerate(hexes[:50])]
    rows += [(100 + i, f"the badge of staff: N{7000000 + 13 * i}-{i % 7}, at the door") for i in range(40)]  # no seeds, no label
    rows += [(200 + i, f"ask staff: person{i}@mail.example.com, at the desk") for i in range(200)]
    rows += [(500 + i, f"the 41111111{i:08d} and the other the thing the end of the day") for i in range(60)]  # few pass Luhn
    rows += [(600 + i, f"commit {h} of the tree") for i, h in enumerate(hexes[50:])] + [(700, None), (701, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = dict(rows)
    for rerun in (docs, docs.repartition(7)):
        more = {
            (r["doc_id"], texts[r["doc_id"]][s["start"] : s["stop"]])
            for r in pii.find(rerun).collect() for s in r["spans"] if s["kind_no"] == len(pii.KINDS)
        }
        assert {x for x in more if x[0] < 100} == {(i, h) for i, h in enumerate(hexes[:50])}
        assert {x[0] for x in more if 100 <= x[0] < 200} == set(range(100, 140))
        assert not {x for x in more if x[0] >= 200}
