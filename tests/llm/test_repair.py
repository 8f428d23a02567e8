"""Conversation repair against a plain search over whole audits."""

from __future__ import annotations

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from seasonstar.llm import repair
from seasonstar.llm.queries import ORACLES
from tests.compare import connect, differences

TURNS = "conv_id long, turn long, role string, text string, block string, cost string"  # the last two clash with results
NEXT, NAME = {0: 2, 1: 2, 2: 3, 3: 2}, {2: "user", 3: "assistant"}
KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NOTHING = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(h, text)
        out += [(conv, turn, "user" if h == 4 else role, text)] * {0: 0, 3: 2}.get(h, 1)
    return out


def brute(rows):
    """Counts, cost, audit and digest of one conversation: the best (cost, audit) of each state, row by row."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    faults, seen = [], set()
    for _, _, role, text in rows:
        end = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else "")
        seen.add((role, text))

    def inserted(way):
        state, cost, audit, said = way
        for _ in range(3):
            yield state, cost, audit, said
            state = NEXT[state]
            cost, audit, said = cost + 5, audit + "I", said + (NAME[state] + ":",)

    best = {0: (0, 0, "", ())}
    for (_, _, role, text), fault in zip(rows, faults):
        found = []
        for way in best.values():
            for state, cost, audit, said in inserted(way):
                found.append((state, cost + 2, audit + "D", said))
                if fault in ("blank", "duplicate"):
                    continue
                more = cost + 5 * (fault == "truncated")
                if (state, role[:1]) in KEPT:
                    found.append((KEPT[state, role[:1]], more, audit + "K", said + (f"{role}:{text}",)))
                found.append((NEXT[state], more + 1, audit + "R", said + (f"{NAME[NEXT[state]]}:{text}",)))
        best = {s: min((w for w in found if w[0] == s), key=lambda w: w[1:3]) for s in {w[0] for w in found}}
    _, cost, audit, said = min((w for way in best.values() for w in inserted(way) if w[0] in (0, 3)), key=lambda w: w[1:3])
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    n = collections.Counter(faults)
    return gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest()


def wanted(rows, before=damaged):
    groups = collections.defaultdict(list)
    for row in before(rows):
        groups[row[0]].append(row)
    return {c: brute(groups[c]) if groups[c] else NOTHING for c in {r[0] for r in rows}}


def odd_rows():
    rng = np.random.default_rng(13)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", None, "", "User"]
    texts = ["Fine.", "No end", "Why? ", "", None, " \t\n", "ß…", "Stop!\x0b", "a" * 3000 + "."]
    rows = []
    for conv in [*range(60), None]:
        for turn in range(int(rng.integers(1, 14))):
            at = None if rng.random() < 0.1 else turn + int(rng.integers(0, 2))
            rows.append((conv, at, roles[rng.integers(len(roles))], texts[rng.integers(len(texts))]))
    rows += [(100, t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(400)]
    rows += [(101, 5, "user", "again.")] * 30 + [(102, -(1 << 62), "user", "a."), (102, 1 << 61, "assistant", "b.")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "b", "c") for r in rows], TURNS)


def by_conversation(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("block_rows", [2048, 3, 1])
def test_repair_against_plain_search(spark, monkeypatch, block_rows):
    """Small blocks cut conversations, so that crossings of blocks and of rows are both used."""
    monkeypatch.setattr(repair, "BLOCK_ROWS", block_rows)
    rows = odd_rows()
    turns = frame(spark, rows)
    got = repair.repair_all(turns, repair.damage(turns)).collect()
    assert len(got) == len({r[0] for r in rows})
    assert {r[0]: tuple(r)[1:] for r in got} == wanted(rows)
    whole = by_conversation(repair.repair(turns))
    assert whole == wanted(rows, lambda rows: [(c, t, *(" " if x is None else x for x in (r, s))) for c, t, r, s in rows])


def test_damage(spark):
    rows = odd_rows()
    got = [tuple(r) for r in repair.damage(frame(spark, rows)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, damaged(rows)))


def test_no_rows_and_conversations_without_rows(spark):
    none = frame(spark, [])
    assert repair.repair(none).collect() == [] and repair.repair_all(none, repair.damage(none)).collect() == []
    assert by_conversation(repair.repair_all(frame(spark, [(7, 1, "user", "x.")]), none)) == {7: NOTHING}


def test_crossings_give_the_audit_least_way():
    """All codes of short conversations, against a listing of all ways."""
    rng = np.random.default_rng(2)
    for _ in range(300):
        codes = bytes(rng.integers(0, 12, int(rng.integers(1, 9))).tolist())
        steps = repair.row_steps(codes)
        end = repair.last_state(*repair.forward(steps, 0, len(steps), 0))
        ways = {0: [(0, "")]}
        for step in steps:
            grown = collections.defaultdict(list)
            for x, found in ways.items():
                for y, way in enumerate(step[x]):
                    if way is not None:
                        grown[y] += [(c + way[0], a + way[1]) for c, a in found]
            ways = {y: sorted(found)[:50] for y, found in grown.items()}
        tails = {0: "", 1: "II", 2: "I", 3: ""}
        least = min((c + 5 * len(tails[y]), a + tails[y]) for y, found in ways.items() for c, a in found)
        assert "".join(repair.block_audit(codes, 0, end)) + tails[end] == least[1]


def test_one_long_conversation_is_read_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK_ROWS", 50)
    rows = [(1, t, ("user", "assistant", "user")[t % 3], f"text {t}" + "." * (t % 5 > 0)) for t in range(3000)]
    turns = frame(spark, rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # a small table would be read by one task
    try:
        found = repair.blocks(turns).select("block", F.size("texts").alias("n")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len({r["block"] >> 33 for r in found}) > 1 and max(r["n"] for r in found) <= 50 and sum(r["n"] for r in found) == 3000
    assert by_conversation(repair.repair(turns)) == {1: brute([(c, t, r, s) for c, t, r, s in rows])}


def test_sql_agrees_on_odd_rows(spark, tmp_path):
    rows = [r for r in odd_rows() if r[0] != 100]
    folder = str(tmp_path)
    frame(spark, rows).coalesce(1).write.parquet(f"{folder}/written")
    (part,) = (tmp_path / "written").glob("*.parquet")
    part.rename(tmp_path / "conversations.parquet")
    turns = spark.read.parquet(f"{folder}/conversations.parquet")
    _, found = differences(repair.repair_all(turns, repair.damage(turns)), connect(folder), ORACLES["op13_repair"])
    assert not found, found
