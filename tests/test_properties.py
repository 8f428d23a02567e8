"""Randomised checks against DuckDB and plain Python."""

from __future__ import annotations

import random
from datetime import date, timedelta

import duckdb
from pyspark.sql import functions as F

from seasonstar.functions import numeric
from seasonstar.operators import extremes, series, staging


def test_rounding_equals_duckdb(spark):
    rng = random.Random(5)
    values = [rng.uniform(-1e6, 1e6) for _ in range(3000)]
    values += [round(rng.uniform(-1000, 1000), 3) for _ in range(3000)]
    values += [k / 8 for k in range(-400, 400)] + [k / 200 for k in range(-1000, 1000)] + [0.0, 1e15 + 0.5, 5e-324]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = df.select("x", *[numeric.round_half_away("x", n).alias(f"r{n}") for n in range(4)]).collect()
    con = duckdb.connect()
    for r in rows:
        want = con.execute("SELECT round(?::DOUBLE, 0), round(?::DOUBLE, 1), round(?::DOUBLE, 2), round(?::DOUBLE, 3)", [r.x] * 4).fetchone()
        assert tuple(map(repr, r[1:])) == tuple(map(repr, want)), r.x


def random_series(rng, keys=3, days=200):
    rows = []
    for k in range(keys):
        for i in range(days):
            if rng.random() < 0.8:
                rows.append((f"k{k}", date(2019, 12, 1) + timedelta(days=i), rng.choice([None, round(rng.uniform(0, 50), 2)])))
    return rows


def test_series_operators_against_python(spark):
    rows = random_series(random.Random(11))
    df = spark.createDataFrame(rows, "k string, t date, x double").repartition(5)
    out = series.gap_safe_diff(df, ["k"], "t", "x", 2, out="d2")
    out = series.lag_diff(out, ["k"], "t", "x", 3, "d3")
    out = series.rolling_sum(out, ["k"], "t", "x", 4, "s4")
    got = {(r.k, r.t): r for r in out.collect()}
    for key in {k for k, _, _ in rows}:
        mine = sorted((t, x) for k, t, x in rows if k == key)
        for i, (t, x) in enumerate(mine):
            r = got[(key, t)]
            gap = i > 0 and (t - mine[i - 1][0]).days == 2 and None not in (x, mine[i - 1][1])
            assert (r.d2 is not None) == bool(gap)
            if gap:
                assert abs(r.d2 - (x - mine[i - 1][1])) < 0.0051
            back = mine[i - 3][1] if i >= 3 else None
            assert r.d3 == (None if None in (x, back) else x - back)
            window = [v for _, v in mine[max(0, i - 3): i + 1] if v is not None]
            assert r.s4 == (round(sum(window), 2) if window else None)


def test_latest_and_top_k_against_python(spark):
    rng = random.Random(3)
    rows = [(rng.choice("aaaab"), rng.randrange(6), rng.randrange(40), i) for i in range(2000)]  # `a` holds most rows
    df = spark.createDataFrame(rows, "k string, d int, ver int, id int").repartition(6)
    newest = staging.dedup_latest(df, ["k", "d"], [F.col("ver").desc(), F.col("id")])
    want = {}
    for k, d, ver, i in rows:
        want[(k, d)] = max(want.get((k, d), (-1, 0)), (ver, -i))
    assert {(r.k, r.d): (r.ver, -r.id) for r in newest.collect()} == want
    top = extremes.top_k_per_group(df, ["k"], [F.col("ver").desc()], 5).collect()
    for key in "ab":
        vers = sorted((v for k, _, v, _ in rows if k == key), reverse=True)
        assert len([r for r in top if r.k == key]) == sum(v >= vers[4] for v in vers)


def test_sums_do_not_depend_on_order(spark):
    rng = random.Random(9)
    rows = [(rng.choice(["a", "b"]), round(rng.uniform(-100, 100), 2)) for _ in range(5000)]
    df = spark.createDataFrame(rows, "k string, x double")

    def result(n):
        out = df.repartition(n).groupBy("k").agg(
            numeric.exact_sum("x", 2).alias("s"), numeric.exact_mean("x", 2).alias("m"), numeric.sum_of_means("x", 1).alias("c")
        )
        return sorted(map(tuple, out.collect()))

    assert result(1) == result(3) == result(13)
    below = spark.createDataFrame([(12.0,), (0.4996,)], "x double")
    assert below.agg(numeric.sum_of_means("x", 0)).first()[0] == 12.0
    for k, s, _, _ in result(2):
        assert s == sum(round(x * 100) for key, x in rows if key == k) / 100
