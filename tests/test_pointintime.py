"""As-of joins and rolling features against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from contrail.operators import grouping
from contrail.operators import pointintime as P

D0 = dt.date(2020, 1, 1)


def day(i):
    return None if i is None else D0 + dt.timedelta(days=i)


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(5)
    left = [(n, rng.choice(["hot"] * 6 + ["a", "b", None]), rng.choice([None] + [rng.randrange(400)] * 9)) for n in range(400)]
    right = [(rng.choice(["hot", "a", "c", None]), rng.randrange(0, 400, 7), float(n), n) for n in range(120)] + [("hot", 14, 1.0, 900), ("hot", 14, 1.0, 901), ("hot", None, 5.0, 902)]
    l = spark.createDataFrame([(n, k, day(i)) for n, k, i in left], "id int, k string, d date").repartition(5)
    r = spark.createDataFrame([(k, day(i), v, w) for k, i, v, w in right], "k string, rd date, v double, w int")
    return left, right, l, r


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("bucket", [1, 30, 10_000])
def test_as_of_join_matches_a_scan(tables, strict, bucket):
    left, right, l, r = tables
    got = {x.id: (x.v, x.w) for x in P.as_of_join(l, r, ["k"], "d", "rd", ["v", "w"], bucket, strict).collect()}
    for n, k, i in left:
        found = [(ri, v, w) for rk, ri, v, w in right if rk == k and k is not None and i is not None and ri is not None and (ri < i or (ri == i and not strict))]
        assert got[n] == (max(found)[1:] if found else (None, None)), (n, k, i)
    assert len(got) == len(left)


def test_clashing_names_empty_sides_and_timestamps(spark, tables):
    _, _, l, r = tables
    odd = l.select("*", *[F.lit("x").alias(c) for c in ("_k", "rd", "bucket", "key")])
    out = P.as_of_join(odd, r, ["k"], "d", "rd", ["v"], 30)
    assert out.columns == [*odd.columns, "v"] and out.count() == 400
    assert P.as_of_join(l, r.limit(0), ["k"], "d", "rd", ["v"], 30).where("v IS NOT NULL").count() == 0
    assert P.as_of_join(l.limit(0), r, ["k"], "d", "rd", ["v"], 30).count() == 0
    ts = spark.createDataFrame([(1, dt.datetime(2020, 1, 1, 12)), (1, dt.datetime(2020, 1, 1, 13))], "k int, ts timestamp")
    facts = spark.createDataFrame([(1, dt.datetime(2020, 1, 1, 12, 30), 7)], "k int, at timestamp, v int")
    assert {x.ts.hour: x.v for x in P.as_of_join(ts, facts, ["k"], "ts", "at", ["v"], 3_600_000_000).collect()} == {12: None, 13: 7}


def test_as_of_cumulative_stats_equal_the_leakage_safe_ones(spark):
    rng = random.Random(2)
    rows = [(rng.choice("xyz"), day(rng.randrange(60)), float(rng.randrange(40)) if rng.random() < 0.9 else None) for _ in range(500)]
    df = spark.createDataFrame(rows, "k string, d date, y double")
    want = {(r.k, r.d): r for r in grouping.leakage_safe_stats(df, "k", "d", "y", "k").collect()}
    got = P.as_of_join(df.select("k", "d").distinct(), P.cumulative_stats(df, ["k"], "d", "y", "k"), ["k"], "d", "d", P.prior_columns("k"), 10)
    for r in got.collect():
        w = want[r.k, r.d]
        assert (r.k_prior_n or 0) == w.k_prior_n
        for c in ("avg", "std", "rate"):
            a, b = r[f"k_prior_{c}"], w[f"k_prior_{c}"]
            assert (a is None) == (b is None) and (a is None or a == pytest.approx(b))


@pytest.mark.parametrize("segment", [8, 30, 10_000])
def test_rolling_features_match_a_scan(spark, segment):
    rng = random.Random(9)
    rows = [(rng.choice("ab"), rng.randrange(100), float(rng.randrange(30)) if rng.random() < 0.9 else None) for _ in range(300)]
    df = spark.createDataFrame([(k, day(i), y) for k, i, y in rows] + [("a", None, 1.0)], "k string, d date, y double")
    got = {(r.k, (r.d - D0).days): r for r in P.rolling_stats(df, ["k"], "d", "y", 7, segment).collect()}
    assert set(got) == {(k, i) for k, i, _ in rows}
    for (k, i), r in got.items():
        past = [y for kk, j, y in rows if kk == k and i - 7 <= j < i]
        known = [y for y in past if y is not None]
        lag = [y for kk, j, y in rows if kk == k and j == i - 1 and y is not None]
        now = sum(1 for kk, j, _ in rows if kk == k and j == i)
        assert r.rolling_n == len(known) and r.congestion == now
        assert r.rolling_avg == (pytest.approx(sum(known) / len(known)) if known else None)
        assert r.lag_avg == (pytest.approx(sum(lag) / len(lag)) if lag else None)
        assert r.congestion_ratio == (pytest.approx(now * 7 / len(past)) if past else None)
