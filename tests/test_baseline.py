"""Stored baseline profiles: merge, measure, PSI and quality against numpy."""

import math

import numpy as np
import pytest

from contrail.operators import baseline as B
from contrail.operators import drift

from test_order_stats_drift import frame, psi_brute


def one(df):
    return {r.col_name: r for r in df.collect()}


def test_profile_matches_numpy(spark):
    rng = np.random.default_rng(2)
    x, y = rng.normal(1e6, 1, 400), np.round(rng.exponential(size=400), 1)
    got = one(B.baseline_profile(frame(spark, x=list(x), y=list(y)), ["x", "y"]))
    for c, v in (("x", x), ("y", y)):
        edges = np.unique(np.percentile(v, np.linspace(0, 100, 11)))
        assert got[c].edges == pytest.approx(list(edges)) and got[c].counts == list(np.histogram(v, bins=got[c].edges)[0])
        assert got[c].n == 400 and got[c].mean == pytest.approx(v.mean()) and got[c].m2 == pytest.approx(v.var() * 400, rel=1e-6)
        assert (got[c].min, got[c].max, got[c].below, got[c].above) == (v.min(), v.max(), 0, 0)


def test_merged_batches_equal_one_batch(spark, tmp_path):
    rng = np.random.default_rng(4)
    parts = [rng.normal(i, 1 + i, 150) for i in range(4)]
    base = B.save_profile(B.baseline_profile(frame(spark, x=list(parts[0])), ["x"]), str(tmp_path / "base"))
    measured = [B.measure(frame(spark, x=list(p)), base, ["x"]) for p in parts[1:]]
    merged = one(B.merge_profiles(base, *measured))["x"]
    stepwise = one(B.merge_profiles(B.merge_profiles(base, measured[0]), B.merge_profiles(measured[2], measured[1])))["x"]
    every = np.concatenate(parts)
    edges = np.array(one(base)["x"].edges)
    for got in (merged, stepwise):
        assert got.n == 600 and got.mean == pytest.approx(every.mean()) and got.m2 == pytest.approx(every.var() * 600)
        assert got.counts == list(np.histogram(every, bins=edges)[0])
        assert (got.below, got.above) == ((every < edges[0]).sum(), (every > edges[-1]).sum())
        assert got.min == every.min() and got.max == every.max()


def test_profiles_of_different_edges_do_not_merge(spark):
    a = B.baseline_profile(frame(spark, x=[1.0, 2.0, 3.0]), ["x"])
    b = B.baseline_profile(frame(spark, x=[1.0, 2.0, 4.0]), ["x"])
    with pytest.raises(Exception, match="different edges"):
        B.merge_profiles(a, b).collect()


def test_psi_and_quality_read_the_stored_table_only(spark, tmp_path):
    rng = np.random.default_rng(6)
    e, a = rng.normal(size=300), np.concatenate([rng.normal(0.4, 1.3, 200), [50.0, -50.0]])
    profile = B.save_profile(B.baseline_profile(frame(spark, x=list(e)), ["x"]), str(tmp_path / "p"))
    production = frame(spark, x=[*a, None, math.nan], other=[1.0] * 100 + [None] * 104)
    measured = B.measure(production, profile, ["x"])
    assert drift.psi_from_baseline(profile, measured).first()["psi"] == pytest.approx(psi_brute(e, a), rel=1e-9)
    q = B.quality_of(measured).first()
    share = (np.abs(a - e.mean()) <= 3 * e.std()).mean()
    assert q.completeness == pytest.approx((202 + 100) / 408) and q.range_validity == pytest.approx(share)
    row = drift.monitor_batch(profile, production, ["x"]).first()
    assert row.n_rows == 204 and row.quality_score == pytest.approx(q.quality_score) and row.mean_psi == pytest.approx(psi_brute(e, a), rel=1e-9)


def test_constant_empty_and_missing(spark):
    const = B.baseline_profile(frame(spark, x=[5.0] * 20, y=[None] * 20), ["x", "y"])
    got = one(const)
    assert list(got) == ["x"] and got["x"].edges == [5.0] and got["x"].counts == [20]
    far = B.measure(frame(spark, x=[1.0, 5.0, 9.0] * 5, y=[1.0] * 15), const, ["x", "y"])
    m = one(far)
    assert (m["x"].below, m["x"].counts, m["x"].above) == (5, [5], 5) and m["y"].edges is None
    assert drift.psi_from_baseline(const, far).first()["psi"] == 0.0
    nothing = B.measure(frame(spark, x=[1.0], y=[1.0]).limit(0), const, ["x", "y"])
    assert drift.psi_from_baseline(const, nothing).count() == 0
    assert B.quality_of(nothing).first()["quality_score"] == 0.0
    assert drift.monitor_batch(const, frame(spark, x=[1.0], y=[1.0]).limit(0), ["x", "y"]).first()["n_rows"] == 0


def test_a_batch_is_scanned_once(spark):
    profile = spark.createDataFrame([], B.PROFILE)
    batch = spark.range(10).selectExpr("cast(id AS double) AS x", "id AS other")
    plan = B.measure(batch, profile, ["x"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 10") == 1
