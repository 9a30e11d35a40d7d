"""Every registered query runs on the smoke tables with a stable schema."""

import pytest

import __spark_entry__ as E
from contrail.plans import load_all

from paths import SMOKE

OWN = load_all()[0]  # the training-data queries have their tests in tests/llm

SLOW = {"model_leaderboard"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert E.entry(spark).schema == df.schema


def test_every_query_has_docstring_and_oracle_keys_exist():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert all(fn.__doc__ for fn in q.values())
    assert set(OWN) <= set(q) and not any(k.startswith("op") or "pipeline" in k for k in OWN)


@pytest.mark.parametrize("name", sorted(set(OWN) - SLOW))
def test_query_runs(spark, name):
    df = E.queries()[name](spark, SMOKE)
    df.collect()
