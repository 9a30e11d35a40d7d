"""A case per outcome, and enough labelled rows on the driver's tables."""

import pytest

import __spark_entry__ as E
from contrail.operators import metrics

from paths import SF01


@pytest.mark.parametrize("n,error,want", [(99, 50.0, (False, False)), (100, 50.0, (True, True)), (100, 13.0, (False, True)),
                                          (100, 1.0, (False, False)), (200, 11.0, (False, False))])
def test_outcomes(spark, n, error, want):
    """Errors of +-``error`` around labels with a std of about 100: R2 stays high until the error is large."""
    rows = [(float(200 * (i % 2)), float(200 * (i % 2)) + error * (1 if i % 4 < 2 else -1)) for i in range(n)]
    r = metrics.accuracy_check(spark.createDataFrame(rows, "y double, p double"), "y", "p", 0.85).first()
    assert (r.accuracy_drop, r.retrain_on_mae) == want and r.n == n


def test_no_baseline_and_no_rows(spark):
    rows = [(float(i % 5), 500.0) for i in range(150)]
    df = spark.createDataFrame(rows, "y double, p double")
    r = metrics.accuracy_check(df, "y", "p", None).first()
    assert not r.accuracy_drop and r.retrain_on_mae
    r = metrics.accuracy_check(df.limit(0), "y", "p", 0.85).first()
    assert r.n == 0 and not r.accuracy_drop and not r.retrain_on_mae


def test_the_rules_have_enough_rows_on_the_driver_tables(spark):
    r = E.queries()["accuracy_check_sessions"](spark, SF01).first()
    assert r.n >= 100 and r.accuracy_drop and r.retrain_on_mae
