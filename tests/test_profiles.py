"""Profiles against numpy: exact moments, sketches within their bound, correlations."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from annalist.operators import profiles


@pytest.fixture(scope="module")
def data():
    r = np.random.default_rng(2)
    n = 20_000
    x = pd.DataFrame({"a": r.normal(3, 2, n), "b": r.exponential(1, n), "c": r.integers(-5, 6, n).astype(float), "part": r.integers(0, 7, n)})
    x["d"] = x["a"] * 2 + r.normal(0, 1, n)
    x["one"] = 4.0
    x["none"] = None
    x.loc[r.random(n) < 0.2, ["b", "d"]] = None
    x.loc[r.random(n) < 0.1, "a"] = None
    return x


@pytest.fixture(scope="module")
def table(spark, data):
    clean = data.astype(object).where(data.notna(), None)
    return spark.createDataFrame(clean.values.tolist(), "a double, b double, c double, part int, d double, one double, none double").repartition(6)


COLUMNS = ["a", "b", "c", "d", "one", "none"]


def near(x, y):
    return (x is None and (y is None or np.isnan(y))) or x == pytest.approx(y, rel=1e-6, abs=1e-9)


def test_profile_in_one_pass_and_merged(spark, table, data):
    whole, parts = profiles.profile(table, COLUMNS), profiles.described(profiles.merged(profiles.sketches(table, COLUMNS, ["part"])))
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ") == 1 and plan.count("Exchange SinglePartition") == 1
    for found in (whole, parts):
        rows = {r["column_name"]: r for r in found.collect()}
        assert set(rows) == set(COLUMNS)
        for c in COLUMNS[:-2]:
            r, x = rows[c], data[c].dropna().astype(float)
            assert (r["n"], r["n_missing"], r["n_zero"], r["n_negative"]) == (len(x), len(data) - len(x), (x == 0).sum(), (x < 0).sum())
            assert near(r["mean"], x.mean()) and near(r["stddev"], x.std()) and (r["lo"], r["hi"]) == (x.min(), x.max())
            assert r["skewness"] == pytest.approx(x.skew(), abs=0.01) and r["kurtosis"] == pytest.approx(x.kurt(), abs=0.05)
            for q in profiles.QUANTILES:
                got = r[f"q{round(q * 100):02d}"]
                assert (x < got).mean() - profiles.rank_error() <= q <= (x <= got).mean() + profiles.rank_error()
            exact, _ = np.histogram(x, profiles.BINS)
            if c != "c":  # whole numbers stand on the edges of bins
                assert np.abs(np.array(r["histogram"]) - exact).max() <= 2 * (profiles.rank_error() + 1 / profiles.GRID) * len(x) + 1
            assert abs(sum(r["histogram"]) - len(x)) <= profiles.BINS
        assert rows["one"]["histogram"] == [len(data)] and rows["one"]["stddev"] == 0 and rows["one"]["skewness"] is None
        assert rows["none"]["n"] == 0 and rows["none"]["mean"] is rows["none"]["q50"] is rows["none"]["histogram"] is None


def test_correlations(spark, table, data, monkeypatch):
    for most in (500, 4):
        monkeypatch.setattr(profiles, "PAIRS", most)
        found = {(r["a"], r["b"]): r for r in profiles.correlations(table, COLUMNS).collect()}
        assert len(found) == 15
        for (a, b), r in found.items():
            x = data[[a, b]].astype(float)
            both = x.dropna()
            assert r["n_both"] == len(both)
            varies = len(both) > 1 and (both.std() > 0).all()
            assert near(r["correlation"], both[a].corr(both[b]) if varies else np.nan)
            nulls = x.isna().astype(float)
            assert near(r["null_correlation"], nulls[a].corr(nulls[b]) if (nulls.std() > 0).all() else np.nan)


def test_not_numbers(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (2.0,), (None,)], "x double")
    r = profiles.profile(df, ["x"]).first()
    assert (r["n"], r["n_missing"], r["mean"], r["hi"]) == (1, 3, 2.0, 2.0)
    r = profiles.profile(df.where(F.lit(False)), ["x"]).first()
    assert r["n"] == 0 and r["mean"] is None and profiles.correlations(df, ["x"]).count() == 0
