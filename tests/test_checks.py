"""Checks that are made by the job that computes the result."""

import uuid

import pytest
from pyspark.sql import functions as F

from annalist.operators import guards, joins
from annalist.operators.checks import Checks, asserted, unique_rows
from annalist.pipeline import Engineer


def jobs(spark, f):
    """The result of f, and how many jobs it started."""
    sc, group = spark.sparkContext, uuid.uuid4().hex
    sc.setJobGroup(group, group)
    try:
        out = f()
        return out, len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setJobGroup("none", "none")


@pytest.fixture
def base(spark):
    return spark.createDataFrame([(1, 2020), (2, 2021), (None, 2021)], "k int, y int")


@pytest.fixture
def table(spark):
    return spark.createDataFrame([("1", 2019, "a", None), ("2.0", 2020, "b", None), ("2", 2019, "c", None)], "key string, year int, v string, w string")


REFS = {"p": ({"k": "key"}, 1), "q": ({"k": "key"}, 0), "r": ({"k": "key"}, 2)}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_all_checks_of_all_references_in_one_job(spark, base, table, tmp_path):
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # which makes a job of each stage
    try:
        checks = Checks()
        out, built = jobs(spark, lambda: joins.lagged_lookups(base, table, REFS, "y", "year", True, checks))
        stored, ran = jobs(spark, lambda: checks.stored(out, f"file://{tmp_path}/o"))
        plain, alone = jobs(spark, lambda: joins.lagged_lookups(base, table, REFS, "y", "year").write.parquet(f"file://{tmp_path}/p"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert built == 0 and ran == alone  # the write, and the broadcasts of the tables
    assert stored.columns == ["k", "y", "p_v_lag1", "r_v_lag2"]
    assert rows(stored) == [(1, 2020, "a", None), (2, 2021, "b", "c"), (None, 2021, None, None)]
    assert rows(joins.lagged_lookups(base, table, REFS, "y", "year", True)) == rows(stored)


def test_broken_conditions_are_errors(spark, base, table, tmp_path):
    twice = table.union(table.limit(1))
    with pytest.raises(Exception, match="not unique on"):
        joins.lagged_lookups(base, twice, REFS, "y", "year").collect()
    checks = Checks()
    out = joins.lagged_lookups(base, twice, REFS, "y", "year", True, checks)
    assert out.count() == 3  # and no row is multiplied
    with pytest.raises(ValueError, match="not unique on"):
        checks.stored(out, f"file://{tmp_path}/o")
    assert not (tmp_path / "o").exists()
    far = spark.createDataFrame([(2021, 2020), (2021, 2019), (2021, None)], "y int, s int")
    checks = Checks()
    with pytest.raises(ValueError, match="linked over") as told:
        checks.stored(checks.watch_ranges(checks.watch_lag(far, "y", "s", 1), {"s": (2020, 2030)}), f"file://{tmp_path}/l")
    assert "out of range: s from 2019 to 2020" in str(told.value)  # all that is broken, at once
    checks = Checks()
    checks.stored(checks.watch_ranges(checks.watch_lag(far.where("s IS NULL OR s = 2020"), "y", "s", 1), {"s": (2020, 2030)}), f"file://{tmp_path}/l")
    with pytest.raises(Exception, match="bad 2019"):
        asserted(far.dropna(), F.col("s") != 2019, F.concat(F.lit("bad "), F.col("s"))).collect()
    assert rows(unique_rows(far, ["s"])) == rows(far.select("s", "y"))
    with pytest.raises(Exception, match="not unique"):
        unique_rows(far.union(far.where("s IS NULL")), ["s"]).collect()


def test_empty_frames(spark, base, table, tmp_path):
    checks = Checks()
    out = joins.lagged_lookups(base.limit(0), table.limit(0), REFS, "y", "year", True, checks)
    assert checks.stored(out, f"file://{tmp_path}/o").columns == ["k", "y"]
    checks = Checks()
    assert checks.stored(checks.watch_empty(base.where("k > 5"), ["k"], wrong=True), f"file://{tmp_path}/e").count() == 0
    with pytest.raises(ValueError, match="empty columns"):
        checks.stored(checks.watch_empty(base.where("k IS NULL"), ["k"], wrong=True), f"file://{tmp_path}/e")


def test_types_are_audited_by_the_job_that_writes(spark, tmp_path):
    df = spark.createDataFrame([("1", "5/6/2018", "yes"), ("x", None, "N/A")], "n string, d string, b string")
    kinds = {"n": "numeric", "d": "datetime", "b": "boolean"}
    checks = Checks()
    (out, found), built = jobs(spark, lambda: guards.typed(df, kinds, checks=checks))
    assert built == 0 and found == []
    stored = checks.stored(out, f"file://{tmp_path}/t")
    assert [(f.column, f.became_null) for f in found] == [("n", 1)] and rows(stored.select("n", "b")) == [(1.0, True), (None, None)]
    checks = Checks()
    bad, _ = guards.typed(df.withColumn("d", F.lit("31/31/2018")), kinds, checks=checks)
    with pytest.raises(ValueError, match="can't be read as datetime"):
        checks.stored(bad, f"file://{tmp_path}/u")
    with pytest.raises(ValueError, match="no numbers"):
        guards.typed(df, kinds, numbers="error")
    with pytest.raises(ValueError, match="single values"):
        guards.typed(df.withColumn("a", F.array("n")), {"a": "numeric"})


def test_the_facade_links_in_one_job(spark, base, table, tmp_path):
    linked = Engineer(base, "k", "y").link(table, REFS, "y", "year", f"file://{tmp_path}/f")
    assert linked.df.columns == ["k", "y", "p_v_lag1", "r_v_lag2"]
    with pytest.raises(ValueError, match="not unique"):
        Engineer(base, "k", "y").link(table.union(table), REFS, "y", "year", f"file://{tmp_path}/g")
