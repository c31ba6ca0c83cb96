"""Merging that follows what has changed, and how many jobs that takes."""

import uuid

import pytest
from pyspark.sql import functions as F

from annalist.catalog import SchemaCatalog
from annalist.operators import joins, merging
from annalist.pipeline import Curator, Orchestrator, SourceFile
from annalist.sources.store import Store


def jobs(spark, f):
    sc, group = spark.sparkContext, uuid.uuid4().hex
    sc.setJobGroup(group, group)
    try:
        out = f()
        return out, len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setJobGroup("none", "none")


def exchanges(df):
    return df.select("*")._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def rows(df):
    return sorted((str(sorted(r.asDict().items(), key=str)) for r in df.collect()))


FILES = {
    "census_18.csv": ("census", "2018-2019", 9, "Stud ID,Gender\ns,M\nt,F\n"),
    "att_18.csv": ("att", "2018-2019", 9, "Stud ID,Sessions\ns,10\nu,20\n"),
    "census_19.csv": ("census", "2019-2020", 9, "Stud ID,Gender\nv,M\nw,F\n"),
    "att_19.csv": ("att", "2019-2020", 9, "Stud ID,Sessions\nv,30\n"),
    "census_17.csv": ("census", "2017-2018", 11, "Stud ID,Gender\ns,M\nx,F\n"),
    "ks4_17.csv": ("ks4", "2017-2018", 11, "Stud ID,Score\ns,50\nx,60\n"),
    "unused.csv": ("~old", "2018-2019", 9, "Stud ID\nq\n"),
}


def inventory(folder):
    for name, (*_, text) in FILES.items():
        (folder / name).write_text(text)
    return [SourceFile(f"file://{folder}/{n}", c, k, g) for n, (c, k, g, _) in FILES.items()]


def orchestrator(spark, folder, store, **options):
    facts = folder / "later.parquet"
    if not facts.exists():
        spark.createDataFrame([("s", 15, 1, "A"), ("s", 15, 2, "B"), ("s", 16, 1, "C"), ("s", 16, 2, "D"), ("x", 16, 2, "E")], "stud_id string, age int, half int, code string").write.parquet(f"file://{facts}")
    catalog = SchemaCatalog({"census": {"gender": "category"}, "att": {"sessions": "Int64"}, "ks4": {"score": "Int64"}})
    return Orchestrator(Curator(spark, "stud_id", catalog), Store(spark, f"file://{store}"), f"file://{facts}", {"age": "age", "half": "half", "target": "code"}, **options)


def test_only_what_changed_is_made_again(spark, tmp_path):
    listed = inventory(tmp_path)
    first = orchestrator(spark, tmp_path, tmp_path / "store")
    out = [rows(df) for df in first.run(listed)]
    assert {n.split("/")[0] for n in first.store.made} == {"curated", "cohort", "longitudinal"} and len([n for n in first.store.made if n.startswith("cohort")]) == 3
    again = orchestrator(spark, tmp_path, tmp_path / "store")
    frames, n = jobs(spark, lambda: again.run(listed))
    assert n == 0 and again.store.made == [] and [rows(df) for df in frames] == out
    (tmp_path / "att_19.csv").write_text("Stud ID,Sessions\nv,31\nw,5\n")
    changed = orchestrator(spark, tmp_path, tmp_path / "store")
    new = [rows(df) for df in changed.run(listed)]
    assert sorted(n.split("/")[0] for n in changed.store.made) == ["cohort", "curated", "longitudinal"] and "cohort/2019-2020-9" in changed.store.made
    full = orchestrator(spark, tmp_path, tmp_path / "other")
    assert [rows(df) for df in full.run(listed)] == new != out
    assert changed.store.tidy() > 0 and changed.store.tidy() == 0 and [rows(df) for df in changed.run(listed)] == new
    options = orchestrator(spark, tmp_path, tmp_path / "store", merge={"check": False})
    assert [rows(df) for df in options.run(listed)] == new and sum(n.startswith("cohort") for n in options.store.made) == 3 and not any(n.startswith("curated") for n in options.store.made)


def test_a_lost_run_leaves_nothing_that_counts(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s")
    with pytest.raises(ZeroDivisionError):
        store.tables("x", [1], lambda stamp: {"": store.write("x", spark.range(3), stamp), "y": 1 / 0})
    assert store.table("x", [1], lambda: spark.range(5)).read(spark).count() == 5 and store.made == ["x"]
    with pytest.raises(ValueError, match="several files"):
        o = orchestrator(spark, tmp_path, tmp_path / "t")
        (tmp_path / "a.csv").write_text("Stud ID,Gender\ns,M\n")
        o.run([SourceFile(f"file://{tmp_path}/a.csv", "census", "2018-2019", 9)] * 2)


def test_a_merge_is_written_once(spark):
    n = 200
    sources = {
        "census": spark.range(n).select(F.col("id").cast("string").alias("id"), F.lit("M").alias("census_gender")),
        "att": spark.range(n).select(F.col("id").cast("string").alias("id"), (F.col("id") * 2).alias("att_n")),
        "ks4": spark.range(n).select(F.col("id").cast("string").alias("id"), F.col("id").alias("ks4_score")),
    }
    facts = spark.range(4 * n).select((F.col("id") % n).cast("string").alias("id"), (15 + F.floor(F.col("id") / n / 2)).cast("int").alias("age"), (1 + F.floor(F.col("id") / n) % 2).cast("int").alias("half"), F.col("id").cast("string").alias("code"))
    parts, started = jobs(spark, lambda: merging.merge_cohort(11, sources, merging.Destinations(facts, "age", "half", "code"), merging.MergeOptions("id")))
    assert started <= 30 and [(m.year_group, m.age, m.df.count()) for m in parts] == [(11, 15, n), (11, 15, 2 * n)]
    for m in parts:
        plan = m.df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "Exchange" not in plan
    with pytest.raises(ValueError, match="lost values of b"):
        merging.require_preserved({"a": sources["att"], "b": sources["ks4"]}, parts[0].df, "id")
    merging.require_preserved(sources, parts[1].df, "id", ("age", [15]))
    with pytest.raises(ValueError, match="lost values of census"):
        merging.require_preserved({"census": sources["census"]}, parts[1].df, "id", ("age", [15, 16]))


def test_outer_joins_take_one_exchange(spark):
    a = spark.createDataFrame([(1, "a", None), (1, "b", 2), (None, "n", 3)], "k int, x string, v int")
    b = spark.createDataFrame([(1, 7, 8), (2, 9, 9), (None, 5, 6), (None, 6, 6)], "k int, v int, w int")
    c = spark.createDataFrame([(1, "c"), (3, "d")], "k int, z string")
    out = joins.outer_coalesce([a, b, c], ["k"])
    step = joins.null_safe_join(joins.null_safe_join(a, b, ["k"], "full"), c, ["k"], "full")
    want = step.select("k", "x", F.coalesce("v", "v_dup").alias("v"), "w", "z")
    assert out.columns == want.columns and rows(out) == rows(want) and len(rows(out)) == 6
    assert exchanges(out) == 1


def test_keyless_rows_do_not_meet(spark):
    from annalist.operators import references

    none = [(None, f"x{k}") for k in range(300)]
    a, b = spark.createDataFrame([("1", "a"), *none], "urn string, p string"), spark.createDataFrame([("1", "b"), *none], "urn string, q string")
    c = spark.createDataFrame([("1", "7", "c"), (None, "7", "d")], "urn string, estab_no string, r string")
    joined = references._joined([a, b], ["urn", "estab_no"], 2020)
    assert rows(joined) == rows(spark.createDataFrame([("1", "a", "b")], "urn string, p string, q string"))
    assert exchanges(joined) == 1
    out = references.school_year([a, b, c, c], ["urn", "estab_no"], 2020)
    assert out.count() == 2  # a number counts as a key once the files before have one
