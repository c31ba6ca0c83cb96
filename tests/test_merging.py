"""Merging, guarded types, metadata, reports and composites on small fixtures."""

import random

import pytest
from pyspark.sql import functions as F

from annalist import config
from annalist.functions import classify, codes, coerce
from annalist.operators import aggregate, clean, derive, guards, history, joins, merging, profile, resolve, schemas
from annalist.sources import files, inventory, manifest


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_dates_in_many_forms(spark):
    forms = {
        "2018/03/05": "2018-03-05", "05-Mar-2018": "2018-03-05", "March 5, 2018": "2018-03-05", "5.3.2018": "2018-05-03", "Apr 2003": "2003-04-01", "2024-01": "2024-01-01",
        "04/01/2022": "2022-01-04", "13/1/2020": "2020-01-13", "Aug-00": "2000-08-01", "Aug-99": "1999-08-01", "2018-09-01T00:00:00.000Z": "2018-09-01", "2018-09-01 00:00:00": "2018-09-01",
        "20180901": "2018-09-01", "2019": "2019-01-01", "1st September 2018": "2018-09-01", "5 Mar 18": "2018-03-05", "\t2018-3-5\n": "2018-03-05", "March 5 18": "2018-03-05", "Feb/29/2019": None, "29 February 2020": "2020-02-29", "0000": None, "31-31-2018": None, "Thursday": None, "StudID": None, "": None,
    }
    got = {r["t"]: r["d"] for r in frame(spark, [(f,) for f in forms], "t string").select("t", coerce.date(F.col("t")).alias("d")).collect()}
    assert {k: str(v) if v else None for k, v in got.items()} == forms


def test_white_space_of_all_kinds(spark):
    df = frame(spark, [(1, "A", "A\t"), (1, " A　", "\nB ")], "k int, x string, y string")
    assert rows(aggregate.collapse(df, ["k"], ["x", "y"], "v")) == [(1, ["A", "B"])]
    assert rows(df.select(clean.substantive(F.lit("\tREFUSED\n"), derive.ETHNICITY_FILLERS))) == [(False,), (False,)]


def test_guarded_types(spark):
    df = frame(spark, [("1", "5/6/2018", "yes", " a b ", "1.0"), ("2.5", None, "N/A", "7", "2"), (None, " ", None, "nan", "")], "n string, d string, b string, c string, k string")
    kinds = {"n": "Int64", "d": "datetime", "b": "boolean", "c": "category", "k": "category"}
    out, found = guards.typed(df, kinds)
    assert found == [] and dict(out.dtypes)["n"] == "double"
    assert rows(out, "n", "c", "k") == [(1.0, "A B", "1"), (2.5, "7", "2"), (None, None, None)]
    for column, value, kind in (("d", "31/31/2018", "datetime"), ("d", "1970-05-05", "datetime"), ("b", "maybe", "boolean")):
        with pytest.raises(ValueError, match=column):
            guards.typed(df.withColumn(column, F.lit(value)), {column: kind})
    out, found = guards.typed(df.withColumn("n", F.lit("x")), {"n": "numeric", "d": "datetime"})
    assert [(f.column, f.became_null) for f in found] == [("n", 3)]
    assert guards.typed(df.withColumn("d", F.lit("StudID")), {"d": "datetime"})[1][0].unreadable == 0


def test_rows_of_null_keys_are_not_multiplied(spark):
    df = frame(spark, [(None, 1, "a", 1.0), (None, 1, "b", 2.0), ("s", 1, "a", None), ("s", 1, None, 3.0), ("t", 1, "x", 1.0), ("t", 1, "y", 1.0)], "id string, t int, u string, v double")
    rules = [resolve.Rule("complete", ["u"], [F.col("u")]), resolve.Rule("complete", ["v"], [F.col("v")])]
    out = resolve.verified(resolve.resolve(df, "id", ["id", "t"], rules), ["id", "t"])
    assert rows(out) == sorted([(None, 1, "a", 1.0), (None, 1, "b", 2.0), ("s", 1, "a", 3.0), ("t", 1, "x", 1.0)], key=str)
    with pytest.raises(ValueError):
        resolve.verified(df, ["id", "t"])


def test_lookups_do_not_multiply_rows(spark):
    df, twice = frame(spark, [(1,)], "k int"), frame(spark, [(" 1", 2020, "a", None), ("1.0", 2020, "b", None)], "key string, year int, v string, w string")
    with pytest.raises(Exception, match="not unique"):
        joins.lookup(df, twice, [F.col("k")], [F.col("key")], {"v": "v"}).collect()
    out = joins.lagged_lookup(df.withColumn("y", F.lit(2021)), twice.limit(1), {"k": "key"}, "y", "year", 1, "p", drop_empty=True)
    assert rows(out) == [(1, 2021, "a")] and out.columns == ["k", "y", "p_v_lag1"]
    far = frame(spark, [(2021, 2020), (2021, 2019), (2021, None)], "y int, s int")
    assert rows(joins.year_differences(far, "y", "s")) == [(1, 1), (2, 1)]
    with pytest.raises(ValueError):
        joins.require_lag(far, "y", "s", 1)


def test_fingerprints_tell_rows_apart(spark):
    one = lambda *r: (lambda df: df.agg(profile.fingerprint(df, ["a", "b"]).alias("f")).first()["f"])(frame(spark, [r], "a string, b string"))
    assert len({one("a|b", "c"), one("a", "b|c"), one(None, "~"), one("~", None), one("~", "~"), one("-", ""), one(None, "")}) == 7


def test_environment_values_have_types():
    env = {"ANNALIST_DATASET__YEAR_RANGE": "2018-2022", "ANNALIST_CLEAN__DROP_DUPLICATES": "false", "ANNALIST_CLEAN__NULL_THRESHOLD": "0.9", "ANNALIST_PATHS__ROOT": "2018-2022"}
    c = config.Config.load(environ=env)
    assert c.dataset().endswith("/2018-2022.parquet") and c.values["clean"] == {"drop_duplicates": False, "null_threshold": 0.9} and c.path("root") == "2018-2022"
    with pytest.raises(ValueError):
        config.Config.load(environ={"ANNALIST_CLEAN__DROP_DUPLICATES": "perhaps"})


def plain_history(lists):
    counts, out = {}, []
    for own in lists:
        own = sorted({v.strip() for v in own or [] if v and v.strip()})
        for v in own:
            counts[v] = counts.get(v, 0) + 1
        if not own:
            out.append((None, None, None, None))
            continue
        top = max(counts.values())
        best = sorted(v for v, n in counts.items() if n == top)
        main = own[0] if len(best) > 1 and len(own) == 1 else best[0]
        out.append((sorted(counts), len(counts), main, counts[main]))
    return out


def test_histories_by_brute_force(spark):
    rng = random.Random(4)
    data = {i: [rng.choice([None, [], [" a"], [" "], rng.choices("abcd", k=3), [rng.choice("abc")]]) for _ in range(rng.randint(1, 12))] for i in range(30)}
    df = frame(spark, [(i, t, v, "old") for i, vs in data.items() for t, v in enumerate(vs)], "id int, t int, v array<string>, x_hist string")
    out = history.cumulative(df, "id", ["t"], "v", "x_")
    assert out.columns == ["id", "t", "v", "x_hist", "x_n_uniq", "x_main", "x_main_n"]
    got = {(r["id"], r["t"]): (r["x_hist"], r["x_n_uniq"], r["x_main"], r["x_main_n"]) for r in out.collect()}
    assert got == {(i, t): w for i, vs in data.items() for t, w in enumerate(plain_history(vs))}
    plan = history.cumulative(df, "id", ["t"], "v", "x_")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_classifier_compiles(spark):
    spark.conf.set("spark.sql.codegen.fallback", "false")
    spark.conf.set("spark.sql.codegen.factoryMode", "CODEGEN_ONLY")
    try:
        df = spark.range(50).select(F.concat(F.lit("Academy_sponsor-led "), F.col("id").cast("string")).alias("t"))
        assert {r[0] for r in df.select(classify.classify(F.col("t"), classify.SCHOOL_TYPES)).collect()} == {"Academy - Sponsor Led"}
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")
        spark.conf.unset("spark.sql.codegen.factoryMode")


def test_column_groups():
    a, b, c, d = {1, 2, 3, 4}, {1, 2}, {1, 2, 3, 5}, {9}
    assert merging.column_groups([a, b, c, d]) == [[0], [1], [2], [3]]
    assert merging.column_groups([a, b, c, d], 0.6) == [[0, 2], [1], [3]]
    assert merging.column_groups([a, b, c, d], strategy="flexible") == [[0, 1, 2], [3]]
    assert merging.column_groups([a, b, d], subset=0.6, strategy="balanced") == [[0], [1], [2]]
    assert merging.column_groups([a, b, d], subset=0.5, strategy="balanced") == [[0, 1], [2]]
    with pytest.raises(ValueError):
        merging.column_groups([a], strategy="loose")


def cohort(spark):
    census = frame(spark, [("s", "M"), ("t", "F")], "id string, census_gender string")
    ks4 = frame(spark, [("s", 50.0, "M"), ("u", 40.0, "F")], "id string, ks4_score double, ks4_gender string")
    facts = frame(spark, [("s", 15, 1, "A", 1), ("s", 15, 2, "B", 2), ("s", 16, 1, "C", 3), ("s", 16, 2, "D", 4), ("t", 16, 2, "E", 5), ("s", 17, 2, "F", 6), ("x", 15, 1, "G", 7)], "id string, age int, half int, code string, n int")
    return {"ks4": ks4, "census": census}, merging.Destinations(facts, "age", "half", "code")


def test_cohort_before_the_final_year(spark):
    sources, dest = cohort(spark)
    (m,) = merging.merge_cohort(9, sources, dest, merging.MergeOptions("id"))
    assert (m.year_group, m.age, m.df.columns) == (9, 13, ["id", "census_gender", "code"]) and rows(m.df) == [("s", "M", "D"), ("t", "F", "E")]
    alone = merging.merge_cohort(9, {"ks4": sources["ks4"]}, None, merging.MergeOptions("id"))
    assert rows(alone[0].df) == [("s", 50.0), ("u", 40.0)]


def test_cohort_in_the_final_year(spark):
    sources, dest = cohort(spark)
    school, *later = merging.merge_cohort(11, sources, dest, merging.MergeOptions("id"))
    assert rows(school.df, "id", "code") == [("s", "D"), ("t", "E")] and "ks4_score" not in school.df.columns
    assert [(m.year_group, m.age) for m in later] == [(11, 15), (12, 16)]
    assert rows(later[0].df, "id", "_phase", "code_latest", "code", "ks4_score") == sorted([("s", "pre", "A", "B", 50.0), ("t", "pre", None, None, None), ("u", "pre", None, None, 40.0), ("s", "post", "B", "C", 50.0), ("t", "post", None, None, None), ("u", "post", None, None, 40.0)], key=str)
    assert "ks4_gender" not in later[0].df.columns and later[0].df.columns[0] == "id" and later[0].df.columns[-1] == "_phase"


def test_merges_that_lose_values(spark):
    source = frame(spark, [("s", "a"), ("t", None)], "id string, v string")
    merging.require_preserved({"x": source}, frame(spark, [("s", "a", 1), ("t", "", 1)], "id string, v string, w int"), "id")
    with pytest.raises(ValueError, match="lost values of x"):
        merging.require_preserved({"x": source}, frame(spark, [("s", "b"), ("t", None)], "id string, v string"), "id")
    with pytest.raises(ValueError, match="empty columns"):
        merging.require_clean(source.withColumn("e", F.lit(None).cast("string")))
    with pytest.raises(ValueError, match="twice"):
        merging.require_clean(source.union(source))


def test_longitudinal_groups(spark):
    a = frame(spark, [("s", 1)], "id string, x int")
    b = frame(spark, [("t", 2), ("t", 2)], "id string, x int")
    c = frame(spark, [("u", 3)], "id string, other int")
    out = merging.merge_all([("2019-2020", 8, b), ("2018-2019", 7, a), ("2018-2019", 9, c)], check=True, order="id")
    assert [df.columns for df in out] == [["id", "x", "_cohort", "_year_group", "_acad_year"], ["id", "other", "_cohort", "_year_group", "_acad_year"]]
    assert [tuple(r) for r in out[0].collect()] == [("s", 1, "2018-2019", "7", "2014-2015"), ("t", 2, "2019-2020", "8", "2016-2017")]
    assert len(merging.merge_all([("2018-2019", 7, a), ("2018-2019", 9, c)], strategy=None)) == 1


def test_early_and_undated_files(spark):
    inv = frame(spark, [("ks2", 6, "Y6 2012 - 2013"), ("census", 7, "Y7 2013 - 2014")], "category string, year_group int, label string")
    out = merging.expand_early(inv, groups=(7, 8))
    assert rows(out) == [("census", 7, "Y7 2013 - 2014"), ("ks2", 7, "Y7 2013 - 2014"), ("ks2", 8, "Y8 2014 - 2015")]
    one = frame(spark, [("s", "A & B", None)], "id string, v string, e string")
    assert rows(merging.stack_records([("2024 Mar", one), ("2023 Sep", one)])) == [("s", "A and B", "2023 Sep"), ("s", "A and B", "2024 Mar")]
    with pytest.raises(ValueError):
        merging.stack_records([("2018 - 2019", one)])


def test_best_key_by_names(spark):
    assert joins.school_columns(["att_estab", "ks2_School", "school_age", "x"]) == ["att_estab", "ks2_School"]
    a = frame(spark, [("s", "The Hill", 1), ("s", "Vale", 2)], "id string, att_school string, n int")
    b = frame(spark, [("s", "hill", "q", 10), ("s", "vale", "q", 20)], "id string, ks2_estab string, ks2_school string, m int")
    assert rows(joins.best_key_join(a, b, "id"), "n", "m") == [(1, 10), (2, 20)]


def test_equivalent_columns_by_prefix(spark):
    df = frame(spark, [(1, "a", "a", "p", None, "x", "y"), (2, None, None, None, "q", "x", "z")], "i int, k_u string, l_u string, k_v string, l_v string, k_w string, l_w string")
    out, bad = aggregate.merge_by_prefix(df, ["k", "l"], ("i",))
    assert "l_u" not in out.columns and rows(out, "k_u", "v") == [("a", "p"), (None, "q")] and bad == ["w"]


def test_incompatible_rows_in_order(spark):
    df = frame(spark, [("s", 1, "a", None), ("s", 2, "b", None), ("s", 3, None, "c"), ("s", 4, "b", "d"), (None, 1, "a", "a")], "id string, o int, x string, y string")
    assert rows(aggregate.merge_compatible_rows(df, "id", ["o"])) == [("s", 1, "a", "c"), ("s", 2, "b", "d")]


def test_metadata_and_types(spark):
    a, b = frame(spark, [("1", "x"), ("0", None)], "flag string, k_name string"), frame(spark, [(5, "y")], "flag int, extra string")
    told = schemas.require_described_once(schemas.column_metadata([("c", "a", a), ("c", "b", b)]))
    assert rows(told, "column_name", "dtype", "dtypes", "n_unique", "samples", "files") == [("extra", "string", "string", 1, "y", "b"), ("flag", "string", "int, string", 3, "0|1|5", "a, b"), ("k_name", "string", "string", 1, "x", "a")]
    with pytest.raises(ValueError):
        schemas.require_described_once(told.union(told))
    text = told.withColumn("values_text", F.when(F.col("column_name") == "flag", "0 = No, 1 = Yes"))
    assert rows(schemas.curated_dtypes(text, {"category": ["name"]}, ["k"]), "column_name", "curated", "changed") == [("extra", "string", False), ("flag", "boolean", True), ("k_name", "category", True)]
    with pytest.raises(ValueError, match="several types"):
        schemas.curated_dtypes(text, {"category": ["flag"]})
    assert rows(frame(spark, [("No.", "no", "No!"), (None, " ", "")], "a string, b string, c string").select(schemas.joined_texts(["a", "b", "c"]))) == [("No\nno",), (None,)]
    assert schemas.difference("a\nb", "a\nc") == "- b\n+ c"
    assert rows(schemas.sample_differences(frame(spark, [(["a", "b"],), (["a"],)], "v array<string>"), "v"), "difference") == [("- a\n+ b",), (None,)]


def test_drift_of_files(spark):
    s = frame(spark, [("c", f"f{i}", x) for i in range(5) for x in (["score", "rate_%"] if i else ["scores", "rate"])], "category string, file string, column_name string")
    assert rows(schemas.drift(s)) == sorted([("c", "f0", "score", "missing", "scores", 10 / 11), ("c", "f0", "rate_%", "missing", None, None), ("c", "f0", "scores", "extra", "score", 10 / 11), ("c", "f0", "rate", "extra", None, None)], key=str)
    a = frame(spark, [(1, "x"), (2, "y")], "k int, v string")
    assert schemas.duplicate_files({"a": a, "b": a.orderBy(F.desc("k")), "c": a.limit(1)}) == [["a", "b"]]


def test_files_cleaned_as_one_job(spark):
    a, b = frame(spark, [("s", "x", None), ("s", "x", None), (None, "y", None)], "id string, v string, e string"), frame(spark, [("t", 1)], "id string, w int")
    kept, bad, told = clean.clean_files({"a": a, "b": b}, clean.CleanOptions("id"))
    assert rows(kept, "id", "v", "w", "_file") == [("s", "x", None, "a"), ("t", None, 1, "b")] and rows(bad, "reject_reason", "_file") == [("duplicate", "a"), ("null_id", "a")]
    assert rows(told, "_file", "column_name", "n_values") == [("a", "id", 1), ("a", "v", 1), ("b", "id", 1), ("b", "w", 1)]
    assert clean.matching_columns(["id", "ks2_a", "ks2_age", "x"], ["KS2"], ["age"]) == ["ks2_a"] and clean.matching_columns(["a", "b", "c"], first="b") == ["b", "c"]
    assert rows(clean.identical_columns(frame(spark, [(1, "a", "a", "b")], "k int, z string, y string, x string"), ["k"])) == [("z", "y")]


def test_quoted_lines_and_repeated_headers(spark, tmp_path):
    (tmp_path / "q.csv").write_text('a title,\nURN,Name\n1,"Hill\nSchool"\nURN,Name\n2,"say ""hi"""\n')
    assert rows(files.load_columns(spark, f"file://{tmp_path}/q.csv", {"Name": "name", "URN": "urn"})) == [("1", "Hill\nSchool"), ("2", 'say "hi"'), ("URN", "Name")]
    raw = frame(spark, [("WBRI", "White British", "W", "White", "Mixed/Duel Background", "z"), (None, None, None, None, None, "z")], "`DfE Extended Code` string, `Approved Extended Categories` string, `DfE Main Code` string, `Main Category` string, `Sub- Category` string, other string")
    assert rows(files.ethnicity_table(raw)) == [("WBRI", "White British", "W", "White", "Mixed/Dual Background")]


def test_backups_and_reports(spark, tmp_path):
    path, df = f"file://{tmp_path}/t.parquet", frame(spark, [("s", "a"), ("s", "b"), ("t", "c")], "id string, v string")
    assert manifest.compare_and_backup(df, path, "1") and not manifest.compare_and_backup(df, path, "2")
    assert manifest.compare_and_backup(df.limit(1), path, "3") and spark.read.parquet(path).count() == 1
    assert spark.read.parquet(f"file://{tmp_path}/backup_3_t.parquet").count() == 3
    text, ids = manifest.conflict_report(df, ["id"], ["v"], "id")
    assert text == "conflicting_entities: 1\nexamples: [s]\ncolumns:\n  v: 1\n" and rows(ids) == [("s",)]
    status = frame(spark, [("a.csv", 1.0), ("b.log", 1.0)], "name string, mtime double")
    assert manifest.load_status(spark, f"file://{tmp_path}/none").count() == 0
    manifest.save_status(status, f"file://{tmp_path}/status")
    now = frame(spark, [("a.csv", 9.0), ("c.log", 1.0)], "name string, mtime double")
    assert rows(manifest.changes(manifest.load_status(spark, f"file://{tmp_path}/status"), now, ignore=(".log",))) == [("a.csv", "modified")]


def test_inventory_grows(spark):
    known = frame(spark, [("a.csv", "s", "edited")], "file_name string, sheet_name string, category string")
    out = inventory.extended(known, frame(spark, [("a.csv", "s"), ("census 2018_19.csv", "Y7 (2018_19)")], "file_name string, sheet_name string"), [inventory.CategoryRule("census", ["census"])])
    assert rows(out, "file_name", "category") == [("a.csv", "edited"), ("census 2018_19.csv", "census")]
    counted = inventory.with_row_counts(out, {"a.csv": known})
    assert rows(counted, "file_name", "n_rows") == [("a.csv", 1), ("census 2018_19.csv", None)]
    assert rows(inventory.from_names(frame(spark, [("ks2_2018-2019_Y7.parquet",)], "file_name string"), ["category", "cohort", "year_group"])) == [("ks2_2018-2019_Y7.parquet", "ks2", "2018-2019", 7)]


def test_coverage_rules(spark):
    df = frame(spark, [(7, "c1", "a"), (7, "c2", "~a"), (7, "c2", "EXCLUDE"), (7, "c2", "b"), (8, "c1", "a")], "g int, c string, k string")
    assert rows(profile.missing_categories(df, ["g"], "c", "k")) == [(7, "c1", "b"), (7, "c2", "a")]
    assert rows(profile.missing_groups(df, "c", "g")) == [("c2", 8)]
    with pytest.raises(ValueError):
        profile.require_one_cohort(df, "g", "c")


def test_feature_facade(spark):
    table = frame(spark, [("WBRI", "White British", "White", "W", "White"), ("BCRB", "Caribbean", "Black", "B", "Black")], "extended_code string, extended_category string, sub_category string, main_code string, main_category string")
    assert len(derive.level_maps(table)) == 16
    with pytest.raises(ValueError):
        derive.level_maps(table.union(frame(spark, [("WBRI", "Other", "White", "W", "White")], table.schema)))
    df = frame(spark, [("s", 1, "wbri", "M", "cy", "en"), ("s", 2, "B", "M", "va", "missing"), ("t", 1, " Missing", "F", None, "fr"), ("t", 2, None, "F", "cy", "fr")], "id string, t int, e string, g string, k string, l string")
    steps = {"ethnicity": {"column": "e", "table": table}, "gender": {"column": "g"}, "school": {"attributes": {"kind": ["k"]}, "type_columns": ["k"], "threshold": 1}, "language": {"column": "l"}}
    out, reports = derive.derive_features(df, "id", "t", steps)
    got = {(r["id"], r["t"]): r for r in out.collect()}
    assert sorted(got) == [("s", 1), ("s", 2), ("t", 2)]
    assert [got["s", 2][c] for c in ("der_ethnicity_main_cat", "der_ethnicity_n_values", "der_ethnicity_has_conflict", "der_ethnicity_main", "der_gender_curated", "k", "der_sch_kind_n_uniq")] == ["Black", 2, True, "Black", "M", "Voluntary Aided School", 2]
    assert got["s", 2]["der_language_n_uniq"] is None and got["s", 1]["der_language_main"] == "en"
    assert rows(reports["school_types"]) == [("cy", "Community School", True), ("va", "Voluntary Aided School", True)] and rows(reports["several_schools"], "id") == [("s",)]
    again, _ = derive.derive_features(out, "id", "t", steps)
    assert again.columns == out.columns


def test_code_tables(spark):
    got = rows(frame(spark, [(260,), (550,), (540,), (999,)], "c int").select("c", codes.activity_level(F.col("c"))))
    assert got == [(260, "Education"), (540, "NEET"), (550, "Employment"), (999, None)]
    assert set(codes.ACTIVITY_LEVELS) == set(codes.ACTIVITY) and len(codes.CHARACTERISTICS) == 11


def test_deprivation_by_two_hops(spark):
    from annalist.operators import references

    columns = ["LSOA", "Crime Score", "Odd Score (x)", "IMD Decile", "IDACI Score", "name"]
    assert references.score_columns(columns, "Decile", "d_") == {"Crime Score": "d_crime_score", "Odd Score (x)": "d_odd_score_x", "IMD Decile": "d_imd_decile"}
    df = frame(spark, [("ab1 2cd",), ("ZZ99 9ZZ",), (None,)], "pc string")
    areas = frame(spark, [("AB12CD", "E1", 1), ("AB1 2CD", "E2", 2)], "pcds string, lsoa string, row int")
    scores = frame(spark, [("E1", 1.0, 5), ("E2", 2.0, 6)], "code string, `Crime Score` double, `IMD Decile` int")
    out = references.with_deprivation(df, "pc", areas, scores, "pcds", "lsoa", "code", "Decile", ["row"])
    assert rows(out) == sorted([("ab1 2cd", 2.0, 6), ("ZZ99 9ZZ", None, None), (None, None, None)], key=str)


def test_schools_of_several_years(spark):
    from annalist.operators import references

    a = frame(spark, [("1", "Hill", "50%", None), (None, "none", "1%", None)], "urn string, name string, fsm_pct string, late_rate string")
    b = frame(spark, [("1.0", "other", "2", "30"), ("2", "Vale", "4", "40")], "urn string, name string, ofsted_rating string, late_rate string")
    c = frame(spark, [("1", "Hill")], "urn string, name string")
    out = references.school_table({2019: [c], 2018: [a, b]})
    assert rows(out.where("acad_end_year = '2018'"), "urn", "name") == [(1.0, "Hill"), (2.0, "Vale")] and rows(out.where("acad_end_year = '2019'"), "urn", "name") == [(1.0, "Hill")]
    one = references.school_year([a, b], ["urn", "estab_no"], 2018)
    assert rows(one, "urn", "name", "fsm_pct", "late_rate", "ofsted_rating") == [(1.0, "Hill", 50.0, 0.3, "Good"), (2.0, "Vale", None, 0.4, "Inadequate")]
    with pytest.raises(ValueError, match="out of range"):
        references.school_year([a.withColumn("fsm_pct", F.lit("150%"))], ["urn"], 2018)
    with pytest.raises(ValueError, match="in common"):
        references.school_year([a, b.drop("urn")], ["urn"], 2018)
