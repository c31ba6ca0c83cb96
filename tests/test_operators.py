"""Operators on small frames: null keys, orders, ties, and the invariants of each step."""

import random

import pytest
from pyspark.sql import functions as F

from annalist.operators import aggregate, clean, derive, history, joins, profile, resolve
from annalist.sources import files, manifest


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=str)


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_null_keys_match(spark):
    a, b = frame(spark, [(1, "x"), (None, "y")], "k int, v string"), frame(spark, [(None, "p"), (2, "q")], "k int, v string")
    assert rows(joins.null_safe_join(a, b, ["k"])) == sorted([(1, "x", None), (None, "y", "p")], key=str)
    assert rows(joins.null_safe_join(a, b, ["k"], "full")) == sorted([(1, "x", None), (None, "y", "p"), (2, None, "q")], key=str)
    assert rows(joins.null_safe_join(a, b, ["k"], "left_anti")) == [(1, "x")]


def test_lagged_lookup(spark):
    table = frame(spark, [("100", 2020, 5), ("100", 2021, 6)], "urn string, year int, size int")
    df = frame(spark, [(" 100.0", 2021), ("100", 2023), (None, 2021)], "urn string, y int")
    out = joins.lagged_lookup(df, table, {"urn": "urn"}, "y", "year", 1, "att")
    assert rows(out) == sorted([(" 100.0", 2021, 5), ("100", 2023, None), (None, 2021, None)], key=str)
    with pytest.raises(ValueError):
        joins.require_unique(frame(spark, [(1,), (1,)], "k int"), ["k"])


def test_two_hops_and_last_wins(spark):
    areas = frame(spark, [("AB1", "L1", 1), ("AB1", "L2", 2)], "postcode string, area string, o int")
    scores = frame(spark, [("L2", 7.5, 1)], "area string, score double, o int")
    from annalist.functions.coerce import postcode

    out = joins.two_hop(frame(spark, [("ab 1",), ("zz",)], "p string"), areas, scores, postcode(F.col("p")), "postcode", "area", "area", {"score": "score"}, ["o"])
    assert rows(out) == [("ab 1", 7.5), ("zz", None)]


def test_best_key(spark):
    left = frame(spark, [(1, "The Hill"), (1, "Vale"), (2, "x")], "id int, school string")
    right = frame(spark, [(1, "hill", "h"), (1, "vale", "v"), (3, "w", "w")], "id int, estab string, d string")
    out = joins.best_key_join(left, right, "id", ["school"], ["d", "estab"])
    assert rows(out, "id", "school", "d") == sorted([(1, "The Hill", "h"), (1, "Vale", "v"), (2, "x", None), (3, None, "w")], key=str)
    unique = frame(spark, [(1, "u")], "id int, e string")
    assert rows(joins.best_key_join(left, unique, "id", [], [])) == sorted([(1, "The Hill", "u"), (1, "Vale", None), (2, "x", None)], key=str)
    with pytest.raises(ValueError):
        joins.best_key_join(left, frame(spark, [(1, 1), (1, 2)], "id int, e int"), "id", [], [])


def test_outer_coalesce_and_lost_rows(spark):
    a, b = frame(spark, [(1, None), (2, "a")], "k int, v string"), frame(spark, [(1, "b"), (3, "c")], "k int, v string")
    assert rows(joins.outer_coalesce([a, b], ["k"])) == [(1, "b"), (2, "a"), (3, "c")]
    assert rows(joins.lost_rows(a, a.where("k = 2"))) == [("1", None)]


def test_compatible_rows(spark):
    def merged(data):
        df = frame(spark, [(1, i, *d) for i, d in enumerate(data)], "id int, o int, p string, q string")
        return [tuple(r) for r in aggregate.merge_compatible_rows(df, "id", ["o"]).orderBy("o").select("p", "q").collect()]

    assert merged([("a", None), (None, "x"), ("b", None), ("a", "y")]) == [("a", "x"), ("b", None), ("a", "y")]
    assert merged([("a", None), ("a", "y"), (None, "x"), ("b", None)]) == [("a", "y"), ("b", "x")]
    empty = frame(spark, [(None, 1, "a", "b")], "id int, o int, p string, q string")
    assert aggregate.merge_compatible_rows(empty, "id", ["o"]).count() == 0


def test_history(spark):
    data = [("s", 1, ["A"]), ("s", 2, [" B", "B"]), ("s", 3, None), ("s", 4, ["B", "A"]), ("s", 5, ["C"]), ("s", 6, ["A", ""]), ("t", 1, [])]
    out = history.cumulative(frame(spark, data, "id string, t int, v array<string>"), "id", ["t"], "v", "h_").orderBy("id", "t").collect()
    got = [(r["h_hist"], r["h_n_uniq"], r["h_main"], r["h_main_n"]) for r in out]
    none = (None, None, None, None)
    assert got == [(["A"], 1, "A", 1), (["A", "B"], 2, "B", 1), none, (["A", "B"], 2, "A", 2), (["A", "B", "C"], 3, "C", 1), (["A", "B", "C"], 3, "A", 3), none]


def test_state_changes(spark):
    data = [(1, ["1"], ["P"], ["X"]), (2, ["2"], ["Q"], ["X"]), (3, ["2", "3"], ["Q", "R"], ["X"]), (4, ["3"], ["R"], ["X"]), (5, None, ["S"], ["X"]), (6, ["9"], ["T"], ["X"])]
    df = frame(spark, [("s", *d) for d in data], "id string, t int, urn array<string>, pcd array<string>, kind array<string>")
    out = history.state_changes(df, "id", ["t"], ["urn", "pcd", "kind"], "", 2).orderBy("t").collect()
    assert [(r["changed"], r["n_chg"], r["ever"]) for r in out] == [(0, 0, 0), (1, 1, 1), (1, 2, 1), (0, 2, 1), (0, 2, 1), (0, 2, 1)]


def test_sums_and_percentages(spark):
    df = frame(spark, [("a", 100, 10), ("a", 50, None), ("b", None, None)], "id string, possible int, absence_count int")
    assert [(r[0], r[1], r[2], r[3] and round(r[3], 4)) for r in aggregate.sum_and_percent(df, ["id"], ["absence_count"], "possible").orderBy("id").collect()] == [("a", 10, 150, 6.6667), ("b", 0, 0, None)]
    assert aggregate.sum_and_percent(df, ["id"], ["absence_count"], "possible", 1.0).where("id = 'a'").first()["absence_pct"] == pytest.approx(10 / 150)


def test_resolvers(spark):
    df = frame(spark, [("s", 2.0, "M", "2020-01-01"), ("s", 1.0, "S", "2019-01-01"), ("s", 1.0, "C", "2018-01-01"), ("s", None, "M", "2021-01-01")], "id string, err double, st string, d string")
    best = resolve.by_priority(df, ["id"], F.col("err"), F.col("st"), {"M": 1, "C": 2, "S": 3}, F.col("d"), [F.col("d")])
    assert rows(best, "st") == [("C",)]
    full = resolve.most_complete(frame(spark, [("s", 1, "1", None, None), ("s", 2, None, "2", "3")], "id string, o int, a string, b string, c string"), ["id"], ["a", "b", "c"], [F.col("o")])
    assert rows(full, "o", "a", "b", "c") == [(2, "1", "2", "3")]
    last = resolve.latest_with_count(frame(spark, [("s", "d1"), ("s", "d2"), ("s", None)], "id string, d string"), ["id"], "d", [F.col("d")], "n")
    assert rows(last) == [("s", "d2", 3)]


def test_resolve_leaves_one_row_a_group(spark):
    df = frame(spark, [("s", 1, "a", "2020"), ("s", 1, "b", "2021"), ("s", 2, "c", "2020"), ("t", 1, "a", "2020"), ("t", 1, "a", "2020")], "id string, g int, what string, at string")
    rule = resolve.Rule("latest", ["what", "at"], [F.col("what")], {"date": "at", "count": "n"})
    out = resolve.resolve(df, "id", ["id", "g"], [rule])
    assert rows(out) == [("s", 1, "b", "2021", 2), ("s", 2, "c", "2020", 1), ("t", 1, "a", "2020", None)]
    with pytest.raises(Exception, match="conflicts without a rule: extra"):
        resolve.resolve(df.withColumn("extra", F.col("what")), "id", ["id", "g"], [rule]).collect()


def test_all_rules_in_one_pass(spark):
    r = random.Random(3)
    data = []
    for _ in range(400):
        i, t = r.choice([None, *range(40)]), r.choice([None, 1, 2])
        pick = (lambda *x: x[((i or 0) + (t or 0)) % len(x)]) if (i or 0) % 3 == 0 else (lambda *x: r.choice([None, *x]))  # noqa: B023
        data.append((i, t, pick("2020", "2021"), pick("u", "v"), pick("p", "q"), pick("r"), pick("t"), pick(1, 2), pick(10, 20), pick("n", "m"), pick(1.0, 2.0), pick("M", "C", "Z"), pick("1", "2"), "same"))
    df = frame(spark, data, "id int, t int, d string, w string, a string, b string, c string, x_count int, possible int, note string, err double, st string, rec string, rest string")
    keys, c = ["id", "t"], F.col
    rules = [
        resolve.Rule("latest", ["d", "w"], [c("w")], {"date": "d", "count": "n"}), resolve.Rule("complete", ["a", "b", "c"]), resolve.Rule("sum", ["x_count", "possible", "note"], [c("note")], {"counts": ["x_count"], "possible": "possible"}),
        resolve.Rule("priority", ["err", "st", "rec"], [c("rec")], {"error": c("err"), "priority": c("st"), "priorities": {"M": 1, "C": 2}, "recency": c("rec")}),
    ]
    single = [
        lambda x: resolve.latest_with_count(x, keys, "d", [c("w")], "n"), lambda x: resolve.most_complete(x, keys, ["a", "b", "c"], [c("a"), c("b"), c("c")]),
        lambda x: resolve.summed(x, keys, ["x_count"], "possible", [c("note")]), lambda x: resolve.by_priority(x, keys, c("err"), c("st"), {"M": 1, "C": 2}, c("rec"), [c("rec")]),
    ]
    out = resolve.resolve(df, "id", keys, rules)
    known = df.dropna(subset=keys)
    assert out.dropna(subset=keys).count() == known.select(*keys).distinct().count()
    assert rows(out.where("id IS NULL OR t IS NULL"), *df.columns) == rows(df.where("id IS NULL OR t IS NULL").distinct())
    got = {(x["id"], x["t"]): x for x in out.dropna(subset=keys).collect()}
    for rule, alone in zip(rules, single, strict=True):
        calm, conflicted = resolve.split_conflicted(known, keys, rule.columns, "id")
        want = alone(conflicted).collect()
        assert len(want) > 20 and all(got[x["id"], x["t"]][k] == v for x in want for k, v in x.asDict().items())
        once = calm.groupBy(*keys).agg(*[F.max(k).alias(k) for k in rule.columns]).collect()
        assert len(once) > 5 and all(got[x["id"], x["t"]][k] == v for x in once for k, v in x.asDict().items())
    plan = out.select("*")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and plan.count("Scan ") == 1


def test_rows_fold_as_one_by_one(spark):
    def plain(data):
        out = []
        for i in sorted({d[0] for d in data if d[0]}):
            held = []
            for row in sorted((d for d in data if d[0] == i), key=lambda d: [(v is not None, "" if v is None else v) for v in d[1:]]):
                for h in held:
                    if all(a is None or b is None or a == b for a, b in zip(h[2:], row[2:], strict=True)):
                        h[2:] = [b if a is None else a for a, b in zip(h[2:], row[2:], strict=True)]
                        break
                else:
                    held.append(list(row))
            out += map(tuple, held)
        return sorted(out, key=str)

    for seed in range(3):
        r = random.Random(seed)
        data = [(r.choice([None, "a", "b", "c"]), r.randint(0, 3), *[r.choice([None, None, "x", "y"]) for _ in range(4)], r.choice("pq") if seed else None) for _ in range(150)]
        out = aggregate.merge_compatible_rows(frame(spark, data, "id string, o int, u string, v string, w string, z string, t string"), "id", ["o"])
        assert rows(out) == plain(data)
    plan = out.select("*")._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan and "Python" not in plan and plan.count("Exchange ") == 1


def test_agreement_and_curation(spark):
    df = frame(spark, [("a", "F", "F"), ("a", None, " F "), ("b", "F", "M"), ("c", None, None)], "id string, x string, y string")
    assert rows(aggregate.agree_or_null(df, ["id"], ["x", "y"], "g")) == [("a", "F"), ("b", None)]
    assert rows(aggregate.collapse(df, ["id"], ["x", "y"], "g")) == [("a", ["F"]), ("b", ["F", "M"])]


def test_clean(spark):
    df = frame(spark, [(1, "a", None, "k"), (1, "a", None, "k"), (None, "b", None, "k"), (9, "c", None, "k")], "id int, v string, e string, k string")
    kept, bad = clean.clean(df, clean.CleanOptions("id", blocked=[9], sensitive=["zzz"], drop_constant=True, null_threshold=0.5))
    assert rows(bad, "reject_reason") == [("blocked_id",), ("duplicate",), ("null_id",)]
    assert kept.columns == ["id"] and rows(kept) == [(1,)]
    assert clean.constant_columns(df) == ["e", "k"] and clean.sparse_columns(df, 0.2) == ["id", "e"]
    assert clean.reorder(df.withColumn("_m", F.lit(1)), ["k"]).columns == ["k", "id", "v", "e", "_m"]


def test_percent_and_rate_columns(spark):
    df = frame(spark, [("0.1", "12%", 0.2, 0.2), ("0.5", "50%", 40.0, 0.4)], "a string, b string, c double, d double")
    out = profile.scale_rates(profile.scale_percents(df, ["a", "b"]), ["c", "d"])
    assert rows(out) == [(10.0, 12.0, 0.0, 0.2), (50.0, 50.0, 0.4, 0.4)]


def test_levels_and_histories(spark):
    table = frame(spark, [("WBRI", "White British", "W", "White"), ("WIRI", "White Irish", "W", "White")], "ext_code string, ext_cat string, main_code string, main_cat string")
    df = frame(spark, [("wbri ",), ("White Irish",), ("w",), ("?",), (None,)], "c string")
    out = derive.map_levels(df, "c", table, ["ext_code", "ext_cat", "main_code"], ["main_cat"], "e_")
    assert rows(out) == sorted([("wbri ", "White"), ("White Irish", "White"), ("w", "White"), ("?", None), (None, None)], key=str)
    told = derive.value_history(frame(spark, [("s", 1, "en"), ("s", 2, "refused"), ("s", 3, "fr")], "id string, t int, l string"), "id", "t", "l", "l_").orderBy("t").collect()
    assert [r["l_n_uniq"] for r in told] == [1, None, 2]


def test_merged_columns(spark):
    df = frame(spark, [(1, "a", None), (2, "b", "b"), (3, None, "c")], "i int, x string, y string")
    out, bad = aggregate.merge_equivalent(df, {"z": ["x", "y"]})
    assert rows(out, "z") == [("a",), ("b",), ("c",)] and bad == []
    assert aggregate.merge_equivalent(frame(spark, [("a", "b")], "x string, y string"), {"z": ["x", "y"]})[1] == ["z"]
    assert aggregate.similar("school_name", "school_names") > 0.9
    with pytest.raises(ValueError):
        aggregate.pivot(df, "i", "x", "y", "median")


def test_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("title line,x\nURN,Name\n1,Hill\n2,Vale\n")
    assert rows(files.load_columns(spark, f"file://{tmp_path}/a.csv", {"URN": "urn"})) == [("1",), ("2",)]
    (tmp_path / "b.csv").write_text("URN,Name\n1,Hill\n")
    assert rows(files.load_columns(spark, f"file://{tmp_path}/b.csv", {"Name": "name", "URN": "urn"})) == [("1", "Hill")]
    path = f"file://{tmp_path}/t.parquet"
    files.write(spark.range(3).toDF("k"), path)
    files.write(spark.range(9).toDF("k"), path, skip_existing=True)
    assert files.load(spark, path).count() == 3
    assert files.resolve(spark, default=path).count() == 3
    with pytest.raises(ValueError):
        files.resolve(spark)
    listed = manifest.listing(spark, f"file://{tmp_path}", "*.csv")
    assert [r["name"].rsplit("/", 1)[-1] for r in listed.orderBy("name").collect()] == ["a.csv", "b.csv"]
    a = spark.createDataFrame([("x", 1.0), ("y", 1.0), ("z", 1.0)], "name string, mtime double")
    b = spark.createDataFrame([("x", 1.5), ("y", 9.0), ("w", 1.0)], "name string, mtime double")
    assert rows(manifest.diff(a, b)) == [("w", "added"), ("y", "modified"), ("z", "removed")]
    assert manifest.same(a, a) and not manifest.same(a, b)


def test_facades(spark):
    from annalist.catalog import SchemaCatalog
    from annalist.pipeline import Curator, Engineer

    cat = SchemaCatalog({"census": {"age": "numeric"}, "ks2": {"score": "Int64"}})
    c = Curator(spark, "stud_id", cat)
    a = c.curate("census", frame(spark, [("s", "7", "R&D"), ("s", "7", "R&D"), (None, "8", "x")], "`Stud Id` string, Age string, Note string"))
    b = c.curate("ks2", frame(spark, [("s", "100.0"), ("t", "90")], "`Stud Id` string, Score string"))
    assert a.columns == ["stud_id", "census_age", "census_note"] and rows(c.rejected["census"], "reject_reason") == [("duplicate",), ("null_id",)]
    one = c.merge([a, b], [], [])
    assert rows(one) == [("s", 7.0, "RandD", 100), ("t", None, None, 90)]
    whole = c.unite([("2018-2019", 7, one), ("2019-2020", 8, one.drop("ks2_score"))])
    assert whole.count() == 4 and "_year_group" in whole.columns
    e = Engineer(whole, "stud_id", "_year_group").histories({"note": ["census_note"]}, threshold=1)
    assert rows(e.df.where("stud_id = 's'"), "der_note_main") == [("RandD",), ("RandD",)]
