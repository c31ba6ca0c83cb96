"""Tables stored by entity: later stages take no exchange; patterns of nulls; bitmaps of many columns."""

import uuid

import pytest
from pyspark.sql import functions as F

from annalist.operators import aggregate, derive, history, resolve
from annalist.sources import files


def exchanges(df):
    return df.select("*")._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_no_exchange_on_tables_stored_by_entity(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    name = f"stored_{uuid.uuid4().hex}"
    try:
        df = spark.range(500).select((F.col("id") % 40).alias("id"), F.floor(F.col("id") / 40).cast("int").alias("t"), F.array((F.col("id") % 7).cast("string")).alias("v"), (F.col("id") % 5).cast("string").alias("k"), F.lit("2020").alias("d"))
        stored = files.store_by_entity(df, name, "id", ["t"], 4)
        steps = {
            "W1": lambda x: history.cumulative(x, "id", ["t"], "v", "h_"), "W2": lambda x: history.state_changes(x, "id", ["t"], ["v"], "s_"),
            "R3": lambda x: resolve.latest_with_count(x, ["id", "t"], "d", [F.col("k")], "n"), "R6": lambda x: resolve.resolve(x.drop("v"), "id", ["id", "t"], [resolve.Rule("complete", ["k", "d"])]),
            "D7": lambda x: derive.set_histories(x, "id", "t", {"kind": ["k"]}, "x_", 1),
        }
        for step, f in steps.items():
            assert exchanges(f(stored)) < exchanges(f(df)) and (step == "R6" or exchanges(f(stored)) == 0), step
            assert rows(f(stored)) == rows(f(df))
        assert exchanges(stored.join(stored.groupBy("id").agg(F.count("*").alias("n")), "id")) == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_thousand_columns(spark, tmp_path):
    """Pairs that never have values together are told apart by patterns; the rest by value."""
    import difflib

    k = F.col("id")
    # x has values in even rows, y beside it in odd ones, in even ones the same, or in even ones others
    other = lambda i: (k % 2 == (1 if i % 6 == 1 else 0), (k + (1 if i % 6 == 5 else 0)).cast("string"))
    name = lambda i: f"{'qwertzuiop'[i // 100]}{'asdfghjkl0'[i // 10 % 10] * 3}{(i // 2) % 5}{'xy'[i % 2]}"
    spark.range(60).select(*[F.when(*other(i)).alias(name(i)) for i in range(1000)]).coalesce(1).write.parquet(f"file://{tmp_path}/wide")
    wide = spark.read.parquet(f"file://{tmp_path}/wide")
    patterns = aggregate.null_patterns(wide, wide.columns)
    assert patterns.count() == 2
    assert aggregate.value_bitmaps(patterns, wide.columns).groupBy("column_name").agg(F.sum("n").alias("n")).where("n = 30").count() == 1000
    some = wide.columns[:60]
    found = {tuple(sorted(r)) for r in aggregate.complementary_pairs(wide, some, 0.83).collect()}
    data, want = wide.select(*some).collect(), set()
    for i, a in enumerate(sorted(some)):
        for b in sorted(some)[i + 1 :]:
            if difflib.SequenceMatcher(None, a, b).ratio() >= 0.83 and all(r[a] is None or r[b] is None or r[a] == r[b] for r in data):
                want.add((a, b))
    assert found == want and len(want) > 20


def test_emptier_to_fuller(spark):
    df = spark.createDataFrame([("a", None, None, 1), ("b", "b", None, 1), ("c", None, "z", 1)], "name_1 string, name_2 string, name_3 string, name_4 int")
    assert rows(aggregate.complementary_pairs(df, df.columns, 0.8)) == [("name_2", "name_1"), ("name_2", "name_3")]
    assert aggregate.complementary_pairs(df, ["name_1"], 0.8).count() == 0
    empty = spark.createDataFrame([(None, None)], "name_1 string, name_2 string")
    assert rows(aggregate.complementary_pairs(empty, empty.columns, 0.8)) == [("name_1", "name_2")]


def test_constancy(spark):
    from annalist.operators import clean

    df = spark.createDataFrame([("f1", "x", None, "p", None), ("f1", "x", None, "q", None), ("f2", "x", "v", "p", None), ("f3", "y", None, "p", None)], "f string, a string, b string, c string, d string")
    got = {r["column_name"]: r for r in clean.constancy(df, "f", consistency=0.8, missing=0.7, most=1).collect()}
    assert {k: r["verdict"] for k, r in got.items()} == {"a": "middle", "b": "missing", "c": "middle"}
    assert (got["a"]["top_value"], got["a"]["n_files"], got["a"]["n_constant"]) == ("x", 3, 3) and got["a"]["values"] == "x (75.00%)... (1 more not shown)"
    assert got["c"]["constants"] == "p (66.67%)... (1 more not shown)" and got["c"]["n_constant"] == 2
    assert clean.constancy(df, "f", missing=None).where("verdict = 'missing'").count() == 0
    spared = clean.constancy(df, "f", missing=0.7, never_missing=("b",)).where("column_name = 'b'").first()
    assert spared["verdict"] == "middle" and spared["top_value"] == "Missing"


@pytest.mark.parametrize("seed", range(2))
def test_best_names_as_difflib_tells(spark, seed):
    import difflib
    import random

    from annalist.operators import schemas

    r = random.Random(seed)
    names = ["".join(r.choices("abc_%é", k=r.randint(1, 7))) for _ in range(40)]
    pairs = [(a, b) for a in names for b in names]
    got = {(x["a"], x["b"]): x["similarity"] for x in schemas.alike_names(spark.createDataFrame(pairs, "a string, b string"), 0.5).collect()}
    want = {(a, b): s for a, b in pairs if (s := difflib.SequenceMatcher(None, a, b).ratio()) > 0.5}
    assert got == want


def test_profiles_and_reset_of_the_configuration(tmp_path):
    from annalist.config import DEFAULTS, Config

    path = tmp_path / "user.json"
    path.write_text('{"profiles": {"mine": {"dataset": {"year_range": [2018, 2020]}}}, "clean": {"null_threshold": 0.5}}')
    c = Config.load(path, {})
    assert c.profile("mine") == {"dataset": {"year_range": [2018, 2020]}} and set(c.values["profiles"]) == {"sample", "real", "mine"}
    c.profile("mine")["dataset"]["year_range"] = None
    assert c.with_profile("mine").dataset().endswith("/2018-2020.parquet") and c.with_profile("sample").dataset().endswith("/sample.parquet")
    with pytest.raises(KeyError, match="no such profile"):
        c.profile("other")
    saved = c.with_profile("mine").save(tmp_path / "saved.json")
    assert Config.load(tmp_path / "saved.json", {}).values == saved.values
    assert c.reset().values == DEFAULTS and not path.exists() and saved.reset().values == DEFAULTS and not (tmp_path / "saved.json").exists()
    assert Config().reset().values == DEFAULTS
