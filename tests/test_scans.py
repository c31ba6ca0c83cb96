"""Scans in two levels against those in one, on a table where one entity has half of all rows."""

import random
import time

import pytest
from pyspark.sql import functions as F

from annalist.operators import history, scans


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def table(spark):
    r = random.Random(11)
    data = []
    for k in range(3000):
        i = r.choice([None, *range(150)]) if k % 2 else "hot"
        value = r.choice([None, [], [" "], [r.choice("abcdefgh")], r.choices("abcdefghijkl", k=3), [f"v{r.randint(0, 40)}"]])
        data.append((i if i is None else str(i), k, value, r.choice([None, None, None, f"x{k}"])))
    r.shuffle(data)
    return spark.createDataFrame(data, "id string, t int, v array<string>, x string")


@pytest.mark.parametrize("block", [100, 700, 10_000])
def test_same_as_in_one_level(spark, table, block):
    got, want = scans.cumulative(table, "id", ["t"], "v", "c_", block), history.cumulative(table, "id", ["t"], "v", "c_")
    assert got.columns == want.columns and rows(got) == rows(want)
    got, want = scans.state_changes(table, "id", ["t"], ["v"], "s_", 1, block), history.state_changes(table, "id", ["t"], ["v"], "s_", 1)
    assert rows(got.select(want.columns)) == rows(want)
    got, want = scans.first_known(table, "id", ["t"], ["x"], block), table.withColumn("x", history.first_known("x", ["id"], [F.col("t")]))
    assert rows(got) == rows(want)


def test_no_task_has_more_than_its_share(spark, table):
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "200"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        tasks = lambda df: [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max(df.columns[-1])).collect()]
        for out in (scans.cumulative(table, "id", ["t"], "v", "c_", 100), scans.state_changes(table, "id", ["t"], ["v"], "s_", 1, 100), scans.first_known(table, "id", ["t"], ["x"], 100)):
            assert max(tasks(out)) < 600  # a few blocks that hash alike
        assert max(tasks(history.cumulative(table, "id", ["t"], "v", "c_"))) >= 1500
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_empty(spark, table):
    none = table.limit(0)
    assert scans.cumulative(none, "id", ["t"], "v", "c_").count() == scans.state_changes(none, "id", ["t"], ["v"], "s_").count() == scans.first_known(none, "id", ["t"], ["x"]).count() == 0


def test_a_row_costs_no_more_in_a_longer_block(spark):
    n = 24_000
    one = spark.range(n).select(F.lit("a").alias("id"), F.col("id").cast("int").alias("t"), F.array(F.concat(F.lit("v"), F.col("id") % 5)).alias("v"), F.when(F.col("id") == n - 1, "x").alias("x"))

    def seconds(make, rows):
        began = time.time()
        make(rows).write.format("noop").mode("overwrite").save()
        return time.time() - began

    for make in (lambda rows: scans.first_known(one, "id", ["t"], ["x"], rows), lambda rows: scans.cumulative(one, "id", ["t"], "v", "c_", rows)):
        make(1000).count()  # code is compiled
        assert seconds(make, n) < 2 * seconds(make, 1000) + 1
    assert scans.first_known(one, "id", ["t"], ["x"], n).where("x = 'x'").count() == n
