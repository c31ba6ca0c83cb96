"""Streams over files, against the batch operators."""

from pyspark.sql import functions as F

from annalist.operators import resolve
from annalist.streaming.latest import arriving, latest_with_count, windowed_counts, write_batches


def test_latest_follows_the_files(spark, tmp_path):
    source, out, mark = (f"file://{tmp_path}/{n}" for n in ("in", "out", "mark"))
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("user_id", "event_type", "ts", "event_id")
    schema = "user_id bigint, event_type string, ts timestamp_ntz, event_id bigint"

    def step(part):
        part.coalesce(1).write.mode("append").parquet(source)
        q = write_batches(latest_with_count(arriving(spark, source, schema), ["user_id", "event_type"], "ts", ["event_id"]), out, mark)
        q.awaitTermination(120)
        assert q.exception() is None

    step(e.where("event_id % 2 = 0"))
    step(e.where("event_id % 2 = 1"))
    batches = spark.read.parquet(out)
    newest = resolve.first_per_group(batches, ["user_id", "event_type"], [F.desc("batch")]).select("user_id", "event_type", "event_id", "event_count")
    want = resolve.latest_with_count(e, ["user_id", "event_type"], "ts", [F.desc("event_id")], "event_count").select("user_id", "event_type", "event_id", "event_count")
    assert newest.exceptAll(want).count() == 0 and newest.count() == want.count()


def test_windows_close(spark, tmp_path):
    rows = spark.sql("SELECT timestamp('2024-01-01 00:00:00') + make_interval(0, 0, 0, 0, 0, CAST(id AS INT) * 7, 0) AS ts, id % 2 AS k FROM range(40)")
    rows.coalesce(1).write.parquet(f"file://{tmp_path}/in")
    stream = windowed_counts(arriving(spark, f"file://{tmp_path}/in", "ts timestamp, k bigint"), ["k"], "ts", "1 hour", "10 minutes")
    q = stream.writeStream.outputMode("append").format("memory").queryName("closed").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {(str(r["start"]), r["k"]): r["n"] for r in spark.table("closed").collect()}
    want = {}
    for i in range(40):
        start = f"2024-01-01 0{i * 7 // 60}:00:00"
        want[start, i % 2] = want.get((start, i % 2), 0) + 1
    assert got and all(want[k] == n for k, n in got.items())
