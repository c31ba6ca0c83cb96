"""Shared folders: where tables are cut to, and when they go."""

import os
import threading
import time
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from annalist.llm import common, jaccard


def folder(spark):
    return common.shared_dir(spark).removeprefix("file://").removeprefix("file:")


def test_a_cluster_needs_a_shared_folder():
    conf = SimpleNamespace(get=lambda *_: None)
    cluster = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="spark://host:7077", getConf=lambda: conf))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(cluster)
    cluster.sparkContext.master = "local[2]"
    assert common.shared_dir(cluster).startswith("file:///")


def test_tables_go_when_their_block_ends(spark):
    before = {*os.listdir(folder(spark))}
    with common.tables(spark):
        gone = common.cut(spark.range(3), "gone")
        with common.tables(spark):
            common.cut(spark.range(4), "inner")
            kept = common.cut(gone, "kept", keep=True)
        assert kept.count() == 3 and len({*os.listdir(folder(spark))} - before) == 2
        last = common.cut(kept, "last", keep=True)
    assert last.count() == 3 and [n.split("-")[1] for n in {*os.listdir(folder(spark))} - before] == ["last"]
    with pytest.raises(RuntimeError), common.tables(spark):
        common.cut(spark.range(1), "lost")
        raise RuntimeError
    assert len({*os.listdir(folder(spark))} - before) == 1


def test_blocks_of_threads_are_their_own(spark):
    inside, done, found = threading.Event(), threading.Event(), []

    def other():
        with common.tables(spark):
            df = common.cut(spark.range(7), "other")
            inside.set()
            done.wait(60)
            found.append(df.count())

    thread = threading.Thread(target=other)
    with common.tables(spark):
        thread.start()
        inside.wait(60)
        common.cut(spark.range(2), "mine")
    done.set()
    thread.join()
    assert found == [7]


def test_an_operator_leaves_what_its_result_reads(spark):
    before = {*os.listdir(folder(spark))}
    docs = spark.createDataFrame([(i, f"a b c d e f g h {i % 4}") for i in range(20)], "doc_id bigint, text string")
    found = jaccard.near_duplicates(docs)
    assert {n.split("-")[1] for n in {*os.listdir(folder(spark))} - before} == {"signed", "labels"}
    assert found.count() == 20


def test_unused_names(spark):
    assert common.unused(spark.createDataFrame([(1, 2)], "_Row int, x int"), "_row", "y") == ["__row", "y"]


def test_passages_of_a_very_long_message(spark):
    """A pasted archive of alternating lines: work grows with the lines, not with their square."""
    import time

    from pyspark.sql import functions as F

    from annalist.llm import conversations

    text = "\n".join(f"> quoted line {i} of it" if i % 2 else f"plain {i}" for i in range(20_000))
    df = spark.createDataFrame([(text,)], "t string").select(conversations.passages(conversations.parse_lines(F.col("t"))).alias("p"))
    began = time.time()
    found = df.first()["p"]
    assert time.time() - began < 30 and len(found) == 10_000
    assert (found[0]["place"], found[0]["level"], found[0]["words"]) == (1, 1, ["quoted", "line", "1", "of", "it"]) and found[-1]["place"] == 19_999
    nested = "a\n> b\n> c\n>> d\n> e\n\n>> f g"
    got = spark.createDataFrame([(nested,), (None,), ("",)], "t string").select(conversations.passages(conversations.parse_lines(F.col("t"))).alias("p")).collect()
    assert [(p["place"], p["level"], p["words"]) for p in got[0]["p"]] == [(1, 1, ["b", "c"]), (3, 2, ["d"]), (4, 1, ["e"]), (6, 2, ["f", "g"])] and got[1]["p"] == got[2]["p"] == []


def test_a_cut_leaves_no_shuffle_files(spark):
    dirs = [str(d) for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    files = lambda: {f for d in dirs for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}
    held = spark.range(50_000).groupBy((F.col("id") % 9_000).alias("k")).count()  # referred to all the time, as a lazy frame is
    before, told = files(), spark.conf.get(common.FREED, None)
    out = common.cut(held, "freed")
    for _ in range(100):  # they are removed in the background
        if not (left := files() - before):
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(common.FREED, None) == told
    assert out.count() == common.cut(held, "again").count() == held.count() == 9_000
