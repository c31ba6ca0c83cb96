"""Exact dedup and its index against plain dictionaries."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from annalist.llm import exact
from annalist.llm.lines import Cuckoo

SCHEMA = "doc_id long, text string"


def plain(text):
    return re.sub("[\x20\x09-\x0d]", "", text or "")


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(plain(t), []).append((-len(t or ""), i is None, i))
    out = []
    for i, t in rows:
        g = groups[plain(t)]
        first = min(g, key=lambda x: x[:2] + (x[2] or 0,))
        out.append((i, first[2], len(g), (first[0], first[2]) == (-len(t or ""), i), hashlib.sha256(plain(t).encode()).hexdigest()))
    return sorted(out, key=str)


def weak(content):
    """A digest that mixes up most texts."""
    return F.char_length(content) % 7, F.lit(0)


def documents(seed, n=400):
    r = random.Random(seed)
    texts = ["".join(r.choices("ab \t é\n", k=r.randint(0, 8))) for _ in range(n // 4)]
    rows = [(k, r.choice(texts)) for k in range(n)] + [(n + k, f"only {k} of me") for k in range(n)]
    rows += [(2 * n + k, " many  copies" if k % 2 else "manycopies") for k in range(n)]
    return rows + [(None, None), (None, "a b"), (3 * n, None), (3 * n + 1, "\x0b\x0c\r"), (3 * n + 2, " "), (7, rows[7][1])]


@pytest.mark.parametrize("digest", [exact.digest, weak])
@pytest.mark.parametrize("seed", [1, 2])
def test_against_a_dictionary(spark, seed, digest):
    rows = documents(seed)
    docs = spark.createDataFrame([(*x, 1, "z") for x in rows], SCHEMA + ", k1 int, content string").repartition(5)
    found = exact.dedup(docs, digest)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows)


def test_edges(spark):
    assert exact.dedup(spark.createDataFrame([], SCHEMA)).collect() == []
    long = "word " * 400_000
    rows = [(1, long), (2, long + " "), (3, long + "x")]
    assert sorted((tuple(r) for r in exact.dedup(spark.createDataFrame(rows, SCHEMA)).collect()), key=str) == brute(rows)
    texts = spark.createDataFrame([("b", "x y"), ("a", "xy "), (None, "x  y"), (None, "xy")], "doc_id string, text string")
    assert {r["keep_id"] for r in exact.dedup(texts).collect()} == {None}  # the longest stays, though it has no id
    assert {r["keep_id"] for r in exact.dedup(texts.where("length(text) < 4")).collect()} == {"a"}


@pytest.mark.parametrize("digest", [exact.digest, weak])
def test_index_goes_back_and_forth(spark, digest):
    r, rows = random.Random(5), [x for x in documents(3, 60) if x[0] is not None][:-1]
    rows = list(dict(rows).items())
    r.shuffle(rows)
    frame = lambda x: spark.createDataFrame(x, SCHEMA)

    def same(index, live):
        want = {}
        for i, _, size, kept, _ in brute(live):
            if kept:
                want[i] = size
        assert {g["keep_id"]: g["group_size"] for g in index.groups().collect()} == want
        assert index.contents.count() == len({plain(t) for _, t in live})
        held = {f["shard"]: Cuckoo.load(bytes(f["buckets"]), list(f["stash"])) for f in index.filters.collect()}
        for k in index.rows.select("k1", "k2", exact._shard(index.shards).alias("shard")).collect():
            assert held[k["shard"]].may_hold(np.array([k["k1"]]), np.array([k["k2"]]))[0]
        return sum(int((c.table > 0).sum()) + len(c.stash) for c in held.values())

    index = exact.ExactIndex.build(frame(rows[:100]), digest)
    n = same(index, rows[:100])
    more = index.insert(frame(rows[100:]))
    assert same(more, rows) >= n
    changed = [(rows[0][0], "other text now"), (rows[1][0], rows[2][1])]
    same(more.insert(frame(changed)), changed + rows[2:])
    less = more.delete(frame(rows[100:]).select("doc_id"))
    assert same(less, rows[:100]) == n
    none = less.delete(frame(rows).select("doc_id"))
    assert none.rows.count() == 0 and sum(int(np.frombuffer(f["buckets"], np.uint16).any()) + len(f["stash"]) for f in none.filters.collect()) == 0
    same(none.insert(frame(rows[:50])), rows[:50])


def test_overflow_builds_anew_from_stored_keys(spark, monkeypatch):
    monkeypatch.setattr(exact, "SHARD_KEYS", 100_000)
    small = exact.ExactIndex.build(spark.createDataFrame([(k, f"text {k}") for k in range(20)], SCHEMA))
    large = small.insert(spark.createDataFrame([(k, f"text {k}") for k in range(20, 3000)], SCHEMA))
    size = lambda i: sum(len(f["buckets"]) for f in i.filters.collect())
    assert large.shards == small.shards and size(large) > 20 * size(small)
    again = large.insert(spark.createDataFrame([(k, f"t e x t{k - 5000}") for k in range(5000, 8000)], SCHEMA))
    assert again.groups().where("group_size = 2").count() == 3000


def test_alone_texts_miss(spark):
    """The filters decide: nearly all documents that are alone go without a comparison."""
    docs = spark.createDataFrame([(k, f"only {k}") for k in range(5000)] + [(5000 + k, f"only {k}") for k in range(50)], SCHEMA)
    batch = exact._compare(docs, None, exact.digest)
    assert 50 <= batch.n_hits < 150 and batch.contents.where("n = 2").count() == 50
