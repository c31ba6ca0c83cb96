"""Reversible line dedup: exact reference tables, with sharded cuckoo filters in front of them.

The reference table has a row for each line key and document that holds it; the
count table, for each key, in how many documents it is and the largest of them.
Keys that are frequent enough stand in cuckoo filters, one per shard, so that a
line is looked up in the count table only if its shard's filter may hold it. A
filter's yes is always checked exactly. Documents can be inserted and deleted:
counts follow, and keys enter or leave the filters as they cross the limit.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annalist.llm.common import cut, partitions, small_batches, tables, unused

LEAST_DOCS = 3
LEAST_CHARS = 20
#: Keys of a filter, on average, and rows of a shard that one group of probes takes, about.
SHARD_KEYS = 20_000
PROBES = 100_000
#: A filter with more in its stash is built anew; all are, in more shards, once a filter has so many times SHARD_KEYS keys on average.
STASHED = 64
GROWN = 2
_SPACE = " \t\n\x0b\f\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SLOTS = 4
_KICKS = 200


class Cuckoo:
    """A set of 64-bit pairs (k1, k2) that allows deletion. Buckets of four 16-bit fingerprints; what finds no place goes to a stash, so nothing is ever lost."""

    def __init__(self, buckets: np.ndarray, stash: list[tuple[int, int]]):
        self.table, self.stash, self.mask = buckets.reshape(-1, _SLOTS), stash, len(buckets) // _SLOTS - 1

    @classmethod
    def of_size(cls, keys: int) -> "Cuckoo":
        n = 1 << max(1, int(np.ceil(np.log2(max(1, keys / (_SLOTS * 0.7))))))
        return cls(np.zeros(n * _SLOTS, np.uint16), [])

    @classmethod
    def load(cls, buckets: bytes, stash: list[int]) -> "Cuckoo":
        return cls(np.frombuffer(buckets, np.uint16).copy(), [(s >> 16, s & 0xFFFF) for s in stash])

    def dump(self) -> tuple[bytes, list[int]]:
        return self.table.tobytes(), [b << 16 | f for b, f in self.stash]

    def _places(self, k1: np.ndarray, k2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        f = (k2.astype(np.uint64) % np.uint64(65535)).astype(np.int64) + 1
        a = ((k1.astype(np.uint64) >> np.uint64(17)) & np.uint64(self.mask)).astype(np.int64)
        return f, a, self._other(a, f)

    def _other(self, bucket, f):
        return bucket ^ ((f * 0x5BD1) & self.mask)

    def _put(self, bucket: int, f: int) -> bool:
        row = self.table[bucket]
        for s in range(_SLOTS):
            if not row[s]:
                row[s] = f
                return True
        return False

    def insert(self, k1: np.ndarray, k2: np.ndarray) -> None:
        for f, a, b in zip(*(x.tolist() for x in self._places(k1, k2)), strict=True):
            if self._put(a, f) or self._put(b, f):
                continue
            at, kick = b, 0
            while kick < _KICKS:
                s = (f + kick) % _SLOTS
                f, self.table[at, s] = int(self.table[at, s]), f
                at = self._other(at, f)
                if self._put(at, f):
                    break
                kick += 1
            else:
                self.stash.append((min(at, self._other(at, f)), f))

    def delete(self, k1: np.ndarray, k2: np.ndarray) -> None:
        """Keys that were inserted before."""
        for f, a, b in zip(*(x.tolist() for x in self._places(k1, k2)), strict=True):
            if (min(a, b), f) in self.stash:
                self.stash.remove((min(a, b), f))
                continue
            for bucket in (a, b):
                hit = np.flatnonzero(self.table[bucket] == f)
                if len(hit):
                    self.table[bucket, hit[0]] = 0
                    break

    def may_hold(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        f, a, b = self._places(k1, k2)
        found = (self.table[a] == f[:, None]).any(1) | (self.table[b] == f[:, None]).any(1)
        for bucket, g in self.stash:
            found |= (f == g) & (np.minimum(a, b) == bucket)
        return found


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(_SPACE)), _UPPER, _LOWER)


def references(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(k1, k2, doc_id, at): for each key and document, the row (by its text's hash) and places of its lines. A null doc_id holds no references."""
    lines = docs.where("doc_id IS NOT NULL").select("doc_id", F.xxhash64("text").alias("row"), F.posexplode(lines_of(F.col("text"))).alias("place", "line"))
    keys = lines.select("doc_id", "row", "place", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= least_chars)
    keys = keys.select(F.xxhash64("key").alias("k1"), F.xxhash64(F.lit(1), "key").alias("k2"), "doc_id", F.struct("row", "place").alias("at"))
    return keys.groupBy("k1", "k2", "doc_id").agg(F.collect_set("at").alias("at"))


def counts(refs: DataFrame) -> DataFrame:
    return refs.groupBy("k1", "k2").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper"))


def _shard(n: int) -> Column:
    return F.pmod(F.col("k1"), F.lit(n)).cast("int")


_FILTER = "shard int, buckets binary, stash array<bigint>"


def _filters(frequent: DataFrame, shards: int) -> DataFrame:
    """A filter for each shard of the keys; a shard has about SHARD_KEYS distinct keys, dealt by their hash."""

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        c = Cuckoo.of_size(len(rows))
        c.insert(rows["k1"].to_numpy(), rows["k2"].to_numpy())
        buckets, stash = c.dump()
        return pd.DataFrame({"shard": [int(rows["shard"].iloc[0])], "buckets": [buckets], "stash": [stash]})

    return frequent.select(_shard(shards).alias("shard"), "k1", "k2").groupBy("shard").applyInPandas(build, _FILTER)


@dataclass
class LineIndex:
    """State of incremental line dedup; each change makes a new index and leaves the old one as it is."""

    refs: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int
    least_docs: int = LEAST_DOCS

    @classmethod
    def build(cls, docs: DataFrame, least_docs: int = LEAST_DOCS, least_chars: int = LEAST_CHARS) -> "LineIndex":
        small_batches(docs.sparkSession)
        refs = cut(references(docs, least_chars), "line-refs")
        count = cut(counts(refs), "line-counts")
        frequent = count.where(F.col("n_docs") >= least_docs)
        shards = max(1, -(-frequent.count() // SHARD_KEYS))
        return cls(refs, count, cut(_filters(frequent, shards), "line-filters"), shards, least_docs)

    def insert(self, docs: DataFrame, least_chars: int = LEAST_CHARS) -> "LineIndex":
        """With more documents; a doc_id that is known already is replaced."""
        base = self.delete(docs.select("doc_id"))
        new = cut(references(docs, least_chars), "line-refs")
        refs = cut(base.refs.unionByName(new), "line-refs")
        count = base.counts.unionByName(counts(new)).groupBy("k1", "k2").agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"))
        return base._changed(refs, cut(count, "line-counts"))

    def delete(self, ids: DataFrame) -> "LineIndex":
        """Without the documents of these ids; counts of the keys that they held are taken anew from the references."""
        ids = ids.select("doc_id").where("doc_id IS NOT NULL").distinct()
        held = cut(self.refs.join(ids, "doc_id", "left_semi").select("k1", "k2").distinct(), "line-held")
        refs = cut(self.refs.join(ids, "doc_id", "left_anti"), "line-refs")
        again = counts(refs.join(held, ["k1", "k2"], "left_semi"))
        count = self.counts.join(held, ["k1", "k2"], "left_anti").unionByName(again)
        return self._changed(refs, cut(count, "line-counts"))

    def _changed(self, refs: DataFrame, count: DataFrame) -> "LineIndex":
        small_batches(refs.sparkSession)
        old = self.counts.where(F.col("n_docs") >= self.least_docs).select("k1", "k2")
        new = count.where(F.col("n_docs") >= self.least_docs).select("k1", "k2")
        changes = new.join(old, ["k1", "k2"], "left_anti").withColumn("enters", F.lit(True)).unionByName(old.join(new, ["k1", "k2"], "left_anti").withColumn("enters", F.lit(False))).withColumn("shard", _shard(self.shards))

        def update(found: pd.DataFrame, change: pd.DataFrame) -> pd.DataFrame:
            shard = int((found if len(found) else change)["shard"].iloc[0])
            c = Cuckoo.load(found["buckets"].iloc[0], list(found["stash"].iloc[0])) if len(found) else Cuckoo.of_size(len(change))
            for rows, f in ((change[~change["enters"]], c.delete), (change[change["enters"]], c.insert)):
                f(rows["k1"].to_numpy(), rows["k2"].to_numpy())
            buckets, stash = c.dump()
            return pd.DataFrame({"shard": [shard], "buckets": [buckets], "stash": [stash]})

        keys = new.count()
        if keys > GROWN * SHARD_KEYS * self.shards:
            shards = -(-keys // SHARD_KEYS)
            return LineIndex(refs, count, cut(_filters(new, shards), "line-filters"), shards, self.least_docs)
        filters = cut(self.filters.groupBy("shard").cogroup(changes.groupBy("shard")).applyInPandas(update, _FILTER), "line-filters")
        full = filters.where(F.size("stash") > STASHED).select("shard")
        if full.first() is not None:
            again = _filters(new.withColumn("shard", _shard(self.shards)).join(full, "shard", "left_semi").drop("shard"), self.shards)
            filters = cut(filters.join(full, "shard", "left_anti").unionByName(again), "line-filters")
        return LineIndex(refs, count, filters, self.shards, self.least_docs)

    def _parts(self, refs: DataFrame) -> DataFrame:
        """(shard, parts) of the shards that one group of probes is too few for. A table: their number grows with the data."""
        size = refs.groupBy(_shard(self.shards).alias("shard")).agg(F.ceil(F.count("*") / PROBES).cast("int").alias("parts"))
        return cut(size.where("parts > 1"), "line-parts")

    def probed(self, refs: DataFrame, hot: DataFrame | None = None) -> DataFrame:
        """The rows of refs whose key the filters may hold, and the part of its shard that each was probed in.

        A shard with many rows is dealt in parts, each with its own copy of the filter, which comes first in the sorted stream.
        """
        small_batches(refs.sparkSession)
        spark, hot = refs.sparkSession, self._parts(refs) if hot is None else hot
        parts = F.coalesce("parts", F.lit(1))
        rows = refs.select("k1", "k2", "doc_id", "at", _shard(self.shards).alias("shard")).join(hot, "shard", "left")
        rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id"), parts).cast("int")).drop("parts").withColumns({"buckets": F.lit(None).cast("binary"), "stash": F.lit(None).cast("array<bigint>"), "probe": F.lit(1)})
        filters = self.filters.join(hot, "shard", "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts").withColumns({"probe": F.lit(0)})
        stream = filters.unionByName(rows, allowMissingColumns=True).repartition(partitions(spark), "shard", "part").sortWithinPartitions("shard", "part", "probe")
        names = ["k1", "k2", "doc_id", "at", "part"]

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            owner, held = None, None
            for b in batches:
                if not b.num_rows:
                    continue
                shard, part, kind = (b.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "part", "probe"))
                k1, k2 = (b.column(c).fill_null(0).to_numpy(zero_copy_only=False) for c in ("k1", "k2"))
                keep = np.zeros(b.num_rows, bool)
                edges = np.flatnonzero((np.diff(shard) != 0) | (np.diff(part) != 0) | (np.diff(kind) != 0)) + 1
                for a, z in zip([0, *edges], [*edges, b.num_rows], strict=True):
                    if kind[a] == 0:
                        owner, held = (shard[a], part[a]), Cuckoo.load(b.column("buckets")[a].as_py(), b.column("stash")[a].as_py())
                    elif owner == (shard[a], part[a]):
                        keep[a:z] = held.may_hold(k1[a:z], k2[a:z])
                yield b.select(names).filter(pa.array(keep))

        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in refs.select("k1", "k2", "doc_id", "at").schema) + ", part int"
        return stream.mapInArrow(probe, schema)

    def drops(self, refs: DataFrame) -> DataFrame:
        """(doc_id, drops): the lines of each document to go, as rows and places. A frequent key stands once for each part of its shard, so the lines of a very common one are dealt over tasks."""
        hot = self._parts(refs)
        frequent = self.counts.where(F.col("n_docs") >= self.least_docs).select("k1", "k2", "keeper", _shard(self.shards).alias("shard")).join(hot, "shard", "left")
        frequent = cut(frequent.select("k1", "k2", "keeper", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part")), "line-frequent")
        gone = self.probed(refs, hot).join(frequent, ["k1", "k2", "part"]).where("doc_id <> keeper")
        return gone.groupBy("doc_id").agg(F.flatten(F.collect_list("at")).alias("drops"))


def dedup(docs: DataFrame, index: LineIndex | None = None, least_docs: int = LEAST_DOCS, least_chars: int = LEAST_CHARS) -> DataFrame:
    """docs with lines gone whose key is in at least least_docs documents, but in the largest doc_id; with `n_lines` and `n_dropped`.

    A null or empty text is one empty line, and an empty text afterwards. Keys
    under least_chars code points stay. Rows with one doc_id are one document.
    Rows with a null doc_id stay as they are. Other columns are kept, those named
    as the new ones are replaced.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("n_lines", "n_dropped")])
    gone, lines, row, kept = unused(docs, "_drops", "_lines", "_row", "_kept")
    with tables(docs.sparkSession):
        index = index or LineIndex.build(docs, least_docs, least_chars)
        drops = cut(index.drops(index.refs).withColumnRenamed("drops", gone), "line-drops", keep=True)
    found = docs.join(drops, "doc_id", "left").withColumns({lines: lines_of(F.col("text")), row: F.xxhash64("text")})
    places = F.transform(F.filter(gone, lambda d: d["row"] == F.col(row)), lambda d: d["place"])
    found = found.withColumn(kept, F.when(F.col(gone).isNull(), F.col(lines)).otherwise(F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), places), lambda i: F.get(lines, i))))
    columns = [F.array_join(kept, "\n").alias("text") if c == "text" else F.col(c) for c in docs.columns]
    return found.select(*columns, F.size(lines).cast("long").alias("n_lines"), (F.size(lines) - F.size(kept)).cast("long").alias("n_dropped"))
