"""Exact dedup: an index of live digests in cuckoo filters, whose hits are verified against the content.

The index has a row for each live document (its digest and which of the contents of
that digest it has), the contents, once each, and a cuckoo filter of the live
digests for each shard. Documents that come are first probed: the shards' filters
take their digests wave by wave, and a digest that its filter may hold already, or
that comes twice in a wave, is a hit. What misses is alone for certain, and its text need
not be compared. The whole texts of hits are compared with each other and with the
contents of the index, which are in buckets by their digests; copies are folded where
they are read. A digest whose last document is deleted leaves its filter; a filter
that overflows is built anew, twice as large, from the stored keys of its shard.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from annalist.llm.common import cut, owned, partitions, scratch, small_batches, tables
from annalist.llm.lines import STASHED, Cuckoo

#: Keys of a filter, on average.
SHARD_KEYS = 20_000
#: Waves, by document ids, in which the digests of a batch come to the filters and their rows learn their groups: a text with many copies is dealt over as many tasks.
WAVES = 16
#: Bytes of hits that are broadcast, so that texts are filtered where they are read; beyond, they are dealt by digest.
BROADCAST = 32 << 20
_SPACE = "[\\x20\\x09-\\x0D]+"
_FILTER = "shard int, buckets binary, stash array<bigint>"
_KEY = ["k1", "k2"]


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), _SPACE, "")


def digest(content: Column) -> tuple[Column, Column]:
    return F.xxhash64(content), F.xxhash64(F.lit(1), content)


def _keyed(docs: DataFrame, digest: Callable) -> DataFrame:
    """doc_id, n_chars, the digest, the wave and the whole normalised text."""
    rows = docs.select("doc_id", F.char_length(F.coalesce("text", F.lit(""))).alias("n_chars"), normalised(F.col("text")).alias("content"))
    k1, k2 = digest(F.col("content"))
    return rows.withColumns({"k1": k1.cast("long"), "k2": k2.cast("long"), "wave": F.pmod(F.xxhash64("doc_id"), F.lit(WAVES)).cast("int")})


def _shard(n: int) -> Column:
    return F.pmod(F.xxhash64(*_KEY), F.lit(n)).cast("int")


def _filter_of(k1: np.ndarray, k2: np.ndarray, size: int) -> Cuckoo:
    """A filter of distinct keys, doubled until next to nothing overflows. Equal fingerprints of many keys would overflow any size: those stay in the stash, which is exact."""
    size = max(size, len(k1))
    for _ in range(4):
        found = Cuckoo.of_size(size)
        found.insert(k1, k2)
        if len(found.stash) <= STASHED:
            break
        size *= 2
    return found


def _packed(shard: int, found: Cuckoo) -> pd.DataFrame:
    buckets, stash = found.dump()
    return pd.DataFrame({"shard": [shard], "buckets": [buckets], "stash": [stash]})


def _filters(keys: DataFrame, shards: int) -> DataFrame:
    """A filter for each shard of these distinct keys."""

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        return _packed(int(rows["shard"].iloc[0]), _filter_of(rows["k1"].to_numpy(), rows["k2"].to_numpy(), len(rows)))

    return keys.select(_shard(shards).alias("shard"), *_KEY).groupBy("shard").applyInPandas(build, _FILTER)


def _hits(come: DataFrame, filters: DataFrame | None, shards: int) -> DataFrame:
    """(k1, k2): digests that their shard's filter may hold when they come, or that come twice in a wave. come: a row for each digest and wave.

    The index's filter of a shard, which stands first in the sorted stream, is only
    read; another takes what is new and grows from its keys.
    """
    spark = come.sparkSession
    come = come.select(_shard(shards).alias("shard"), "wave", *_KEY, "twice")
    none = {"buckets": F.lit(None).cast("binary"), "stash": F.lit(None).cast("array<bigint>")}
    stream = come.withColumns(none) if filters is None else come.unionByName(filters.withColumn("wave", F.lit(-1)), allowMissingColumns=True)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner, old, new, stored = None, None, Cuckoo.of_size(1024), []
        for b in batches:
            if not b.num_rows:
                continue
            shard, wave = (b.column(c).to_numpy() for c in ("shard", "wave"))
            k1, k2 = (b.column(c).fill_null(0).to_numpy(zero_copy_only=False) for c in _KEY)
            hit = b.column("twice").fill_null(False).to_numpy(zero_copy_only=False).copy()
            edges = np.flatnonzero((np.diff(shard) != 0) | (np.diff(wave) != 0)) + 1
            for a, z in zip([0, *edges], [*edges, b.num_rows], strict=True):
                if shard[a] != owner:
                    owner, old, new, stored = shard[a], None, Cuckoo.of_size(1024), []
                if wave[a] < 0:
                    old = Cuckoo.load(b.column("buckets")[a].as_py(), b.column("stash")[a].as_py())
                    continue
                held = new.may_hold(k1[a:z], k2[a:z])
                if old is not None:
                    held |= old.may_hold(k1[a:z], k2[a:z])
                hit[a:z] |= held
                stored.append((k1[a:z][~held], k2[a:z][~held]))
                new.insert(*stored[-1])
                if len(new.stash) > STASHED:
                    stored = [tuple(np.concatenate(c) for c in zip(*stored, strict=True))]
                    new = _filter_of(*stored[0], 2 * new.table.size)
            yield b.select(_KEY).filter(pa.array(hit & (wave >= 0)))

    return stream.repartition(partitions(spark), "shard").sortWithinPartitions("shard", "wave").mapInArrow(probe, "k1 long, k2 long").distinct()


def _among(rows: DataFrame, hits: DataFrame, n_hits: int) -> DataFrame:
    """The rows of these digests. Few hits go to where the rows are read; many, by digest."""
    return rows.join(F.broadcast(hits) if 16 * n_hits <= BROADCAST else hits, _KEY, "left_semi")


@dataclass
class _Batch:
    """What is known of documents that came: their keys; of those whose digest was a hit, (k1, k2, content, known, n, keep); the digests with several contents."""

    keyed: DataFrame
    keys: DataFrame
    come: DataFrame
    hits: DataFrame
    n_hits: int
    contents: DataFrame
    crowd: DataFrame


def _compare(docs: DataFrame, index: "ExactIndex | None", digest: Callable) -> _Batch:
    small_batches(docs.sparkSession)
    keyed = _keyed(docs, digest)
    keys = cut(keyed.select("doc_id", "n_chars", *_KEY, "wave", F.unhex(F.sha2("content", 256)).alias("sha")), "exact-keys")
    come = cut(keys.groupBy(*_KEY, "wave").agg((F.count("*") > 1).alias("twice")), "exact-come")
    shards = index.shards if index else max(1, -(-come.count() // SHARD_KEYS))
    hits = cut(_hits(come, index.filters if index else None, shards), "exact-hits")
    n_hits = hits.count()
    # a copy is folded into a row for its task, content and length before anything is dealt
    texts = _among(keyed, hits, n_hits).groupBy(*_KEY, "content", "n_chars").agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id"))
    texts = texts.withColumn("known", F.lit(None).cast("int"))
    if index:
        texts = texts.unionByName(_among(index.contents.drop("bucket").withColumnRenamed("variant", "known"), hits, n_hits), allowMissingColumns=True)
    contents = cut(texts.groupBy(*_KEY, "content").agg(F.max("known").alias("known"), F.sum("n").alias("n"), F.min(_first()).alias("first")), "exact-contents")
    crowd = cut(contents.groupBy(*_KEY).agg(F.count("*").alias("m")).where("m > 1").select(*_KEY), "exact-crowd")
    return _Batch(keyed, keys, come, hits, n_hits, contents, crowd)


def _first() -> Column:
    """Least for the row that stays: most code points, then the smallest doc_id, a null one last; rows of the index don't count."""
    return F.when(F.col("n_chars").isNotNull(), F.struct((-F.col("n_chars")).alias("less"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc_id")))


def _variants(batch: _Batch) -> DataFrame:
    """The contents with `variant`, which tells apart contents of one digest: 0 but for those; known ones keep theirs."""
    alone = batch.contents.join(batch.crowd, _KEY, "left_anti").withColumn("variant", F.coalesce("known", F.lit(0)))
    of = Window.partitionBy(*_KEY)
    several = batch.contents.join(batch.crowd, _KEY, "left_semi").withColumn("place", F.row_number().over(of.orderBy(F.col("known").isNotNull(), "content")))
    several = several.withColumn("variant", F.coalesce("known", F.coalesce(F.max("known").over(of), F.lit(-1)) + F.col("place"))).drop("place")
    return alone.unionByName(several)


def _rows(batch: _Batch, variants: DataFrame, columns: list[str]) -> DataFrame:
    """The keys with `variant` and columns of their contents, null for what missed. Rows of one digest are dealt by their waves; only those of a digest with several contents meet them by text."""
    found = variants.select(*_KEY, "variant", *columns)
    waves = _among(batch.come.select(*_KEY, "wave"), batch.hits, batch.n_hits).join(batch.crowd, _KEY, "left_anti").join(found, _KEY)
    keys = batch.keys.join(batch.crowd, _KEY, "left_anti").join(waves, [*_KEY, "wave"], "left")
    again = _among(batch.keyed, batch.crowd, batch.n_hits).withColumn("sha", F.unhex(F.sha2("content", 256))).join(variants.select(*_KEY, "content", "variant", *columns), [*_KEY, "content"]).select(keys.columns)
    return keys.unionByName(again)


def dedup(docs: DataFrame, digest: Callable[[Column], tuple[Column, Column]] = digest) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), a row for each row of docs.

    Texts are equal if they are without the characters [\\x20\\x09-\\x0D]; null counts
    as empty, and empty texts are equal. Of equal texts the one with the most code
    points before that stays, then the smallest doc_id (any type; null last). Rows of
    one doc_id and length are marked alike. Other columns play no part. An empty
    table gives no rows. digest may be any two numbers that equal texts share: what
    it mixes up, the comparison parts.
    """
    with tables(docs.sparkSession):
        batch = _compare(docs.select("doc_id", "text"), None, digest)
        rows = cut(_rows(batch, _variants(batch), ["n", "first"]), "exact-rows", keep=True)
    alone = F.col("first").isNull()
    keep = F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id"))
    kept = alone | (keep.eqNullSafe(F.col("doc_id")) & (F.col("first.less") == -F.col("n_chars")))
    return rows.select("doc_id", keep.alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), kept.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


@dataclass
class ExactIndex:
    """State of incremental exact dedup; each change makes a new index and leaves the old one as it is.

    rows: (doc_id, n_chars, k1, k2, variant, sha) of live documents; contents: (bucket,
    k1, k2, variant, content) in folders by bucket, each live content once.
    """

    rows: DataFrame
    contents: DataFrame
    filters: DataFrame
    shards: int
    digest: Callable[[Column], tuple[Column, Column]] = digest

    @classmethod
    def build(cls, docs: DataFrame, digest: Callable[[Column], tuple[Column, Column]] = digest) -> "ExactIndex":
        batch = _compare(docs.select("doc_id", "text"), None, digest)
        variants = _variants(batch)
        rows = cut(_rows(batch, variants, []).select("doc_id", "n_chars", *_KEY, F.coalesce("variant", F.lit(0)).alias("variant"), "sha"), "exact-rows")
        keys = rows.select(*_KEY).distinct()
        shards = max(1, -(-keys.count() // SHARD_KEYS))
        return cls(rows, cls._stored(cls._new_contents(batch, variants), shards), cut(_filters(keys, shards), "exact-filters"), shards, digest)

    @staticmethod
    def _new_contents(batch: _Batch, variants: DataFrame) -> DataFrame:
        fresh = variants.where("known IS NULL").select(*_KEY, "variant", "content")
        missed = batch.keyed.join(F.broadcast(batch.hits) if 16 * batch.n_hits <= BROADCAST else batch.hits, _KEY, "left_anti")
        return fresh.unionByName(missed.select(*_KEY, F.lit(0).alias("variant"), "content"))

    @staticmethod
    def _stored(contents: DataFrame, shards: int) -> DataFrame:
        spark, path = contents.sparkSession, scratch(contents.sparkSession, "exact-content")
        contents = contents.select(*_KEY, "variant", "content", _shard(shards).alias("bucket"))
        contents.repartition(partitions(spark), "bucket").write.partitionBy("bucket").parquet(path)
        owned(spark, path)
        return spark.read.schema(contents.schema).parquet(path)

    def insert(self, docs: DataFrame) -> "ExactIndex":
        """With more documents; a doc_id that is known already is replaced. Rows of one doc_id in docs are one document each."""
        base = self.delete(docs.select("doc_id"))
        batch = _compare(docs.select("doc_id", "text"), base, self.digest)
        variants = _variants(batch)
        new = _rows(batch, variants, []).select("doc_id", "n_chars", *_KEY, F.coalesce("variant", F.lit(0)).alias("variant"), "sha")
        rows = cut(base.rows.unionByName(new), "exact-rows")
        return base._changed(rows, base.contents.drop("bucket").unionByName(self._new_contents(batch, variants)))

    def delete(self, ids: DataFrame) -> "ExactIndex":
        """Without the documents of these ids; a content goes with its last document."""
        ids = ids.select("doc_id").where("doc_id IS NOT NULL").distinct()
        rows = cut(self.rows.join(ids, "doc_id", "left_anti"), "exact-rows")
        live = rows.select(*_KEY, "variant").distinct()
        return self._changed(rows, self.contents.drop("bucket").join(live, [*_KEY, "variant"], "left_semi"))

    def _changed(self, rows: DataFrame, contents: DataFrame) -> "ExactIndex":
        small_batches(rows.sparkSession)
        before, after = self.rows.select(*_KEY).distinct(), cut(rows.select(*_KEY).distinct(), "exact-live")
        changes = after.join(before, _KEY, "left_anti").withColumn("enters", F.lit(True)).unionByName(before.join(after, _KEY, "left_anti").withColumn("enters", F.lit(False))).withColumn("shard", _shard(self.shards))

        def update(found: pd.DataFrame, change: pd.DataFrame) -> pd.DataFrame:
            shard = int((found if len(found) else change)["shard"].iloc[0])
            c = Cuckoo.load(found["buckets"].iloc[0], list(found["stash"].iloc[0])) if len(found) else Cuckoo.of_size(len(change))
            for part, f in ((change[~change["enters"]], c.delete), (change[change["enters"]], c.insert)):
                f(part["k1"].to_numpy(), part["k2"].to_numpy())
            return _packed(shard, c)

        filters = cut(self.filters.groupBy("shard").cogroup(changes.groupBy("shard")).applyInPandas(update, _FILTER), "exact-filters")
        full = filters.where(F.size("stash") > STASHED).select("shard")
        if not full.isEmpty():
            again = _filters(after.withColumn("shard", _shard(self.shards)).join(full, "shard", "left_semi").drop("shard"), self.shards)
            filters = cut(filters.join(full, "shard", "left_anti").unionByName(again), "exact-filters")
        return ExactIndex(rows, self._stored(contents, self.shards), filters, self.shards, self.digest)

    def groups(self) -> DataFrame:
        """(k1, k2, variant, keep_id, group_size) of live contents."""
        found = self.rows.groupBy(*_KEY, "variant").agg(F.count("*").alias("group_size"), F.min(_first()).alias("first"))
        return found.select(*_KEY, "variant", F.col("first.doc_id").alias("keep_id"), "group_size")
