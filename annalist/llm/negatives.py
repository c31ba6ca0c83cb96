"""Hard-negative mining by bit-sliced integer products.

Rows are packed in blocks, their components as bit planes. A block of anchors meets
a block of rows: the planes are multiplied one by one, the most significant first.
After plane k each score lies within the product so far and what the lower k bits
can still add, at least -(2^k - 1) times the sum of an anchor's negative components
and at most as many times that of its positive ones. A candidate goes once its
interval misses every band of scores that is asked for, or once as many others as
are asked for are surely better. What is left at the last plane is exact.

Positives are the best of one unbounded band; the negatives of each positive are
the best of its band. Blocks of all anchors meet blocks of all rows, each pair of
blocks in a task of its own; a task holds one matrix of scores of a fixed size.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from annalist.llm.common import cut, small_batches, tables

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: Scores of negatives, in hundredths of the positive's.
LOW, HIGH = 30, 90
#: Rows and anchors of a block, about: together a matrix of 2 million scores.
ROWS, ANCHORS = 4096, 512
#: A component has fewer bits, so that products of up to 65536 components fit.
BITS = 23
_LEAST, _MOST = -(1 << 62), 1 << 62


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, x as double; null for a null vector and one with a component that is null or not finite. A component too large for exact products is an error."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    whole = F.transform(whole, lambda x: F.when(F.abs(x) < (1 << BITS), x.cast("int")).otherwise(F.raise_error(F.lit(f"a component has more than {BITS} bits"))))
    return F.when(finite, whole)


def items(vectors: DataFrame) -> DataFrame:
    """(id, label, vector) with one row per id: rows without an id, label or vector take no part, and of those that share an id the least by label, then vector."""
    known = vectors.where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    return known.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("x")).select("id", F.col("x.label").cast("long").alias("label"), "x.vector")


def _matrix(column: pa.ChunkedArray, dtype) -> np.ndarray:
    """Lists as rows, shorter ones filled with zeros."""
    lists = column.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0)
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), dtype)
    out[np.arange(out.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _numbers(column: pa.ChunkedArray) -> bytes:
    return column.to_numpy().astype(np.int64).tobytes()


def _row_blocks(rows: DataFrame, n: int) -> DataFrame:
    """(b, ids, labels, width, planes): plane k holds bit k of all components in two's complement, a bit row for each component."""

    def pack(t: pa.Table) -> pa.Table:
        x = _matrix(t.column("vector"), np.int64).T
        width = max(int(x.max(initial=0)).bit_length(), int(~x.min(initial=0)).bit_length()) + 1
        planes = b"".join(np.packbits((x >> k & 1).astype(np.uint8), axis=1).tobytes() for k in range(width))
        return pa.table({"b": pa.array([t.column("b")[0].as_py()], pa.int32()), "ids": [_numbers(t.column("id"))], "labels": [_numbers(t.column("label"))], "width": pa.array([width], pa.int32()), "planes": [planes]})

    return rows.withColumn("b", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")).groupBy("b").applyInArrow(pack, "b int, ids binary, labels binary, width int, planes binary")


def _anchor_blocks(anchors: DataFrame, n: int) -> DataFrame:
    """(a, anchors, anchor_labels, size, components, n_bands, lows, highs)"""

    def pack(t: pa.Table) -> pa.Table:
        x = _matrix(t.column("vector"), np.int32)
        lows, highs = _matrix(t.column("lows"), np.int64), _matrix(t.column("highs"), np.int64)
        short = lows.shape[1]
        sizes = np.array([len(v) for v in t.column("lows").to_pylist()], np.int64)
        lows[np.arange(short) >= sizes[:, None]] = _MOST  # no band: its low end is above its high end
        return pa.table({"a": pa.array([t.column("a")[0].as_py()], pa.int32()), "anchors": [_numbers(t.column("id"))], "anchor_labels": [_numbers(t.column("label"))], "size": pa.array([x.shape[1]], pa.int32()), "components": [x.tobytes()], "n_bands": pa.array([short], pa.int32()), "lows": [lows.tobytes()], "highs": [highs.tobytes()]})

    return anchors.withColumn("a", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")).groupBy("a").applyInArrow(pack, "a int, anchors binary, anchor_labels binary, size int, components binary, n_bands int, lows binary, highs binary")


def _still(low: np.ndarray, high: np.ndarray, bands: np.ndarray, most: int) -> np.ndarray:
    """Which intervals may hold a score that is among the most best of one of the bands."""
    out = np.zeros(len(low), bool)
    for least, top in bands:
        if least > top:
            continue
        may = (high >= least) & (low <= top)
        sure = low[may & (low >= least) & (high <= top)]
        if len(sure) >= most:
            may &= high >= np.partition(sure, len(sure) - most)[len(sure) - most]
        out |= may
    return out


def best(anchors: np.ndarray, planes: np.ndarray, alive: np.ndarray, bands: np.ndarray, most: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(anchor, band, columns, scores): of the columns alive for an anchor, those that may be among its most best in a band, exactly scored (ties over the number included).

    planes: (width, components, bytes) of packed bits; bands: (anchors, bands, 2).
    """
    up, down = anchors.clip(min=0).sum(1), anchors.clip(max=0).sum(1)
    whole = anchors.astype(np.float32 if np.abs(anchors).sum(1).max(initial=0) < 1 << 24 else np.float64)
    columns, scores = np.arange(alive.shape[1]), np.zeros(alive.shape, np.int64)
    for k in reversed(range(len(planes))):
        here = alive.any(0)
        if not here.all():
            columns, scores, alive = columns[here], scores[:, here], alive[:, here]
        bits = np.unpackbits(planes[k], axis=1)[:, columns].astype(whole.dtype)
        part = (whole @ bits).astype(np.int64)
        scores += -(part << k) if k == len(planes) - 1 else part << k
        rest = (1 << k) - 1
        for i in range(len(anchors)):
            at = np.flatnonzero(alive[i])
            alive[i, at] = _still(scores[i, at] + rest * down[i], scores[i, at] + rest * up[i], bands[i], most)
    for i in range(len(anchors)):
        at = np.flatnonzero(alive[i])
        for j, (least, top) in enumerate(bands[i]):
            inside = at[(scores[i, at] >= least) & (scores[i, at] <= top)]
            yield i, j, columns[inside], scores[i, inside]


def _searched(anchors: DataFrame, rows: DataFrame, n_a: int, n_b: int, same: bool, most: int) -> DataFrame:
    """(anchor_id, band, id, score, rank): for each anchor and band the best rows of its label, but for itself, or of others."""
    tasks = 2 * n_a * n_b
    left = _anchor_blocks(anchors, n_a).withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(n_b - 1)))).repartition(tasks, "a", "b")
    right = rows.withColumn("a", F.explode(F.sequence(F.lit(0), F.lit(n_a - 1)))).repartition(tasks, "a", "b")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                x = {name: batch.column(name)[r].as_py() for name in batch.schema.names}
                ids, labels, mine, my_labels = (np.frombuffer(x[c], np.int64) for c in ("ids", "labels", "anchors", "anchor_labels"))
                vectors = np.frombuffer(x["components"], np.int32).reshape(len(mine), x["size"]).astype(np.int64)
                planes = np.frombuffer(x["planes"], np.uint8).reshape(x["width"], -1, -(-len(ids) // 8)) if x["planes"] else np.zeros((x["width"], 0, -(-len(ids) // 8)), np.uint8)
                shared = min(vectors.shape[1], planes.shape[1])
                bands = np.stack([np.frombuffer(x[c], np.int64).reshape(len(mine), x["n_bands"]) for c in ("lows", "highs")], 2)
                alike = my_labels[:, None] == labels
                alive = alike & (mine[:, None] != ids) if same else ~alike
                alive &= (bands[:, :, 0] <= bands[:, :, 1]).any(1)[:, None]
                out: list[list[np.ndarray]] = [[], [], [], []]
                for i, j, at, scores in best(vectors[:, :shared], planes[:, :shared], alive, bands, most):
                    first = np.lexsort((ids[at], -scores))[:most]
                    for column, v in zip(out, (np.full(len(first), mine[i]), np.full(len(first), j, np.int32), ids[at[first]], scores[first]), strict=True):
                        column.append(v)
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=["anchor_id", "band", "id", "score"])

    met = left.join(right, ["a", "b"]).mapInArrow(search, "anchor_id long, band int, id long, score long")
    order = Window.partitionBy("anchor_id", "band").orderBy(F.desc("score"), "id")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mine(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of (id, label, vector of whole numbers).

    Of an anchor (an item where is_anchor, a column on id, holds), the positives are
    the best other items of its label, the negatives of each the best items of other
    labels with low to high hundredths of the positive's score. Higher scores come
    first, ties by the smaller id. Which rows are items, items() says. A shorter
    vector is filled with zeros; an empty one has a score of 0 with all. Without
    rows, anchors or matching negatives there are no rows; other columns play no part.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    with tables(spark):
        rows = cut(items(vectors.select("id", "label", "vector")), "negatives-items")
        n, n_anchors = rows.agg(F.count("*"), F.count_if(is_anchor)).first()
        n_a, n_b = max(1, -(-n_anchors // ANCHORS)), max(1, -(-n // ROWS))
        blocks = cut(_row_blocks(rows, n_b), "negatives-blocks")
        anchors = rows.where(is_anchor)
        all_ = anchors.withColumns({"lows": F.array(F.lit(_LEAST)), "highs": F.array(F.lit(_MOST))})
        found = cut(_searched(all_, blocks, n_a, n_b, True, positives).select("anchor_id", "id", "score", "rank"), "negatives-positives", keep=True)
        # the whole numbers from low to high hundredths of the score; none if it is negative
        bands = F.array_sort(F.collect_list(F.struct("rank", F.expr(f"(score * {int(low)} + 99) div 100").alias("low"), F.expr(f"score * {int(high)} div 100").alias("high"), "score")))
        bands = F.transform(bands, lambda x: F.when((x["score"] >= 0) & (x["low"] <= x["high"]), F.struct(x["rank"].alias("rank"), x["low"].alias("low"), x["high"].alias("high"))).otherwise(F.struct(x["rank"].alias("rank"), F.lit(_MOST).alias("low"), F.lit(_LEAST).alias("high"))))
        of = found.groupBy(F.col("anchor_id").alias("id")).agg(bands.alias("x"))
        of = anchors.join(of, "id").select("id", "label", "vector", F.col("x.low").alias("lows"), F.col("x.high").alias("highs"))
        hard = cut(_searched(of, blocks, n_a, n_b, False, negatives), "negatives-found", keep=True)
    hard = hard.select("anchor_id", (F.col("band") + 1).alias("place"), F.col("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    found = found.select("anchor_id", F.col("rank").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return hard.join(found, ["anchor_id", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
