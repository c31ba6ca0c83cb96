"""Histories of entities that are too long for one task: scans in two levels.

Rows are dealt in blocks by ranges of entity and order, so that a long entity spans
several blocks and no block has more than its share. What each block of an entity
adds up to is one row; windows over these rows tell what every block starts from.
That comes into the block as rows before its first (or after its last), and the
windows of the scan then run within the blocks.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from annalist.operators import history
from annalist.sources.store import Store

#: Rows of a block, about.
BLOCK_ROWS = 1_000_000
_BEFORE, _AFTER = -1, (1 << 63) - 1


def blocked(df: DataFrame, id_col: str, order: list[str], rows: int = BLOCK_ROWS, store: Store | None = None) -> DataFrame:
    """df, written sorted by id and order, with `_seg` (the id and its block) and `_place` (the order of all rows of an id, and of blocks)."""
    store = store or Store.scratch(df.sparkSession)
    blocks = max(1, -(-df.count() // rows))
    dealt = df.repartitionByRange(blocks, F.col(id_col), *[F.col(c) for c in order]).sortWithinPartitions(id_col, *order)
    written = store.write("blocks", dealt.withColumn("_place", F.monotonically_increasing_id())).read(df.sparkSession)
    # a struct, as parts of structs match null with null
    return written.withColumn("_seg", F.struct(F.col(id_col).alias("id"), F.shiftright("_place", 33).alias("block")))


def _carried(ends: DataFrame, values: dict[str, Column]) -> DataFrame:
    """(_seg, values) of a table with a row for each block of each entity; values are windows made for (entity, before the block)."""
    return ends.select("_seg", *[v.alias(n) for n, v in values.items()])


def _entity(back: bool = True):
    w = Window.partitionBy("_seg.id").orderBy("_seg.block")
    return w.rowsBetween(Window.unboundedPreceding, -1) if back else w.rowsBetween(1, Window.unboundedFollowing)


def cumulative(df: DataFrame, id_col: str, order: list[str], list_col: str, prefix: str, rows: int = BLOCK_ROWS, store: Store | None = None) -> DataFrame:
    """history.cumulative for entities of any length: the same values.

    A block starts from the counts so far of the values that it has, the distinct
    values so far (which each of its rows would list anyway), the highest count, how
    many values have it and the smallest of these. As counts only grow, a value with
    the highest count so far reached it in the last block that had it, so blocks'
    own highest counts are enough to tell that.
    """
    store = store or Store.scratch(df.sparkSession)
    at = blocked(df, id_col, order, rows, store)
    each = history.values_of(at.select("_seg", "_place", F.struct(*df.columns).alias("_row"), history.clean_list(F.col(list_col)).alias("_own")))
    so_far = Window.partitionBy("_seg.id", "_v").orderBy("_seg.block").rowsBetween(Window.unboundedPreceding, -1)
    counts = each.where("_v IS NOT NULL").groupBy("_seg", "_v").agg(F.count("*").alias("_c")).withColumn("_prior", F.coalesce(F.sum("_c").over(so_far), F.lit(0)))
    counts = store.write("counts", counts).read(df.sparkSession)
    ends = counts.groupBy("_seg", (F.col("_prior") + F.col("_c")).alias("_n")).agg(F.count("*").alias("_k"), F.min("_v").alias("_v"))
    ends = ends.groupBy("_seg").agg(F.max(F.struct("_n", "_k", "_v")).alias("x")).select("_seg", "x.*")
    new = counts.where("_prior = 0").groupBy("_seg").agg(F.collect_list("_v").alias("_set"))
    ends = ends.join(new, "_seg", "left")
    reached = Window.partitionBy("_seg.id", "_n").orderBy("_seg.block").rowsBetween(Window.unboundedPreceding, 0)
    ends = ends.withColumn("_k", F.sum("_k").over(reached))
    before = _entity()
    starts = _carried(ends, {
        "_top": F.max(F.struct(F.col("_n").alias("n"), F.col("_k").alias("k"))).over(before),
        "_best": F.min(F.struct((-F.col("_n")).alias("n"), F.col("_v").alias("v"))).over(before),
        "_set": F.flatten(F.collect_list("_set").over(before)),
    }).where("_top IS NOT NULL")
    return history.running(each, df.columns, prefix, counts.where("_prior > 0").select("_seg", "_v", F.col("_prior").alias("_w")), starts)


def _with(rows: DataFrame, starts: DataFrame, place: int) -> DataFrame:
    """rows with one more for each block, at a place before or after all."""
    return rows.unionByName(starts.withColumn("_place", F.lit(place).cast("long")), allowMissingColumns=True)


def state_changes(df: DataFrame, id_col: str, order: list[str], columns: list[str], prefix: str, threshold: int = 1, rows: int = BLOCK_ROWS, store: Store | None = None) -> DataFrame:
    """history.state_changes for entities of any length: a block starts from the last row before it, and the changes so far."""
    at = blocked(df, id_col, order, rows, store)
    last = at.groupBy("_seg").agg(F.max_by(F.struct(*columns), "_place").alias("_last"))
    before = Window.partitionBy("_seg.id").orderBy("_seg.block")
    starts = _carried(last, {"_last": F.lag("_last").over(before)}).where("_last IS NOT NULL").select("_seg", "_last.*")
    within = Window.partitionBy("_seg").orderBy("_place")
    flagged = _with(at, starts, _BEFORE).withColumn("_changed", history.changed(columns, within, threshold)).where(F.col("_place") >= 0)
    sums = flagged.groupBy("_seg").agg(F.sum("_changed").alias("_n"))
    starts = _carried(sums, {"_changed": F.sum("_n").over(_entity())}).where("_changed > 0")
    out = _with(flagged, starts, _BEFORE).withColumn("_total", F.sum("_changed").over(within.rowsBetween(Window.unboundedPreceding, 0))).where(F.col("_place") >= 0)
    told = {f"{prefix}changed": F.col("_changed"), f"{prefix}n_chg": F.col("_total"), f"{prefix}ever": (F.col("_total") > 0).cast("bigint")}
    return out.select(*[F.col(c) for c in df.columns if c not in told], *[v.alias(k) for k, v in told.items()])


def first_known(df: DataFrame, id_col: str, order: list[str], columns: list[str], rows: int = BLOCK_ROWS, store: Store | None = None) -> DataFrame:
    """df with each column's first value at or after the row in its entity, for entities of any length: a block ends with the first values after it."""
    at = blocked(df, id_col, order, rows, store)
    firsts = at.groupBy("_seg").agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_place"))).alias(c) for c in columns])
    after = _entity(back=False)
    ends = _carried(firsts, {c: F.first(c, ignorenulls=True).over(after) for c in columns})
    # from the last row on: a frame that ends at the row is kept up, one that begins there is gone through for each row
    within = Window.partitionBy("_seg").orderBy(F.desc("_place")).rowsBetween(Window.unboundedPreceding, 0)
    out = _with(at, ends, _AFTER)
    out = out.withColumns({f"_known_{c}": F.last(c, ignorenulls=True).over(within) for c in columns}).where(F.col("_place") < _AFTER)
    return out.select(*[F.col(f"_known_{c}").alias(c) if c in columns else F.col(c) for c in df.columns])
