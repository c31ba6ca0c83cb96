"""Histories: what an entity has had so far, and when its state changed."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from annalist.functions.coerce import trimmed


def clean_list(values: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(F.transform(values, trimmed), lambda v: v.isNotNull() & (v != ""))))


def values_of(rows: DataFrame) -> DataFrame:
    """A row for each value of the list `_own`, and one for a list without any."""
    return rows.select("_seg", "_place", "_row", F.size("_own").alias("_size"), F.explode_outer("_own").alias("_v"))


def cumulative(df: DataFrame, id_col: str, order: list[str], list_col: str, prefix: str) -> DataFrame:
    """df with `<prefix>hist`, `_n_uniq`, `_main` and `_main_n` of the list column up to each row.

    Values are trimmed, not empty, and once a row. The main value is the most
    frequent so far; on ties the row's own if it has one value (though it be none
    of the tied), else the smallest. A row without values has nulls. All windows
    are within an id, so rows are dealt once; a value's count is its place among
    the rows that have it, and the best so far are running minima and maxima, so
    that a row costs its own values and, for `hist`, the distinct ones so far. An id
    is one task's work; for ids of very many rows see scans.cumulative.
    """
    rows = df.select(F.col(id_col).alias("_seg"), F.struct(*df.columns).alias("_row"), clean_list(F.col(list_col)).alias("_own"))
    rows = rows.withColumn("_place", F.row_number().over(Window.partitionBy("_seg").orderBy(*[F.col("_row")[c] for c in order])))
    return running(values_of(rows), df.columns, prefix, id_col=id_col)


def running(each: DataFrame, columns: list[str], prefix: str, counts: DataFrame | None = None, starts: DataFrame | None = None, id_col: str | None = None) -> DataFrame:
    """The histories of rows (a row for each value), by segments `_seg`. counts (_seg, _v, _w) and starts (_seg, _top, _best, _set) are what segments start from, if not from nothing. With id_col, segments are ids, and stay what the result is dealt by."""
    h, n, main, main_n = (f"{prefix}{s}" for s in ("hist", "n_uniq", "main", "main_n"))
    before, known = F.lit(-1).cast("long"), F.col("_v").isNotNull()
    if counts is None:
        each = each.withColumn("_n", F.when(known, F.row_number().over(Window.partitionBy("_seg", "_v").orderBy("_place"))))
        # which of the values that came to this count it is
        each = each.withColumn("_k", F.row_number().over(Window.partitionBy("_seg", "_n").orderBy("_place", "_v")))
        each = each.withColumns({"_start_top": F.lit(None).cast("struct<n:bigint,k:bigint>"), "_start_best": F.lit(None).cast("struct<n:bigint,v:string>"), "_set": F.lit(None).cast("array<string>")})
    else:
        to_here = lambda *by: Window.partitionBy("_seg", *by).orderBy("_place", "_v").rowsBetween(Window.unboundedPreceding, 0)
        each = each.withColumn("_w", F.lit(1).cast("long")).unionByName(counts.withColumn("_place", before), allowMissingColumns=True)
        each = each.withColumn("_n", F.when(known, F.sum("_w").over(to_here("_v")))).where(F.col("_place") >= 0).withColumn("_w", F.lit(1).cast("long"))
        first = starts.select("_seg", before.alias("_place"), F.col("_top.n").alias("_n"), F.col("_top.k").alias("_w"), F.col("_top").alias("_start_top"), F.col("_best").alias("_start_best"), "_set")
        each = each.unionByName(first, allowMissingColumns=True).withColumn("_k", F.sum("_w").over(to_here("_n")))
    each = each.groupBy("_seg", "_place").agg(
        F.first("_row").alias("_row"), F.max("_size").alias("_size"), F.min("_v").alias("_first"), F.min(F.when(known, F.col("_n"))).alias("_first_n"),
        F.coalesce(F.first("_set"), F.collect_list(F.when(F.col("_n") == 1, F.col("_v")))).alias("_new"),
        F.coalesce(F.first("_start_best"), F.min(F.when(known, F.struct((-F.col("_n")).cast("long").alias("n"), F.col("_v").alias("v"))))).alias("_best"),
        F.coalesce(F.first("_start_top"), F.max(F.when(known, F.struct(F.col("_n").cast("long").alias("n"), F.col("_k").cast("long").alias("k"))))).alias("_top"),
    )
    w = Window.partitionBy("_seg").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    # lists are collected of the rows that bring something new, or each row would cost as many empty ones as there are rows before it
    each = each.withColumn("_new", F.when(F.size("_new") > 0, F.col("_new")))
    run = each.withColumns({"_all": F.flatten(F.collect_list("_new").over(w)), "_best": F.min("_best").over(w), "_top": F.max("_top").over(w)})
    some, tie = F.col("_size") > 0, (F.col("_top.k") > 1) & (F.col("_size") == 1)
    out = {
        h: F.when(some, F.array_sort("_all")),
        n: F.when(some, F.size("_all").cast("bigint")),
        main: F.when(some, F.when(tie, F.col("_first")).otherwise(F.col("_best.v"))),
        main_n: F.when(some, F.when(tie, F.col("_first_n")).otherwise(F.col("_top.n")).cast("bigint")),
    }
    run = run if counts is None else run.where(F.col("_place") >= 0)
    return run.select(*[(F.col("_seg") if c == id_col else F.col("_row")[c]).alias(c) for c in columns if c not in out], *[v.alias(k) for k, v in out.items()])


def between_change(column: str, w) -> Column:
    """1 if a row's set has a value that the row just before lacks, both being there."""
    before = F.lag(column).over(w)
    return F.coalesce(F.size(F.array_except(column, before)) > 0, F.lit(False)).cast("int")


def changed(columns: list[str], w, threshold: int) -> Column:
    """1 if enough columns differ from the row before, or enough hold several values."""
    between = [between_change(c, w) for c in columns]
    within = [F.coalesce(F.size(c) > 1, F.lit(False)).cast("int") for c in columns]
    return ((sum(between[1:], between[0]) >= threshold) | (sum(within[1:], within[0]) >= threshold)).cast("bigint")


def state_changes(df: DataFrame, id_col: str, order: list[str], columns: list[str], prefix: str, threshold: int = 1) -> DataFrame:
    """df with `<prefix>changed`, `_n_chg` (so far) and `_ever`: enough columns differ from the row before, or enough hold several values. For ids of very many rows see scans.state_changes."""
    w = Window.partitionBy(id_col).orderBy(*order)
    out = df.withColumn(f"{prefix}changed", changed(columns, w, threshold))
    out = out.withColumn(f"{prefix}n_chg", F.sum(f"{prefix}changed").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return out.withColumn(f"{prefix}ever", (F.col(f"{prefix}n_chg") > 0).cast("bigint"))


def cumcount(keys: list[str], order: list) -> Column:
    """0-based place of a row in its group."""
    return (F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1).cast("bigint")


def first_known(column: str, keys: list[str], order: list) -> Column:
    """The first value at or after the row in its group."""
    return F.first(column, ignorenulls=True).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(0, Window.unboundedFollowing))
