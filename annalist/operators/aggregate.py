"""Aggregations: collapsing, typed duplicates, conflicts, coverage, pivots, equivalent columns and row merging."""

import difflib
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from annalist.functions.coerce import trimmed
from annalist.operators.frames import unpivot
from annalist.sources.store import Store


def collapse(df: DataFrame, keys: list[str], columns: list[str], out: str) -> DataFrame:
    """(keys, out): sorted distinct trimmed values of several columns; groups without any are absent, a null key is a group."""
    rows = unpivot(df, keys, columns).withColumn("value", trimmed(F.col("value"))).where("value <> ''")
    return rows.groupBy(*keys).agg(F.array_sort(F.collect_set("value")).alias(out))


def agree_or_null(df: DataFrame, keys: list[str], columns: list[str], out: str) -> DataFrame:
    """(keys, out): the one value that the columns have, null if they have several."""
    rows = unpivot(df, keys, columns).withColumn("value", trimmed(F.col("value"))).where("value <> ''")
    return rows.groupBy(*keys).agg(F.when(F.min("value") == F.max("value"), F.min("value")).alias(out))


def typed_duplicates(df: DataFrame, keys: list[str], means: list[str], sums: list[str], texts: list[str], order: list[str]) -> DataFrame:
    """One row per key. Numbers are averaged or summed and texts listed, but only where a group has more than one value; else the first row's value (may be null)."""
    # one least row for all columns, its fields being the order and then the values
    values = [*means, *sums, *texts]
    least = F.min(F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], *[F.col(c).alias(f"_v{i}") for i, c in enumerate(values)]))
    parts = [f(c).alias(f"{n}_{c}") for c in values for n, f in (("_lo", F.min), ("_hi", F.max))]
    many = [*[F.avg(c).alias(f"_many_{c}") for c in means], *[F.sum(c).alias(f"_many_{c}") for c in sums], *[F.array_join(F.array_sort(F.collect_set(c)), ", ").alias(f"_many_{c}") for c in texts]]
    out = df.groupBy(*keys).agg(least.alias("_first"), *parts, *many)
    return out.select(*keys, *[F.when(F.col(f"_lo_{c}") < F.col(f"_hi_{c}"), F.col(f"_many_{c}")).otherwise(F.col(f"_first._v{i}")).alias(c) for i, c in enumerate(values)])


def similarity_report(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, ratio): the share of columns with exactly one distinct value."""
    one = [F.coalesce(F.min(c) == F.max(c), F.lit(False)).cast("int") for c in columns]
    return df.groupBy(*keys).agg((sum(one[1:], one[0]) / len(columns)).alias("ratio"))


def conflict_flags(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, columns): whether a group (of keys without null) has more than one value in a column; one aggregate for all columns."""
    known = df.dropna(subset=keys)
    return known.groupBy(*keys).agg(*[F.coalesce(F.min(c) < F.max(c), F.lit(False)).alias(c) for c in columns])


def conflict_counts(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(column_name, n_conflicts)"""
    from annalist.operators.frames import long_form

    return long_form(conflict_flags(df, keys, columns), {c: F.sum(F.col(c).cast("bigint")) for c in columns}, "n_conflicts")


def conflict_ids(df: DataFrame, keys: list[str], columns: list[str], id_col: str) -> DataFrame:
    """Ids with a conflict in any of their groups."""
    any_ = F.greatest(*[F.col(c).cast("int") for c in columns]) if len(columns) > 1 else F.col(columns[0]).cast("int")
    return conflict_flags(df, keys, columns).where(any_ == 1).select(id_col).distinct()


def sum_and_percent(df: DataFrame, keys: list[str], counts: list[str], possible: str, scale: float = 100.0) -> DataFrame:
    """Summed `X_count` and possible columns (null as 0), with each `X_pct` anew; null where nothing was possible."""
    out = df.groupBy(*keys).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in [*counts, possible]])
    return out.withColumns({c.removesuffix("_count") + "_pct": F.try_divide(F.col(c), F.col(possible)) * scale for c in counts})


def curated_value(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, n_values, has_conflict, curated): distinct values, whether several, and the one if it is one."""
    n = F.count_distinct(column)
    return df.groupBy(key).agg(n.alias("n_values"), (n > 1).alias("has_conflict"), F.when(F.min(column) == F.max(column), F.min(column)).alias("curated"))


def value_shares(df: DataFrame, columns: list[str]) -> DataFrame:
    """(columns, n, share), null being a value."""
    counts = df.groupBy(*columns).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select(*columns, "n", (F.col("n") / F.col("total")).alias("share"))  # one row


def coverage(df: DataFrame, groups: list[str], columns: list[str]) -> DataFrame:
    """(groups, column_name, present): 1 if a group has any value in a column."""
    wide = df.groupBy(*groups).agg(*[F.max(F.col(c).isNotNull().cast("int")).alias(c) for c in columns])
    return wide.unpivot(groups, columns, "column_name", "present")


AGGREGATES = {"nunique": F.count_distinct, "count": F.count, "sum": F.sum}


def pivot(df: DataFrame, index: str, columns: str, values: str, how: str, headings: list | None = None) -> DataFrame:
    if how not in AGGREGATES:
        raise ValueError(f"no such aggregate: {how}")
    return df.groupBy(index).pivot(columns, headings).agg(AGGREGATES[how](values))


def merge_equivalent(df: DataFrame, groups: dict[str, list[str]]) -> tuple[DataFrame, list[str]]:
    """Columns that never differ where both have a value, as one: name -> columns. Groups that do differ stay, and are named."""
    clash = lambda cs: F.max(F.array_size(F.array_distinct(F.array_compact(F.array(*cs)))) > 1)
    told = df.agg(*[clash(cs).alias(n) for n, cs in groups.items()]).first() if groups else {}
    bad = [n for n in groups if told[n]]
    return df.withColumns({n: F.coalesce(*cs) for n, cs in groups.items() if n not in bad}), bad


def similar(a: str, b: str) -> float:
    return difflib.SequenceMatcher(None, a, b).ratio()


#: Columns of one number of a pattern, and pairs that are compared in one pass.
_WORD = 62
COMPARED = 400


def null_patterns(df: DataFrame, columns: list[str]) -> DataFrame:
    """(pattern, n): which columns rows have values in, as bits, and how many rows each such pattern has; one aggregate, in which few patterns stand for many rows."""
    words = [columns[i : i + _WORD] for i in range(0, len(columns), _WORD)]
    bits = [sum((F.shiftleft(F.col(c).isNotNull().cast("long"), i) for i, c in enumerate(w[1:], 1)), F.col(w[0]).isNotNull().cast("long")) for w in words]
    return df.select(F.array(*bits).alias("pattern")).groupBy("pattern").agg(F.count("*").alias("n"))


def value_bitmaps(patterns: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, bucket, bitmap, n): in which patterns a column has values, in bitmaps, and in how many rows."""
    numbered = patterns.withColumn("at", F.monotonically_increasing_id())
    has = F.filter(F.array(*[F.struct(F.lit(c).alias("c"), F.getbit(F.get("pattern", F.lit(i // _WORD)), F.lit(i % _WORD)).alias("has")) for i, c in enumerate(columns)]), lambda x: x["has"] == 1)
    each = numbered.select("at", "n", F.explode(has).alias("x")).select("at", "n", F.col("x.c").alias("column_name"))
    return each.groupBy("column_name", F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bitmap"), F.sum("n").alias("n"))


def complementary_pairs(df: DataFrame, columns: list[str], threshold: float) -> DataFrame:
    """(from_col, to_col): columns of alike names and one type that never differ where both have a value; from the emptier to the fuller, on ties by name.

    Names are compared first. Bitmaps of the patterns in which columns have values
    then tell which pairs ever have values together: others can't differ, and no value
    of theirs is looked at. The rest is compared by value, many pairs in one pass.
    """
    from annalist.operators.schemas import alike_names

    spark, kinds, names = df.sparkSession, dict(df.dtypes), sorted(columns)
    schema = "from_col string, to_col string"
    if len(names) < 2:
        return spark.createDataFrame([], schema)
    named = spark.createDataFrame([(c, kinds[c]) for c in names], "name string, kind string")
    both = named.select(F.col("name").alias("a"), "kind").join(named.select(F.col("name").alias("b"), "kind"), "kind").where("a < b")
    alike = alike_names(both, threshold, strict=False)
    store = Store.scratch(spark)
    patterns = store.write("patterns", null_patterns(df, names)).read(spark)  # their numbers hold only for what is written
    bitmaps = store.write("bitmaps", value_bitmaps(patterns, names)).read(spark)
    counts = bitmaps.groupBy("column_name").agg(F.sum("n").alias("n"))
    sides = alike.select("a", "b", F.explode(F.array("a", "b")).alias("column_name")).join(bitmaps, "column_name")
    # in a bucket that only one of the two has there is nothing in common
    shared = sides.groupBy("a", "b", "bucket").agg(F.count("*").alias("m"), F.bitmap_count(F.bitmap_and_agg("bitmap")).alias("k")).groupBy("a", "b").agg(F.max((F.col("m") == 2) & (F.col("k") > 0)).alias("meet"))
    of = lambda side: counts.select(F.col("column_name").alias(side), F.col("n").alias(f"n_{side}"))
    told = alike.join(shared, ["a", "b"], "left").join(of("a"), "a", "left").join(of("b"), "b", "left").select("a", "b", F.coalesce("meet", F.lit(False)).alias("meet"), F.coalesce("n_a", F.lit(0)).alias("n_a"), F.coalesce("n_b", F.lit(0)).alias("n_b"))
    pairs = sorted(told.collect(), key=lambda r: (r["a"], r["b"]))  # pairs of columns with alike names
    differ, meet = set(), [(r["a"], r["b"]) for r in pairs if r["meet"]]
    for start in range(0, len(meet), COMPARED):
        some = meet[start : start + COMPARED]
        row = df.agg(*[F.coalesce(F.max(F.col(a) != F.col(b)), F.lit(False)).alias(f"d{i}") for i, (a, b) in enumerate(some)]).first()
        differ |= {p for i, p in enumerate(some) if row[f"d{i}"]}
    rows = [(r["a"], r["b"]) if r["n_a"] <= r["n_b"] else (r["b"], r["a"]) for r in pairs if (r["a"], r["b"]) not in differ]
    return spark.createDataFrame(rows, schema)


def apply_column_map(df: DataFrame, mapping: dict[str, str], drop: bool = True) -> DataFrame:
    """to = coalesce(to, from) for each from -> to; a missing `to` is made."""
    for old, new in mapping.items():
        if old in df.columns:
            df = df.withColumn(new, F.coalesce(F.col(new), F.col(old)) if new in df.columns else F.col(old))
    return df.drop(*[o for o in mapping if o not in mapping.values()]) if drop else df


def filled(columns: list[str]) -> Column:
    """How many of the columns have a value."""
    flags = [F.col(c).isNotNull().cast("int") for c in columns]
    return sum(flags[1:], flags[0])


def _merged(rows: Column, kind: str, values: list[str], kept: list[str]) -> Column:
    """An array of structs of that type, in order, merged greedily; only its values are compared and filled."""

    def step(open_: Column, row: Column) -> Column:
        fits = F.transform(open_, lambda r: F.forall(F.array(*[r[v].isNull() | row[v].isNull() | (r[v] == row[v]) for v in values]), lambda x: x))
        merge = lambda r: F.struct(*[r[k].alias(k) for k in kept], *[F.coalesce(r[v], row[v]).alias(v) for v in values])
        # the place is bound once, not found anew for each open row
        place = F.array(F.array_position(fits, True))
        return F.transform(place, lambda at: F.when(at == 0, F.concat(open_, F.array(row))).otherwise(F.transform(open_, lambda r, i: F.when(i + 1 == at, merge(r)).otherwise(r))))[0]

    return F.when(F.size(rows) == 1, rows).otherwise(F.aggregate(rows, F.array().cast(f"array<{kind}>"), step))


def merge_compatible_rows(df: DataFrame, id_col: str, order: list[str], by: list[str] | None = None) -> DataFrame:
    """Rows of an id merged greedily: the first row left takes in each later one that differs from it nowhere, filling nulls. Ids that are null are left out.

    Depends on the order (that of `order`, whose columns are not compared, then of
    `by`, then of all columns; nulls first), so rows of an id are folded one by one.
    Rows that differ in a column in which all rows of their id have a value never
    merge, whatever comes between: those columns tell groups apart that are folded by
    themselves, so a row is compared with the open rows of its group only. Rows are
    dealt once, by id; a group of one row passes by.
    """
    columns = df.columns
    if not [c for c in columns if c != id_col and c not in order]:
        return df.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(*[F.min(F.struct(*order))[c].alias(c) for c in order]).select(columns)
    name = {c: f"v{i}" for i, c in enumerate(columns)}
    kept, values = [name[c] for c in columns if c == id_col or c in order], [name[c] for c in columns if c != id_col and c not in order]
    row = F.struct(*[F.col(c).alias(name[c]) for c in columns if name[c] in kept], *[F.col(c).alias(name[c]) for c in columns if name[c] in values])
    at = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate([*order, *(by or [])])]) if order or by else F.lit(0)
    rows = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), at.alias("_at"), row.alias("_row")).repartition("_id")
    each = Window.partitionBy("_id")
    rows = rows.withColumn("_apart", F.struct(*[F.when(F.min(F.col("_row")[v].isNotNull()).over(each), F.col("_row")[v]).alias(v) for v in values]))
    groups = rows.groupBy("_id", "_apart").agg(F.array_sort(F.collect_list(F.struct("_at", "_row"))).alias("_rows"))
    merged = _merged(F.transform("_rows", lambda x: x["_row"]), dict(rows.dtypes)["_row"], values, kept)
    return groups.select(F.explode(merged).alias("_r")).select(*[F.col("_r")[name[c]].alias(c) for c in columns])


def equivalent_groups(columns: list[str], prefixes: list[str]) -> dict[str, list[str]]:
    """name without its prefix -> the columns that have it, where there are several."""
    out: dict[str, list[str]] = {}
    for c in columns:
        bare = next((c.removeprefix(f"{p}_") for p in prefixes if c.startswith(f"{p}_")), c)
        out.setdefault(bare, []).append(c)
    return {k: v for k, v in out.items() if len(v) > 1}


def merge_by_prefix(df: DataFrame, prefixes: list[str], skip: tuple[str, ...] = ()) -> tuple[DataFrame, list[str]]:
    """Columns that are one but for their prefix, merged: of columns equal in all rows (null with null) the first stays under its name; of others that never differ where both have a value, the first value goes under the bare name and the originals stay. Groups that differ are named."""
    groups = equivalent_groups([c for c in df.columns if c not in skip], prefixes)
    if not groups:
        return df, []
    unlike = lambda cs: F.max(reduce(lambda a, b: a | b, [~F.col(cs[0]).eqNullSafe(F.col(c)) for c in cs[1:]]).cast("int"))
    told = df.agg(*[unlike(cs).alias(n) for n, cs in groups.items()]).first()
    same = {n: cs for n, cs in groups.items() if not told[n]}
    out, bad = merge_equivalent(df, {n: cs for n, cs in groups.items() if n not in same})
    return out.drop(*[c for cs in same.values() for c in cs[1:]]), bad
