"""Joins in which null keys match, lookups, and joins whose key the data choose.

Sides are left to Spark's own size estimates (and AQE's run-time sizes): a
lookup is broadcast if it is small, else shuffled.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from annalist.functions.coerce import normalise_key, normalise_name
from annalist.operators.checks import Checks, lagging, unique_rows
from annalist.operators.frames import first_per_group


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left", suffix: str = "_dup") -> DataFrame:
    """A join in which null matches null. Keys come once; other columns of the right side that the left has too get the suffix."""
    keyed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c).alias(c + suffix if c in left.columns else c) for c in right.columns])
    on = reduce(lambda a, b: a & b, [left[k].eqNullSafe(keyed[f"_r_{k}"]) for k in keys])
    out = left.join(keyed, on, how)
    if how in ("left_semi", "left_anti"):
        return out
    if how in ("full", "full_outer", "outer", "right"):
        out = out.withColumns({k: F.coalesce(F.col(k), F.col(f"_r_{k}")) for k in keys})
    return out.drop(*[f"_r_{k}" for k in keys])


def last_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key."""
    return first_per_group(df, keys, [F.col(c).desc() for c in order])


def lookup(df: DataFrame, table: DataFrame, left_on: list[Column], right_on: list[Column], values: dict[str, str], drop_empty: bool = False, checks: Checks | None = None) -> DataFrame:
    """df with the table's columns `values` (name -> new name); keys are compared as trimmed text without `.0`, null with null.

    No row is multiplied: a table that isn't unique on its keys, as they are
    compared, is an error of the job that computes the result, or told by checks.
    With drop_empty, new columns without any value go: by checks when they store the
    result, else by a job.
    """
    names = [f"_k{i}" for i in range(len(left_on))]
    right = table.select(*[normalise_key(c).alias(n) for c, n in zip(right_on, names, strict=True)], *[F.col(c).alias(v) for c, v in values.items()])
    left = df.withColumns({n: normalise_key(c) for c, n in zip(left_on, names, strict=True)})
    out = null_safe_join(left, unique_rows(right, names, checks), names).drop(*names)
    return without_empty(out, list(values.values()), checks) if drop_empty else out


def without_empty(df: DataFrame, columns: list[str], checks: Checks | None = None) -> DataFrame:
    """df without those of the columns that have no value; one job for all, or noted by checks."""
    if checks is not None or not columns:
        return checks.watch_empty(df, columns) if columns else df
    found = df.agg(*[F.max(F.col(c).isNotNull()).alias(c) for c in columns]).first()
    return df.drop(*[c for c in columns if not found[c]])


def lagged_lookup(df: DataFrame, table: DataFrame, keys: dict[str, str], year: str, table_year: str, lag: int, prefix: str, drop_empty: bool = False, checks: Checks | None = None) -> DataFrame:
    """df with the table's values of `lag` years before: its year is moved on by lag and joined for equality. keys: column of df -> column of the table, which is unique on keys and year; that linked years lie back by lag is checked."""
    values = {c: f"{prefix}_{c}_lag{lag}" for c in table.columns if c not in (*keys.values(), table_year)}
    moved = table.withColumn("_year", F.col(table_year) + lag)
    out = lookup(df, moved, [*map(F.col, keys), F.col(year)], [*map(F.col, keys.values()), F.col("_year")], values | {table_year: "_linked"}, checks=checks)
    out = lagging(out, year, "_linked", lag, checks)
    return without_empty(out, list(values.values()), checks) if drop_empty else out


def lagged_lookups(df: DataFrame, table: DataFrame, refs: dict[str, tuple[dict[str, str], int]], year: str, table_year: str, drop_empty: bool = False, checks: Checks | None = None) -> DataFrame:
    """lagged_lookup for each reference: prefix -> (keys, lag). Empty columns are looked for once, after all."""
    before = set(df.columns)
    for prefix, (keys, lag) in refs.items():
        df = lagged_lookup(df, table, keys, year, table_year, lag, prefix, False, checks)
    return without_empty(df, [c for c in df.columns if c not in before], checks) if drop_empty else df


def year_differences(df: DataFrame, year: str, linked_year: str) -> DataFrame:
    """(lag, n): how many years the linked rows lie back."""
    return df.where(F.col(linked_year).isNotNull()).groupBy((F.col(year) - F.col(linked_year)).cast("bigint").alias("lag")).agg(F.count("*").alias("n"))


def require_lag(df: DataFrame, year: str, linked_year: str, lag: int) -> DataFrame:
    """df without the linked year, which has to lie back by lag in all linked rows."""
    if wrong := [r["lag"] for r in year_differences(df, year, linked_year).where(F.col("lag") != lag).limit(5).collect()]:
        raise ValueError(f"linked over {sorted(wrong)} years, not {lag}")
    return df.drop(linked_year)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def require_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    if (bad := duplicate_keys(df, keys).first()) is not None:
        raise ValueError(f"not unique on {keys}: {bad.asDict()}")
    return df


def two_hop(df: DataFrame, first: DataFrame, second: DataFrame, start: Column, first_key: str, link: str, second_key: str, values: dict[str, str], order: list[str]) -> DataFrame:
    """df with values of the second lookup, reached through the first; in both, the last row of a key counts."""
    a = last_wins(first, [first_key], order).select(F.col(first_key).alias("_a"), F.col(link).alias("_b"))
    b = last_wins(second, [second_key], [c for c in order if c in second.columns] or [second_key]).select(F.col(second_key).alias("_b"), *[F.col(c).alias(v) for c, v in values.items()])
    return df.withColumn("_a", start).join(a, "_a", "left").join(b, "_b", "left").drop("_a", "_b")


def key_matches(left: DataFrame, right: DataFrame, id_col: str, left_keys: list[str], right_keys: list[str]) -> DataFrame:
    """(left_key, right_key, n): rows that match on the id and each pair of name columns, of all pairs in one join of their values."""
    def values(df: DataFrame, keys: list[str], name: str) -> DataFrame:
        return df.select(id_col, F.explode(F.array(*[F.struct(F.lit(k).alias(name), normalise_name(F.col(k)).alias("v")) for k in keys])).alias("x")).select(id_col, f"x.{name}", "x.v").groupBy(id_col, name, "v").agg(F.count("*").alias(f"n_{name}"))

    both = values(left, left_keys, "left_key").join(values(right, right_keys, "right_key"), [id_col, "v"])
    return both.groupBy("left_key", "right_key").agg(F.sum(F.col("n_left_key") * F.col("n_right_key")).alias("n"))


# Parts of the names of columns that tell a school, and of those that don't all the same.
SCHOOL_PARTS = ["urn", "estab_no", "estab", "estab_id", "laestab", "school_code", "stat_school", "school", "establishment", "urn_ac"]
NO_SCHOOL_PARTS = ["age"]


def school_columns(columns: list[str], parts: list[str] | None = None, without: list[str] | None = None) -> list[str]:
    """Columns whose names contain one of the parts and none of the others, in any case, in their order."""
    has = lambda c, words: any(w in c.lower() for w in words)
    return [c for c in columns if has(c, SCHOOL_PARTS if parts is None else parts) and not has(c, NO_SCHOOL_PARTS if without is None else without)]


def repeated_in(frames: dict[str, DataFrame], key: str) -> set[str]:
    """The frames in which a key comes several times (null being one), all counted in one aggregate."""
    ids = [df.select(F.lit(n).alias("_frame"), F.col(key).cast("string").alias("_id")) for n, df in frames.items()]
    found = reduce(DataFrame.unionByName, ids).groupBy("_frame", "_id").agg(F.count("*").alias("n")).where("n > 1").select("_frame").distinct()
    return {r["_frame"] for r in found.collect()}


def best_key_join(left: DataFrame, right: DataFrame, id_col: str, left_keys: list[str] | None = None, right_keys: list[str] | None = None, unique: tuple[bool, bool] | None = None) -> DataFrame:
    """Full outer on the id if it is unique on both sides; else on the id and the pair of name columns that matches most rows; else, with ids unique on the right, the right row goes to the first left row. Name columns that aren't given are found by their names, uniqueness (of left and right) by a job."""
    left_keys = school_columns(left.columns) if left_keys is None else left_keys
    right_keys = school_columns(right.columns) if right_keys is None else right_keys
    if unique is None:
        repeated = repeated_in({"left": left, "right": right}, id_col)
        unique = ("left" not in repeated, "right" not in repeated)
    if all(unique):
        shared = set(left.columns) & set(right.columns) - {id_col}
        return null_safe_join(left, right, [id_col], "full") if shared else outer_coalesce([left, right], [id_col])
    pairs = [(a, b) for a in left_keys if a in left.columns for b in right_keys if b in right.columns]
    if pairs:
        found = {(r["left_key"], r["right_key"]): r["n"] for r in key_matches(left, right, id_col, sorted({a for a, _ in pairs}), sorted({b for _, b in pairs})).collect()}
        a, b = max(pairs, key=lambda p: found.get(p, 0))  # the first on ties
        l2, r2 = left.withColumn("_name", normalise_name(F.col(a))), right.withColumn("_name", normalise_name(F.col(b)))
        return null_safe_join(l2, r2, [id_col, "_name"], "full").drop("_name")
    if unique[1]:
        return attach_to_first(left, right, [id_col], left.columns)
    raise ValueError("no key joins these frames")


def best_key_joins(frames: dict[str, DataFrame], id_col: str, repeated: set[str] | None = None) -> tuple[DataFrame, bool]:
    """All frames, each joined to those before it by the key that fits best, and whether ids are unique in the result.

    One aggregate tells in which frames they are repeated, if it isn't known. Frames from the first on that have
    unique ids and no other column in common meet in one exchange.
    """
    repeated, names = repeated_in(frames, id_col) if repeated is None else repeated, list(frames)
    end, held = 0, set()
    while end < len(names) and names[end] not in repeated and not held & (rest := {c for c in frames[names[end]].columns if c != id_col}):
        held |= rest
        end += 1
    out = outer_coalesce([frames[n] for n in names[:end]], [id_col]) if end > 1 else frames[names[0]]
    unique = names[0] not in repeated
    for n in names[max(end, 1) :]:
        out = best_key_join(out, frames[n], id_col, unique=(unique, n not in repeated))
        unique = unique and n not in repeated
    return out, unique


def attach_to_first(left: DataFrame, right: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Right rows joined (full outer) to the first left row of their key; other left rows stay without."""
    ranked = left.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    first = null_safe_join(ranked.where("_n = 1").drop("_n"), right, keys, "full")
    return first.unionByName(ranked.where("_n > 1").drop("_n"), allowMissingColumns=True)


def outer_coalesce(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Full outer join of all frames, null keys matching; a column that several have is coalesced in their order.

    All rows are dealt once, by the keys, each frame's under its own column; a key
    that frames have several times makes all combinations, as a join of them would.
    """
    rest = [[c for c in df.columns if c not in keys] for df in frames]
    tagged = [df.select(*keys, F.struct(F.lit(True).alias("there"), *[F.col(c).alias(f"c{j}") for j, c in enumerate(own)]).alias(f"_f{i}")) for i, (df, own) in enumerate(zip(frames, rest, strict=True))]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    out = every.groupBy(*keys).agg(*[F.collect_list(f"_f{i}").alias(f"_f{i}") for i in range(len(frames))])
    for i in range(len(frames)):
        out = out.withColumn(f"_f{i}", F.explode_outer(f"_f{i}"))
    names = dict.fromkeys([*frames[0].columns, *(c for own in rest for c in own)])
    values = {c: [F.col(f"_f{i}")[f"c{own.index(c)}"] for i, own in enumerate(rest) if c in own] for c in names if c not in keys}
    return out.select(*[F.col(c) if c in keys else F.coalesce(*values[c]).alias(c) for c in names])


def left_joins(base: DataFrame, frames: list[DataFrame], keys: list[str]) -> DataFrame:
    return reduce(lambda a, b: null_safe_join(a, b, keys), frames, base)


def lost_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """Distinct rows of before that, as text, are not in after."""
    text = lambda df: df.select(*[F.col(c).cast("string").alias(c) for c in before.columns]).distinct()
    return null_safe_join(text(before), text(after), before.columns, "left_anti")


def expand_groups(df: DataFrame, low: int, high: int, name: str = "year_group") -> DataFrame:
    """Each row once for each group from low to high."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(low), F.lit(high))))


def two_phase_targets(base: DataFrame, facts: DataFrame, id_col: str, age: str, half: str, value: str, offset: int, first_age: int, last_age: int, left_until: int) -> DataFrame:
    """train_and_target() of one fact column: `value` as `feature` of the phase's half and as its `target`; base has the column `group`, and its age is group + offset."""
    one = facts.select(id_col, age, F.when(F.col(half) == 1, 1).otherwise(2).alias(half), F.col(value).alias("feature"), F.col(value).alias("target"))
    phases = base.withColumn("age", F.col("group") + offset).where(F.col("age").between(first_age, last_age))
    found = train_and_target(phases, one.withColumnRenamed(age, "age"), id_col, "age", half, "target", left_until, dedup=False, has="feature")
    return found.drop("target_latest").withColumnRenamed("_phase", "phase")


def train_and_target(base: DataFrame, facts: DataFrame, id_col: str, age: str, half: str, target: str, left_until: int, dedup: bool = True, has: str | None = None) -> DataFrame:
    """Base rows (with an age) with all facts of a phase and the target of the next one, all ages at once.

    facts has a row for an id, an age and a half (1 or 2), and any columns. In the
    phase `pre` the features are those of half 1 and the target that of half 2 of
    the same age; in `post` of half 2, and of half 1 of the next age. The target
    column among the features is called `<target>_latest`. Up to the age left_until
    a row without facts stays, above it goes. A phase of an age without any
    features or any targets, for ids of the base, is left out. `_phase` tells the
    phase; with dedup, equal rows are one.
    """
    mine = facts.join(base.select(id_col).distinct(), id_col, "left_semi")
    phases = base.withColumn("_phase", F.explode(F.array(F.lit("pre"), F.lit("post"))))
    features = mine.withColumn("_phase", F.when(F.col(half) == 1, "pre").otherwise("post")).withColumnRenamed(target, f"{target}_latest").drop(half)
    features = features.withColumn("_has", F.lit(True) if has is None else F.when(F.col(has).isNotNull(), True))
    second = F.col(half) == 2
    targets = mine.select(id_col, F.when(second, F.col(age)).otherwise(F.col(age) - 1).alias(age), F.when(second, "pre").otherwise("post").alias("_phase"), target)
    there = features.select(age, "_phase").distinct().join(targets.select(age, "_phase").distinct(), [age, "_phase"])
    keys = [id_col, age, "_phase"]
    out = phases.join(there, [age, "_phase"], "left_semi").join(features, keys, "left").where((F.col(age) <= left_until) | F.col("_has").isNotNull())
    out = out.drop("_has").join(targets, keys, "left")
    return out.distinct() if dedup else out
