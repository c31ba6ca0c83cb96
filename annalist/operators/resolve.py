"""One row per group out of conflicting records, by a rule for each kind of data.

Entities with a conflict anywhere go through a resolver with all their rows; the
others pass by. Each resolver is one window or one aggregate on the group's keys;
resolve() does all of them in one pass.
"""

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from annalist.operators.aggregate import filled, sum_and_percent
from annalist.operators.checks import asserted
from annalist.operators.frames import first_per_group
from annalist.operators.history import first_known
from annalist.operators.joins import left_joins, require_unique


def by_priority(df: DataFrame, keys: list[str], error: Column, priority: Column, priorities: dict[str, int], recency: Column, tie: list) -> DataFrame:
    """The row with the least error, then the best priority (unknown ones last), then the latest; nulls last throughout."""
    rank = F.lit(99)
    for value, r in priorities.items():
        rank = F.when(priority == value, r).otherwise(rank)
    return first_per_group(df, keys, [error.asc_nulls_last(), rank.asc(), recency.desc_nulls_last(), *tie])


def expected_exam_year(born: Column, age: int) -> Column:
    """The year in which one born then is examined at an age; those born from September on, a year later."""
    return F.year(born) + age + F.when(F.month(born) >= 9, 1).otherwise(0)


def most_complete(df: DataFrame, keys: list[str], columns: list[str], tie: list, error: Column | None = None) -> DataFrame:
    """The row with most values in columns (then the least error), its gaps filled from the rows after it in that order."""
    order = [filled(columns).desc(), *([error.asc_nulls_last()] if error is not None else []), *tie]
    out = df.select(*[F.col(c) for c in df.columns if c not in columns], *[first_known(c, keys, order).alias(c) for c in columns], F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).alias("_rank"))
    return out.where("_rank = 1").select(*df.columns)


def latest_with_count(df: DataFrame, keys: list[str], date: str, tie: list, count: str) -> DataFrame:
    """The latest row and how many there were."""
    n = F.count("*").over(Window.partitionBy(*keys))
    return first_per_group(df.withColumn(count, n), keys, [F.col(date).desc_nulls_last(), *tie])


def summed(df: DataFrame, keys: list[str], counts: list[str], possible: str, tie: list, scale: float = 100.0) -> DataFrame:
    """Counts summed, percentages anew, all other columns of the last row under the order `tie`."""
    sums = sum_and_percent(df, keys, counts, possible, scale)
    rest = [c for c in df.columns if c not in sums.columns]
    if not rest:
        return sums
    last = first_per_group(df.select(*keys, *rest), keys, tie)
    return left_joins(sums, [last], keys).select(*[c for c in df.columns if c in sums.columns or c in rest], *[c for c in sums.columns if c not in df.columns])


@dataclass
class Rule:
    """How a category (its columns, its order of rows) is resolved: latest | complete | sum | priority."""

    kind: str
    columns: list[str]
    tie: list = field(default_factory=list)
    options: dict = field(default_factory=dict)


def flag_conflicted(df: DataFrame, keys: list[str], columns: list[str], id_col: str, flag: str = "_conflicted") -> DataFrame:
    """Distinct rows with any value, and whether their entity has a conflict in any of its groups (with known keys).

    The rows are dealt once, by entity; distinct, the groups' windows and the entity's window all use that.
    """
    rows = df.select(*keys, *columns).repartition(id_col).distinct().where(filled(columns) > 0)
    group, entity = Window.partitionBy(*keys), Window.partitionBy(id_col)
    differs = reduce(lambda a, b: a | b, [F.coalesce(F.min(c).over(group) < F.max(c).over(group), F.lit(False)) for c in columns])
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return rows.withColumn("_differs", differs & known).withColumn(flag, F.max("_differs").over(entity)).drop("_differs")


def split_conflicted(df: DataFrame, keys: list[str], columns: list[str], id_col: str) -> tuple[DataFrame, DataFrame]:
    """Distinct rows with any value: those of entities without a conflict, and all those of entities with one."""
    rows = flag_conflicted(df, keys, columns, id_col)
    return rows.where("NOT _conflicted").drop("_conflicted"), rows.where("_conflicted").drop("_conflicted")


def _all(flags: list[Column], start: bool) -> Column:
    return reduce((lambda a, b: a & b) if start else (lambda a, b: a | b), flags, F.lit(start))


def _order(rule: Rule) -> list[Column]:
    """The order of a group's rows in which the first is the one that the rule picks."""
    tie, o = rule.tie or [F.col(c) for c in rule.columns], rule.options
    if rule.kind == "latest":
        return [F.col(o["date"]).desc_nulls_last(), *tie]
    if rule.kind == "complete":
        error = [o["error"].asc_nulls_last()] if o.get("error") is not None else []
        return [filled(o.get("fill", rule.columns)).desc(), *error, *tie]
    if rule.kind == "priority":
        rank = F.lit(99)
        for value, r in o["priorities"].items():
            rank = F.when(o["priority"] == value, r).otherwise(rank)
        return [o["error"].asc_nulls_last(), rank.asc(), o["recency"].desc_nulls_last(), *tie]
    if rule.kind == "sum":
        return tie
    raise ValueError(f"no such rule: {rule.kind}")


def _picked(rule: Rule, i: int) -> tuple[dict[str, Column], dict[str, Column]]:
    """Aggregates of a group's rows that make the rule's values, and its values by these. Rows have `_any`, `_rank` and `_new` (the first of equal ones) of the rule's number."""
    here, o = F.col(f"_any{i}"), rule.options
    first = F.min_by(F.struct(*rule.columns), F.when(here, F.col(f"_rank{i}")))
    parts, values = {f"_first{i}": first}, {c: F.col(f"_first{i}")[c] for c in rule.columns}
    if rule.kind == "latest":
        parts[f"_count{i}"] = F.count(F.when(here & F.col(f"_new{i}"), True))
        values[o["count"]] = F.col(f"_count{i}")
    elif rule.kind == "complete":
        for j, c in enumerate(o.get("fill", rule.columns)):
            parts[f"_fill{i}_{j}"] = F.min_by(c, F.when(here & F.col(c).isNotNull(), F.col(f"_rank{i}")))
            values[c] = F.col(f"_fill{i}_{j}")
    elif rule.kind == "sum":
        names = [*o["counts"], o["possible"]]
        for j, c in enumerate(names):
            parts[f"_sum{i}_{j}"] = F.coalesce(F.sum(F.when(here & F.col(f"_new{i}"), F.col(c))), F.lit(0))
            values[c] = F.col(f"_sum{i}_{j}")
        for c in o["counts"]:
            values[c.removesuffix("_count") + "_pct"] = F.try_divide(values[c], values[o["possible"]]) * o.get("scale", 100.0)
    return parts, values


def resolve(df: DataFrame, id_col: str, keys: list[str], rules: list[Rule]) -> DataFrame:
    """One row per group of known keys: each rule's category resolved for entities with conflicts, other columns required to be free of them.

    A `latest` rule's event count is null for entities without a conflict, whose
    gaps in a group are filled from its other rows. Rows with a null key are of no
    group: they pass by whole, once each. A conflict in a column without a rule is an
    error of the job that finds it. verified() checks the result.

    All rules work on one pass: rows are dealt once, by entity; conflicts, the order
    of each rule and equal rows are windows within that, and one aggregate by group
    takes each rule's values.
    """
    ruled = [c for r in rules for c in r.columns]
    rest = [c for c in df.columns if c not in keys and c not in ruled]
    known = _all([F.col(k).isNotNull() for k in keys], True)
    rows = df.withColumn("_loose", F.when(~known, F.struct(*df.columns))).repartition(id_col)
    # the entity comes first, so that its rows are sorted together as its groups are
    group = [id_col, *[k for k in keys if k != id_col], "_loose"]
    of, entity = Window.partitionBy(*group), Window.partitionBy(id_col)
    differ = lambda columns: _all([F.coalesce(F.min(c).over(of) < F.max(c).over(of), F.lit(False)) for c in columns], False)
    rows = rows.withColumns({f"_differ{i}": differ(r.columns) for i, r in enumerate(rules)})
    rows = rows.withColumns({f"_bad{i}": F.max(f"_differ{i}").over(entity) for i in range(len(rules))} | {f"_any{i}": filled(r.columns) > 0 for i, r in enumerate(rules)})
    for i, r in enumerate(rules):
        rows = rows.withColumn(f"_rank{i}", F.row_number().over(of.orderBy(F.col(f"_any{i}").desc(), *_order(r))))
        if r.kind in ("latest", "sum"):
            rows = rows.withColumn(f"_new{i}", F.row_number().over(Window.partitionBy(*group, *[c for c in r.columns if c not in group]).orderBy(f"_rank{i}")) == 1)
    picked = [_picked(r, i) for i, r in enumerate(rules)]
    conflict = {c: F.min(c) < F.max(c) for c in rest}
    out = rows.groupBy(*group).agg(
        *[F.max(c).alias(f"_once_{c}") for c in [*ruled, *rest]], *[F.max(f"_bad{i}").alias(f"_bad{i}") for i in range(len(rules))],
        *[a.alias(n) for parts, _ in picked for n, a in parts.items()], F.concat_ws(", ", *[F.when(x, F.lit(c)) for c, x in conflict.items()]).alias("_unruled"),
    )
    if rest:
        out = asserted(out, F.col("_unruled") == "", F.concat(F.lit("conflicts without a rule: "), F.col("_unruled")))
    own = F.col("_loose").isNull()
    values = {c: F.col(f"_once_{c}") for c in [*ruled, *rest]}
    for i, (_, told) in enumerate(picked):
        bad = own & F.col(f"_bad{i}") & F.col(f"_first{i}").isNotNull()
        for c, v in told.items():
            values[c] = F.when(bad, v).otherwise(values[c]) if c in values else F.when(bad, v)
    return out.select(*[F.col(c) if c in keys else values[c].alias(c) for c in df.columns], *[v.alias(c) for c, v in values.items() if c not in df.columns])


def verified(df: DataFrame, keys: list[str]) -> DataFrame:
    """df, if each group of known keys has one row."""
    require_unique(df.dropna(subset=keys), keys)
    return df


def event_counts(df: DataFrame, keys: list[str], name: str = "event_count") -> DataFrame:
    """(keys, name): the number of records of each group."""
    return df.groupBy(*keys).agg(F.count("*").alias(name))
