"""Merging of a cohort's tables into one, and of cohorts into longitudinal tables.

Tables come by category with prefixed columns. What a merge must not do (lose or
change a source's values, multiply rows, leave empty columns) is checked with anti
joins and aggregates, not by looking at rows.
"""

import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annalist.functions import labels
from annalist.operators import aggregate, clean, joins
from annalist.operators.checks import Checks
from annalist.sources.store import Store, Table, stamp_of

Strategy = Literal["strict", "flexible", "balanced"]


def set_similarity(a: Column, b: Column) -> Column:
    """Shared elements of two arrays as a share of all of theirs; 0 for two empty ones."""
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))), F.lit(0.0))


def column_groups(sets: list[set[str]], similarity: float = 0.7, subset: float = 0.5, strategy: Strategy = "strict") -> list[list[int]]:
    """Places of the column sets that belong together, directly or by others, in the order of the first of each.

    strict: similar enough. flexible: or one is part of the other. balanced: or one
    is part of the other and they are similar to `subset` at least.
    """
    if strategy not in ("strict", "flexible", "balanced"):
        raise ValueError(f"no such strategy: {strategy}")
    parent = list(range(len(sets)))

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for j, b in enumerate(sets):
        for i, a in enumerate(sets[:j]):
            alike = len(a & b) / len(a | b) if a | b else 0.0
            part = a <= b or b <= a
            if alike >= similarity or strategy == "flexible" and part or strategy == "balanced" and part and alike >= subset:
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    groups: dict[int, list[int]] = {}
    for i in range(len(sets)):
        groups.setdefault(root(i), []).append(i)
    return [*groups.values()]


def _as_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct rows as text; null, empty text and columns that aren't there are one."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in columns]).distinct()


def lost_values(source: DataFrame, merged: DataFrame, id_col: str) -> DataFrame:
    """Distinct rows of a source, as text, that the merged table doesn't have in the source's columns; null and empty text are one."""
    return _as_text(source, source.columns).join(_as_text(merged, source.columns), source.columns, "left_anti")


def _texts(df: DataFrame, columns: list[str]) -> Column:
    return F.to_json(F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in columns]))


def missing_rows(sources: dict[str, DataFrame], merged: DataFrame, each: tuple[str, list] | None = None) -> DataFrame:
    """(source, of, row): rows of the sources, as in lost_values, that merged lacks; with each, (column, values), for each of these values. All sources in one aggregate: merged is read once, and rows that are there cancel out before they are dealt."""
    names = list(sources)
    of = [F.lit(str(v)) for v in each[1]] if each else [F.lit("")]
    asked = [df.select(F.lit(n).alias("source"), F.explode(F.array(*of)).alias("of"), _texts(df, df.columns).alias("row"), F.lit(False).alias("there")) for n, df in sources.items()]
    found = F.array(*[F.struct(F.lit(n).alias("source"), _texts(merged, sources[n].columns).alias("row")) for n in names])
    there = merged.select((F.col(each[0]).cast("string") if each else F.lit("")).alias("of"), F.explode(found).alias("x")).select("x.source", "of", "x.row", F.lit(True).alias("there"))
    every = reduce(DataFrame.unionByName, asked).unionByName(there)
    return every.groupBy("source", "of", "row").agg(F.max("there").alias("there")).where("NOT there").drop("there")


def require_preserved(sources: dict[str, DataFrame], merged: DataFrame, id_col: str, each: tuple[str, list] | None = None) -> None:
    """An error that names a source of which the merged table has lost or changed values (for one of the values of each)."""
    if sources and (bad := missing_rows(sources, merged, each).limit(5).collect()):
        raise ValueError("; ".join(f"the merge lost values of {r['source']}: {r['row']}" for r in bad))


def require_clean(df: DataFrame) -> DataFrame:
    """df, if no row comes twice and no column is empty (a frame without rows has none to miss)."""
    counts = df.agg(F.count("*").alias("_rows"), *[F.count(c).alias(c) for c in df.columns]).first()
    if counts["_rows"] and (empty := [c for c in df.columns if not counts[c]]):
        raise ValueError(f"empty columns: {empty}")
    if df.groupBy(*df.columns).count().where("count > 1").first() is not None:
        raise ValueError("rows come twice")
    return df


@dataclass
class Destinations:
    """Post-16 records: the names (with their prefix) of the age, the half of the year (1 autumn, 2 spring) and the target."""

    facts: DataFrame
    age: str
    half: str
    target: str
    target_age: int = 16
    left_until: int = 17
    last_age: int = 24
    prefix: str = ""


@dataclass
class MergeOptions:
    id_col: str
    #: The category that waits for the last year of school.
    held_back: str = "ks4"
    final_group: int = labels.FINAL_GROUP
    #: Years between a year group and the age at its start.
    age_offset: int = 4
    redundant: list[str] = field(default_factory=lambda: list(clean.REDUNDANT))
    check: bool = True
    #: Types of merged columns, applied at the end.
    types: Callable[[DataFrame], DataFrame] | None = None


@dataclass
class Merged:
    year_group: int
    age: int
    df: DataFrame
    #: Where it is written.
    table: Table | None = None


def one_row_per_id(facts: DataFrame, id_col: str, age: str, half: str) -> DataFrame:
    """The fullest record of each id, age and half; ties by the values."""
    rest = [c for c in facts.columns if c not in (id_col, age, half)]
    from annalist.operators.frames import first_per_group

    return first_per_group(facts, [id_col, age, half], [aggregate.filled(rest).desc(), *[F.col(c).asc_nulls_last() for c in rest]]) if rest else facts.distinct()


def _finished(store: Store, name: str, df: DataFrame, o: MergeOptions, age: str | None, ages: dict[int, int], stamp: str) -> list[Merged]:
    """The tables of some ages, written once as one: without redundant columns and repeated rows, rows that add nothing merged into others of their id (and age), the id and ages first, metadata last; each without its empty columns.

    ages: age -> year group; age: the column that tells them apart, None for one age.
    """
    df = clean.drop_redundant(df, o.redundant)
    apart = [o.id_col] if age is None else [o.id_col, age]
    keyed = df.where(F.col(o.id_col).isNotNull()).withColumn("_apart", F.struct(*apart))
    merged = aggregate.merge_compatible_rows(keyed, "_apart", apart, [c for c in df.columns if c not in apart]).drop("_apart")
    first = [o.id_col, *[c for c in df.columns if c != o.id_col and any(w in c.lower() for w in ("age", "ncy"))]]
    merged = clean.reorder(merged, [c for c in first if not c.startswith(clean.META)])
    # which columns have values at which age is noticed while they are written
    checks, some = Checks(), {}
    here = {a: F.col(age) == a if age else F.lit(True) for a in ages}
    merged = checks.watch(merged, {f"a{a}_{i}": F.max(F.when(h, F.col(c).isNotNull())) for a, h in here.items() for i, c in enumerate(merged.columns)}, lambda m: some.update(m) or [])
    table = store.write(name, merged, stamp)
    checks.verify()
    out = []
    for a, group in ages.items():
        part = table.part(f"`{age}` = {a}" if age else None, [c for i, c in enumerate(merged.columns) if some.get(f"a{a}_{i}")])
        frame = part.read(store.spark)
        if o.types:
            frame = clean.drop_all_null_columns(o.types(frame).distinct())
            part = store.write(f"{name}-{a}", frame, stamp_of(stamp, a))
            frame = part.read(store.spark)
        out.append(Merged(group, a, frame, part))
    return out


def merge_cohort(year_group: int, sources: dict[str, DataFrame], destinations: Destinations | None, o: MergeOptions, store: Store | None = None, name: str = "cohort", stamp: str | None = None) -> list[Merged]:
    """The tables of one cohort in one year group: one of the school years, and from the final group on one for each later age.

    sources: category -> table with prefixed columns, joined in their order by the
    key that fits best (`joins.best_key_joins`). The held-back category is not part
    of the school table (unless it is all there is) but of those after it. Up to the
    final group the table gets the target at the target's age by a left join; in
    the final group, tables with a phase each for later ages follow
    (`joins.train_and_target`). With check, each source's values must be there, for
    ages under 18, before redundant columns go.

    What several steps need (the joined sources, the records, the rows of all later
    ages) is written to the store once; the tables given back are parts of what is
    written there under name.
    """
    store = store or Store.scratch(sources[next(iter(sources))].sparkSession)
    spark, stamp = store.spark, stamp or stamp_of(name, year_group, uuid.uuid4().hex)
    kept = lambda step, df: store.write(f"{name}/{step}", df, stamp).read(spark)
    sources = {c: kept(f"source-{i}", df) for i, (c, df) in enumerate(sources.items())}
    school = [c for c in sources if c != o.held_back] or list(sources)
    repeated = joins.repeated_in(sources, o.id_col)
    base, unique = joins.best_key_joins({c: sources[c] for c in school}, o.id_col, repeated)
    base = kept("base", base)
    age, own = year_group + o.age_offset, {c: sources[c] for c in school}
    if o.check and age < 18 and (destinations is None or year_group <= o.final_group):
        require_preserved(own, base, o.id_col)  # what is joined later is joined to all of it
    if destinations is None:
        return _finished(store, f"{name}/school", base, o, None, {age: year_group}, stamp)
    d, out = destinations, []
    facts, ages = _facts(store, f"{name}/facts", year_group, d, o, stamp)
    if year_group <= o.final_group:
        spring = facts.where((F.col(d.half) == 2) & (F.col(d.age) == d.target_age)).select(o.id_col, d.target)
        out += _finished(store, f"{name}/school", base.join(spring, o.id_col, "left"), o, None, {age: year_group}, stamp)
    if year_group == o.final_group and ages:
        full = base
        if o.held_back in sources and o.held_back not in school:
            full = joins.best_key_join(base, sources[o.held_back], o.id_col, unique=(unique, o.held_back not in repeated))
        every = full.withColumn(d.age, F.explode(F.sequence(F.lit(min(ages)), F.lit(max(ages))).cast(f"array<{dict(facts.dtypes)[d.age]}>")))
        every = kept("later-rows", joins.train_and_target(every, facts, o.id_col, d.age, d.half, d.target, d.left_until, dedup=False))
        if o.check and (young := [a for a in ages if a < 18]):
            require_preserved(sources, every, o.id_col, (d.age, young))
        out += _finished(store, f"{name}/later", every, o, d.age, ages, stamp)
    return out


def _facts(store: Store, name: str, year_group: int, d: Destinations, o: MergeOptions, stamp: str) -> tuple[DataFrame, dict[int, int]]:
    """The records, one for each id, age and half, written once; and age -> year group for each age with a next one that they have, from the age of the year group (or the first that they have) on."""
    facts, seen, checks = one_row_per_id(clean.remove_metadata(d.facts), o.id_col, d.age, d.half), {}, Checks()
    ends = {"low": F.min(F.when(F.col(d.half) == 1, F.col(d.age))), "high": F.max(F.when(F.col(d.half) == 2, F.col(d.age)))}
    facts = store.write(name, checks.watch(facts, ends, lambda m: seen.update(m) or []), stamp).read(store.spark)
    checks.verify()
    if seen.get("low") is None or seen.get("high") is None:
        return facts, {}
    first = max(year_group + o.age_offset, int(seen["low"]))
    last = max(first, min(int(seen["high"]), d.last_age))
    return facts, {age: year_group + k for k, age in enumerate(range(first, last))}


def longitudinal(parts: list[tuple[str, int, DataFrame]], types: Callable[[DataFrame], DataFrame] | None = None, check: bool = False, order: str | None = None) -> DataFrame:
    """(cohort `YYYY-YYYY`, year group, frame) as one table of distinct rows, with metadata columns (cohort, year group, academic year) as text and missing columns as nulls.

    With an order column (an id), rows come sorted by it, the cohort's first year and the year group; with check, no row twice and no empty column.
    """
    named = []
    for cohort, group, df in parts:
        start = cohort.split("-")[0].strip()
        extra = {"acad_year": f"{int(start) + group - labels.FINAL_GROUP}-{int(start) + group - labels.FINAL_GROUP + 1}"} if start.isdigit() and "-" in cohort else {}
        named.append(clean.append_metadata(df, cohort=cohort, year_group=group, **extra))
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named).distinct()
    out = types(out) if types else out
    if check:
        require_clean(out)
    if order:
        out = out.orderBy(order, F.substring_index("_cohort", "-", 1).cast("int"), F.col("_year_group").cast("int"))
    return clean.reorder(out, []) if order else out


def merge_all(parts: list[tuple[str, int, DataFrame]], similarity: float = 0.7, subset: float = 0.5, strategy: Strategy | None = "strict", **options) -> list[DataFrame]:
    """Cohort tables (cohort, year group, frame) as longitudinal tables, one for each group of alike columns, or one of all with strategy None; in the order of cohorts and year groups."""
    ordered = sorted(parts, key=lambda p: (int(p[0].split("-")[0]), p[1]))
    if strategy is None:
        return [longitudinal(ordered, **options)]
    return [longitudinal([ordered[i] for i in places], **options) for places in column_groups([set(df.columns) for *_, df in ordered], similarity, subset, strategy)]


def expand_early(inventory: DataFrame, category: str = "ks2", groups: tuple[int, int] = (7, 11), from_group: int = 6) -> DataFrame:
    """Inventory rows (category, year_group, label `Yn YYYY - YYYY`) with those of an early category once for each later group, their labels moved on."""
    early = F.contains(F.col("category"), F.lit(category))
    later = inventory.where(early).withColumn("year_group", F.explode(F.sequence(F.lit(groups[0]), F.lit(groups[1]))))
    form = r"^Y\d+ (\d{4})\s*-\s*(\d{4})$"
    year = lambda g: (F.regexp_extract("label", form, g).try_cast("int") + F.col("year_group") - from_group).cast("string")
    moved = F.concat(F.lit("Y"), F.col("year_group").cast("string"), F.lit(" "), year(1), F.lit(" - "), year(2))
    return inventory.where(F.coalesce(~early, F.lit(True))).unionByName(later.withColumn("label", F.coalesce(moved, F.col("label"))))


def stack_records(frames: list[tuple[str, DataFrame]], record_col: str = "record_date") -> DataFrame:
    """Files of one category without a cohort, one under the other with the date that they were recorded; distinct, without empty columns."""
    for date, _ in frames:
        years = [y for y in re.findall(r"\d+", date or "") if len(y) == 4]
        if len(years) != 1:
            raise ValueError(f"a record date has one year: {date!r}")
    named = [clean.append_metadata(clean.replace_ampersand(df), **{record_col: date}) for date, df in frames]
    return clean.drop_all_null_columns(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named).distinct())
