"""Derived features: code hierarchies, agreed values, guarded repairs, and composites of histories."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annalist.functions.classify import SCHOOL_TYPES, classify
from annalist.functions.coerce import trimmed
from annalist.operators.aggregate import curated_value
from annalist.operators.clean import substantive
from annalist.operators.frames import first_per_group, unpivot
from annalist.operators.history import cumulative, state_changes
from annalist.operators.joins import null_safe_join

# Texts that say nothing about an ethnicity, and about a language.
ETHNICITY_FILLERS = ["refused", "unknown", "not obtained", "not known", "information not yet obtained", "missing", "refu", "nobt"]
LANGUAGE_FILLERS = ["refused", "unknown", "not obtained", "not known", "information not yet obtained", "missing", "ref", "not"]


def dependency_violations(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with more than one value, where one is meant to determine the other."""
    return df.groupBy(key).agg(F.min(value).alias("lo"), F.max(value).alias("hi")).where("lo < hi").select(key)


def map_levels(df: DataFrame, code: str, table: DataFrame, sources: list[str], levels: list[str], prefix: str) -> DataFrame:
    """df with `<prefix><level>` for each level: looked up by the code (trimmed, any case) in the source columns, the first that has it."""
    key = F.lower(trimmed(F.col(code)))
    out = df.withColumn("_code", key)
    for i, s in enumerate(sources):
        one = first_per_group(table.where(F.col(s).isNotNull()).select(F.lower(trimmed(F.col(s))).alias("_code"), *[F.col(x).alias(f"_{i}_{x}") for x in levels]), ["_code"], [F.col(f"_{i}_{x}") for x in levels])
        out = out.join(one, "_code", "left")
    done = out.withColumns({f"{prefix}{x}": F.coalesce(*[F.col(f"_{i}_{x}") for i in range(len(sources))]) for x in levels})
    return done.drop("_code", *[f"_{i}_{x}" for i in range(len(sources)) for x in levels])


#: Levels of a code table of ethnicities, from fine to coarse: name -> column.
ETHNICITY_LEVELS = {"ext_code": "extended_code", "ext_cat": "extended_category", "sub_cat": "sub_category", "main_code": "main_code", "main_cat": "main_category"}
# The levels that each level is mapped to.
LEVEL_PAIRS = {
    "ext_code": ["ext_code", "ext_cat", "sub_cat", "main_cat", "main_code"],
    "ext_cat": ["ext_cat", "ext_code", "sub_cat", "main_cat", "main_code"],
    "sub_cat": ["sub_cat", "main_code", "main_cat"],
    "main_code": ["main_code", "main_cat"],
    "main_cat": ["main_cat"],
}


def level_maps(table: DataFrame, levels: dict[str, str] | None = None, pairs: dict[str, list[str]] | None = None) -> dict[tuple[str, str], DataFrame]:
    """(from, to) -> (key, value): one level of a code table to another, for the levels that the table has. A key with several values is an error."""
    levels, pairs, out = levels or ETHNICITY_LEVELS, pairs or LEVEL_PAIRS, {}
    for a, others in pairs.items():
        for b in others:
            if levels[a] in table.columns and levels[b] in table.columns:
                both = table.select(F.col(levels[a]).alias("key"), F.col(levels[b]).alias("value")).dropna().distinct()
                if (bad := dependency_violations(both, "key", "value").first()) is not None:
                    raise ValueError(f"{a} doesn't determine {b}: {bad['key']}")
                out[a, b] = both
    return out


def with_levels(df: DataFrame, code: str, table: DataFrame, prefix: str, levels: dict[str, str] | None = None) -> DataFrame:
    """df with `<prefix><level>` for each level of the code table, looked up by the code (trimmed, any case) in the finest level that has it, by maps that are checked to be ones."""
    maps = level_maps(table, levels)
    sources = list(dict.fromkeys(a for a, _ in maps))
    out, key = df.withColumn("_code", F.lower(trimmed(F.col(code)))), {}
    for a in sources:
        own = [m.select(F.lower(trimmed(F.col("key"))).alias("_code"), F.col("value").alias(f"_{x}_{b}")) for (x, b), m in maps.items() if x == a]
        one = reduce(lambda p, q: p.join(q, "_code", "full"), [first_per_group(m, ["_code"], [F.col(m.columns[1])]) for m in own])
        for c in one.columns[1:]:
            key.setdefault(c.removeprefix(f"_{a}_"), []).append(c)
        out = out.join(one, "_code", "left")
    done = out.withColumns({f"{prefix}{b}": F.coalesce(*cs) for b, cs in key.items()})
    return done.drop("_code", *[c for cs in key.values() for c in cs])


def ethnicity_features(df: DataFrame, id_col: str, column: str, table: DataFrame, prefix: str, check_level: str | None = "main_cat", time: str | None = None) -> DataFrame:
    """Rows whose ethnicity says something, with its levels, the agreement of an entity's values at check_level (of the column itself if there is no such level), and the main category so far at each time."""
    out = with_levels(df.where(substantive(F.col(column), ETHNICITY_FILLERS)), column, table, prefix)
    if check_level:
        checked = f"{prefix}{check_level}" if f"{prefix}{check_level}" in out.columns else column
        told = curated_value(out, id_col, checked)
        out = null_safe_join(out, told.select(id_col, *[F.col(c).alias(f"{prefix}{c}") for c in ("n_values", "has_conflict", "curated")]), [id_col])
    if time and f"{prefix}main_cat" in out.columns:
        rows = out.where(F.col(f"{prefix}main_cat").isNotNull()).groupBy(id_col, time).agg(F.array_sort(F.collect_set(f"{prefix}main_cat")).alias("_values"))
        out = null_safe_join(out, cumulative(rows, id_col, [time], "_values", prefix).select(id_col, time, f"{prefix}main"), [id_col, time])
    return out


def code_sources(df: DataFrame, code: str, table: DataFrame, sources: list[str]) -> DataFrame:
    """(code, source_column): the first source column in which each distinct code is; null if none."""
    codes = df.select(F.lower(trimmed(F.col(code))).alias("code")).distinct().where("code IS NOT NULL")
    places = table.select(F.explode(F.array(*[F.struct(F.lower(trimmed(F.col(s))).alias("code"), F.lit(i).alias("i")) for i, s in enumerate(sources)])).alias("x")).select("x.*").groupBy("code").agg(F.min("i").alias("i"))
    return codes.join(places, "code", "left").select("code", F.get(F.array(*map(F.lit, sources)), F.col("i")).alias("source_column"))


def with_agreed(df: DataFrame, key: str, column: str, prefix: str, fillers: list[str] = ETHNICITY_FILLERS) -> DataFrame:
    """Rows with a substantive value, with `<prefix>n_values`, `has_conflict` and `curated` of their entity."""
    kept = df.where(substantive(F.col(column), fillers))
    told = curated_value(kept, key, column)
    return kept.join(told.select(key, *[F.col(c).alias(f"{prefix}{c}") for c in ("n_values", "has_conflict", "curated")]), key, "left")


def fill_total(total: Column, parts: list[Column]) -> Column:
    """A missing total as the sum of its parts, if all are there."""
    return F.coalesce(total, reduce(lambda a, b: a + b, parts))


def parts_differ(total: Column, parts: list[Column], tolerance: float = 1e-6) -> Column:
    """A known total that is not the sum of its known parts."""
    return F.coalesce(F.abs(total - reduce(lambda a, b: a + b, parts)) > tolerance, F.lit(False))


def ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole)


def split_fixed(c: Column, at: int) -> tuple[Column, Column]:
    return F.substring(c, 1, at), F.substring(c, F.lit(at + 1), F.length(c))


def set_histories(df: DataFrame, id_col: str, time: str, attributes: dict[str, list[str]], prefix: str, threshold: int = 2) -> DataFrame:
    """Per id and time with any value: each attribute's set of values (of its columns; trimmed, sorted, null if there are none), its history, and whether enough of the attributes changed. One aggregate makes all sets; on a table stored by id, no exchange is needed."""
    sets = {name: F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.filter(F.array(*[trimmed(F.col(c)) for c in columns]), lambda v: v.isNotNull() & (v != "")))))) for name, columns in attributes.items()}
    out = df.groupBy(id_col, time).agg(*[v.alias(n) for n, v in sets.items()])
    out = out.select(id_col, time, *[F.when(F.size(n) > 0, F.col(n)).alias(n) for n in sets]).dropna("all", subset=list(sets))
    for name in attributes:
        out = cumulative(out, id_col, [time], name, f"{prefix}{name}_")
    return state_changes(out, id_col, [time], list(attributes), prefix, threshold)


def value_history(df: DataFrame, id_col: str, time: str, column: str, prefix: str, fillers: list[str] = LANGUAGE_FILLERS) -> DataFrame:
    """df with the history of a single-valued column's substantive values, per id and time (null-safe); of several rows of a time, the fullest."""
    rows = df.where(substantive(F.col(column), fillers) & F.col(column).isNotNull()).select(id_col, time, F.array(F.col(column)).alias("_values")).distinct()
    told = cumulative(rows, id_col, [time, "_values"], "_values", prefix)
    best = first_per_group(told, [id_col, time], [F.col(f"{prefix}n_uniq").desc(), F.col("_values").desc()]).drop("_values")
    return null_safe_join(df, best, [id_col, time])


def type_mapping(df: DataFrame, columns: list[str]) -> DataFrame:
    """(raw, clean, changed): the distinct school types in columns and what they are standardised to, for review."""
    raw = unpivot(df, [], columns).where("value IS NOT NULL").select(F.col("value").alias("raw")).distinct()
    return raw.withColumn("clean", classify(F.col("raw"), SCHOOL_TYPES)).withColumn("changed", ~F.col("clean").eqNullSafe(F.col("raw")))


def several_values(df: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """(id, columns): ids that have more than one value in any of the columns, and in which."""
    many = [F.when(F.min(c) < F.max(c), F.lit(c)) for c in columns]
    return df.groupBy(id_col).agg(F.concat_ws(",", *many).alias("columns")).where("columns <> ''")


def school_features(df: DataFrame, id_col: str, time: str, attributes: dict[str, list[str]], prefix: str, type_columns: list[str] | None = None, threshold: int = 2) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """(df with the histories of its school attributes, the mapping of school types if there are type columns, ids with several values in a column). Types are standardised first."""
    types = [c for c in type_columns or [] if c in df.columns]
    mapping = type_mapping(df, types) if types else None
    df = df.withColumns({c: classify(F.col(c), SCHOOL_TYPES) for c in types}) if types else df
    told = set_histories(df, id_col, time, attributes, prefix, threshold)
    return null_safe_join(df, told, [id_col, time]), mapping, several_values(df, id_col, [c for cs in attributes.values() for c in cs])


def gender_features(df: DataFrame, id_col: str, column: str, prefix: str) -> DataFrame:
    """df with how many genders an entity has, whether they differ, and the one that they agree on."""
    told = curated_value(df, id_col, column)
    return null_safe_join(df, told.select(id_col, *[F.col(c).alias(f"{prefix}{c}") for c in ("n_values", "has_conflict", "curated")]), [id_col])


def derive_features(df: DataFrame, id_col: str, time: str, steps: dict[str, dict], prefix: str = "der") -> tuple[DataFrame, dict[str, DataFrame]]:
    """df with the features of each step whose columns it doesn't have yet, and the reports that steps make.

    steps: `ethnicity` (column, table, check_level), `gender` (column), `school`
    (attributes, type_columns, threshold), `language` (column), in this order, each
    with the arguments of its operator. A step is done if df has a column with its
    prefix `<prefix>_<step>` (`sch` for school).
    """
    names = {"ethnicity": "ethnicity", "gender": "gender", "school": "sch", "language": "language"}
    if unknown := set(steps) - set(names):
        raise ValueError(f"no such features: {sorted(unknown)}")
    reports: dict[str, DataFrame] = {}
    for step, name in names.items():
        start = f"{prefix}_{name}"
        if step not in steps or any(start in c.lower() for c in df.columns):
            continue
        told = steps[step]
        if step == "ethnicity":
            df = ethnicity_features(df, id_col, told["column"], told["table"], f"{start}_", told.get("check_level", "main_cat"), time)
        elif step == "gender":
            df = gender_features(df, id_col, told["column"], f"{start}_")
        elif step == "school":
            df, mapping, several = school_features(df, id_col, time, told["attributes"], f"{start}_", told.get("type_columns"), told.get("threshold", 2))
            reports |= {"school_types": mapping} if mapping is not None else {}
            reports["several_schools"] = several
        else:
            df = value_history(df, id_col, time, told["column"], f"{start}_")
    return df, reports
