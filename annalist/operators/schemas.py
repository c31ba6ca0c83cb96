"""What is known of columns: metadata by category, curated types, drift between files, and reports for people to review."""

import difflib
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annalist.catalog import RENAMED_TYPES
from annalist.operators import profile

# Words that booleans are written in, and texts that tell that a code stands for one.
BOOLEAN_VALUES = {"0", "1", "true", "false", "yes", "no", "y", "n"}
BOOLEAN_KEYS = [("0 = no", "1 = yes"), ("0 = false", "1 = true")]


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def column_metadata(files: list[tuple[str, str, DataFrame]], most: int = 10) -> DataFrame:
    """(category, column_name, dtype, dtypes, n_unique, samples, files) of files (category, file name, frame): the first and all types, distinct values without null, the first few by order, and the files that have the column.

    One pass over each file makes the distinct values; the rest is on these.
    """
    parts = []
    for at, (category, name, df) in enumerate(files):
        kinds = dict(df.dtypes)
        values = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]).unpivot([], df.columns, "column_name", "value").distinct()
        kind = F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv])[F.col("column_name")]
        parts.append(values.select(F.lit(category).alias("category"), F.lit(name).alias("file"), F.lit(at).alias("at"), "column_name", kind.alias("dtype"), "value"))
    every = union_all(parts)
    told = every.groupBy("category", "column_name").agg(F.min_by("dtype", "at").alias("dtype"), F.array_join(F.array_sort(F.collect_set("dtype")), ", ").alias("dtypes"), F.array_join(F.array_sort(F.collect_set("file")), ", ").alias("files"))
    distinct = every.where("value IS NOT NULL").select("category", "column_name", "value").distinct()
    ranked = profile.ranked_values(distinct, ["category", "column_name"], "value", most)
    return told.join(ranked, ["category", "column_name"], "left").withColumns({"n_unique": F.coalesce("n_unique", F.lit(0)), "samples": F.coalesce("samples", F.lit(""))})


def require_described_once(metadata: DataFrame) -> DataFrame:
    """metadata, if each category and column has one row."""
    if (bad := metadata.groupBy("category", "column_name").count().where("count > 1").first()) is not None:
        raise ValueError(f"described more than once: {bad['category']}, {bad['column_name']}")
    return metadata


def curated_dtypes(metadata: DataFrame, named: dict[str, list[str]], prefixes: list[str] | None = None) -> DataFrame:
    """metadata (column_name, dtype, samples as `a|b`, values_text) with `curated` and `changed`.

    named: logical type -> names that have it, with or without a category's prefix.
    A column is boolean if its values are more than one, all of them words for truth,
    or if the text on its values says so. Of two types for one column it is an error;
    of none, the raw type stays, under its logical name. Decided on the driver: one
    row for a column.
    """
    rows = []
    for r in metadata.select("category", "column_name", "dtype", "samples", "values_text").collect():
        bare = next((r["column_name"].removeprefix(f"{p}_") for p in prefixes or [] if r["column_name"].startswith(f"{p}_")), r["column_name"])
        found = {kind for kind, names in named.items() if r["column_name"] in names or bare in names}
        values = {v.strip().lower() for v in (r["samples"] or "").split("|") if v.strip()}
        text = (r["values_text"] or "").lower()
        if len(values) > 1 and values <= BOOLEAN_VALUES or any(all(x in text for x in pair) for pair in BOOLEAN_KEYS):
            found.add("boolean")
        if len(found) > 1:
            raise ValueError(f"{r['column_name']} has several types: {sorted(found)}")
        kind = found.pop() if found else r["dtype"]
        rows.append((r["category"], r["column_name"], RENAMED_TYPES.get(kind, kind)))
    told = metadata.sparkSession.createDataFrame(rows, "category string, column_name string, curated string")
    out = metadata.join(F.broadcast(told), ["category", "column_name"])  # a row for each column
    return out.withColumn("changed", ~F.col("curated").eqNullSafe(F.col("dtype")))


def joined_texts(columns: list[str]) -> Column:
    """Distinct texts of several columns in their order, without punctuation at their ends, a line each; empty ones are left out."""
    each = F.transform(F.array(*columns), lambda c: F.trim(F.regexp_replace(c, r"[^\w\s]+$", "")))
    return F.nullif(F.array_join(F.array_distinct(F.filter(each, lambda c: F.length(c) > 0)), "\n"), F.lit(""))


def difference(before: str | None, after: str | None) -> str:
    """Lines that only one of two texts has, marked - and +."""
    return "\n".join(x for x in difflib.ndiff((before or "").splitlines(), (after or "").splitlines()) if x[:1] in "+-")


def _by_arrow(f, kind: str):
    """A function of two texts on Arrow batches, called once for each distinct pair of a batch."""

    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        pairs = pd.Series(list(zip(a, b, strict=True)), dtype=object)
        known = {p: f(*p) for p in set(pairs)}
        return pairs.map(known)

    return F.pandas_udf(run, kind)


def sample_differences(df: DataFrame, column: str, out: str = "difference") -> DataFrame:
    """df with the line differences between the first and the last of an array column's texts; null for fewer than two. Texts go in Arrow batches; only rows with several texts are compared."""
    several = F.size(F.array_distinct(column)) > 1
    ends = [F.when(several, F.element_at(column, i)) for i in (1, -1)]
    return df.withColumn(out, F.when(several, _by_arrow(difference, "string")(*ends)))


def alike_names(pairs: DataFrame, alike: float, strict: bool = True) -> DataFrame:
    """(a, b, similarity) of distinct pairs of names that are more alike than that (or as alike), as difflib tells it.

    An index of letters (each with which of its kind it is in the name) counts what
    two names have in common, in any order: twice that over both lengths is a bound on
    their likeness. Only pairs over the bound are compared exactly, on the executors.
    """
    pairs = pairs.select("a", "b").distinct()
    letters = F.filter(F.split("name", ""), lambda x: x != "")
    names = pairs.select(F.col("a").alias("name")).union(pairs.select("b")).distinct()
    grams = names.select("name", F.char_length("name").alias("size"), F.explode(letters).alias("letter")).groupBy("name", "size", "letter").agg(F.count("*").alias("n"))
    one = lambda side: grams.select(F.col("name").alias(side), F.col("size").alias(f"{side}_size"), "letter", F.col("n").alias(f"{side}_n"))
    shared = pairs.join(one("a"), "a").join(one("b"), ["b", "letter"])
    bound = shared.groupBy("a", "b").agg((2 * F.sum(F.least("a_n", "b_n")) / F.max(F.col("a_size") + F.col("b_size"))).alias("bound"))
    ratio = _by_arrow(lambda a, b: difflib.SequenceMatcher(None, a, b).ratio(), "double")
    over = lambda c: F.col(c) > alike if strict else F.col(c) >= alike
    return bound.where(over("bound")).select("a", "b", ratio("a", "b").alias("similarity")).where(over("similarity"))


def drift(schemas: DataFrame, threshold: float = 0.8, alike: float = 0.5) -> DataFrame:
    """(category, file, column_name, kind, best, similarity): common columns that a file is missing and extra ones that it has.

    schemas: (category, file, column_name). A column is common to a category if
    enough of its files have it. `best` is the most alike column on the other side of
    the same file, if alike enough and both or neither have a `%`; the first by name
    on ties.
    """
    schemas = schemas.select("category", "file", "column_name").distinct()
    common = profile.common_columns(schemas, threshold).select("category", "column_name")
    expected = schemas.select("category", "file").distinct().join(common, "category")
    keys = ["category", "file", "column_name"]
    missing = expected.join(schemas, keys, "left_anti").select(*keys)
    extra = schemas.join(common, ["category", "column_name"], "left_anti").select(*keys)
    sides = missing.withColumnRenamed("column_name", "m").join(extra.withColumnRenamed("column_name", "e"), ["category", "file"])
    sides = sides.where(F.contains("m", F.lit("%")) == F.contains("e", F.lit("%")))
    found = []
    for kind, own, other, frame in (("missing", "m", "e", missing), ("extra", "e", "m", extra)):
        # likeness isn't the same both ways: the name that is looked for comes first
        pairs = sides.select("category", "file", F.col(own).alias("a"), F.col(other).alias("b"))
        scored = pairs.join(alike_names(pairs, alike), ["a", "b"])
        best = scored.groupBy("category", "file", F.col("a").alias("column_name")).agg(F.min(F.struct((-F.col("similarity")).alias("less"), F.col("b").alias("best"))).alias("x"))
        found.append(frame.join(best, keys, "left").select(*keys, F.lit(kind).alias("kind"), F.col("x.best").alias("best"), (-F.col("x.less")).alias("similarity")))
    return found[0].unionByName(found[1])


def duplicate_files(frames: dict[str, DataFrame]) -> list[list[str]]:
    """Names of files that hold the same rows in the same columns."""
    groups: dict[tuple, list[str]] = {}
    for name, df in frames.items():
        columns = sorted(df.columns)
        key = (tuple(columns), df.agg(profile.fingerprint(df, columns).alias("f")).first()["f"])
        groups.setdefault(key, []).append(name)
    return [names for names in groups.values() if len(names) > 1]


def review_report(df: DataFrame, keys: list[str], before: DataFrame | None = None, needed: list[str] | None = None) -> DataFrame:
    """df with `needs_review` (a needed column is empty), `changed` (it differs from the row of the same keys before, or is new) and `changed_columns`.

    What a workbook would show by colours, as columns.
    """
    lacks = reduce(lambda a, b: a | b, [F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "") for c in needed], F.lit(False)) if needed else F.lit(False)
    out = df.withColumn("needs_review", lacks)
    if before is None:
        return out.withColumns({"changed": F.lit(False), "changed_columns": F.lit("")})
    shared = [c for c in df.columns if c in before.columns and c not in keys]
    old = before.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.struct(*[F.col(c).cast("string").alias(c) for c in shared]).alias("_old"), F.lit(True).alias("_was"))
    on = reduce(lambda a, b: a & b, [out[k].eqNullSafe(old[f"_k_{k}"]) for k in keys])
    out = out.join(old, on, "left")
    differing = F.concat_ws(",", *[F.when(F.col("_was") & ~F.col(c).cast("string").eqNullSafe(F.col("_old")[c]), F.lit(c)) for c in shared])
    return out.withColumn("changed_columns", differing).withColumn("changed", F.col("_was").isNull() | (F.col("changed_columns") != "")).drop("_old", "_was", *[f"_k_{k}" for k in keys])


def profile_changed(before: DataFrame, after: DataFrame) -> bool:
    """Whether two frames of as many columns differ in the values of any, by place; rows in any order."""
    one = lambda df: df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    a, b = one(before), one(after)
    return a.agg(profile.fingerprint(a, a.columns).alias("f")).first()["f"] != b.agg(profile.fingerprint(b, b.columns).alias("f")).first()["f"]
