"""Profiles and checks: what columns hold, what schemas share, and rows that break a rule."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from annalist.operators.frames import long_form, unpivot


def column_profile(df: DataFrame, columns: list[str], most: int = 10) -> DataFrame:
    """(column_name, n_unique, samples): distinct values without null, and the first few by order."""
    return ranked_values(unpivot(df, [], columns).where("value IS NOT NULL").distinct(), ["column_name"], "value", most)


def ranked_values(distinct: DataFrame, keys: list[str], value: str, most: int) -> DataFrame:
    """(keys, n_unique, samples) of distinct values."""
    counts = distinct.groupBy(*keys).agg(F.count("*").alias("n_unique"))
    first = distinct.withColumn("r", F.row_number().over(Window.partitionBy(*keys).orderBy(value))).where(F.col("r") <= most)
    samples = first.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(value)), "|").alias("samples"))
    return counts.join(samples, keys)


def sample_text(values: Column, most: int = 10) -> Column:
    """Sorted values as text, null as Missing, cut after `most` with `, ...`."""
    named = F.array_sort(F.transform(values, lambda v: F.coalesce(v, F.lit("Missing"))))
    return F.concat(F.array_join(F.slice(named, 1, most), ", "), F.when(F.size(named) > most, ", ...").otherwise(""))


def numeric_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    parts = {"n": F.count, "n_missing": lambda c: F.sum(F.col(c).isNull().cast("bigint")), "mean": F.avg, "lo": F.min, "hi": F.max}
    wide = df.agg(*[f(c).alias(f"{k}_{i}") for i, c in enumerate(columns) for k, f in parts.items()])
    return wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), *[F.col(f"{k}_{i}").cast("bigint" if k[0] == "n" else "double").alias(k) for k in parts]) for i, c in enumerate(columns)])).alias("x")).select("x.*")


def top_values(df: DataFrame, columns: list[str], k: int) -> DataFrame:
    counts = unpivot(df, [], columns).groupBy("column_name", "value").agg(F.count("*").alias("n"))
    return counts.withColumn("place", F.row_number().over(Window.partitionBy("column_name").orderBy(F.desc("n"), F.col("value").asc_nulls_last())).cast("bigint")).where(F.col("place") <= k)


def boolean_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, is_boolean): more than one value, all of them words for true or false."""
    words = ["0", "1", "true", "false", "yes", "no", "y", "n"]
    bad = lambda c: F.max((~F.lower(F.col(c).cast("string")).isin(words)).cast("int"))
    return long_form(df, {c: F.coalesce((F.min(c) < F.max(c)) & (bad(c) == 0), F.lit(False)) for c in columns}, "is_boolean")


def differing_columns(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, differing): the columns in which a group has several values, null being one."""
    many = lambda c: (F.coalesce(F.min(c) < F.max(c), F.lit(False))) | ((F.count(c) > 0) & (F.count(c) < F.count("*")))
    return df.groupBy(*keys).agg(F.concat_ws(",", *[F.when(many(c), F.lit(c)) for c in columns]).alias("differing")).where("differing <> ''")


def fingerprint(df: DataFrame, columns: list[str]) -> Column:
    """An aggregate: rows in any order have one fingerprint, the sum of their hashes and their number."""
    # each value by its length and itself, so that no two rows read the same
    text = [F.col(c).cast("string") for c in columns]
    row = F.md5(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]))
    number = F.conv(F.substring(row, 1, 15), 16, 10).cast("decimal(38,0)")
    return F.concat_ws(":", F.count("*").cast("string"), F.sum(number).cast("string"))


def common_columns(schemas: DataFrame, threshold: float = 0.8) -> DataFrame:
    """schemas: (category, file, column_name). (category, column_name, files, missing): columns in enough of a category's files."""
    files = schemas.groupBy("category").agg(F.count_distinct("file").alias("all_files"))
    found = schemas.groupBy("category", "column_name").agg(F.count_distinct("file").alias("files"))
    return found.join(files, "category").where(F.col("files") >= threshold * F.col("all_files")).select("category", "column_name", "files", (F.col("all_files") - F.col("files")).alias("missing"))


def out_of_range(df: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """(column_name, n_bad): values below or above a column's range."""
    return long_form(df, {c: F.coalesce(F.sum((~F.col(c).between(lo, hi)).cast("bigint")), F.lit(0)) for c, (lo, hi) in ranges.items()}, "n_bad")


def coercion_audit(df: DataFrame, pairs: dict[str, tuple[Column, Column]]) -> DataFrame:
    """(column_name, became_null, became_value): pairs are a column before and after a conversion."""
    wide = df.agg(*[F.sum(f(a, b).cast("bigint")).alias(f"{n}_{i}") for i, (a, b) in enumerate(pairs.values()) for n, f in (("lost", lambda a, b: a.isNotNull() & b.isNull()), ("made", lambda a, b: a.isNull() & b.isNotNull()))])
    return wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"lost_{i}").alias("became_null"), F.col(f"made_{i}").alias("became_value")) for i, c in enumerate(pairs)])).alias("x")).select("x.*")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """(n_duplicates): rows beyond the first of each."""
    n = df.groupBy(*df.columns).agg(F.count("*").alias("n"))
    return n.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates"))


# Marks of categories that an inventory leaves out.
LEFT_OUT, LEFT_OUT_MARK = "EXCLUDE", "~"


def counted_categories(df: DataFrame, category: str) -> DataFrame:
    """Rows of categories that count: known ones that are neither excluded nor marked as unused."""
    c = F.col(category)
    return df.where(c.isNotNull() & ~F.contains(c, F.lit(LEFT_OUT)) & ~F.startswith(c, F.lit(LEFT_OUT_MARK)))


def existing_categories(df: DataFrame, keys: list[str], category: str) -> DataFrame:
    return counted_categories(df, category).groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set(category)), ", ").alias("existing"))


def missing_categories(df: DataFrame, group: list[str], cohort: str, category: str) -> DataFrame:
    """Categories that a group has in some cohort, for its cohorts that lack them."""
    df = counted_categories(df, category)
    expected = df.select(*group, cohort).distinct().join(df.select(*group, category).distinct(), group)
    return expected.join(df.select(*group, cohort, category).distinct(), [*group, cohort, category], "left_anti")


def coverage_report(df: DataFrame, group: list[str], cohort: str, category: str) -> DataFrame:
    keys = [*group, cohort]
    df = counted_categories(df, category)
    have = df.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set(category)), ", ").alias("existing"), F.count_distinct(category).alias("n_existing"))
    lack = missing_categories(df, group, cohort, category).groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set(category)), ", ").alias("missing"))
    return have.join(lack, keys, "left")


def missing_groups(df: DataFrame, cohort: str, group: str) -> DataFrame:
    """(cohort, group): groups that some cohort has, for the cohorts that lack them."""
    groups = F.broadcast(df.agg(F.collect_set(group).alias("_all")))  # one row: the year groups of a school system
    return df.groupBy(cohort).agg(F.collect_set(group).alias("_own")).crossJoin(groups).select(cohort, F.explode(F.array_except("_all", "_own")).alias(group))


def require_one_cohort(df: DataFrame, label: str, cohort: str) -> DataFrame:
    """df, if each label of a year group belongs to one cohort."""
    if (bad := df.where(F.col(label).isNotNull()).groupBy(label).agg(F.min(cohort).alias("lo"), F.max(cohort).alias("hi")).where("lo < hi").first()) is not None:
        raise ValueError(f"{bad[label]} belongs to several cohorts: {bad['lo']}, {bad['hi']}")
    return df


def pair_counts(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """(from_col, to_col, n_from, n_to): how many values each side of a mapping has."""
    wide = df.agg(*[F.count(c).alias(f"n_{c}") for c in sorted({*mapping, *mapping.values()})])
    return wide.select(F.explode(F.array(*[F.struct(F.lit(a).alias("from_col"), F.lit(b).alias("to_col"), F.col(f"n_{a}").alias("n_from"), F.col(f"n_{b}").alias("n_to")) for a, b in mapping.items()])).alias("x")).select("x.*")


def _bounds(df: DataFrame, columns: list[str]):
    return df.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))]).first()


def scale_percents(df: DataFrame, columns: list[str]) -> DataFrame:
    """Percent columns as numbers; those whose values are all shares (0 to 1) times 100. One aggregate decides for all."""
    from annalist.functions.coerce import percent_text

    df = df.withColumns({c: percent_text(F.col(c)) for c in columns})
    b = _bounds(df, columns)
    shares = [c for c in columns if b[f"lo_{c}"] is not None and b[f"lo_{c}"] >= 0 and b[f"hi_{c}"] <= 1]
    return df.withColumns({c: F.round(F.col(c) * 100, 2) for c in shares}) if shares else df


def scale_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rate columns that go over 1 divided by 100."""
    b = _bounds(df, columns)
    high = [c for c in columns if (b[f"hi_{c}"] or 0) > 1]
    return df.withColumns({c: F.round(F.col(c) / 100, 2) for c in high}) if high else df
