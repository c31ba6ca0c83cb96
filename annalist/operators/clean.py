"""Row and column cleaning. Decisions about columns take one aggregate each; frames stay lazy."""

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from annalist.functions.coerce import trimmed
from annalist.operators.frames import long_form, one_row

META = "_"


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    counts = one_row(df, F.count)
    return df.select(*[c for c in df.columns if counts[c]])


def distinct_with_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows once, and the repetitions that were left out (as often as they repeat)."""
    rank = F.row_number().over(Window.partitionBy(*[F.col(c) for c in df.columns]).orderBy(F.lit(1)))
    return df.dropDuplicates(), df.withColumn("_n", rank).where("_n > 1").drop("_n")


def drop_null_ids(df: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    return df.where(F.col(id_col).isNotNull()), df.where(F.col(id_col).isNull())


def block_ids(df: DataFrame, id_col: str, blocked: list | DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose id is not blocked (a null id is not), and the others. A long list comes as a DataFrame."""
    if isinstance(blocked, list):
        hit = F.coalesce(F.col(id_col).isin(blocked), F.lit(False))
        return df.where(~hit), df.where(hit)
    return df.join(blocked, id_col, "left_anti"), df.join(blocked, id_col, "left_semi")


def drop_sensitive(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.drop(*[c for c in columns if c in df.columns])


def constant_columns(df: DataFrame, skip: tuple[str, ...] = ()) -> list[str]:
    """Columns of one value, null being a value too."""
    columns = [c for c in df.columns if c not in skip]
    told = df.agg(F.count("*").alias("rows"), *[f(c).alias(f"{n}_{i}") for i, c in enumerate(columns) for n, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]).first()
    return [c for i, c in enumerate(columns) if not told[f"n_{i}"] or (told[f"n_{i}"] == told["rows"] and told[f"lo_{i}"] == told[f"hi_{i}"])]


def constant_flags(df: DataFrame) -> DataFrame:
    """(column_name, is_constant) in one pass."""
    n = F.count("*")
    return long_form(df, {c: (F.count(c) == 0) | ((F.count(c) == n) & F.coalesce(F.min(c) == F.max(c), F.lit(False))) for c in df.columns}, "is_constant")


def null_ratios(df: DataFrame) -> DataFrame:
    """(column_name, null_ratio)"""
    return long_form(df, {c: F.avg(F.col(c).isNull().cast("double")) for c in df.columns}, "null_ratio")


def sparse_columns(df: DataFrame, threshold: float) -> list[str]:
    ratios = one_row(df, lambda c: F.avg(F.col(c).isNull().cast("double")))
    return [c for c in df.columns if (ratios[c] or 0) > threshold]


def repeated_ids(df: DataFrame, id_col: str) -> DataFrame:
    return df.groupBy(id_col).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def value_counts_by_file(df: DataFrame, file_col: str) -> DataFrame:
    """(file, column_name, value, n): how often each file has each value, null being `Missing`; counts are made before rows are dealt."""
    columns = [c for c in df.columns if c != file_col]
    named = df.select(F.col(file_col).alias("file"), *[F.coalesce(F.col(c).cast("string"), F.lit("Missing")).alias(c) for c in columns])
    return named.unpivot(["file"], columns, "column_name", "value").groupBy("file", "column_name", "value").agg(F.count("*").alias("n"))


def _shares(counts: DataFrame, most: int) -> DataFrame:
    """(column_name, n_values, distribution, missing_share) of (column_name, value, n): the first few values by share, ties by value, as `a (66.67%), b (33.33%)`, and how many more there are."""
    of = Window.partitionBy("column_name")
    ranked = counts.withColumns({"total": F.sum("n").over(of), "n_values": F.count("*").over(of), "place": F.row_number().over(of.orderBy(F.desc("n"), "value"))})
    share = F.col("n") / F.col("total")
    text = F.concat("value", F.format_string(" (%.2f%%)", share * 100))
    shown = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("place") <= most, F.struct("place", text.alias("text"))))), lambda x: x["text"]), ", ")
    more = F.when(F.max("n_values") > most, F.concat(F.lit("... ("), (F.max("n_values") - most).cast("string"), F.lit(" more not shown)"))).otherwise("")
    missing = F.coalesce(F.max(F.when(F.col("value") == "Missing", share)), F.lit(0.0))
    return ranked.groupBy("column_name").agg(F.max("n_values").alias("n_values"), F.concat(shown, more).alias("distribution"), missing.alias("missing_share"))


def constancy(df: DataFrame, file_col: str, consistency: float = 0.8, missing: float | None = 0.8, middle: float = 0.5, most: int = 5, never_missing: tuple[str, ...] = ()) -> DataFrame:
    """(column_name, verdict, top_value, top_share, n_files, n_constant, missing_share, values, constants) of columns over all files.

    A column is `constant` if one value is the only one in enough files (`Missing`
    for none being a value), `missing` if it isn't but enough of all its values are
    missing (unless it begins with one of never_missing, or missing is None), and
    `middle` if its top share is at least middle; other columns have no verdict, and
    those without any value are left out. values and constants tell the first few of
    all values and of the files' only ones (`NonConstant` where there are several).

    Rows become counts by file and value first; all else is on these.
    """
    counts = value_counts_by_file(df, file_col)
    files = counts.groupBy("column_name", "file").agg(F.when(F.count("*") == 1, F.min("value")).otherwise("NonConstant").alias("value"))
    constants = files.groupBy("column_name", "value").agg(F.count("*").alias("n"))
    overall = _shares(counts.groupBy("column_name", "value").agg(F.sum("n").alias("n")), most).withColumnRenamed("distribution", "values")
    told = constants.groupBy("column_name").agg(
        F.sum("n").alias("n_files"), F.sum(F.when(F.col("value") != "NonConstant", F.col("n")).otherwise(0)).alias("n_constant"),
        F.min(F.when(F.col("value") != "NonConstant", F.struct((-F.col("n")).alias("less"), F.col("value").alias("value")))).alias("top"),
    )
    out = told.join(overall, "column_name").join(_shares(constants, most).select("column_name", F.col("distribution").alias("constants")), "column_name")
    share = F.coalesce(-F.col("top.less") / F.col("n_files"), F.lit(0.0))
    spared = reduce(lambda a, b: a | b, [F.startswith("column_name", F.lit(p)) for p in never_missing], F.lit(False))
    empty = F.lit(False) if missing is None else (F.col("missing_share") >= missing) & ~spared
    verdict = F.when(share >= consistency, "constant").when(empty, "missing").when(share >= middle, "middle")
    out = out.where(~((F.col("n_values") == 1) & (F.col("missing_share") == 1)))
    return out.select("column_name", verdict.alias("verdict"), F.col("top.value").alias("top_value"), share.alias("top_share"), "n_files", "n_constant", "missing_share", "values", "constants")


def globally_constant_columns(df: DataFrame, file_col: str, consistency: float = 0.8) -> DataFrame:
    """(column_name, value, share): columns that have one and the same value within most files. Nulls count as `Missing`; columns that are all missing don't."""
    columns = [c for c in df.columns if c != file_col]
    told = df.groupBy(file_col).agg(*[f(F.coalesce(F.col(c).cast("string"), F.lit("Missing"))).alias(f"{n}_{i}") for i, c in enumerate(columns) for n, f in (("lo", F.min), ("hi", F.max))])
    rows = told.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.when(F.col(f"lo_{i}") == F.col(f"hi_{i}"), F.col(f"lo_{i}")).otherwise("NonConstant").alias("value")) for i, c in enumerate(columns)])).alias("x")).select("x.*")
    shares = rows.groupBy("column_name", "value").agg(F.count("*").alias("files"))
    total = rows.groupBy("column_name").agg(F.count("*").alias("all_files"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    top = shares.where("value <> 'NonConstant'").withColumn("r", F.row_number().over(Window.partitionBy("column_name").orderBy(F.desc("files"), "value"))).where("r = 1")
    share = F.col("files") / F.col("all_files")
    return top.join(total, "column_name").where(~((F.col("lo") == "Missing") & (F.col("hi") == "Missing"))).where(share >= consistency).select("column_name", "value", share.alias("share"))


# Columns that a merged table does without, as other sources tell the same better.
REDUNDANT = ["ks4_gender", "nccis_sex_code", "nccis_calculated_sex_code", "nccis_establishment_type"]


def drop_redundant(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.drop(*[c for c in (REDUNDANT if columns is None else columns) if c in df.columns])


def matching_columns(columns: list[str], include: list[str] | None = None, exclude: list[str] | None = None, first: str | None = None, last: str | None = None) -> list[str]:
    """Columns whose names, in any case, contain one of include (all if none is given) and none of exclude, from the column `first` to `last` by place."""
    has = lambda c, words: any(w.lower() in c.lower() for w in words)
    a = columns.index(first) if first else 0
    z = columns.index(last) + 1 if last else len(columns)
    return [c for c in columns[a:z] if (include is None or has(c, include)) and not has(c, exclude or [])]


def replace_ampersand(df: DataFrame) -> DataFrame:
    return df.select(*[F.regexp_replace(c, "&", "and").alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])


def append_metadata(df: DataFrame, **values) -> DataFrame:
    return df.withColumns({f"{META}{k}": F.lit(None if v is None else str(v)).cast("string") for k, v in values.items()})


def remove_metadata(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in df.columns if not c.startswith(META)])


def reorder(df: DataFrame, first: list[str]) -> DataFrame:
    """The named columns first, metadata last, the rest as they are."""
    head = [c for c in first if c in df.columns]
    meta = [c for c in df.columns if c.startswith(META) and c not in head]
    return df.select(*head, *[c for c in df.columns if c not in head and c not in meta], *meta)


def substantive(c: Column, fillers: list[str]) -> Column:
    """True unless the trimmed, lower-cased text is a filler; null is kept."""
    return c.isNull() | ~F.lower(trimmed(c)).isin(fillers)


def recode(c: Column, values: dict) -> Column:
    """Exact matches replaced, a value of None by null."""
    out = None
    for old, new in values.items():
        out = (F.when if out is None else out.when)(c == F.lit(old), F.lit(new))
    return c if out is None else out.otherwise(c)


def column_fingerprints(df: DataFrame, row_id: list[str]) -> DataFrame:
    """(column_name, fingerprint): equal for columns that are equal in all rows. The row's id is part of each hash, and sums don't depend on order."""
    one = lambda c: F.sum(F.xxhash64(*row_id, F.coalesce(F.col(c).cast("string"), F.lit("\u0000null"))).cast("decimal(38,0)"))
    return long_form(df, {c: one(c).cast("string") for c in df.columns if c not in row_id}, "fingerprint")


def identical_columns(df: DataFrame, row_id: list[str], check: bool = True) -> DataFrame:
    """(kept, dropped) pairs of equal columns, the first by place being kept. With check, candidates by fingerprint are compared value by value, all pairs in one pass."""
    names = [c for c in df.columns if c not in row_id]
    prints: dict[str, list[str]] = {}
    found = {r["column_name"]: r["fingerprint"] for r in column_fingerprints(df, row_id).collect()}  # a row for each column
    for c in names:
        prints.setdefault(found[c], []).append(c)
    pairs = [(same[0], other) for same in prints.values() for other in same[1:]]
    if check and pairs:
        differ = lambda a, b: F.coalesce(F.max((~F.col(a).cast("string").eqNullSafe(F.col(b).cast("string"))).cast("int")), F.lit(0))
        told = df.agg(*[differ(a, b).alias(f"d{i}") for i, (a, b) in enumerate(pairs)]).first()
        pairs = [p for i, p in enumerate(pairs) if not told[f"d{i}"]]
    return df.sparkSession.createDataFrame(pairs, "kept string, dropped string")


def backfill_from_reference(df: DataFrame, key: str, column: str, where: Column, reference: Column, order: list) -> DataFrame:
    """Nulls of column in rows `where`, filled from the key's first reference row (by order) that has a value."""
    ref = df.where(reference & F.col(column).isNotNull()).withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_r = 1").select(key, F.col(column).alias("_fill"))
    filled = F.when(where & F.col(column).isNull(), F.col("_fill")).otherwise(F.col(column))
    return df.join(ref, key, "left").withColumn(column, filled).drop("_fill")


@dataclass
class CleanOptions:
    id_col: str
    drop_duplicates: bool = True
    blocked: list = field(default_factory=list)
    sensitive: list[str] = field(default_factory=list)
    drop_constant: bool | list[str] = False
    null_threshold: float | None = None


def clean_files(frames: dict[str, DataFrame], options: CleanOptions, file_col: str = "_file") -> tuple[DataFrame, DataFrame, DataFrame]:
    """All files as one job: (kept rows, rejected rows with `reject_reason`, metadata of the kept columns), each with the file's name.

    Each file loses its own empty columns, and is cleaned by the same options; the
    metadata tells each column's type, values, distinct values and share of nulls.
    """
    if not frames:
        raise ValueError("no files")
    kept, bad, told = [], [], []
    for name, df in frames.items():
        good, rejected = clean(df, options)
        kept.append(good.withColumn(file_col, F.lit(name)))
        bad.append(rejected.withColumn(file_col, F.lit(name)))
        kinds = dict(good.dtypes)
        columns = [c for c in good.columns if not c.startswith(META)]
        wide = good.agg(F.count("*").alias("rows"), *[f(c).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("n", F.count), ("u", F.count_distinct))])
        rows = [F.struct(F.lit(c).alias("column_name"), F.lit(kinds[c]).alias("dtype"), F.col(f"n{i}").alias("n_values"), F.col(f"u{i}").alias("n_unique"), F.try_divide(F.col("rows") - F.col(f"n{i}"), F.col("rows")).alias("null_ratio")) for i, c in enumerate(columns)]
        told.append(wide.select(F.lit(name).alias(file_col), F.explode(F.array(*rows)).alias("x")).select(file_col, "x.*"))
    union = lambda parts: reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return union(kept), union(bad), union(told)


def clean(df: DataFrame, options: CleanOptions) -> tuple[DataFrame, DataFrame]:
    """Kept rows, and rejected ones with `reject_reason`. In this order: empty columns, repeated rows, null ids, blocked ids, sensitive, constant and sparse columns."""
    df = drop_all_null_columns(df)
    rejects = []
    if options.drop_duplicates:
        df, bad = distinct_with_rejects(df)
        rejects.append(bad.withColumn("reject_reason", F.lit("duplicate")))
    df, bad = drop_null_ids(df, options.id_col)
    rejects.append(bad.withColumn("reject_reason", F.lit("null_id")))
    if options.blocked:
        df, bad = block_ids(df, options.id_col, options.blocked)
        rejects.append(bad.withColumn("reject_reason", F.lit("blocked_id")))
    df = drop_sensitive(df, options.sensitive)
    if options.drop_constant:
        names = constant_columns(df, (options.id_col,)) if options.drop_constant is True else options.drop_constant
        df = df.drop(*names)
    if isinstance(options.null_threshold, float):
        df = df.drop(*sparse_columns(df, options.null_threshold))
    out = rejects[0]
    for r in rejects[1:]:
        out = out.unionByName(r, allowMissingColumns=True)
    return df, out
