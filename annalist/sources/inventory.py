"""An inventory of source files: category, cohort and year group out of their names."""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annalist.functions import labels
from annalist.operators.joins import null_safe_join
from annalist.sources.manifest import count_rows

EXCLUDED = "EXCLUDE"
# Categories whose files are of one year group, and those that need no cohort of their group.
GROUP_OF_CATEGORY = {"ks2": 6, "ks4": 11}
WITHOUT_GROUP = ("nccis", "sepGuarantee")


@dataclass
class CategoryRule:
    """A category whose keywords are in the file or sheet name, and whose criteria (any, if given) are in the file name."""

    category: str
    keywords: list[str]
    criteria: list[str] = field(default_factory=list)


@dataclass
class ExcludeRule:
    """Files whose name contains a text, with any of some texts in the sheet's."""

    name_contains: str
    sheets_contain: list[str]


def _any(c: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(c, F.lit(w.lower()))
    return out


def categorise(file: Column, sheet: Column, rules: list[CategoryRule], excluded: list[ExcludeRule]) -> Column:
    """Exclusions first, then the first category in order; names in lower case without `ANON`."""
    name, tab = (F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), "ANON", "")) for c in (file, sheet))
    out = F.when(F.lit(False), "")
    for r in excluded:
        out = out.when(F.contains(name, F.lit(r.name_contains.lower())) & _any(tab, r.sheets_contain), EXCLUDED)
    for r in rules:
        fits = _any(name, r.keywords) | _any(tab, r.keywords)
        out = out.when(fits & _any(name, r.criteria) if r.criteria else fits, r.category)
    return out


def inventory(files: DataFrame, rules: list[CategoryRule], excluded: list[ExcludeRule] | None = None, date_format: str = "YYYY_YY") -> DataFrame:
    """files (file_name, sheet_name) with category, cohort, raw and curated year group and label, and whether a person should look."""
    out = files.withColumn("category", categorise(F.col("file_name"), F.col("sheet_name"), rules, excluded or []))
    out = out.withColumn("cohort", labels.cohort_label(F.col("file_name"), date_format)).withColumn("_raw", labels.year_group(F.col("sheet_name")))
    fixed = F.create_map(*[F.lit(x) for kv in GROUP_OF_CATEGORY.items() for x in kv])[F.col("category")]
    out = out.withColumns({"raw_year_group": F.col("_raw.year_group"), "raw_label": F.col("_raw.label")})
    out = out.withColumn("_cur", labels.curated_cohort(F.coalesce(fixed, F.col("raw_year_group")), F.col("raw_label"), F.col("cohort")))
    out = out.withColumns({"year_group": F.col("_cur.year_group"), "label": F.col("_cur.label")})
    grouped = ~F.coalesce(F.col("category").isin(*WITHOUT_GROUP), F.lit(False))
    review = F.col("cohort").isNull() | (grouped & (F.col("year_group").isNull() | F.col("label").isNull()))
    return out.withColumn("needs_review", review & (F.coalesce(F.col("category"), F.lit("")) != EXCLUDED)).drop("_raw", "_cur")


def duplicates(found: DataFrame) -> DataFrame:
    """Entries of one category, cohort and year group that come more than once."""
    keys = ["category", "cohort", "year_group"]
    return found.join(found.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(*[F.col(k).alias(f"_{k}") for k in keys]), F.expr(" AND ".join(f"{k} <=> _{k}" for k in keys)), "left_semi")


def standard_names(found: DataFrame) -> DataFrame:
    return found.withColumn("standard_name", labels.standard_file_name([F.col("category"), F.col("cohort"), F.regexp_replace("label", r"^\S+ ", "")], F.col("year_group")))


def extended(known: DataFrame, files: DataFrame, rules: list[CategoryRule], excluded: list[ExcludeRule] | None = None, date_format: str = "YYYY_YY") -> DataFrame:
    """A known inventory with entries for the files (file_name, sheet_name) that it doesn't have; what people edited stays."""
    keys = ["file_name", "sheet_name"]
    new = null_safe_join(files.select(*keys).distinct(), known.select(*keys).distinct(), keys, "left_anti")
    return known.unionByName(inventory(new, rules, excluded, date_format), allowMissingColumns=True)


def with_row_counts(found: DataFrame, frames: dict[str, DataFrame]) -> DataFrame:
    """found with `n_rows` of the files whose tables are given."""
    if not frames:
        return found.withColumn("n_rows", F.lit(None).cast("bigint"))
    counts = count_rows(frames).select(F.col("source").alias("file_name"), F.col("n").alias("n_rows"))
    return found.join(counts, "file_name", "left")


def from_names(files: DataFrame, parts: list[str], separator: str = "_") -> DataFrame:
    """files (file_name) with a column for each part of the name without its suffix, by place; `Yn` of a year group as a number."""
    stem = F.split(F.regexp_replace("file_name", r"\.[^.]*$", ""), F.lit(rf"\Q{separator}\E"))
    out = files.withColumns({p: F.get(stem, F.lit(i)) for i, p in enumerate(parts)})
    return out.withColumn("year_group", F.regexp_extract("year_group", r"^Y?(\d+)$", 1).try_cast("int")) if "year_group" in parts else out
