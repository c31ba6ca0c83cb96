"""Column functions that read labels: cohorts, year groups and names of files, sheets and columns."""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annalist.functions.coerce import trimmed

# Months as they stand in file names.
MONTHS = "Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec"
#: The year group by which cohorts are named.
FINAL_GROUP = 11


def _years(start: Column, end: Column) -> Column:
    return F.concat_ws(" - ", start.cast("string"), end.cast("string"))


def cohort_label(name: Column, style: str) -> Column:
    """The cohort in a file name. style: `MMM YY` (Mar 18), `YYYY_YY` (2018_19) or `YYYY` (1819); else a year in brackets ends the cohort; else null."""
    found = lambda p, g=1: F.nullif(F.regexp_extract(name, p, g), F.lit(""))
    ways = {
        "MMM YY": lambda: F.concat(F.lit("20"), found(rf"({MONTHS}) (\d{{2}})", 2), F.lit(" "), found(rf"({MONTHS}) (\d{{2}})")),
        "YYYY_YY": lambda: _of_start(found(r"\b(\d{4})_\d{2}\b"), found(r"\b\d{4}_(\d{2})\b")),
        "YYYY": lambda: F.concat(F.lit("20"), found(r"\b(\d{2})\d{2}\b"), F.lit(" - 20"), found(r"\b\d{2}(\d{2})\b")),
    }
    year = found(r"\([^)]*(\d{4})[^)]*\)").try_cast("int")
    in_brackets = F.when(year.isNotNull(), _years(year - 1, year))
    return F.coalesce(ways[style](), in_brackets) if style in ways else in_brackets


def _of_start(start: Column, end_suffix: Column) -> Column:
    end = F.concat(F.substring(start, 1, 2), end_suffix)
    return F.when(start.isNotNull(), F.concat(start, F.lit(" - "), end))


# The label forms that year groups and academic years come in, tried in this order.
YEAR_GROUP_PATTERNS = {
    "group_then_six_digits": r"^\b(Y\d+) (\d{6})\b(?!.*\d{2}\b)",
    "group_then_four_digits": r"\b(Year \d+|Y\d+) (\d{2}\d{2})\b",
    "group_then_short_pair": r"\b(Y\d+).*?\b(\d{2})_(\d{2})\b",
    "group_then_january": r"\b(Y\d+) (\d{6}).*?\b(Jan)\b.*?(\d{2})",
    "group_with_long_pair": r"Y(\d+)\s*\((\d{4})_(\d{2})\)",
    "group_with_short_pair": r"Y(\d+)\s*\((\d{2})_(\d{2})\)",
    "pair_with_group": r"(\d{4})_(\d{2})\s*\(Y(\d+)\)",
    "group_with_bracket": r"Y(\d+)\s*\(([^)]*)\)",
    "pair_alone": r"^[^\d]*?(\d{2})-(\d{2})\b",
}


def year_group(sheet: Column) -> Column:
    """struct(year_group, label) of a sheet name: the first form that fits; both null if none does. Label: `g YYYY - YYYY`."""
    # within a lambda the name is a variable: trimmed once, and forms are tried only until one fits
    return F.element_at(F.transform(F.array(trimmed(sheet)), _year_group), 1)


def _year_group(s: Column) -> Column:
    p = YEAR_GROUP_PATTERNS

    def part(form: str, group: int) -> Column:
        return F.regexp_extract(s, p[form], group)

    def number(form: str, group: int) -> Column:
        return F.regexp_replace(part(form, group), r"\D", "").try_cast("int")

    def digits(form: str, group: int, at: int, n: int) -> Column:
        return F.substring(part(form, group), at, n).try_cast("int")

    def rule(fits: Column, group: Column, start: Column, end: Column) -> Column:
        label = F.concat(group.cast("string"), F.lit(" "), _years(start, end))
        return F.when(fits, F.struct(group.cast("int").alias("year_group"), label.alias("label")))

    fits = lambda form: F.regexp(s, F.lit(p[form]))
    century = F.lit(2000)
    six = F.regexp_extract(s, r"\b(\d{6})\b", 1)
    january = number("group_then_january", 4) + century
    bracket = part("group_with_bracket", 2)
    bracket_year = F.regexp_extract(bracket, r"\b(\d{2})\b", 1).try_cast("int") + century
    a, b, c, d, e, f, g, h, i = p
    rules = [
        rule(fits(a) & ~F.contains(s, F.lit("_")), number(a, 1), digits(a, 2, 1, 4), digits(a, 2, 5, 2) + century),
        rule(fits(b), number(b, 1), digits(b, 2, 1, 2) + century, digits(b, 2, 3, 2) + century),
        rule(fits(c), number(c, 1), number(c, 2) + century, number(c, 3) + century),
        rule(fits(d), number(d, 1), january - 1, january),
        rule(fits(e), number(e, 1), number(e, 2), number(e, 3) + century),
        rule(fits(f), number(f, 1), number(f, 2) + century, number(f, 3) + century),
        rule(fits(g), number(g, 3), number(g, 1), number(g, 2) + century),
        rule(fits(h) & (F.regexp_count(bracket, F.lit(r"\b\d{2}\b")) == 1), number(h, 1), bracket_year - 1, bracket_year),
        rule(fits(i), F.lit(FINAL_GROUP), number(i, 1) + century, number(i, 2) + century),
        rule((F.regexp_count(s, F.lit(r"\bY\d+\b")) == 1) & (F.regexp_count(s, F.lit(r"\b\d{6}\b")) == 1), F.regexp_extract(s, r"\bY(\d+)\b", 1).try_cast("int"), F.substring(six, 1, 4).try_cast("int"), F.substring(six, 5, 2).try_cast("int") + century),
    ]
    return F.coalesce(*rules)


def curated_cohort(group: Column, label: Column, final: Column) -> Column:
    """struct(year_group, label): a group and its label made to agree with the cohort's final year (`YYYY - YYYY`).

    Without a label it is shifted from the final year. A final-year group whose
    label starts in another year is moved to the group of that year. Another group
    whose label starts in the final year has its label shifted. Labels that can't
    be read stay as they are, without a final year there is none.
    """
    pair = r"^\s*(\d+)\s*-\s*(\d+)\s*$"
    own = F.regexp_replace(label, r"^\S+ ", "")
    year = lambda c, g: F.regexp_extract(c, pair, g).try_cast("int")
    f1, f2, o1, o2 = year(final, 1), year(final, 2), year(own, 1), year(own, 2)
    text = lambda g, a, b: F.concat(F.lit("Y"), g.cast("string"), F.lit(" "), _years(a, b))
    shifted = text(group, f1 + group - FINAL_GROUP, f2 + group - FINAL_GROUP)
    moved = F.lit(FINAL_GROUP) - (f1 - o1)
    readable = f1.isNotNull() & (label.isNull() | o1.isNotNull())
    moves = readable & label.isNotNull() & (group == FINAL_GROUP) & (o1 != f1)
    new_label = F.when(~readable, label).when(label.isNull(), shifted).when(moves, text(moved, o1, o2)).when((group != FINAL_GROUP) & (o1 == f1), shifted).otherwise(text(group, o1, o2))
    return F.struct(F.when(F.coalesce(moves, F.lit(False)), moved).otherwise(group).cast("int").alias("year_group"), F.when(final.isNotNull(), new_label).alias("label"))


def academic_year(start: Column, group: Column) -> Column:
    """The academic year `YYYY-YYYY` in which a cohort, by the start of its final year, is in a group."""
    first = start + group - FINAL_GROUP
    return F.concat_ws("-", first.cast("string"), (first + 1).cast("string"))


def end_year(label: Column) -> Column:
    return F.right(trimmed(label), F.lit(4)).try_cast("int")


def snake_case(name: Column) -> Column:
    """An underscore before capitals that don't follow one; names with an underscore or in capitals stay."""
    stays = F.contains(name, F.lit("_")) | (name == F.upper(name))
    return F.when(stays, name).otherwise(F.regexp_replace(name, r"(?<!^)(?<![A-Z])(?=[A-Z])", "_"))


def is_mixed_case(name: Column) -> Column:
    """Two capitals, two small letters, and no white space."""
    return F.regexp(name, F.lit(r"^\S*$")) & (F.regexp_count(name, F.lit("[A-Z]")) >= 2) & (F.regexp_count(name, F.lit("[a-z]")) >= 2)


def standard_file_name(parts: list[Column], group: Column | None = None, suffix: str = ".parquet") -> Column:
    """Parts with spaces as `-`, a group as `Y<n>`, joined by `_`; nulls are left out."""
    dashed = [F.regexp_replace(F.regexp_replace(trimmed(p), r"\s+", "-"), "-+", "-") for p in parts]
    if group is not None:
        dashed.append(F.concat(F.lit("Y"), group.cast("int").cast("string")))
    return F.concat(F.concat_ws("_", *dashed), F.lit(suffix))


# Literal replacements that come before the general rules of column names.
NAME_RULES = {"&": "and", "%": "_%"}


def standard_column_names(names: list[str], rules: dict[str, str] | None = None) -> list[str]:
    """Lower-case names of letters, digits, `%` and single underscores; rules are literal replacements that come first."""
    out = []
    for name in names:
        for old, new in (NAME_RULES if rules is None else rules).items():
            name = name.replace(old, new)
        if "_" not in name and not name.isupper():
            name = re.sub(r"(?<!^)(?<![A-Z])(?=[A-Z])", "_", name)
        name = re.sub(r"[^\w%]+", "_", name.lower())
        out.append(re.sub("_+", "_", name).strip("_"))
    return out


def base_name(column: str) -> str:
    """A column's name without the `.N` that readers give to repeated names."""
    return re.sub(r"\.\d+$", "", column)


NAME_PARTS = ("data_category", "cohort_y11_ay", "cohort_yg_ay", "year_group")


def validated_name_format(parts: list[str]) -> list[str]:
    """Parts of a file name: known ones, category and cohort among them; of cohort_yg_ay and year_group the earlier only."""
    if unknown := [p for p in parts if p not in NAME_PARTS]:
        raise ValueError(f"unknown parts of a file name: {unknown}")
    if missing := [p for p in NAME_PARTS[:2] if p not in parts]:
        raise ValueError(f"a file name needs {missing}")
    if not 3 <= len(parts) <= 4 or len(set(parts)) < len(parts):
        raise ValueError("a file name has three or four different parts")
    if len(parts) == 4:
        later = max(NAME_PARTS[2:], key=parts.index)
        parts = [p for p in parts if p != later]
    return parts


def resolve_column(names: list[str] | str, columns: list[str], prefixes: list[str]) -> str | None:
    """The first column that a name stands for: itself, with a prefix, or without one."""
    for name in [names] if isinstance(names, str) else names:
        bare = [name.removeprefix(f"{p}_") for p in prefixes if name.startswith(f"{p}_")]
        for candidate in [name, *(f"{p}_{name}" for p in prefixes), *bare]:
            if candidate in columns:
                return candidate
    return None


def lookup_texts(names: DataFrame, sources: dict[str, DataFrame], key: str, value: str) -> DataFrame:
    """names with the value of each source (its last row of a key), `text` if all that have one agree, else all of them, and `agrees`."""
    for source, df in sources.items():
        # without a column `row`, the largest text counts
        last = df.groupBy(key).agg((F.max_by(value, F.struct("row", value)) if "row" in df.columns else F.max(value)).alias(f"_{source}"))
        names = names.join(last, key, "left")
    texts = F.array_distinct(F.array_compact(F.array(*[f"_{s}" for s in sources])))
    return names.withColumns({"text": F.array_join(texts, " / "), "agrees": F.size(texts) <= 1}).drop(*[f"_{s}" for s in sources])
