"""Types for whole frames: what a column can hold is decided from all its values, and what a conversion loses is an error or a warning.

Deciding and auditing take one aggregate each over all columns.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annalist.functions import coerce
from annalist.operators.checks import Checks

#: Logical types whose conversion must not lose or make a value, and those that fall back to wider numbers.
STRICT = ("category", "string")
NUMBERS = ("Int64", "Float64", "numeric")


@dataclass
class Finding:
    """What became of a column's values."""

    column: str
    logical: str
    became_null: int
    became_value: int
    #: Dates that lost digits or fell on the default year; texts that are no boolean.
    unreadable: int

    def error(self) -> str | None:
        if self.unreadable:
            return f"{self.column}: {self.unreadable} values can't be read as {self.logical}"
        if self.logical in STRICT and (self.became_null or self.became_value):
            return f"{self.column}: {self.became_null} values became empty and {self.became_value} appeared as {self.logical}"
        return None

    def warning(self) -> str | None:
        return f"{self.column}: {self.became_null} values became empty and {self.became_value} appeared as {self.logical}" if self.became_null or self.became_value else None


def _empty(c: Column) -> Column:
    """Null, without text, or one of the words for nothing."""
    t = F.lower(coerce.trimmed(c))
    return t.isNull() | t.isin(coerce.MISSING_WORDS)


def _decided(df: DataFrame, kinds: dict[str, str]) -> dict[str, str]:
    """Int64 where all values are whole, else Float64; a category stays numeric only if all its values are numbers."""
    asked = [c for c, k in kinds.items() if k in ("Int64", "category")]
    if not asked:
        return kinds
    told = df.agg(
        *[F.max((~_empty(F.col(c)) & coerce.integer(F.col(c)).isNull()).cast("int")).alias(f"f{i}") for i, c in enumerate(asked)],
        *[F.max((~_empty(F.col(c)) & coerce.numeric(F.col(c)).isNull()).cast("int")).alias(f"t{i}") for i, c in enumerate(asked)],
    ).first()
    out = dict(kinds)
    for i, c in enumerate(asked):
        if kinds[c] == "Int64" and told[f"f{i}"]:
            out[c] = "Float64"
        if kinds[c] == "category" and told[f"t{i}"]:
            out[c] = "label"
    return out


def label(c: Column) -> Column:
    """A category of words: trimmed, several words in title case, words for nothing as null; numbers stay as they are written."""
    t = coerce.trimmed(c)
    return F.when(F.lower(t).isin(coerce.MISSING_WORDS), None).when(F.contains(t, F.lit(" ")), coerce.title_case(t)).otherwise(t)


def typed_columns(df: DataFrame, kinds: dict[str, str]) -> dict[str, Column]:
    """column -> its values as the type that all of them can have."""
    return {c: label(F.col(c)) if k == "label" else coerce.coerce(F.col(c), k) for c, k in _decided(df, kinds).items()}


def _counts(kinds: dict[str, str], columns: dict[str, Column]) -> dict[str, Column]:
    """For each conversion, how many values it loses, makes and can't read."""
    parts = {}
    for i, (name, new) in enumerate(columns.items()):
        old = F.col(name)
        kind, none = kinds[name], _empty(old)
        bad = F.lit(False)
        if kind == "datetime":
            # 1970 is what readers put where there is no year
            bad = ~none & ((new.isNull() & F.regexp(old.cast("string"), F.lit(r"\d"))) | F.coalesce(F.year(new) == 1970, F.lit(False)))
        elif kind == "boolean":
            bad = F.coalesce(coerce.is_unknown_boolean(old), F.lit(False))
        for n, flag in (("lost", ~none & new.isNull()), ("made", none & new.isNotNull()), ("bad", bad)):
            parts[f"{n}{i}"] = F.coalesce(F.sum(flag.cast("bigint")), F.lit(0))
    return parts


def _found(kinds: dict[str, str], columns: dict[str, Column], told) -> list[Finding]:
    return [Finding(c, kinds[c], told[f"lost{i}"], told[f"made{i}"], told[f"bad{i}"]) for i, c in enumerate(columns)]


def findings(df: DataFrame, kinds: dict[str, str], columns: dict[str, Column]) -> list[Finding]:
    """What each conversion loses and makes, in one pass over all columns."""
    if not columns:
        return []
    return _found(kinds, columns, df.agg(*[c.alias(n) for n, c in _counts(kinds, columns).items()]).first())


def _errors(found: list[Finding], strict: bool, numbers: str) -> list[str]:
    bad = [e for f in found if (e := f.error())] if strict else []
    return bad + [f"{f.column}: {f.became_null} values are no numbers" for f in found if numbers == "error" and f.logical in NUMBERS and f.became_null]


def typed(df: DataFrame, kinds: dict[str, str], strict: bool = True, numbers: str = "warn", checks: Checks | None = None) -> tuple[DataFrame, list[Finding]]:
    """df with columns of the logical types `kinds`, and what that lost and made.

    A whole-number column with fractions becomes one of fractions; text in number
    columns then becomes null with a finding, or is an error at the end of that chain
    with numbers="error". Columns of lists, structs and maps are always an error.
    Dates that lose their digits, texts that are no boolean, and values that a text
    or category loses are errors if strict. With checks, the conversions are counted
    while the result is written, and the findings are there after they are verified.
    """
    if numbers not in ("warn", "error"):
        raise ValueError(f"no such choice: {numbers}")
    kinds = {c: k for c, k in kinds.items() if c in df.columns and k}
    if nested := [c for c, t in df.dtypes if c in kinds and t.startswith(("array", "struct", "map", "binary"))]:
        raise ValueError(f"columns without single values can't be typed: {nested}")
    columns = typed_columns(df, kinds)
    out = df.withColumns(columns) if columns else df
    if checks is None:
        found = findings(df, kinds, columns)
        if errors := _errors(found, strict, numbers):
            raise ValueError("; ".join(errors))
        return out, [f for f in found if f.warning()]
    found = []

    def told(metrics: dict) -> list[str]:
        every = _found(kinds, columns, metrics) if metrics else []
        found.extend(f for f in every if f.warning())
        return _errors(every, strict, numbers)

    watched = checks.watch(df, _counts(kinds, columns), told)
    return watched.withColumns(columns) if columns else df, found
