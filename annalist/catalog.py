"""The schema catalogue: logical types and prefixes of columns by category."""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist.functions.coerce import TYPES, coerce
from annalist.functions.labels import resolve_column
from annalist.operators import guards
from annalist.operators.frames import prefixed

# Names of raw types and the logical types that they become.
RENAMED_TYPES = {"timestamp": "datetime", "int64": "Int64", "double": "Float64", "bool": "boolean"}


@dataclass
class SchemaCatalog:
    """category -> {column: logical type}; names come with or without the category's prefix."""

    types: dict[str, dict[str, str]]
    prefixes: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        self.types = {c: {n: RENAMED_TYPES.get(t, t) for n, t in cols.items()} for c, cols in self.types.items()}
        if bad := {t for cols in self.types.values() for t in cols.values()} - set(TYPES):
            raise ValueError(f"unknown logical types: {sorted(bad)}")

    def prefix_of(self, category: str) -> str:
        return self.prefixes.get(category, category)

    def prefix(self, category: str, df: DataFrame, id_col: str) -> DataFrame:
        return prefixed(df, self.prefix_of(category), (id_col,))

    def type_of(self, column: str, category: str | None = None) -> str | None:
        """A column's type in a category, or in the first category that has it."""
        for c in [category] if category else self.types:
            if found := resolve_column(column, list(self.types[c]), [self.prefix_of(c)]):
                return self.types[c][found]
        return None

    def kinds(self, category: str | None, df: DataFrame) -> dict[str, str]:
        return {c: k for c in df.columns if (k := self.type_of(c, category))}

    def apply(self, category: str | None, df: DataFrame) -> DataFrame:
        """Columns in their logical types, in one projection; unknown ones stay. What can't be read becomes null; see guarded()."""
        kinds = self.kinds(category, df)
        return df.select(*[coerce(F.col(c), kinds[c]).alias(c) if c in kinds else F.col(c) for c in df.columns])

    def guarded(self, category: str | None, df: DataFrame, strict: bool = True, **options) -> tuple[DataFrame, list[guards.Finding]]:
        """Columns in the types that all their values can have; an error if a value is lost that must not be, else what was. See `guards.typed`."""
        return guards.typed(df, self.kinds(category, df), strict, **options)
