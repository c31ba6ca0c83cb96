"""Small helpers on frames that many operators use."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def one_row(df: DataFrame, f: Callable[[str], Column]) -> Row:
    """f of each column, in one aggregate."""
    return df.agg(*[f(c).alias(c) for c in df.columns]).first()


def long_form(df: DataFrame, aggregates: dict[str, Column], value: str) -> DataFrame:
    """(column_name, value): aggregates of one pass as rows."""
    names = list(aggregates)
    wide = df.agg(*[aggregates[c].alias(f"_{i}") for i, c in enumerate(names)])
    return wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias(value)) for i, c in enumerate(names)])).alias("x")).select("x.*")


def unpivot(df: DataFrame, ids: list[str], columns: list[str], name: str = "column_name", value: str = "value") -> DataFrame:
    return df.unpivot(ids, [F.col(c).cast("string").alias(c) for c in columns], name, value) if columns else df.select(*ids, F.lit(None).cast("string").alias(name), F.lit(None).cast("string").alias(value)).limit(0)


def first_per_group(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each group under a total order."""
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rank = 1").drop("_rank")


def prefixed(df: DataFrame, prefix: str, skip: tuple[str, ...] = ()) -> DataFrame:
    """All columns with a prefix, but for the skipped, those that have it and metadata."""
    return df.select(*[F.col(c).alias(c if c in skip or c.startswith((f"{prefix}_", "_")) else f"{prefix}_{c}") for c in df.columns])
