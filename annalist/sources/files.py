"""Tables in files: Parquet, CSV and, where a reader is installed, workbooks."""

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annalist.functions.labels import base_name


def load(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """A table by its suffix: .parquet, .csv (all text, with a header) or .xlsx (the first sheet unless named)."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    if path.endswith(".csv"):
        return spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"')
    if path.endswith(".xlsx"):
        tables = load_sheets(spark, path, [sheet] if sheet else None)
        return next(iter(tables.values()))
    raise ValueError(f"no reader for {path}")


def sheet_names(path: str) -> list[str]:
    """The sheets of a workbook, where a reader is installed."""
    import pandas as pd  # a workbook is one file, small enough for the driver

    with pd.ExcelFile(path) as book:
        return [str(n) for n in book.sheet_names]


def load_sheets(spark: SparkSession, path: str, sheets: list[str] | None = None, skip: int = 0) -> dict[str, DataFrame]:
    """sheet -> table (all text) of a workbook: the named sheets or all, without the first lines if any are skipped."""
    import pandas as pd

    names = sheets or sheet_names(path)
    if missing := set(names) - set(sheet_names(path)):
        raise ValueError(f"{path} has no sheets {sorted(missing)}")
    found = pd.read_excel(path, sheet_name=names, dtype=str, skiprows=skip)
    return {n: spark.createDataFrame(t.astype(object).where(t.notna(), None), ", ".join(f"`{c}` string" for c in t.columns)) for n, t in found.items()}


def resolve(spark: SparkSession, df: DataFrame | None = None, path: str | None = None, default: str | None = None) -> DataFrame:
    """A frame as given, else from a path, else from the default path."""
    if df is not None:
        return df
    if path or default:
        return load(spark, path or default)
    raise ValueError("neither a frame nor a path")


def load_columns(spark: SparkSession, path: str, mapping: dict[str, str]) -> DataFrame:
    """The mapped columns of a CSV (raw name -> name), with the header in the first record or, if that has none of them, in the second.

    Records may hold quoted line breaks. The header is found by place, so later
    records that look like it stay; only the mapped columns are read.
    """
    lines = [r[0] for r in spark.read.text(path).limit(2).collect()]  # a title and the header
    for skip, names in enumerate(next(csv.reader([line]), []) for line in lines):
        if not [n for n in names if n in mapping]:
            continue
        if not skip:
            rows = spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"')
            return rows.select(*[F.col(f"`{n}`").alias(mapping[n]) for n in rows.columns if n in mapping])
        # Spark takes the first record as the header; the one after it is the first row of a file
        kind = ", ".join(f"_{i} string" for i in range(len(names)))
        rows = spark.read.schema(kind).csv(path, header=True, multiLine=True, escape='"', enforceSchema=True).withColumns({"_file": F.input_file_name(), "_at": F.monotonically_increasing_id()})
        first = rows.groupBy("_file").agg(F.min("_at").alias("_first"))  # one row for each file
        rows = rows.join(F.broadcast(first), "_file").where("_at > _first")
        return rows.select(*[F.col(f"_{i}").alias(mapping[n]) for i, n in enumerate(names) if n in mapping])
    raise ValueError(f"{path} has none of the columns")


# Columns of the ethnicity breakdown, and a misprint in it.
ETHNICITY_COLUMNS = {"DfE Extended Code": "extended_code", "Approved Extended Categories": "extended_category", "DfE Main Code": "main_code", "Main Category": "main_category", "Sub- Category": "sub_category"}
ETHNICITY_MISPRINTS = {"Mixed/Duel Background": "Mixed/Dual Background"}


def ethnicity_table(df: DataFrame, columns: dict[str, str] | None = None) -> DataFrame:
    """The code table of ethnicities out of its published sheet: renamed columns, distinct rows with any value, misprints mended."""
    columns = columns or ETHNICITY_COLUMNS
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"the table lacks {missing}")
    named = df.select(*[F.col(f"`{c}`").alias(n) for c, n in columns.items()]).dropna("all").distinct()
    return named.replace(ETHNICITY_MISPRINTS)


def load_ethnicity(spark: SparkSession, path: str, sheet: str = "Ethnicity Breakdown", skip: int = 4) -> DataFrame:
    """The code table of ethnicities from a workbook (its header after a few lines), a CSV or a Parquet file."""
    return ethnicity_table(load_sheets(spark, path, [sheet], skip)[sheet] if path.endswith(".xlsx") else load(spark, path))


def without_empty_twins(df: DataFrame, names: list[str]) -> tuple[DataFrame, list[str]]:
    """Of columns that share a name (but for `.N`), the first that has any value, or the first."""
    plain = [base_name(n) for n in names]
    counts = df.toDF(*[f"_{i}" for i in range(len(names))]).agg(*[F.count(f"_{i}").alias(f"_{i}") for i in range(len(names))]).first()
    keep = []
    for name in dict.fromkeys(plain):
        places = [i for i, n in enumerate(plain) if n == name]
        keep.append(next((i for i in places if counts[f"_{i}"]), places[0]))
    return df.toDF(*[f"_{i}" for i in range(len(names))]).select(*[f"_{i}" for i in keep]), [plain[i] for i in keep]


def write(df: DataFrame, path: str, overwrite: bool = True, skip_existing: bool = False) -> None:
    """A stage's output as Parquet; with skip_existing an existing one stays."""
    if skip_existing:
        at = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if at.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).exists(at):
            return
    df.write.mode("overwrite" if overwrite else "errorifexists").parquet(path)


def write_rejected(rejected: DataFrame, path: str) -> None:
    rejected.write.mode("overwrite").partitionBy("reject_reason").parquet(f"{path.rstrip('/')}_discarded")


def store_by_entity(df: DataFrame, name: str, id_col: str, order: list[str], buckets: int = 200) -> DataFrame:
    """df as the table `name` of the warehouse, in buckets by its entity and sorted within them: windows, aggregates and joins by the entity take no exchange on it.

    Rows are dealt by entity before they are written, so that each bucket is one file.
    """
    spark = df.sparkSession
    df.repartition(buckets, id_col).write.mode("overwrite").bucketBy(buckets, id_col).sortBy(id_col, *order).format("parquet").saveAsTable(name)
    return spark.table(name)
