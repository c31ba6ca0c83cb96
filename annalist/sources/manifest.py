"""What there is to read, and what changed since last time."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def count_rows(frames: dict[str, DataFrame]) -> DataFrame:
    """(source, n)"""
    return reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("source"), "n") for name, df in frames.items()])


def listing(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(name, mtime, size) of the visible files under a folder on any file system, without reading them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(F.col("path").alias("name"), F.col("modificationTime").cast("double").alias("mtime"), F.col("length").alias("size")).where(~name.rlike(r"^[.~]"))


def diff(before: DataFrame, now: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """(name, change): added, removed and modified (by more than the tolerance in seconds) of two manifests (name, mtime)."""
    both = before.select("name", F.col("mtime").alias("_old")).join(now.select("name", F.col("mtime").alias("_new")), "name", "full")
    change = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").when(F.abs(F.col("_old") - F.col("_new")) > tolerance, "modified")
    return both.select("name", change.alias("change")).where("change IS NOT NULL")


def frame_diff(before: DataFrame, now: DataFrame) -> DataFrame:
    """Rows that only one side has, as often as that; side: removed or added."""
    one = lambda a, b, side: a.exceptAll(b).withColumn("side", F.lit(side))
    return one(before, now, "removed").unionByName(one(now, before, "added")).select("side", *before.columns)


def same(a: DataFrame, b: DataFrame) -> bool:
    return a.columns == b.columns and frame_diff(a, b).first() is None


def save_status(status: DataFrame, path: str) -> None:
    """A manifest (name, mtime) as what later runs compare with; one small JSON file."""
    status.select("name", "mtime").coalesce(1).write.mode("overwrite").json(path)


def load_status(spark: SparkSession, path: str) -> DataFrame:
    """A saved manifest; an empty one if there is none yet."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], "name string, mtime double")
    return spark.read.schema("name string, mtime double").json(path)


def changes(before: DataFrame, now: DataFrame, tolerance: float = 1.0, ignore: tuple[str, ...] = ()) -> DataFrame:
    """diff() without the files of ignored suffixes."""
    kept = lambda df: reduce(lambda d, x: d.where(~F.endswith(F.lower("name"), F.lit(x.lower()))), ignore, df)
    return diff(kept(before), kept(now), tolerance)


def compare_and_backup(new: DataFrame, path: str, stamp: str, prefix: str = "backup") -> bool:
    """Whether new differs from the table at path; if so the old one is kept beside it as `<prefix>_<stamp>` and the new one takes its place.

    The new table is written aside first, so that a lost job leaves the old one whole.
    """
    spark = new.sparkSession
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    exists = fs.exists(target)
    if exists and same(spark.read.parquet(path), new):
        return False
    aside = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}_new_{stamp}")
    new.write.mode("overwrite").parquet(aside.toString())
    if exists:
        fs.rename(target, jvm.org.apache.hadoop.fs.Path(target.getParent(), f"{prefix}_{stamp}_{target.getName()}"))
    fs.rename(aside, target)
    return True


def conflict_report(df: DataFrame, keys: list[str], columns: list[str], id_col: str, most: int = 20) -> tuple[str, DataFrame]:
    """(text, ids): how many groups of keys conflict in each column, with examples, as YAML; and all ids with a conflict, as a table."""
    from annalist.operators.aggregate import conflict_counts, conflict_ids

    told = {r["column_name"]: r["n_conflicts"] for r in conflict_counts(df, keys, columns).collect()}
    ids = conflict_ids(df, keys, columns, id_col)
    some = [str(r[0]) for r in ids.orderBy(id_col).limit(most).collect()]
    lines = [f"conflicting_entities: {ids.count()}", f"examples: [{', '.join(some)}]", "columns:", *[f"  {c}: {n}" for c, n in sorted(told.items()) if n]]
    return "\n".join(lines) + "\n", ids
