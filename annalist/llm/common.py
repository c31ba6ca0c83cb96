"""Session helpers the operators share: where to cut lineage, how large Arrow batches are, how tables are read."""

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The largest Arrow batch in rows and bytes; a Python worker holds a few batches at a time.
BATCH_ROWS = "1000"
BATCH_BYTES = "8388608"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: spark.checkpoint.dir. Only a local session may do without, and gets one under the working directory."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"file://{os.path.abspath('spark-warehouse')}/shared"


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/annalist-{name}-{uuid.uuid4().hex}"


#: For each open block of tables(), the paths that go when it ends, and those that are kept; of one thread, as another's blocks are its own.
_open: ContextVar[tuple[tuple[list[str], list[str]], ...]] = ContextVar("open", default=())


def _at(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def drop_path(spark: SparkSession, path: str) -> None:
    at, fs = _at(spark, path)
    fs.delete(at, True)


def owned(spark: SparkSession, path: str, keep: bool = False) -> str:
    """path, a written folder that goes with the innermost block of tables(), or when the session's JVM ends."""
    at, fs = _at(spark, path)
    fs.deleteOnExit(at)
    if _open.get():
        _open.get()[-1][keep].append(path)
    return path


@contextmanager
def tables(spark: SparkSession) -> Iterator[None]:
    """Tables that are cut within are removed when the block ends, but for those cut with keep, which then belong to the block around it."""
    around, (gone, kept) = _open.get(), ([], [])
    inside = _open.set((*around, (gone, kept)))
    try:
        yield
    finally:
        _open.reset(inside)
        if around:
            around[-1][0].extend(kept)
        for path in gone:
            drop_path(spark, path)


#: Spark removes a query's shuffle files when the query ends, not only when the driver happens to collect its garbage, which it does the less often the longer a job runs.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """What is written within leaves no shuffle files behind."""
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(FREED, before) if before is not None else spark.conf.unset(FREED)


def cut(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """df written to the shared folder and read back: later stages depend on files, not on executors, and its shuffle files go."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    with freed(spark):
        df.write.parquet(path)
    owned(spark, path, keep)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of df has."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name), F.lit(""))
