"""The latest record and the number of records per key, kept up to date as files arrive.

The streaming form of `operators.resolve.latest_with_count`, and of comparing file manifests:
a file source's checkpoint knows which files have been read.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def arriving(spark: SparkSession, folder: str, schema: str, kind: str = "parquet", files_per_batch: int = 100) -> DataFrame:
    """Rows of files as they appear in a folder."""
    return spark.readStream.format(kind).schema(schema).option("maxFilesPerTrigger", files_per_batch).load(folder)


def latest_with_count(stream: DataFrame, keys: list[str], date: str, values: list[str], count: str = "event_count") -> DataFrame:
    """One row per key: the values of its latest record (ties by the greatest values; a null date comes before all others) and how many there were.

    The state is one row for each key; run it in update or complete mode.
    """
    order = F.struct(F.col(date).isNotNull(), date, *values)
    best = F.max_by(F.struct(date, *values), order)
    return stream.groupBy(*keys).agg(best.alias("_best"), F.count("*").alias(count)).select(*keys, f"_best.{date}", *[f"_best.{v}" for v in values], count)


def windowed_counts(stream: DataFrame, keys: list[str], time: str, length: str, late: str) -> DataFrame:
    """Counts per key and time window; records later than `late` are left out and closed windows leave the state."""
    return stream.withWatermark(time, late).groupBy(F.window(time, length), *keys).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), *keys, "n")


def write_batches(df: DataFrame, path: str, checkpoint: str, mode: str = "update") -> StreamingQuery:
    """Each batch's rows as Parquet under path/batch=<n>; a batch that is repeated after a failure replaces itself."""

    def save(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={n}")

    return df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(save).start()
