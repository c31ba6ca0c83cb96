"""Checks without jobs of their own: conditions that are noticed while a frame is computed for its own sake.

In a plan, a broken condition is an error of the job that finds it (`asserted`,
`unique_rows`). With `Checks`, conditions are observed metrics of the frames that
they stand in, and all that are broken are told at once, after the one job that
writes the result. Metrics are flags, extremes and counts; those that decide are
flags and extremes, so a task that runs twice changes nothing.
"""

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def asserted(df: DataFrame, ok: Column, message: str | Column) -> DataFrame:
    """df; computing a row for which ok is not true is an error."""
    text = F.lit(message) if isinstance(message, str) else message
    return df.where(F.when(F.coalesce(ok, F.lit(False)), True).otherwise(F.raise_error(text).cast("boolean")))


def _shown(columns: list[str]) -> Column:
    return F.concat_ws(", ", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns])


def _metrics(seen: Observation) -> dict:
    """What was observed; nothing of a frame that the plan could do without, as of one joined to no rows."""
    return dict(seen.get) if seen._jo.getRow().size() else {}


@dataclass
class Checks:
    """Conditions on frames that one later action computes. Each watch_ method gives back its frame, to be used instead."""

    _watched: list[tuple[Observation, Callable[[dict], list[str]]]] = field(default_factory=list)
    #: Columns of which a watched frame turned out to have no value.
    empty: list[str] = field(default_factory=list)

    def watch(self, df: DataFrame, metrics: dict[str, Column], broken: Callable[[dict], list[str]]) -> DataFrame:
        """df; broken tells of its metrics (null ones for a frame without rows, or one that was not needed) what is wrong."""
        if not metrics:
            return df
        seen = Observation(f"check-{uuid.uuid4().hex}")
        self._watched.append((seen, broken))
        return df.observe(seen, *[m.alias(n) for n, m in metrics.items()])

    def watch_unique(self, df: DataFrame, keys: list[str], values: list[str] | None = None) -> DataFrame:
        """One row for each key (null being one) with its count as a condition; values are those of any row."""
        once = once_per_key(df, keys, values)
        return self.watch(once, {"n": F.max("_n")}, lambda m: [f"not unique on {keys}: {m['n']} rows of one key"] if (m.get("n") or 0) > 1 else []).drop("_n")

    def watch_lag(self, df: DataFrame, year: str, linked_year: str, lag: int) -> DataFrame:
        """The linked year, where there is one, lies back by lag."""
        back = F.col(year).cast("bigint") - F.col(linked_year).cast("bigint")
        return self.watch(df, {"lo": F.min(back), "hi": F.max(back)}, lambda m: [f"linked over {sorted({m['lo'], m['hi']})} years, not {lag}"] if m.get("lo") is not None and (m["lo"], m["hi"]) != (lag, lag) else [])

    def watch_ranges(self, df: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
        names = list(ranges)
        metrics = {f"{n}{i}": f(c) for i, c in enumerate(names) for n, f in (("lo", F.min), ("hi", F.max))}

        def broken(m: dict) -> list[str]:
            return [f"out of range: {c} from {m[f'lo{i}']} to {m[f'hi{i}']}" for i, c in enumerate(names) if m.get(f"lo{i}") is not None and (m[f"lo{i}"] < ranges[c][0] or m[f"hi{i}"] > ranges[c][1])]

        return self.watch(df, metrics, broken)

    def watch_empty(self, df: DataFrame, columns: list[str], wrong: bool = False) -> DataFrame:
        """Notes columns without any value in `empty`; an error if that is wrong and there are rows."""
        def broken(m: dict) -> list[str]:
            none = [c for i, c in enumerate(columns) if not m.get(f"c{i}")]
            self.empty += none
            return [f"empty columns: {none}"] if wrong and none and m.get("rows") else []

        return self.watch(df, {"rows": F.max(F.lit(True)), **{f"c{i}": F.max(F.col(c).isNotNull()) for i, c in enumerate(columns)}}, broken)

    def verify(self) -> None:
        """After the action: an error that tells all conditions that were broken."""
        watched, self._watched = self._watched, []
        if told := [x for seen, broken in watched for x in broken(_metrics(seen))]:
            raise ValueError("; ".join(told))

    def stored(self, df: DataFrame, path: str) -> DataFrame:
        """df written to path, which is the one job that all checks in it take, and read back without the columns found to be empty. A broken condition is an error, and nothing stays at path."""
        spark = df.sparkSession
        df.write.mode("overwrite").parquet(path)
        try:
            self.verify()
        except ValueError:
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
            raise
        return spark.read.schema(df.schema).parquet(path).drop(*self.empty)


def once_per_key(df: DataFrame, keys: list[str], values: list[str] | None = None) -> DataFrame:
    """Keys, values and `_n`, the rows of the key: so a lookup can't multiply rows whatever its table holds."""
    values = [c for c in df.columns if c not in keys] if values is None else values
    return df.groupBy(*keys).agg(F.count("*").alias("_n"), *[F.first(c).alias(c) for c in values])


def unique_rows(df: DataFrame, keys: list[str], checks: Checks | None = None) -> DataFrame:
    """The keys and values of df, once each; a key of several rows is an error where it is computed, or told by checks."""
    if checks is not None:
        return checks.watch_unique(df, keys)
    once = once_per_key(df, keys)
    return asserted(once, F.col("_n") == 1, F.concat(F.lit(f"not unique on {keys}: "), _shown(keys))).drop("_n")


def lagging(df: DataFrame, year: str, linked_year: str, lag: int, checks: Checks | None = None) -> DataFrame:
    """df without the linked year, which has to lie back by lag in all linked rows."""
    if checks is not None:
        return checks.watch_lag(df, year, linked_year, lag).drop(linked_year)
    back = F.col(year).cast("bigint") - F.col(linked_year).cast("bigint")
    return asserted(df, F.col(linked_year).isNull() | (back == lag), F.concat(F.lit(f"linked over years other than {lag}: "), _shown([year, linked_year]))).drop(linked_year)
