"""Tables that are made from files and from each other, each written once and made again only when what it is made of has changed.

A table's stamp is a hash of its name, its options and the stamps of its inputs; a
file's stamp is its size and time of change. A table stands in a folder of its
stamp, with a small record beside it that is written last: so a lost job leaves no
half table that counts, and what is there already is read back without any job.
"""

import hashlib
import json
import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: spark.checkpoint.dir. Only a local session may do without, and gets one under the working directory."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"file://{os.path.abspath('spark-warehouse')}/shared"


def stamp_of(*parts) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()[:20]


@dataclass
class Table:
    """A written table or some rows and columns of one."""

    path: str
    schema: StructType
    stamp: str
    where: str | None = None
    columns: list[str] | None = None

    def read(self, spark: SparkSession) -> DataFrame:
        df = spark.read.schema(self.schema).parquet(self.path)
        df = df.where(self.where) if self.where else df
        return df.select(*[f"`{c}`" for c in self.columns]) if self.columns is not None else df

    def part(self, where: str | None, columns: list[str]) -> "Table":
        return Table(self.path, self.schema, stamp_of(self.stamp, where, columns), where, columns)

    def record(self) -> dict:
        return {"path": self.path, "schema": self.schema.jsonValue(), "stamp": self.stamp, "where": self.where, "columns": self.columns}

    @classmethod
    def recorded(cls, told: dict) -> "Table":
        return cls(told["path"], StructType.fromJson(told["schema"]), told["stamp"], told["where"], told["columns"])


@dataclass
class Store:
    spark: SparkSession
    folder: str
    #: What this run has made, by name.
    made: list[str] = field(default_factory=list)
    _current: set[str] = field(default_factory=set)

    @classmethod
    def scratch(cls, spark: SparkSession) -> "Store":
        """A store that goes when the session's JVM ends."""
        out = cls(spark, f"{shared_dir(spark)}/annalist-store-{uuid.uuid4().hex}")
        at, fs = out._at(out.folder)
        fs.mkdirs(at)
        fs.deleteOnExit(at)
        return out

    def _at(self, path: str):
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _read_text(self, path: str) -> str | None:
        at, fs = self._at(path)
        if not fs.exists(at):
            return None
        stream = fs.open(at)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _write_text(self, path: str, text: str) -> None:
        """Under another name first: a record is there as a whole or not at all."""
        aside, fs = self._at(f"{path}.{uuid.uuid4().hex}")
        stream = fs.create(aside, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        target, _ = self._at(path)
        fs.delete(target, False)
        fs.rename(aside, target)

    def file_stamp(self, path: str) -> str:
        """Size and time of change of a file, or of all files of a folder; no job."""
        at, fs = self._at(path)
        found, told = fs.listFiles(at, True), []
        while found.hasNext():
            f = found.next()
            if not f.getPath().getName().startswith((".", "_")):
                told.append((f.getPath().getName(), f.getModificationTime(), f.getLen()))
        return stamp_of(sorted(told))

    def write(self, name: str, df: DataFrame, stamp: str | None = None) -> Table:
        """df as a table of its own, without a record."""
        stamp = stamp or uuid.uuid4().hex
        path = f"{self.folder}/{name}/{stamp}"
        df.write.mode("overwrite").parquet(path)
        return Table(path, df.schema, stamp)

    def tables(self, name: str, inputs: list, make: Callable[[str], dict[str, Table]]) -> dict[str, Table]:
        """What make (given the stamp) writes, or wrote when name and inputs were the same."""
        stamp = stamp_of(name, inputs)
        record = f"{self.folder}/{name}/{stamp}.json"
        self._current.add(record)
        if (told := self._read_text(record)) is None:
            out = make(stamp)
            self._write_text(record, json.dumps({k: t.record() for k, t in out.items()}))
            self.made.append(name)
            return out
        return {k: Table.recorded(t) for k, t in json.loads(told).items()}

    def table(self, name: str, inputs: list, make: Callable[[], DataFrame]) -> Table:
        return self.tables(name, inputs, lambda stamp: {"": self.write(name, make(), stamp)})[""]

    def tidy(self, name: str = "") -> int:
        """Removes what is in the folder (of a name) and was not used in this run; how many records went. Frames of earlier runs must no longer be needed."""
        at, fs = self._at(f"{self.folder}/{name}".rstrip("/"))
        records, found = [], fs.listFiles(at, True)
        while found.hasNext():
            p = found.next().getPath()
            if p.getName().endswith(".json"):
                records.append(p)
        used, gone = set(), []
        current = {self._at(r)[0].toUri().getPath() for r in self._current}
        for p in records:
            paths = {t["path"] for t in json.loads(self._read_text(p.toString()) or "{}").values()}
            if p.toUri().getPath() in current:
                used |= paths
            else:
                gone.append((p, paths))
        for p, paths in gone:
            fs.delete(p, False)
            for path in paths - used:
                fs.delete(self._at(path)[0], True)
        return len(gone)
