"""Reading the test tables, and expressions that both the plans and their SQL use."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def big(c) -> "F.Column":
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def r4(c) -> "F.Column":
    return F.round((F.col(c) if isinstance(c, str) else c).cast("double"), 4)


#: lineitem has no row id; these make a total order of its rows up to equal ones.
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
LINE_SQL = ", ".join(LINE_ORDER)
