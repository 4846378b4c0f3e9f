"""Where queries register: a function of (spark, sf_dir) and, if SQL can say the same, its SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docframe.operators.frame import DocFrame

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

KEYS = {"orders": "o_orderkey", "customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey", "events": "event_id", "documents": "doc_id", "nation": "n_nationkey", "region": "r_regionkey", "embeddings": "vec_id"}


def query(sql: str | None = None, name: str | None = None):
    def register(f):
        key = name or f.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is there already")
        QUERIES[key] = f
        if sql:
            ORACLE_SQL[key] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DocFrame:
    return DocFrame.open(spark, f"{sf_dir}/{name}.parquet", KEYS.get(name))


def scratch(spark: SparkSession) -> str:
    """A new folder below the warehouse, which all executors share; it goes when the application ends."""
    path = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/docframe-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return f"{path}/data"
