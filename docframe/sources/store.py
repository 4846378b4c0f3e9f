"""A Parquet-backed document store with upserts, partial updates and deletes.

A store is a folder of versions. A change is a plan over the current version; ``commit`` writes it as the next version,
complete when Spark's success marker is there, and older versions stay until ``purge``. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docframe.operators.frame import DocFrame


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` replace those of ``old`` with the same key; columns that one lacks are missing there."""
    kept = old.join(new.select(F.col(key).alias("__key")), F.col(key) == F.col("__key"), "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def atomic_update(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Set just the columns of ``new`` (also to missing) for its keys; unknown keys become rows."""
    given = [c for c in new.columns if c != key]
    right = new.select(F.col(key).alias("__key"), *[F.col(c).alias(f"__{c}") for c in given])
    both = old.join(right, F.col(key) == F.col("__key"), "full_outer")
    hit = F.col("__key").isNotNull()
    cols = [F.coalesce(F.col(key), F.col("__key")).alias(key) if c == key else F.when(hit, F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in given else F.col(c) for c in old.columns]
    return both.select(*cols, *[F.col(f"__{c}").alias(c) for c in given if c not in old.columns])


def delete_keys(old: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return old.join(keys.select(F.col(key).alias("__key")), F.col(key) == F.col("__key"), "left_anti")


def delete_where(old: DataFrame, predicate: Column) -> DataFrame:
    """Rows where the predicate is missing stay."""
    return old.where(~F.coalesce(predicate, F.lit(False)))


def mixed_batch(old: DataFrame, docs: DataFrame, deleted: DataFrame, key: str) -> DataFrame:
    """Deletes, then upserts."""
    return upsert(delete_keys(old, deleted, key), docs, key)


@dataclass
class Store:
    spark: SparkSession
    root: str
    key: str

    def _fs(self):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path, jvm

    def versions(self) -> list[int]:
        """Complete versions, oldest first; works on any file system that Spark reads."""
        fs, path, jvm = self._fs()
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return sorted(int(n[1:]) for n in names if n.startswith("v") and n[1:].isdigit() and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{self.root}/{n}/_SUCCESS")))

    def path(self, version: int) -> str:
        return f"{self.root}/v{version}"

    def read(self, version: int | None = None) -> DataFrame:
        found = self.versions()
        if not found:
            raise FileNotFoundError(f"no documents at {self.root}")
        return self.spark.read.parquet(self.path(found[-1] if version is None else version))

    def frame(self) -> DocFrame:
        return DocFrame(self.read(), self.key)

    def commit(self, df: DataFrame, max_segments: int | None = None) -> int:
        """Write the next version; ``max_segments`` bounds its number of files."""
        n = (self.versions() or [0])[-1] + 1
        (df.coalesce(max_segments) if max_segments else df).write.mode("overwrite").parquet(self.path(n))
        return n

    def purge(self, keep: int = 1) -> None:
        fs, _, jvm = self._fs()
        for v in self.versions()[:-keep]:
            fs.delete(jvm.org.apache.hadoop.fs.Path(self.path(v)), True)
        self.spark.catalog.refreshByPath(self.root)

    def _docs(self, docs: DataFrame | Sequence[Mapping[str, Any]]) -> DataFrame:
        if isinstance(docs, DataFrame):
            return docs
        schema = {f.name: f.dataType for f in self.read().schema} if self.versions() else {}
        made = self.spark.createDataFrame([dict(d) for d in docs])
        return made.select(*[F.col(c).cast(schema[c]) if c in schema else F.col(c) for c in made.columns])

    def update(self, docs: DataFrame | Sequence[Mapping[str, Any]], atomic: bool = False) -> int:
        new = self._docs(docs)
        if not self.versions():
            return self.commit(new)
        return self.commit((atomic_update if atomic else upsert)(self.read(), new, self.key))

    def update_batch(self, docs: Mapping[Any, Mapping[str, Any] | None]) -> int:
        """Key -> document, or None to delete it."""
        added = [{self.key: k, **d} for k, d in docs.items() if d is not None]
        gone = [k for k, d in docs.items() if d is None]
        out = self.read()
        if gone:
            out = delete_keys(out, self.spark.createDataFrame([(k,) for k in gone], f"{self.key} {out.schema[self.key].dataType.simpleString()}"), self.key)
        return self.commit(upsert(out, self._docs(added), self.key) if added else out)

    def delete(self, which: Column | Iterable[Any] | None = None) -> int:
        """Delete by predicate or keys; everything without an argument."""
        now = self.read()
        if which is None:
            return self.commit(now.limit(0))
        return self.commit(delete_where(now, which if isinstance(which, Column) else F.col(self.key).isin(list(which))))

    def set_columns(self, predicate: Column | None = None, **values: Any) -> int:
        """Set columns of the rows that a predicate picks; None removes the values."""
        now = self.read()
        cols = {}
        for name, v in values.items():
            value = v if isinstance(v, Column) else F.lit(v)
            old = F.col(name) if name in now.columns else F.lit(None)
            cols[name] = value if predicate is None else F.when(predicate, value).otherwise(old)
            if name in now.columns:
                cols[name] = cols[name].cast(now.schema[name].dataType)
        return self.commit(now.withColumns(cols))

    def replace_query(self, frame: DocFrame, docs: DataFrame) -> int:
        """Delete the rows of a frame over this store, then insert documents."""
        return self.commit(mixed_batch(self.read(), docs, frame.ids(), self.key))


def write_docs(df: DataFrame, path: str, kind: str = "json") -> None:
    """Sinks: parquet, orc, json (missing fields are left out of documents), csv with NA for missing, or xml."""
    if kind == "csv":
        df.write.option("header", True).option("nullValue", "NA").csv(path)
    elif kind == "xml":
        df.write.format("xml").option("rowTag", "doc").save(path)
    else:
        df.write.format(kind).save(path)


def read_docs(spark: SparkSession, path: str, schema, kind: str = "json") -> DataFrame:
    """Sources with a declared schema, so no pass over the data is spent on guessing types."""
    reader = spark.read.schema(schema)
    if kind == "csv":
        return reader.option("header", True).option("nullValue", "NA").csv(path)
    if kind == "xml":
        return reader.format("xml").option("rowTag", "doc").load(path)
    return reader.format(kind).load(path)
