"""Queries: document changes on the supplier table, and sinks read back."""

from pyspark.sql import functions as F

from docframe.queries.registry import query, scratch, table
from docframe.sources import store as st

KEY = "s_suppkey"


@query("""SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL::VARCHAR AS note FROM supplier WHERE s_suppkey % 10 <> 0
UNION ALL SELECT s_suppkey, NULL, NULL, s_acctbal * 2, 'new' FROM supplier WHERE s_suppkey % 10 = 0 UNION ALL SELECT s_suppkey + 1000000, NULL, NULL, s_acctbal * 2, 'new' FROM supplier WHERE s_suppkey % 10 = 0""")
def upsert(spark, d):
    old = table(spark, d, "supplier").df
    tenth = old.where("s_suppkey % 10 = 0").selectExpr(KEY, "s_acctbal * 2 AS s_acctbal", "'new' AS note")
    return st.upsert(old, tenth.union(tenth.withColumn(KEY, F.col(KEY) + 1000000)), KEY)


@query("SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 10 = 0 THEN NULL ELSE s_nationkey END AS s_nationkey, CASE WHEN s_suppkey % 10 = 0 THEN 1.5 ELSE s_acctbal END AS s_acctbal, CASE WHEN s_suppkey % 10 = 0 THEN 'x' END AS tag FROM supplier")
def atomic_update(spark, d):
    old = table(spark, d, "supplier").df
    new = old.where("s_suppkey % 10 = 0").selectExpr(KEY, "CAST(1.5 AS DOUBLE) AS s_acctbal", "CAST(NULL AS INT) AS s_nationkey", "'x' AS tag")
    return st.atomic_update(old, new, KEY)


@query("SELECT * FROM supplier WHERE NOT coalesce(CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_acctbal < 3000 END, FALSE)")
def delete_by_query(spark, d):
    return st.delete_where(table(spark, d, "supplier").df, F.expr("CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_acctbal < 3000 END"))


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier WHERE s_suppkey % 4 NOT IN (0, 1) UNION ALL SELECT s_suppkey, 'again', s_nationkey, s_acctbal FROM supplier WHERE s_suppkey % 4 = 1")
def mixed_batch(spark, d):
    old = table(spark, d, "supplier").df
    return st.mixed_batch(old, old.where("s_suppkey % 4 = 1").withColumn("s_name", F.lit("again")), old.where("s_suppkey % 4 = 0").select(KEY), KEY)


@query("SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN 'owes' ELSE s_name END AS s_name, s_nationkey, s_acctbal FROM supplier WHERE s_suppkey > 5")
def store_commit(spark, d):
    store = st.Store(spark, scratch(spark), KEY)
    store.update(table(spark, d, "supplier").df)
    store.set_columns(F.col("s_acctbal") < 0, s_name="owes")
    store.delete(F.col(KEY) <= 5)
    return store.read()


def _sink(kind: str):
    def f(spark, d):
        df = table(spark, d, "customer").transform(c_name="CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_name END").result()
        path = scratch(spark)
        st.write_docs(df, path, kind)
        return st.read_docs(spark, path, df.schema, kind)

    return f


for _kind in ("parquet", "orc", "json", "csv", "xml"):
    query("SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_name END AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer", f"sink_{_kind}")(_sink(_kind))
