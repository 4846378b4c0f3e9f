"""Queries: summaries, schemas and metadata."""

from pyspark.sql import functions as F

from docframe.queries.registry import query, table
from docframe.sources.schema import DocSchema, FieldInfo, field_names


def _numbers(c: str) -> str:
    stats = {"min": f"min({c})", "q1": f"quantile_cont({c}::DOUBLE, 0.25)", "median": f"quantile_cont({c}::DOUBLE, 0.5)", "mean": f"avg({c})", "q3": f"quantile_cont({c}::DOUBLE, 0.75)", "max": f"max({c})", "nas": f"count_if({c} IS NULL)"}
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", '{s}' AS statistic, round(({e})::DOUBLE, 4) AS value FROM orders" for s, e in stats.items())


@query(" UNION ALL ".join(map(_numbers, ("o_orderkey", "o_custkey", "o_totalprice"))))
def summary_numeric(spark, d):
    out = table(spark, d, "orders").subset(fields=["o_orderkey", "o_custkey", "o_totalprice"]).summary()
    return out.withColumn("value", F.round(F.col("value").cast("double"), 4))


@query("""WITH c AS (SELECT p_brand AS v, count(*) AS n FROM part GROUP BY 1), t AS (SELECT * FROM c ORDER BY n DESC, v LIMIT 6)
SELECT 'p_brand' AS "column", v AS statistic, n::VARCHAR AS value FROM t UNION ALL SELECT 'p_brand', '(Other)', ((SELECT count(*) FROM part) - (SELECT sum(n) FROM t))::BIGINT::VARCHAR""")
def summary_categorical(spark, d):
    return table(spark, d, "part").subset(fields=["p_brand"]).summary()


@query("""SELECT 'o_orderdate' AS "column", 'min' AS statistic, strftime(min(o_orderdate), '%Y-%m-%d %H:%M:%S') AS value FROM orders UNION ALL SELECT 'o_orderdate', 'max', strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') FROM orders UNION ALL SELECT 'o_orderdate', 'nas', '0'""")
def summary_dates(spark, d):
    return table(spark, d, "orders").subset(fields=["o_orderdate"]).summary()


@query()
def derive_schema(spark, d):
    schema = DocSchema.derive(table(spark, d, "supplier").df, "supplier", "s_suppkey", version_field=True)
    return spark.createDataFrame([(f.name, f.type, f.multi_valued, f.required) for f in schema.fields], "name string, type string, multi_valued boolean, required boolean")


@query("SELECT s_suppkey AS id_l, s_name AS name_s, s_acctbal AS bal_d, NULL::VARCHAR AS note FROM supplier")
def dynamic_fields(spark, d):
    schema = DocSchema("s", (FieldInfo("id_l", "bigint", required=True), FieldInfo("note", "string"), FieldInfo("*_s", "string"), FieldInfo("*_d", "double")), "id_l")
    return schema.conform(table(spark, d, "supplier").df.selectExpr("s_suppkey AS id_l", "s_name AS name_s", "s_acctbal AS bal_d"))


@query("SELECT 'nation' AS name, count(*) AS nrow, 3 AS ncol FROM nation")
def dim(spark, d):
    return spark.createDataFrame([("nation", *table(spark, d, "nation").dim())], "name string, nrow long, ncol int")


@query("SELECT unnest(['n_name', 'n_nationkey', 'n_regionkey']) AS name")
def present_fields(spark, d):
    df = table(spark, d, "nation").transform(empty=F.lit(None).cast("string")).df
    return spark.createDataFrame([(n,) for n in field_names(df, present_only=True)], "name string")
