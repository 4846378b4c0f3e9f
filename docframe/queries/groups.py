"""Queries: grouping terms, cross-tabulations, facets and grouped frames."""

from pyspark.sql import functions as F

from docframe.functions import aggs as a
from docframe.plans.formula import Cut, DateCut, Field, I
from docframe.queries.registry import query, table

NP = "CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE o_orderpriority END"


def _orders(spark, d):
    return table(spark, d, "orders").transform(p=NP)


@query("SELECT (o_totalprice > 200000) AS rich, count(*) AS n, min(o_orderkey) AS first FROM orders GROUP BY 1")
def group_logical(spark, d):
    return table(spark, d, "orders").aggregate(I("o_totalprice > 200000", "rich"), n=a.ndoc(), first=a.min_("o_orderkey"))


def _bins(v: str, right: bool, lowest: bool) -> str:
    e = [0, 10, 20, 40]
    label = lambda i: (("[" if lowest and i == 0 else "(") if right else "[") + f"{e[i]},{e[i + 1]}" + ("]" if right or (lowest and i == 2) else ")")
    inside = " ".join(f"WHEN {v} {'>' if right else '>='} {e[i]} AND {v} {'<=' if right else '<'} {e[i + 1]} THEN '{label(i)}'" for i in range(3))
    edge = f"WHEN {v} = 0 THEN '{label(0)}' " if right else f"WHEN {v} = 40 THEN '{label(2)}' "
    return f"CASE {edge if lowest else ''}{inside} END"


def _cut_sql(right: bool, lowest: bool) -> str:
    return f"SELECT * FROM (SELECT {_bins('(p_size - 1)', right, lowest)} AS bin, count(*) AS n, max(p_retailprice) AS top FROM part GROUP BY 1) WHERE bin IS NOT NULL"


def _cut(spark, d, **k):
    return table(spark, d, "part").aggregate(Cut(F.col("p_size") - 1, [0, 10, 20, 40], name="bin", **k), n=a.ndoc(), top=a.max_("p_retailprice"))


@query(_cut_sql(True, False))
def group_cut(spark, d):
    return _cut(spark, d)


@query(_cut_sql(False, False))
def group_cut_left(spark, d):
    return _cut(spark, d, right=False)


@query(_cut_sql(True, True))
def group_cut_lowest(spark, d):
    return _cut(spark, d, include_lowest=True)


@query("SELECT date_trunc('year', o_orderdate)::TIMESTAMP AS year, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2")
def group_date_cut(spark, d):
    out = table(spark, d, "orders").aggregate([DateCut("o_orderdate", "year", "year"), "o_orderstatus"], n=a.ndoc())
    return out.withColumn("year", F.col("year").cast("timestamp_ntz"))


@query(f"SELECT p, count(*) AS n FROM (SELECT {NP} AS p FROM orders) WHERE p IS NOT NULL GROUP BY 1")
def group_na_omit(spark, d):
    return _orders(spark, d).aggregate("~ p", n=a.ndoc())


@query(f"SELECT p, count(*) AS n, round(avg(o_totalprice), 4) AS m FROM (SELECT *, {NP} AS p FROM orders) GROUP BY 1")
def group_na_pass(spark, d):
    return _orders(spark, d).aggregate("~ p", na_action="pass", n=a.ndoc(), m=F.round(a.mean("o_totalprice").column, 4))


@query("SELECT o_custkey % 7 AS k, count(*) AS n FROM orders GROUP BY 1")
def group_computed(spark, d):
    return table(spark, d, "orders").transform(k="o_custkey % 7").aggregate("~ k", n=a.ndoc())


@query("SELECT w, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(string_split(lang || ' ' || source || ' ' || lang, ' ')) AS w FROM documents) GROUP BY 1")
def group_multivalued(spark, d):
    f = table(spark, d, "documents").transform(w=F.split(F.concat_ws(" ", "lang", "source", "lang"), " "))
    return f.aggregate(Field("w", multi=True), n=a.ndoc())


# Cross-tabulations


@query("SELECT o_orderpriority, count(*) AS count FROM orders GROUP BY 1")
def xtabs_one(spark, d):
    return table(spark, d, "orders").xtabs("~ o_orderpriority")


@query("""SELECT o_orderpriority, rich, coalesce(n, 0) AS count FROM (SELECT DISTINCT o_orderpriority FROM orders) CROSS JOIN (VALUES (FALSE), (TRUE)) r(rich)
LEFT JOIN (SELECT o_orderpriority, o_totalprice > 480000 AS rich, count(*) AS n FROM orders GROUP BY 1, 2) USING (o_orderpriority, rich)""")
def xtabs_two(spark, d):
    return table(spark, d, "orders").xtabs(["o_orderpriority", I("o_totalprice > 480000", "rich")])


@query("SELECT never, CAST(CASE WHEN never THEN 0 ELSE (SELECT count(*) FROM orders) END AS BIGINT) AS count FROM (VALUES (FALSE), (TRUE)) r(never)")
def xtabs_zero_cells(spark, d):
    return table(spark, d, "orders").xtabs(I("o_totalprice < 0", "never"))


@query("""SELECT bin, coalesce(n, 0) AS count FROM (VALUES ('(0,20]'), ('(20,60]'), ('(60,90]')) b(bin)
LEFT JOIN (SELECT CASE WHEN p_size > 0 AND p_size <= 20 THEN '(0,20]' WHEN p_size > 20 AND p_size <= 60 THEN '(20,60]' END AS bin, count(*) AS n FROM part GROUP BY 1) USING (bin)""")
def xtabs_cut(spark, d):
    return table(spark, d, "part").xtabs(Cut("p_size", [0, 20, 60, 90], name="bin"))


@query(f"""WITH o AS (SELECT *, {NP} AS p FROM orders) SELECT a.p, b.o_orderstatus, coalesce(c.n, 0) AS count FROM (SELECT DISTINCT p FROM o) a CROSS JOIN (SELECT DISTINCT o_orderstatus FROM o) b
LEFT JOIN (SELECT p, o_orderstatus, count(*) AS n FROM o GROUP BY 1, 2) c ON a.p IS NOT DISTINCT FROM c.p AND b.o_orderstatus = c.o_orderstatus""")
def xtabs_use_na(spark, d):
    return _orders(spark, d).xtabs("~ p + o_orderstatus", use_na=True)


@query("SELECT c_mktsegment, c_nationkey, count(*) AS count FROM customer WHERE c_acctbal > 9500 GROUP BY 1, 2")
def xtabs_drop_unused(spark, d):
    return table(spark, d, "customer").table("~ c_mktsegment + c_nationkey", subset="c_acctbal > 9500", drop_unused=True)


# Facets


@query("""SELECT o_orderstatus, o_orderpriority, (CASE WHEN grouping(o_orderpriority) = 1 THEN 1 ELSE 2 END)::INT AS level, count(*) AS count, max(o_totalprice) AS top FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderstatus, o_orderpriority))""")
def facet_rollup(spark, d):
    return table(spark, d, "orders").facet("~ o_orderstatus + o_orderpriority", top=a.max_("o_totalprice"), name="f").facets().tree("f")


@query("SELECT 'status' AS facet, o_orderstatus AS value, count(*) AS count FROM orders GROUP BY 2 UNION ALL SELECT 'priority', o_orderpriority, count(*) FROM orders GROUP BY 2")
def facet_multi(spark, d):
    f = table(spark, d, "orders").facet("~ o_orderstatus", name="status").facet("~ o_orderpriority", name="priority").facets()
    parts = [f[n].select(F.lit(n).alias("facet"), F.col(f.specs[n].terms[0].name).alias("value"), "count") for n in f.names()]
    return parts[0].union(parts[1])


@query("SELECT o_orderstatus, count(*) AS count FROM orders WHERE o_totalprice > 100000 GROUP BY 1")
def facet_snapshot(spark, d):
    f = table(spark, d, "orders").subset("o_totalprice > 100000").facet("~ o_orderstatus").subset("o_orderstatus = 'F'").sort("o_orderkey").head(3)
    return f.facets()["o_orderstatus"]


@query("SELECT c_nationkey, count(*) AS count, round(avg(c_acctbal), 4) AS m FROM customer GROUP BY 1 ORDER BY m DESC, 1 LIMIT 5")
def facet_sort_limit(spark, d):
    f = table(spark, d, "customer").facet("~ c_nationkey", m=F.round(a.mean("c_acctbal").column, 4), sort="m", decreasing=True, limit=5)
    return f.facets()["~ c_nationkey"]


@query("SELECT * FROM (SELECT c_mktsegment, c_nationkey, count(*) AS count FROM customer GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY c_mktsegment ORDER BY count DESC, c_nationkey) <= 2")
def facet_nested_limit(spark, d):
    return table(spark, d, "customer").facet("~ c_mktsegment + c_nationkey", name="f", sort="count", decreasing=True, limit=2).facets()["f"]


@query("SELECT rich, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS F, CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS O, CAST(sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS BIGINT) AS P FROM (SELECT *, o_totalprice > 250000 AS rich FROM orders) GROUP BY 1")
def facet_pivot(spark, d):
    return table(spark, d, "orders").facet([I("o_totalprice > 250000", "rich"), "o_orderstatus"], name="f").facets().pivot("f")


# Grouped frames


def _top(cond: str, order: str = "o_orderkey") -> str:
    return f"SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY {order}) {cond}"


_SHOWN = ["o_custkey", "o_orderkey", "o_totalprice"]


@query(_top("<= 2"))
def heads(spark, d):
    return table(spark, d, "orders").group("~ o_custkey").heads(2).subset(fields=_SHOWN).result()


@query(_top("<= 2", "o_orderkey DESC"))
def tails(spark, d):
    return table(spark, d, "orders").group("~ o_custkey").tails(2).subset(fields=_SHOWN).result()


@query(_top("> 3", "o_orderkey DESC"))
def heads_neg(spark, d):
    return table(spark, d, "orders").group("~ o_custkey").heads(-3).subset(fields=_SHOWN).result()


@query(_top("> 3"))
def tails_neg(spark, d):
    return table(spark, d, "orders").group("~ o_custkey").tails(-3).subset(fields=_SHOWN).result()


@query(_top("BETWEEN 2 AND 4"))
def windows(spark, d):
    return table(spark, d, "orders").group("~ o_custkey").windows(2, 4).subset(fields=_SHOWN).result()


@query(_top("<= 1", "o_totalprice DESC, o_orderkey"))
def heads_sorted(spark, d):
    return table(spark, d, "orders").sort("o_orderkey").sort("o_totalprice", decreasing=True).group("~ o_custkey").heads(1).subset(fields=_SHOWN).result()


@query("SELECT o_custkey, list(o_orderkey ORDER BY o_orderkey) AS o_orderkey, list(o_orderstatus ORDER BY o_orderkey) AS o_orderstatus FROM orders GROUP BY 1")
def group_list_columns(spark, d):
    return table(spark, d, "orders").group("~ o_custkey").lists("o_orderkey", "o_orderstatus")


@query("SELECT o_custkey, list_sort(list(DISTINCT o_orderstatus)) AS o_orderstatus FROM orders GROUP BY 1")
def group_unique(spark, d):
    return table(spark, d, "orders").group("~ o_custkey").unique("o_orderstatus")


@query("SELECT o_custkey, count(*) AS count FROM orders GROUP BY 1 ORDER BY 1 LIMIT 10 OFFSET 5")
def group_window_over_groups(spark, d):
    return table(spark, d, "orders").group("~ o_custkey").window(6, 15).ndoc()


@query("SELECT DISTINCT o_orderstatus || '.' || o_orderpriority AS name FROM orders")
def group_rownames(spark, d):
    return table(spark, d, "orders").group("~ o_orderstatus").group("~ o_orderpriority").rownames()


@query("SELECT o_orderkey, round(o_totalprice / avg(o_totalprice) OVER (PARTITION BY o_custkey), 8) AS rel FROM orders")
def group_transform(spark, d):
    out = table(spark, d, "orders").group("~ o_custkey").transform(rel=lambda w: F.round(F.col("o_totalprice") / F.avg("o_totalprice").over(w), 8))
    return out.subset(fields=["o_orderkey", "rel"]).result()


@query("SELECT o_custkey, o_orderkey FROM orders")
def unlist(spark, d):
    from docframe.operators.frame import DocFrame
    from docframe.operators.grouped import unlist as flat

    return flat(DocFrame(table(spark, d, "orders").group("~ o_custkey").lists("o_orderkey")), ["o_orderkey"]).result()


@query("SELECT count(DISTINCT o_custkey) AS ngroup FROM orders")
def ngroup(spark, d):
    return spark.createDataFrame([(table(spark, d, "orders").group("~ o_custkey").ngroup(),)], "ngroup long")


@query("SELECT o_custkey, list(o_orderkey ORDER BY o_totalprice DESC, o_orderkey) AS o_orderkey FROM orders GROUP BY 1")
def group_lists_descending(spark, d):
    return table(spark, d, "orders").sort("o_orderkey").group("~ o_custkey").sort("o_totalprice", decreasing=True).lists("o_orderkey")


@query("SELECT o_custkey, list(o_orderkey ORDER BY o_orderkey)[:2] AS o_orderkey_heads FROM orders GROUP BY 1")
def aggregate_heads(spark, d):
    return table(spark, d, "orders").aggregate("o_orderkey ~ o_custkey", "heads", keep=2)


@query("SELECT o_custkey, max(o_orderkey) AS o_orderkey_tails FROM orders GROUP BY 1")
def aggregate_tails_simplified(spark, d):
    return table(spark, d, "orders").aggregate("o_orderkey ~ o_custkey", "tails", keep=1)


@query("SELECT o_custkey, list_sort(list(DISTINCT o_orderstatus)) AS o_orderstatus_unique FROM orders GROUP BY 1")
def aggregate_unique(spark, d):
    return table(spark, d, "orders").aggregate("o_orderstatus ~ o_custkey", "unique")


@query("""WITH o AS (SELECT date_trunc('month', o_orderdate)::TIMESTAMP AS month FROM orders WHERE o_orderkey % 400 = 1)
SELECT m.month, CAST(count(o.month) AS BIGINT) AS count FROM (SELECT unnest(generate_series((SELECT min(month) FROM o), (SELECT max(month) FROM o), INTERVAL 1 MONTH)) AS month) m LEFT JOIN o USING (month) GROUP BY 1""")
def xtabs_date(spark, d):
    out = table(spark, d, "orders").xtabs(DateCut("o_orderdate", "month", "month"), subset="o_orderkey % 400 = 1")
    return out.withColumn("month", F.col("month").cast("timestamp_ntz"))


@query("""WITH o AS (SELECT date_trunc('quarter', o_orderdate)::TIMESTAMP AS q FROM orders WHERE o_orderdate < DATE '1993-01-01')
SELECT m.q, CAST(count(o.q) AS BIGINT) AS count FROM (SELECT unnest(generate_series(TIMESTAMP '1992-01-01', TIMESTAMP '1994-10-01', INTERVAL 3 MONTH)) AS q) m LEFT JOIN o USING (q) GROUP BY 1""")
def xtabs_date_levels(spark, d):
    out = table(spark, d, "orders").xtabs(DateCut("o_orderdate", "quarter", "q", "1992-02-15", "1994-12-31"), subset="o_orderdate < DATE '1993-01-01'")
    return out.withColumn("q", F.col("q").cast("timestamp_ntz"))


@query("SELECT o_orderpriority, CAST(count_if(o_orderstatus = 'F') AS BIGINT) AS F, CAST(count_if(o_orderstatus = 'O') AS BIGINT) AS O FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1")
def ftable_exclude(spark, d):
    return table(spark, d, "orders").ftable("~ o_orderpriority + o_orderstatus", exclude=["P"])


@query("SELECT n_nationkey, n_name, n_regionkey, n_nationkey * 2 AS twice FROM nation WHERE n_nationkey < 9")
def cbind(spark, d):
    f = table(spark, d, "nation")
    return f.cbind(f.subset("n_nationkey < 9").transform(twice="n_nationkey * 2").subset(fields=["n_nationkey", "twice"])).result()
