"""Queries: predicates, joins, column selection, order and bounds."""

from pyspark.sql import functions as F

from docframe.functions import exprs as x
from docframe.operators import sets
from docframe.operators.search import query_words
from docframe.queries.registry import query, scratch, table

NULLED = "CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity END"


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE (o_totalprice > 100000 AND o_orderstatus = 'F') OR NOT (o_orderpriority <> '1-URGENT' OR o_totalprice <= 50000)")
def subset_compare_logic(spark, d):
    f = table(spark, d, "orders")
    price = F.col("o_totalprice")
    keep = ((price > 100000) & (F.col("o_orderstatus") == "F")) | ~((F.col("o_orderpriority") != "1-URGENT") | (price <= 50000))
    return f.subset(keep, fields=["o_orderkey", "o_totalprice"]).result()


@query(f"SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE NOT ({NULLED} > 25)")
def subset_null_excluded(spark, d):
    f = table(spark, d, "lineitem").transform(q=NULLED)
    return f.subset(~(F.col("q") > 25), fields=["l_orderkey", "l_linenumber", "l_quantity"]).result()


@query("SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE floor(l_extendedprice / l_quantity) >= 1500 AND l_quantity - 7 * floor(l_quantity / 7) = 3")
def subset_arith(spark, d):
    f = table(spark, d, "lineitem")
    return f.subset(x.floordiv("l_extendedprice", "l_quantity") >= 1500, x.mod("l_quantity", 7) == 3, fields=["l_orderkey", "l_partkey", "l_quantity"]).result()


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > l_linenumber * 5")
def subset_col_vs_col(spark, d):
    return table(spark, d, "lineitem").subset("l_quantity > l_linenumber * 5", fields=["l_orderkey", "l_linenumber", "l_quantity"]).result()


@query("SELECT o_orderkey FROM orders WHERE o_totalprice > 300000 AND TRUE")
def subset_constants(spark, d):
    f = table(spark, d, "orders")
    return f.subset((F.lit(True) & (F.col("o_totalprice") > 300000)) | F.lit(False), fields="o_orderkey").result()


@query("SELECT p_partkey FROM part WHERE p_size - 20 > 0")
def subset_computed(spark, d):
    return table(spark, d, "part").subset(F.col("p_size") - 20 > 0, fields=["p_partkey"]).result()


@query("SELECT p_partkey FROM part WHERE p_size - 20 <> 0")
def subset_number_as_predicate(spark, d):
    return table(spark, d, "part").subset(x.truth(F.col("p_size") - 20), fields=["p_partkey"]).result()


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def in_vector(spark, d):
    return table(spark, d, "orders").subset(x.in_("o_orderpriority", ["1-URGENT", "2-HIGH"]), fields=["o_orderkey"]).result()


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')")
def not_in_vector(spark, d):
    return table(spark, d, "orders").subset(~x.in_("o_orderpriority", ["1-URGENT", "2-HIGH"]), fields=["o_orderkey"]).result()


@query("SELECT p_partkey, p_type FROM part WHERE regexp_full_match(p_type, '.*(A|E).*[0-9A-Z]')")
def grepl_term(spark, d):
    return table(spark, d, "part").subset(x.grepl(".*(A|E).*[0-9A-Z]", "p_type"), fields=["p_partkey", "p_type"]).result()


@query("SELECT p_partkey FROM part WHERE p_brand = 'Brand#11'")
def grepl_fixed(spark, d):
    return table(spark, d, "part").subset(x.grepl("Brand#11", "p_brand", fixed=True), fields=["p_partkey"]).result()


@query("SELECT p_partkey FROM part WHERE regexp_matches(p_name, '[aeiou]{2}')")
def grepl_search(spark, d):
    return table(spark, d, "part").subset(x.grepl("[aeiou]{2}", "p_name", search=True), fields=["p_partkey"]).result()


@query("SELECT p_brand FROM part WHERE NOT regexp_full_match(p_brand, 'Brand#1.')")
def grep_values_inverted(spark, d):
    return table(spark, d, "part").subset(~x.grepl("Brand#1.", "p_brand"), fields=["p_brand"]).result()


@query(f"SELECT l_orderkey, l_partkey FROM lineitem WHERE ({NULLED}) IS NOT NULL AND l_tax IS NOT NULL")
def complete_cases(spark, d):
    return table(spark, d, "lineitem").transform(q=NULLED).subset(x.complete_cases("q", "l_tax"), fields=["l_orderkey", "l_partkey"]).result()


@query(f"SELECT l_orderkey, l_partkey FROM lineitem WHERE ({NULLED}) IS NULL")
def is_na(spark, d):
    return table(spark, d, "lineitem").transform(q=NULLED).subset(x.is_na("q"), fields=["l_orderkey", "l_partkey"]).result()


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 0)")
def semi_join_predicated(spark, d):
    good = table(spark, d, "customer").subset("c_mktsegment = 'BUILDING'").subset("c_acctbal > 0")
    return table(spark, d, "orders").semi_join("o_custkey", good, "c_custkey").subset(fields=["o_orderkey", "o_custkey"]).result()


@query("SELECT s_suppkey FROM supplier WHERE s_suppkey IN (SELECT s_nationkey FROM supplier)")
def semi_join_self(spark, d):
    f = table(spark, d, "supplier")
    return f.semi_join("s_suppkey", f, "s_nationkey").subset(fields=["s_suppkey"]).result()


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 100000)")
def anti_join(spark, d):
    big = table(spark, d, "orders").subset("o_totalprice > 100000")
    return table(spark, d, "customer").anti_join("c_custkey", big, "o_custkey").subset(fields=["c_custkey"]).result()


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey IN (5, 1, 77, 300)")
def docs_by_id(spark, d):
    return table(spark, d, "orders").docs_by_id([300, 5, 1, 77, -4]).subset(fields=["o_orderkey", "o_orderstatus"]).result()


# Columns


@query("SELECT l_orderkey, l_partkey, l_extendedprice FROM lineitem")
def select_glob(spark, d):
    return table(spark, d, "lineitem").subset(fields=["l_*key", "l_ext*"]).subset(select="-l_suppkey").subset(fields=["l_orderkey", "l_part*", "l_ext*"]).result()


@query("SELECT l_suppkey, l_linenumber, l_quantity FROM lineitem")
def select_range(spark, d):
    return table(spark, d, "lineitem").subset(select="l_suppkey:l_quantity").result()


@query("SELECT o_orderkey, o_orderdate, o_orderpriority FROM orders")
def select_exclude(spark, d):
    return table(spark, d, "orders").subset(select="-(o_custkey:o_totalprice)").result()


@query("SELECT * FROM supplier")
def clip_reset(spark, d):
    return table(spark, d, "supplier").subset(fields=["s_suppkey"]).subset(fields="*").result()


@query("SELECT r_regionkey, r_name AS region FROM region")
def rename(spark, d):
    return table(spark, d, "region").rename(region="r_name").result()


@query("SELECT s_suppkey, s_nationkey AS s_acctbal, s_acctbal AS old FROM supplier")
def transform_parallel(spark, d):
    return table(spark, d, "supplier").transform(s_acctbal="s_nationkey", old="s_acctbal").subset(fields=["s_suppkey", "s_acctbal", "old"]).result()


@query("SELECT p_partkey, p_retailprice * -1 AS p_retailprice FROM part")
def transform_overwrite(spark, d):
    return table(spark, d, "part").transform(p_retailprice=F.col("p_retailprice") * -1).subset(fields=["p_partkey", "p_retailprice"]).result()


@query("SELECT p_partkey, round(p_retailprice * 2 + 1, 6) AS b FROM part WHERE p_retailprice * 2 > 1500")
def transform_chain(spark, d):
    f = table(spark, d, "part").transform(a="p_retailprice * 2").subset("a > 1500").transform(b="round(a + 1, 6)")
    return f.subset(fields=["p_partkey", "b"]).result()


@query("SELECT r_regionkey, r_name FROM region")
def transform_na_dropped(spark, d):
    return table(spark, d, "region").transform(nothing=None).result()


@query("SELECT p_partkey, p_size, p_size AS size_copy FROM part")
def transform_alias(spark, d):
    return table(spark, d, "part").transform(size_copy="p_size").subset(fields=["p_partkey", "p_size", "size_copy"]).result()


@query("SELECT p_partkey, p_size + p_partkey AS total FROM part")
def within_block(spark, d):
    return table(spark, d, "part").within(lambda f: {"total": f["p_size"] + f["p_partkey"]}).subset(fields=["p_partkey", "total"]).result()


# Order and bounds


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderpriority DESC, o_totalprice DESC, o_orderkey LIMIT 50")
def sort_multi(spark, d):
    return table(spark, d, "orders").sort("o_orderkey").sort("o_orderpriority", "o_totalprice", decreasing=True).head(50).subset(fields=["o_orderkey", "o_totalprice"]).result()


@query("SELECT o_orderkey FROM orders ORDER BY (CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice * -1 END) DESC NULLS LAST, o_orderkey LIMIT 40 OFFSET 7000")
def sort_expr_nulls_last(spark, d):
    f = table(spark, d, "orders").sort("o_orderkey").sort("CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice * -1 END", decreasing=True)
    return f.window(7001, 7040).subset(fields=["o_orderkey"]).result()


@query("SELECT o_orderkey, o_orderpriority FROM orders ORDER BY o_orderpriority, o_orderdate, o_orderkey LIMIT 25")
def sort_prepend(spark, d):
    return table(spark, d, "orders").sort("o_orderkey").sort("o_orderdate").sort("o_orderpriority").head(25).subset(fields=["o_orderkey", "o_orderpriority"]).result()


@query("SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey DESC LIMIT 10")
def rev(spark, d):
    return table(spark, d, "orders").sort("o_totalprice", "o_orderkey").rev().head(10).subset(fields=["o_orderkey"]).result()


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 12")
def head(spark, d):
    return table(spark, d, "orders").head(12).subset(fields=["o_orderkey", "o_totalprice"]).result()


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 12")
def tail(spark, d):
    return table(spark, d, "orders").tail(12).subset(fields=["o_orderkey", "o_totalprice"]).result()


@query("SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT (SELECT greatest(count(*) - 14900, 0) FROM orders)")
def head_neg(spark, d):
    return table(spark, d, "orders").head(-14900).subset(fields=["o_orderkey"]).result()


@query("SELECT o_orderkey FROM orders ORDER BY o_orderkey OFFSET 14950")
def tail_neg(spark, d):
    return table(spark, d, "orders").tail(-14950).subset(fields=["o_orderkey"]).result()


@query("SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 11 OFFSET 99")
def window(spark, d):
    return table(spark, d, "orders")[100:110].subset(fields=["o_orderkey"]).result()


@query("SELECT o_orderkey FROM (SELECT o_orderkey FROM orders ORDER BY o_orderkey DESC LIMIT 30) ORDER BY o_orderkey LIMIT 4")
def head_of_tail(spark, d):
    return table(spark, d, "orders").tail(30).head(4).subset(fields=["o_orderkey"]).result()


# Sets


@query("SELECT c_nationkey AS value FROM customer WHERE c_acctbal > 9000 INTERSECT SELECT s_nationkey FROM supplier")
def intersect(spark, d):
    return sets.intersect(table(spark, d, "customer").subset("c_acctbal > 9000"), "c_nationkey", table(spark, d, "supplier"), "s_nationkey")


@query("SELECT n_nationkey AS value FROM nation EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000")
def setdiff(spark, d):
    return sets.setdiff(table(spark, d, "nation"), "n_nationkey", table(spark, d, "supplier").subset("s_acctbal > 5000"), "s_nationkey")


@query("SELECT n_nationkey AS value FROM nation UNION SELECT s_nationkey FROM supplier")
def union(spark, d):
    return sets.union(table(spark, d, "nation"), "n_nationkey", table(spark, d, "supplier"), "s_nationkey")


@query("SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def unique_rows(spark, d):
    return table(spark, d, "orders").unique("o_orderstatus", "o_orderpriority").result()


@query("SELECT DISTINCT c_mktsegment FROM customer WHERE c_acctbal < 0")
def unique_col(spark, d):
    return table(spark, d, "customer").subset("c_acctbal < 0").unique("c_mktsegment").result()


@query("SELECT n_nationkey, n_name, n_regionkey, NULL::INT AS r_regionkey, NULL::VARCHAR AS r_name FROM nation UNION ALL SELECT NULL, NULL, NULL, r_regionkey, r_name FROM region")
def rbind(spark, d):
    return table(spark, d, "nation").rbind(table(spark, d, "region")).result()


# Search

_WORDS = query_words("the nicht ciónes")
_TF = ", ".join(f"len(list_filter(ws, lambda t: t = '{w}')) AS f{i}" for i, w in enumerate(_WORDS))
_DF = ", ".join(f"count_if(f{i} > 0) AS d{i}" for i in range(len(_WORDS)))
_SCORE = " + ".join(f"CASE WHEN f{i} > 0 THEN ln(1 + (n - d{i} + 0.5) / (d{i} + 0.5)) * f{i} * 2.2 / (f{i} + 1.2 * (0.25 + 0.75 * len(ws) / m)) ELSE 0 END" for i in range(len(_WORDS)))


@query(f"""WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS ws FROM documents),
f AS (SELECT doc_id, ws, {_TF} FROM w), s AS (SELECT count(*) AS n, avg(len(ws)) AS m, {_DF} FROM f)
SELECT doc_id, round({_SCORE}, 6) AS score FROM f, s WHERE {" OR ".join(f"f{i} > 0" for i in range(len(_WORDS)))}""")
def search_docs_bm25(spark, d):
    """From a stored index, which is built by the first search of an application."""
    docs = table(spark, d, "documents")
    made = (spark.sparkContext.applicationId, d)
    if made not in _INDEXES:
        _INDEXES[made] = docs.index(f"{scratch(spark)}/index")
    found = docs.search_docs("the nicht ciónes", index=_INDEXES[made])
    return found.transform(score="round(score, 6)").subset(fields=["doc_id", "score"]).result()


_INDEXES: dict = {}


@query(f"""WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS ws FROM documents),
f AS (SELECT doc_id, ws, {_TF} FROM w), s AS (SELECT count(*) AS n, avg(len(ws)) AS m, {_DF} FROM f)
SELECT doc_id, round({_SCORE}, 6) AS score FROM f, s WHERE {" OR ".join(f"f{i} > 0" for i in range(len(_WORDS)))}""")
def search_docs_scan(spark, d):
    """The same without an index."""
    found = table(spark, d, "documents").search_docs("the nicht ciónes")
    return found.transform(score="round(score, 6)").subset(fields=["doc_id", "score"]).result()
