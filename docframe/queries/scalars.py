"""Queries: scalar functions, coercions, rescaling and running functions."""

from pyspark.sql import functions as F

from docframe.functions import exprs as x
from docframe.queries.registry import query, table

N = "CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity END"
KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
K = ", ".join(KEYS)


def _lineitem(spark, d, *names, **new):
    return table(spark, d, "lineitem").transform(q=N).transform(**new).subset(fields=[*KEYS, *(names or new)]).result()


@query(f"SELECT {K}, CASE WHEN ({N}) IS NULL THEN NULL WHEN ({N}) > 25 THEN 'big' ELSE 'small' END AS r FROM lineitem")
def ifelse_null_guard(spark, d):
    return _lineitem(spark, d, r=x.ifelse(F.col("q") > 25, F.lit("big"), F.lit("small")))


@query(f"SELECT {K}, CASE WHEN ({N}) IS NULL THEN NULL ELSE least({N}, l_linenumber * 6.0) END AS lo, CASE WHEN ({N}) IS NULL THEN NULL ELSE greatest({N}, l_linenumber * 6.0) END AS hi FROM lineitem")
def pmin_pmax(spark, d):
    other = F.col("l_linenumber") * 6.0
    return _lineitem(spark, d, lo=x.pmin("q", other), hi=x.pmax("q", other))


@query(f"SELECT {K}, least({N}, l_linenumber * 6.0) AS lo, greatest({N}, l_linenumber * 6.0) AS hi FROM lineitem")
def pmin_pmax_na_rm(spark, d):
    other = F.col("l_linenumber") * 6.0
    return _lineitem(spark, d, lo=x.pmin("q", other, na_rm=True), hi=x.pmax("q", other, na_rm=True))


@query(f"SELECT {K}, round_even(l_quantity / 4, 0) AS r0, round_even(l_extendedprice * 10, 0) / 10 AS r1 FROM lineitem")
def round_half_even(spark, d):
    return _lineitem(spark, d, r0=x.round_half_even(F.col("l_quantity") / 4), r1=x.round_half_even("l_extendedprice", 1))


@query(f"SELECT {K}, CASE WHEN l_tax = 0 THEN 0.0 ELSE round_even(l_extendedprice * pow(10.0, 2 - floor(log10(l_extendedprice))), 0) / pow(10.0, 2 - floor(log10(l_extendedprice))) END AS s FROM lineitem")
def signif(spark, d):
    return _lineitem(spark, d, s=x.signif(F.when(F.col("l_tax") == 0, F.lit(0.0)).otherwise(F.col("l_extendedprice")), 3))


@query(f"SELECT {K}, (l_quantity / 7.0) AS a, floor(-l_quantity / 7.0) AS b, (-l_quantity - 7.0 * floor(-l_quantity / 7.0)) AS c, pow(l_quantity, 2) AS e, -l_quantity AS f FROM lineitem")
def arithmetic(spark, d):
    q = F.col("l_quantity")
    return _lineitem(spark, d, a=x.div(q, 7.0), b=x.floordiv(-q, 7.0), c=x.mod(-q, 7.0), e=x.power(q, 2), f=-q)


@query(f"SELECT {K}, CAST(CASE WHEN l_linenumber = 2 THEN 'NaN' WHEN l_linenumber = 1 THEN '-Infinity' ELSE 'Infinity' END AS VARCHAR) AS r FROM lineitem WHERE l_linenumber < 4")
def division_by_zero(spark, d):
    f = table(spark, d, "lineitem").subset("l_linenumber < 4")
    return f.transform(r=x.div(F.when(F.col("l_linenumber") == 2, 0).when(F.col("l_linenumber") == 1, -1).otherwise(1), 0).cast("string")).subset(fields=[*KEYS, "r"]).result()


@query(f"""SELECT {K}, round(abs(l_tax - 0.05), 8) AS f_abs, round(sqrt(l_quantity), 8) AS f_sqrt, ceil(l_extendedprice) AS f_ceiling, floor(l_extendedprice) AS f_floor, round(ln(l_quantity), 8) AS f_log,
round(log10(l_quantity), 8) AS f_log10, round(log2(l_quantity), 8) AS f_log2, round(exp(l_tax), 8) AS f_exp, round(sin(l_quantity), 8) AS f_sin, round(cos(l_quantity), 8) AS f_cos, round(tan(l_tax), 8) AS f_tan,
round(asin(l_tax), 8) AS f_asin, round(acos(l_tax), 8) AS f_acos, round(atan(l_quantity), 8) AS f_atan, round(sinh(l_tax), 8) AS f_sinh, round(cosh(l_tax), 8) AS f_cosh, round(tanh(l_tax), 8) AS f_tanh FROM lineitem""")
def math_direct(spark, d):
    args = {"abs": F.col("l_tax") - 0.05, "sqrt": "l_quantity", "log": "l_quantity", "log10": "l_quantity", "log2": "l_quantity", "exp": "l_tax", "sin": "l_quantity", "cos": "l_quantity", "tan": "l_tax", "asin": "l_tax", "acos": "l_tax", "atan": "l_quantity", "sinh": "l_tax", "cosh": "l_tax", "tanh": "l_tax"}
    new = {f"f_{n}": F.round(x.math_(n, a), 8) for n, a in args.items()}
    new |= {f"f_{n}": x.math_(n, "l_extendedprice").cast("double") for n in ("ceiling", "floor")}
    return _lineitem(spark, d, **new)


@query(f"""SELECT {K}, sign(l_quantity - 25)::DOUBLE AS f_sign, trunc(-l_extendedprice) AS f_trunc, round(ln(1 + l_tax), 8) AS f_log1p, round(exp(l_tax) - 1, 8) AS f_expm1, round(asinh(l_quantity), 8) AS f_asinh,
round(acosh(l_quantity), 8) AS f_acosh, round(atanh(l_tax), 8) AS f_atanh, round(sin(pi() * l_tax), 8) AS f_sinpi, round(cos(pi() * l_tax), 8) AS f_cospi, round(tan(pi() * l_tax), 8) AS f_tanpi FROM lineitem""")
def math_composed(spark, d):
    args = {"log1p": "l_tax", "expm1": "l_tax", "asinh": "l_quantity", "acosh": "l_quantity", "atanh": "l_tax", "sinpi": "l_tax", "cospi": "l_tax", "tanpi": "l_tax"}
    new = {f"f_{n}": F.round(x.math_(n, F.col(a)), 8) for n, a in args.items()}
    return _lineitem(spark, d, f_sign=x.sign(F.col("l_quantity") - 25), f_trunc=x.trunc(-F.col("l_extendedprice")), **new)


@query("SELECT p_partkey, round(gamma(p_size / 10.0), 6) AS g, round(lgamma(p_size * 1.0), 6) AS lg, round(gamma(p_size % 9 + 1.0), 4) AS f FROM part")
def gamma_family(spark, d):
    f = table(spark, d, "part")
    size = F.col("p_size")
    return f.transform(g=F.round(x.math_("gamma", size / 10.0), 6), lg=F.round(x.math_("lgamma", size), 6), f=F.round(x.math_("factorial", size % 9), 4)).subset(fields=["p_partkey", "g", "lg", "f"]).result()


@query("""WITH RECURSIVE h(n, d, t) AS (SELECT 1, -0.5772156649015329::DOUBLE, (pi() * pi() / 6)::DOUBLE UNION ALL SELECT n + 1, d + 1.0 / n, t - 1.0 / (n * n) FROM h WHERE n < 60)
SELECT p_partkey, round(d, 8) AS di, round(t, 8) AS tri FROM part JOIN h ON n = p_size""")
def digamma_trigamma(spark, d):
    f = table(spark, d, "part")
    return f.transform(di=F.round(x.math_("digamma", "p_size"), 8), tri=F.round(x.math_("trigamma", "p_size"), 8)).subset(fields=["p_partkey", "di", "tri"]).result()


def _cut_sql(v, right=True, lowest=False):
    e = [0, 10, 20, 40]
    low = "WHEN v = 0 THEN 1 " if right and lowest else "WHEN v = 40 THEN 3 " if lowest else ""
    inside = " ".join(f"WHEN v {'>' if right else '>='} {a} AND v {'<=' if right else '<'} {b} THEN {i + 1}" for i, (a, b) in enumerate(zip(e, e[1:])))
    return f"CASE {low}{inside} END".replace("v ", f"{v} ")


@query(f"SELECT {K}, {_cut_sql('(l_quantity - 1)')} AS r, {_cut_sql('(l_quantity - 1)', lowest=True)} AS rl, {_cut_sql('(l_quantity - 1)', right=False)} AS l, {_cut_sql('(l_quantity - 1)', right=False, lowest=True)} AS ll FROM lineitem")
def cut_codes(spark, d):
    v, e = F.col("l_quantity") - 1, [0, 10, 20, 40]
    return _lineitem(spark, d, r=x.cut(v, e), rl=x.cut(v, e, include_lowest=True), l=x.cut(v, e, right=False), ll=x.cut(v, e, include_lowest=True, right=False))


@query(f"SELECT {K}, coalesce(l_returnflag IN ('A', 'N') AND l_linenumber <> 3, FALSE) AS m, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity = 30 END AS eq, (l_linenumber = 3) AS gone FROM lineitem")
def predicates_as_values(spark, d):
    flag = F.when(F.col("l_linenumber") != 3, F.col("l_returnflag"))
    return _lineitem(spark, d, m=x.in_(flag, ["A", "N"]), eq=F.col("q") == 30, gone=~x.exists("q"))


@query(f"SELECT {K}, CASE WHEN l_linenumber = 3 THEN NULL WHEN l_quantity BETWEEN 10 AND 20 THEN 1 ELSE -1 END AS m, CASE WHEN l_quantity > 40 THEN 40 ELSE l_quantity END AS capped FROM lineitem")
def map_and_replace(spark, d):
    return _lineitem(spark, d, m=x.map_range("q", 10, 20, 1, -1), capped=x.replace_where("l_quantity", F.col("l_quantity") > 40, 40.0))


@query("SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS s, CAST(o_orderdate AS DATE) AS d, CAST(o_custkey AS DOUBLE) AS n, CAST(o_custkey % 2 AS BOOLEAN) AS b FROM orders")
def coercions(spark, d):
    f = table(spark, d, "orders")
    return f.transform(s=x.as_character("o_orderkey"), d=x.as_date("o_orderdate"), n=x.as_numeric("o_custkey"), b=x.as_logical(F.col("o_custkey") % 2)).subset(fields=["o_orderkey", "s", "d", "n", "b"]).result()


@query("SELECT c_custkey, round((c_acctbal - lo) / (hi - lo) * 2 - 1, 8) AS c_acctbal FROM customer, (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer)")
def rescale(spark, d):
    return table(spark, d, "customer").rescale("c_acctbal", -1.0, 1.0).transform(c_acctbal="round(c_acctbal, 8)").subset(fields=["c_custkey", "c_acctbal"]).result()


_W = "OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING)"


@query(f"SELECT o_orderkey, round(sum(o_totalprice) {_W}, 2) AS s, max(o_totalprice) {_W} AS hi, min(o_totalprice) {_W} AS lo FROM orders")
def cumulative(spark, d):
    f = table(spark, d, "orders")
    for fun, into in (("cumsum", "s"), ("cummax", "hi"), ("cummin", "lo")):
        f = f.cumulative(fun, "o_totalprice", ["o_custkey"], ["o_orderkey"], into)
    return f.transform(s="round(s, 2)").subset(fields=["o_orderkey", "s", "hi", "lo"]).result()


@query("SELECT o_orderkey, round(product(1 + (o_orderkey % 3) / 10) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING), 6) AS p FROM orders")
def cumprod(spark, d):
    f = table(spark, d, "orders").transform(v="1 + (o_orderkey % 3) / 10").cumulative("cumprod", "v", ["o_custkey"], ["o_orderkey"], "p")
    return f.transform(p="round(p, 6)").subset(fields=["o_orderkey", "p"]).result()


@query("SELECT vec_id, len(embedding) AS n FROM embeddings")
def lengths(spark, d):
    return table(spark, d, "embeddings").transform(n=x.lengths("embedding").cast("long")).subset(fields=["vec_id", "n"]).result()


@query("SELECT doc_id FROM documents WHERE list_contains(string_split(text, ' '), 'and')")
def multivalued_filter(spark, d):
    return table(spark, d, "documents").transform(words=F.split("text", " ")).subset(x.contains_term("words", "and"), fields=["doc_id"]).result()
