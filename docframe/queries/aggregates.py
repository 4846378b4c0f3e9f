"""Queries: aggregation functions, with and without missing values."""

from pyspark.sql import functions as F

from docframe.functions import aggs as a
from docframe.queries.registry import query, table

N = "CASE WHEN l_linenumber = 3 AND l_returnflag = 'A' THEN NULL ELSE l_quantity END"
B = "CASE WHEN l_linenumber = 3 AND l_returnflag <> 'R' THEN NULL ELSE l_quantity > 1 END"


def _rows(spark, d):
    return table(spark, d, "lineitem").transform(q=N, b=B, w="l_linenumber * 1.0")


def _rounded(df, **digits):
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


@query("SELECT l_suppkey, count(*) AS count, round(avg(l_extendedprice), 4) AS dist, round(avg(l_discount), 6) AS delay FROM lineitem GROUP BY l_suppkey HAVING count(*) > 20")
def aggregate_by_formula(spark, d):
    out = table(spark, d, "lineitem").aggregate("~ l_suppkey", count=a.ndoc(), dist=a.mean("l_extendedprice"), delay=a.mean("l_discount"))
    return _rounded(out.where("count > 20"), dist=4, delay=6)


@query("""SELECT l_returnflag, round(sum(l_quantity), 2) AS s, min(l_quantity) AS lo, max(l_quantity) AS hi, min(l_tax) AS range_min, max(l_tax) AS range_max, round(avg(l_quantity), 6) AS m,
round(stddev_samp(l_quantity), 6) AS s_d, round(var_samp(l_quantity), 6) AS v, count(*) AS n FROM lineitem GROUP BY l_returnflag""")
def agg_basic(spark, d):
    out = table(spark, d, "lineitem").aggregate("~ l_returnflag", s=a.sum_("l_quantity"), lo=a.min_("l_quantity"), hi=a.max_("l_quantity"), r=a.range_("l_tax"), m=a.mean("l_quantity"), s_d=a.sd("l_quantity"), v=a.var("l_quantity"), n=a.ndoc())
    return _rounded(out.withColumns({"range_min": F.col("r.min"), "range_max": F.col("r.max")}).drop("r"), s=2, m=6, s_d=6, v=6)


def _na_sql(strict: bool) -> str:
    f = (lambda e: f"CASE WHEN count(q) = count(*) THEN {e} END") if strict else (lambda e: e)
    return f"""SELECT l_returnflag, {f("round(sum(q), 2)")} AS s, {f("min(q)")} AS lo, {f("max(q)")} AS hi, {f("round(avg(q), 6)")} AS m, {f("round(stddev_samp(q), 6)")} AS s_d, {f("round(median(q), 6)")} AS med,
    bool_or(q IS NULL) AS missing, count_if(q IS NULL)::BIGINT AS nas FROM (SELECT *, {N} AS q FROM lineitem) GROUP BY l_returnflag"""


def _na(spark, d, na_rm):
    out = _rows(spark, d).aggregate("~ l_returnflag", s=a.sum_("q", na_rm), lo=a.min_("q", na_rm), hi=a.max_("q", na_rm), m=a.mean("q", na_rm), s_d=a.sd("q", na_rm), med=a.median("q", na_rm), missing=a.any_na("q"), nas=a.n_na("q"))
    return _rounded(out, s=2, m=6, s_d=6, med=6)


@query(_na_sql(True))
def agg_na_rm_false(spark, d):
    return _na(spark, d, False)


@query(_na_sql(False))
def agg_na_rm_true(spark, d):
    return _na(spark, d, True)


@query(f"""SELECT l_returnflag, CASE WHEN bool_or(b) THEN TRUE WHEN count(b) < count(*) THEN NULL ELSE FALSE END AS any_b, CASE WHEN NOT bool_and(b) THEN FALSE WHEN count(b) < count(*) THEN NULL ELSE TRUE END AS all_b,
CASE WHEN bool_or(NOT b) THEN TRUE WHEN count(b) < count(*) THEN NULL ELSE FALSE END AS any_not, CASE WHEN NOT bool_and(q0) THEN FALSE WHEN count(q0) < count(*) THEN NULL ELSE TRUE END AS all_0, coalesce(bool_and(b), TRUE) AS all_rm
FROM (SELECT *, {B} AS b, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity > 0 END AS q0 FROM lineitem) GROUP BY l_returnflag""")
def any_all_3vl(spark, d):
    f = _rows(spark, d).transform(nb="NOT b", q0="CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity > 0 END")
    return f.aggregate("~ l_returnflag", any_b=a.any_("b"), all_b=a.all_("b"), any_not=a.any_("nb"), all_0=a.all_("q0"), all_rm=a.all_("b", na_rm=True))


_Q = ", ".join(f"round(quantile_cont(l_extendedprice::DOUBLE, {p}), 6) AS q{i}" for i, p in enumerate((0.0, 0.25, 0.5, 0.75, 1.0)))


@query(f"SELECT l_linestatus, {_Q} FROM lineitem GROUP BY l_linestatus")
def quantile(spark, d):
    out = table(spark, d, "lineitem").aggregate("~ l_linestatus", q=a.quantile("l_extendedprice"))
    return out.select("l_linestatus", *[F.round(F.col("q")[i], 6).alias(f"q{i}") for i in range(5)])


@query("SELECT l_linestatus, l_returnflag, round(quantile_cont(l_tax::DOUBLE, 0.5), 8) AS med, round(quantile_cont(l_tax::DOUBLE, 0.75) - quantile_cont(l_tax::DOUBLE, 0.25), 8) AS i FROM lineitem GROUP BY 1, 2")
def median_iqr(spark, d):
    return _rounded(table(spark, d, "lineitem").aggregate("~ l_linestatus + l_returnflag", med=a.median("l_tax"), i=a.iqr("l_tax")), med=8, i=8)


@query()
def quantile_approx(spark, d):
    return table(spark, d, "lineitem").aggregate("~ l_linestatus", q=a.quantile("l_extendedprice", approximate=True), m=a.median("l_tax", approximate=True), i=a.iqr("l_tax", approximate=True), d=a.mad("l_extendedprice", approximate=True))


@query(f"SELECT l_returnflag, (count(DISTINCT q) + max(CASE WHEN q IS NULL THEN 1 ELSE 0 END))::INT AS n, count(DISTINCT q)::INT AS n_rm FROM (SELECT *, {N} AS q FROM lineitem) GROUP BY l_returnflag")
def nunique_exact(spark, d):
    return _rows(spark, d).aggregate("~ l_returnflag", n=a.nunique("q"), n_rm=a.nunique("q", na_rm=True))


@query()
def nunique_approx(spark, d):
    return table(spark, d, "lineitem").aggregate("~ l_returnflag", n=a.nunique("l_partkey", approximate=True))


@query(f"""SELECT l_returnflag, CASE WHEN count(q) = count(*) THEN round(sum(q * w) / sum(w), 6) END AS m, round(sum(q * w) / sum(CASE WHEN q IS NOT NULL THEN w END), 6) AS m_rm
FROM (SELECT *, {N} AS q, l_linenumber * 1.0 AS w FROM lineitem) GROUP BY l_returnflag""")
def weighted_mean(spark, d):
    return _rounded(_rows(spark, d).aggregate("~ l_returnflag", m=a.weighted_mean("q", "w"), m_rm=a.weighted_mean("q", "w", na_rm=True)), m=6, m_rm=6)


@query("""SELECT l_returnflag, round(1.4826 * quantile_cont(abs(l_extendedprice - c)::DOUBLE, 0.5), 6) AS m FROM lineitem
JOIN (SELECT l_returnflag, quantile_cont(l_extendedprice::DOUBLE, 0.5) AS c FROM lineitem GROUP BY 1) USING (l_returnflag) GROUP BY 1""")
def mad_grouped(spark, d):
    return _rounded(table(spark, d, "lineitem").aggregate("~ l_returnflag", m=a.mad("l_extendedprice")), m=6)


@query("""SELECT l_returnflag, round(1.4826 * quantile_cont(abs(l_extendedprice - c)::DOUBLE, 0.5), 6) AS m, round(1.4826 * quantile_cont(abs(l_quantity - q)::DOUBLE, 0.5), 6) AS m2 FROM lineitem
JOIN (SELECT l_returnflag, quantile_cont(l_extendedprice::DOUBLE, 0.5) AS c, quantile_cont(l_quantity::DOUBLE, 0.5) AS q FROM lineitem GROUP BY 1) USING (l_returnflag) GROUP BY 1""")
def mad_two_columns(spark, d):
    return _rounded(table(spark, d, "lineitem").aggregate("~ l_returnflag", m=a.mad("l_extendedprice"), m2=a.mad("l_quantity")), m=6, m2=6)


@query("SELECT round(1.4826 * quantile_cont(abs(o_totalprice - (SELECT quantile_cont(o_totalprice::DOUBLE, 0.5) FROM orders))::DOUBLE, 0.5), 6) AS m FROM orders")
def mad_global(spark, d):
    return _rounded(table(spark, d, "orders").aggregate(m=a.mad("o_totalprice")), m=6)


@query("SELECT count(*) AS n, sum(o_totalprice) AS s FROM orders WHERE o_orderkey < 0 HAVING count(*) > 0")
def agg_empty_global(spark, d):
    return table(spark, d, "orders").subset("o_orderkey < 0").aggregate(n=a.ndoc(), s=a.sum_("o_totalprice"))


@query("SELECT count(*) AS n, round(sum(o_totalprice), 2) AS s FROM orders")
def agg_global(spark, d):
    return _rounded(table(spark, d, "orders").aggregate(n=a.ndoc(), s=a.sum_("o_totalprice")), s=2)


@query("SELECT o_orderpriority, count(*) AS count, max(o_totalprice) AS o_totalprice_max FROM orders WHERE o_orderstatus = 'F' GROUP BY 1")
def agg_subset_arg(spark, d):
    return table(spark, d, "orders").aggregate("~ o_orderpriority", a.max_("o_totalprice"), subset="o_orderstatus = 'F'", count=True)


@query("""SELECT o_orderstatus, round(sum(o_totalprice) / count(*), 4) AS m, round(max(o_totalprice) - min(o_totalprice), 4) AS spread, (avg(o_totalprice) > 150000) AS rich,
least(max(o_totalprice), 300000.0) AS capped, round_even(avg(o_totalprice), 0) AS r FROM orders GROUP BY 1""")
def post_agg_arith(spark, d):
    from docframe.functions import exprs as x

    hi, lo, m = a.max_("o_totalprice"), a.min_("o_totalprice"), a.mean("o_totalprice")
    out = table(spark, d, "orders").aggregate("~ o_orderstatus", m=a.sum_("o_totalprice") / a.ndoc(), spread=hi - lo, rich=m > 150000, capped=x.pmin(hi.column, F.lit(300000.0)), r=x.round_half_even(m.column))
    return _rounded(out, m=4, spread=4)


@query("SELECT p_brand, round(ln(product(1 + p_size / 1000)), 8) AS lp FROM part WHERE p_size < 5 GROUP BY 1")
def agg_prod(spark, d):
    f = table(spark, d, "part").subset("p_size < 5").transform(v="1 + p_size / 1000")
    return f.aggregate("~ p_brand", lp=F.round(F.log(a.prod("v").column), 8))


@query("SELECT l_returnflag, max(l_tax) AS l_tax_max FROM lineitem GROUP BY 1")
def aggregate_fun(spark, d):
    return table(spark, d, "lineitem").aggregate("l_tax ~ l_returnflag", "max")


@query("SELECT o_orderstatus, count(*) AS n, min(o_orderkey) AS first FROM orders GROUP BY 1")
def aggregate_frame_fun(spark, d):
    return table(spark, d, "orders").aggregate("~ o_orderstatus", lambda f: {"n": a.ndoc(), "first": a.min_("o_orderkey")})
