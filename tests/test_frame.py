import datetime

import pytest
from pyspark.sql import functions as F

from docframe.functions import aggs as a
from docframe.functions import exprs as x
from docframe.operators.frame import DocFrame
from docframe.plans import bounds, columns
from docframe.plans.formula import Cut, DateCut, Field, I, parse


@pytest.fixture(scope="module")
def docs4(spark):
    now = datetime.datetime(2024, 1, 1)
    rows = [("2", True, 2.0, 1.0, now), ("3", True, 4.0, 5.0, now), ("4", None, 3.0, 3.0, now), ("5", False, 5.0, None, now)]
    return DocFrame(spark.createDataFrame(rows, "id string, inStock boolean, price double, weight double, timestamp_dt timestamp").cache(), "id")


@pytest.fixture(scope="module")
def facet6(spark):
    t = lambda s: s and datetime.datetime.fromisoformat(s)
    rows = [
        ("1", "A", "NY", 4.0, None, "zodiac", t("2001-01-01T01:01:01"), True, "one", None),
        ("2", "B", "NJ", -9.0, -5, "superman", t("2002-02-02T02:02:02"), False, None, ["a", "b"]),
        ("3", None, None, None, None, None, None, None, None, None),
        ("4", "A", "NJ", 2.0, 3, "spiderman", t("2003-03-03T03:03:03"), None, None, ["b"]),
        ("5", "B", "NJ", None, 7, "batman", t("2001-02-03T01:02:03"), None, "two", ["a"]),
        ("6", "B", "NY", -5.0, -5, "hulk", t("2002-03-01T03:02:01"), None, None, ["b", "a"]),
    ]
    return DocFrame(spark.createDataFrame(rows, "id string, cat_s string, where_s string, num_d double, num_i int, super_s string, date_dt timestamp, val_b boolean, sparse_s string, multi_ss array<string>").cache(), "id")


def ids(f):
    return [r.id for r in f.subset(fields=["id"]).collect()]


def kept(f, *p):
    return sorted(ids(f.subset(*p)))


C = F.col


@pytest.mark.parametrize(
    ("predicate", "want"),
    [
        (lambda: x.in_("id", ["3", "4", "5"]), "345"),
        (lambda: C("price") > 2, "345"),
        (lambda: C("price") < 5, "234"),
        (lambda: C("price") != 5, "234"),
        (lambda: ~(C("price") != 5), "5"),
        (lambda: (C("price") <= 2) | (C("price") >= 5), "25"),
        (lambda: ~((C("price") <= 2) | (C("price") >= 5)), "34"),
        (lambda: C("price") + 1 > 3, "345"),
        (lambda: x.is_na("inStock"), "4"),
        (lambda: F.lit(True) | (C("price") > 3), "2345"),
        (lambda: C("price") > C("weight"), "2"),
        (lambda: ~(C("price") > C("weight")), "34"),
        (lambda: C("price") >= C("weight"), "24"),
        (lambda: x.floordiv("price", "weight") == 0, "3"),
        (lambda: ~(x.floordiv("price", "weight") == 0), "24"),
        (lambda: x.trunc(-(C("weight") / C("price"))) == -1, "34"),
        (lambda: x.grepl("[0-4]", "id"), "234"),
        (lambda: x.grepl("[0-4]", "id", fixed=True), ""),
        (lambda: x.grepl("2", "id", fixed=True), "2"),
        (lambda: (C("price") > 3) & F.lit(False), ""),
        (lambda: F.lit(True) & (C("price") > 3), "35"),
        (lambda: C("inStock"), "23"),
    ],
)
def test_filters(docs4, predicate, want):
    assert kept(docs4, predicate()) == list(want)


@pytest.mark.parametrize(
    ("ops", "want"),
    [
        ("h2", "23"), ("t2", "45"), ("t-3", "5"), ("h-3", "2"), ("h-2 t1", "3"), ("t-2 h1", "4"), ("t2 h-1", "4"), ("h2 t-1", "3"), ("t-1 h2", "34"), ("h-2 t-1", "3"), ("h-1 t-2", "4"), ("t-2 h-1", "4"), ("t2 h1", "4"), ("h2 t1", "3"),
        ("t9", "2345"), ("h9", "2345"), ("h-9", ""), ("t-9", ""), ("h0", ""),
    ],
)
def test_bounds(docs4, ops, want):
    f = docs4
    for op in ops.split():
        f = (f.head if op[0] == "h" else f.tail)(int(op[1:]))
    assert ids(f) == list(want) and f.ndoc() == len(want)


def test_bounds_fold_matches_lists():
    import itertools

    for n in (0, 3, 7):
        for ops in itertools.product([("head", 2), ("head", -2), ("tail", 3), ("tail", -1), ("window", 2, 4), ("window", 3, 2)], repeat=3):
            rows = list(range(n))
            for kind, k, *rest in ops:
                rows = rows[:k] if kind == "head" else (rows[max(0, len(rows) - k) :] if k >= 0 else rows[-k:]) if kind == "tail" else rows[k - 1 : rest[0]]
            low, size = bounds.fold(ops, lambda n=n: n)
            assert list(range(n))[low : None if size is None else low + size] == rows
    assert not bounds.needs_count([("head", 2), ("tail", -1)]) and bounds.fold([("head", 2)], lambda: 1 / 0) == (0, 2)


def test_sort(docs4):
    assert ids(docs4.sort("price")) == list("2435") and ids(docs4.sort("price", decreasing=True)) == list("5342")
    assert ids(docs4.sort("price", decreasing=True).rev()) == list("2435")
    by = C("weight") * -1
    assert ids(docs4.sort(by)) == list("3425") and ids(docs4.sort(by, decreasing=True)) == list("2435")
    assert ids(docs4.sort(by).tail(2)) == list("25") and ids(docs4.sort("id", decreasing=True)) == list("5432")
    with pytest.raises(ValueError, match="order"):
        DocFrame(docs4.df).head(2).result()
    with pytest.raises(ValueError, match="score"):
        docs4.sort()


def values(f, name):
    return [r[name] for r in f.sort("id").subset(fields=[name]).collect()]


def test_transform(docs4):
    f = docs4.transform(
        stocked="inStock", member=x.in_("id", ["3", "4", "5"]), eq=C("weight") == 3, gt=C("price") > C("weight"), nothing=None, both=C("inStock") & F.lit(None), either=C("inStock") | F.lit(None),
        lo=x.pmin("price", "weight"), hi=x.pmax("price", "weight"), lo_rm=x.pmin("price", "weight", na_rm=True), hi_rm=x.pmax("price", "weight", na_rm=True), r=x.round_half_even(C("price") / 3), bin=x.cut("weight", [1, 3, 5]),
    )
    want = {
        "stocked": [True, True, None, False], "member": [False, True, True, True], "eq": [False, False, True, None], "gt": [True, False, False, None], "both": [None, None, None, False], "either": [True, True, None, None],
        "lo": [1, 4, 3, None], "hi": [2, 5, 3, None], "lo_rm": [1, 4, 3, 5], "hi_rm": [2, 5, 3, 5], "r": [1, 1, 1, 2], "bin": [None, 2, 1, None],
    }
    assert {k: values(f, k) for k in want} == want
    assert "nothing" not in f.names() and "nothing" not in f.result().columns
    assert [r.asDict() for r in docs4.subset(fields=["id", "inStock"]).subset(fields="*").collect()] == [r.asDict() for r in docs4.collect()]
    assert docs4.rename(cost="price").names()[2] == "cost"
    with pytest.raises(KeyError):
        docs4.rename(a="b")


def test_columns():
    names = ["id", "price", "includes", "inStock"]
    assert columns.matching(["price", "i*"], names) == ["price", "id", "includes", "inStock"]
    assert columns.selected("price:inStock", names) == names[1:] and columns.selected("-(price:includes)", names) == ["id", "inStock"]
    assert columns.selected(["i*", "-id"], names) == ["includes", "inStock"]
    with pytest.raises(KeyError):
        columns.matching(["gone"], names)


def test_rows_by_id(docs4):
    assert ids(docs4.docs_by_id(["4", "2", "9"])) == ["4", "2"] and docs4.doc("9") is None
    assert "weight" not in docs4.doc("5") and docs4.doc("5")["price"] == 5
    assert ids(docs4[2:3]) == list("34") and ids(docs4[2:]) == list("345")
    assert docs4.dim() == (4, 5) and docs4[C("price") > 4].ndoc() == 1


def test_semi_and_anti_joins(spark, docs4):
    more = docs4.df.select("id", "price", F.lit(None).cast("string").alias("links")).union(spark.createDataFrame([("6", None, "4"), ("7", None, "2")], "id string, price double, links string"))
    f = DocFrame(more, "id")
    assert kept(f.semi_join("links", f.subset("price > 2"), "id")) == ["6"] and kept(f.semi_join("links", f, "id")) == ["6", "7"]
    assert kept(f.anti_join("links", f.subset("price > 2"), "id")) == ["7"]


def counts(df, *names):
    return [tuple(r[n] for n in (*names, "count")) for r in df.collect()]


def test_logical_and_cut_facets(docs4):
    assert counts(docs4.xtabs("~ inStock"), "inStock") == [(False, 1), (True, 2)]
    t = lambda c: counts(docs4.xtabs(I(c, "k")), "k")
    assert t("NOT inStock") == [(False, 2), (True, 1)] and t("price > 10") == [(False, 4), (True, 0)] and t("price > 3 AND inStock") == [(False, 3), (True, 1)] and t("price > log2(8)") == [(False, 2), (True, 2)]
    assert counts(docs4.xtabs(Cut("price", [1, 3, 5])), "price_cut") == [("(1,3]", 2), ("(3,5]", 2)]
    facet = docs4.facet("~ inStock").subset("inStock")
    assert counts(facet.facets()["inStock"], "inStock") == [(False, 1), (True, 2)]
    assert counts(docs4.subset("inStock").xtabs(I("inStock", "k")), "k") == [(False, 0), (True, 2)]


@pytest.mark.parametrize("na_rm", [False, True])
def test_stats_by_group(facet6, na_rm):
    out = {
        r.cat_s: r
        for r in facet6.aggregate(
            "~ cat_s", n=a.ndoc(), lo=a.min_("num_d", na_rm), hi=a.max_("num_d", na_rm), u=a.nunique("num_d", na_rm), q=a.quantile("num_d", na_rm=na_rm), med=a.median("num_d", na_rm), iqr=a.iqr("num_d", na_rm),
            w=a.weighted_mean("num_d", F.abs("num_i"), na_rm), m=a.mean("num_d", na_rm), any_=a.any_("val_b", na_rm), all_=a.all_("val_b", na_rm),
        ).collect()
    }
    assert list(out) == ["A", "B"]
    A, B = out["A"], out["B"]
    assert (A.n, A.lo, A.hi, A.u, A.q, A.med, A.iqr, A.w, A.m, A.any_) == (2, 2, 4, 2, [2, 2.5, 3, 3.5, 4], 3, 1, None, 3, True)
    if na_rm:
        assert (B.n, B.lo, B.hi, B.u, B.q, B.med, B.iqr, B.w, B.m, B.any_, B.all_, A.all_) == (3, -9, -5, 2, [-9, -8, -7, -6, -5], -7, 2, -7, -7, False, False, True)
    else:
        assert (B.n, B.lo, B.hi, B.u, B.q, B.med, B.iqr, B.w, B.m, B.any_, B.all_, A.all_) == (3, None, None, 3, None, None, None, None, None, None, False, None)


def test_other_aggregates(facet6):
    assert [(r.cat_s, r.s) for r in facet6.aggregate("~ cat_s", na_action="pass", s=a.sum_("num_d")).collect()] == [("A", 6), ("B", None), (None, None)]
    assert [tuple(r) for r in facet6.aggregate(n=a.ndoc(), s=a.sum_("num_d")).collect()] == [(6, None)]
    assert facet6.subset("cat_s = 'C'").aggregate(n=a.ndoc()).count() == 0
    assert [tuple(r) for r in facet6.aggregate(I("num_d > 100", "k"), s=a.sum_("num_d")).collect()] == [(False, -8)]
    assert facet6.aggregate(m=a.mad("num_d", na_rm=True)).first().m == pytest.approx(6.6717)
    assert counts(facet6.xtabs("~ val_b", use_na=True), "val_b") == [(False, 1), (True, 1), (None, 4)]
    assert counts(facet6.xtabs(["cat_s", I("where_s = 'NJ'", "nj")]), "cat_s", "nj") == [("A", False, 1), ("A", True, 1), ("B", False, 1), ("B", True, 2)]
    assert counts(facet6.xtabs([I("cat_s = 'B'", "b"), I("where_s = 'NJ'", "nj")]), "b", "nj") == [(False, False, 1), (False, True, 1), (True, False, 1), (True, True, 2)]
    years = facet6.aggregate(DateCut("date_dt", "year", "y"), n=a.ndoc()).collect()
    assert [(r.y.year, r.n) for r in years] == [(2001, 2), (2002, 2), (2003, 1)]
    cut = lambda **k: [n for _, n in counts(facet6.xtabs(Cut("num_d", [-5, 0, 5, 10], name="c", **k)), "c")]
    assert sorted(cut()) == [0, 0, 2] and sorted(cut(right=False)) == [0, 1, 2] and sorted(cut(include_lowest=True)) == [0, 1, 2]
    assert counts(facet6.xtabs(Field("multi_ss", multi=True), drop_unused=True), "multi_ss") == [("a", 3), ("b", 3)]


def test_formula():
    left, terms = parse("y ~ a + I(b > 3 AND (c + 1) < 2) + cut(d, 0, 5, 10, right=FALSE)")
    assert left == ["y"] and [t.name for t in terms] == ["a", "b_3_AND_c_1_2", "d_cut"] and terms[2].levels == ("[0,5)", "[5,10)")


def test_groups_and_lists(docs4):
    g = docs4.group("~ inStock")
    assert {r.inStock: r.id for r in g.lists("id").collect()} == {True: ["2", "3"], False: ["5"], None: ["4"]}
    assert g.ngroup() == 3 and sorted(ids(g.heads(1))) == ["2", "4", "5"] and sorted(ids(g.tails(1))) == ["3", "4", "5"]
    assert sorted(ids(g.heads(-1))) == ["2"] and sorted(ids(g.tails(-1))) == ["3"] and ids(g.windows(2, 2)) == ["3"]
    assert docs4.summary().count() > 0
    assert [r["price_max"] for r in docs4.aggregate("price ~ inStock", "max").collect()] == [5, 4]


def test_scalars(spark):
    df = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (-5.0, 2.0), (7.0, -3.0), (None, 1.0), (2.5, None)], "p double, q double")
    rows = df.select(x.div("p", "q").alias("d"), x.floordiv("p", "q").alias("f"), x.mod("p", "q").alias("m"), x.sign("p").alias("s"), x.round_half_even("p").alias("r"), x.signif(F.col("p") * 1234, 2).alias("g")).collect()
    inf = float("inf")
    assert [r.d for r in rows[:2]] == [inf, -inf] and rows[2].d != rows[2].d and rows[5].d is None and rows[6].d is None
    assert (rows[3].f, rows[4].f) == (-3, -3) and (rows[3].m, rows[4].m) == (1, -2) and [r.s for r in rows[:3]] == [1, -1, 0]
    assert rows[6].r == 2 and [r.g for r in rows[:4]] == [1200, -1200, 0, -6200]
    g = df.select(x.math_("gamma", F.abs("p") + 1).alias("g"), x.math_("digamma", F.lit(1.0)).alias("d"), x.math_("trigamma", F.lit(0.5)).alias("t")).collect()
    assert g[4].g == pytest.approx(5040) and g[5].g is None and g[0].d == pytest.approx(-0.5772156649) and g[0].t == pytest.approx(4.934802200544679)
    out = df.select(x.ifelse(F.col("p") > F.col("q"), F.lit(1), F.lit(0)).alias("i")).collect()
    assert [r.i for r in out] == [1, 0, 0, 0, 1, None, None]


def test_approximate_quantiles_are_near(spark, sf):
    f = DocFrame.open(spark, f"{sf}/lineitem.parquet")
    x_ = "l_extendedprice"
    near = f.aggregate(q=a.quantile(x_, approximate=True), m=a.median(x_, approximate=True), i=a.iqr(x_, approximate=True), d=a.mad(x_, approximate=True)).first()
    exact = f.aggregate(q=a.quantile(x_), m=a.median(x_), i=a.iqr(x_), d=a.mad(x_)).first()
    assert near.q == pytest.approx(exact.q, rel=0.01) and (near.m, near.i, near.d) == pytest.approx((exact.m, exact.i, exact.d), rel=0.01)
    assert f.summary(approximate=True).count() == f.summary().count()


def test_ids_names_and_bound_columns(spark):
    f = DocFrame(spark.createDataFrame([(1, "a", None), (2, "b", 5)], "k int, x string, y int"), "k")
    assert f.with_ids("k * 10").docs() == [{"k": 10, "x": "a"}, {"k": 20, "x": "b", "y": 5}]
    assert DocFrame(f.df.drop("k")).with_ids("concat(x, '!')").key == "id"
    assert f.with_names(["id", "p", "q"]).key == "id" and f.with_names(["id", "p", "q"]).names() == ["id", "p", "q"]
    both = f.cbind(DocFrame(spark.createDataFrame([(2, 7, 1)], "j int, y int, z int"), "j"))
    assert both.names() == ["k", "x", "y", "z"] and [tuple(r) for r in both.collect()] == [(2, "b", 7, 1)]


def test_listing_aggregates_and_simplify(spark):
    f = DocFrame(spark.createDataFrame([(1, "a", 3), (2, "a", 3), (3, "b", 4), (4, None, 9)], "k int, g string, v int"), "k")
    assert [tuple(r) for r in f.aggregate("v ~ g", "unique").collect()] == [("a", 3), ("b", 4)]
    assert [tuple(r) for r in f.aggregate("v ~ g", "unique", simplify=False).collect()] == [("a", [3]), ("b", [4])]
    assert [tuple(r) for r in f.aggregate("v ~ g", "heads", keep=5, na_action="pass").collect()] == [("a", [3, 3]), ("b", [4]), (None, [9])]
    assert f.subset("k > 9").aggregate("v ~ g", "unique").count() == 0


def test_list_columns_in_a_descending_order(spark):
    f = DocFrame(spark.createDataFrame([(1, "a", 3), (2, "a", None), (3, "a", 4)], "k int, g string, v int"), "k")
    assert f.sort("v", decreasing=True).group("~ g").lists("k").first().k == [3, 1, 2]
    assert f.sort("v").group("~ g").lists("k").first().k == [1, 3, 2]


def test_a_facet_says_that_bounds_do_not_count(spark):
    f = DocFrame(spark.createDataFrame([(1, "a"), (2, "a")], "k int, g string"), "k")
    with pytest.warns(UserWarning, match="bound"):
        assert f.head(1).facet("~ g").facets()["g"].first()["count"] == 2


def test_search_index(spark, tmp_path):
    rows = [(1, "The cat, the CAT"), (2, "a dog"), (3, None), (4, ""), (5, "cat " * 2000 + "dog")]
    f = DocFrame(spark.createDataFrame(rows, "k int, text string"), "k")
    index = f.index(str(tmp_path / "index"))
    for words in ("cat dog", "the", "nothing", "", "cat cat"):
        want = {r.k: round(r.score, 9) for r in f.search_docs(words).collect()}
        assert {r.k: round(r.score, 9) for r in f.search_docs(words, index=index).collect()} == want
    assert [r.k for r in f.search_docs("dog", index=index).head(1).collect()] == [2]


def test_gamma_family_is_native_and_right(spark):
    import math

    from docframe.functions import exprs as x

    values = [0.5, 1.0, 2.0, 5.0, 10.3, 25.0, 100.5, 170.0, -0.5, -3.2, 1e-3]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (math.nan,), (0.0,), (-2.0,)], "x double")
    rows = df.select("x", *[x.math_(n, "x").alias(n) for n in x.GAMMA]).collect()
    for r in rows[: len(values)]:
        assert r.gamma == pytest.approx(math.gamma(r.x), rel=1e-12) and r.lgamma == pytest.approx(math.lgamma(r.x), abs=1e-11)
        assert r.factorial == pytest.approx(math.gamma(r.x + 1), rel=1e-12)
        h = 1e-5
        assert r.digamma == pytest.approx((math.lgamma(r.x + h) - math.lgamma(r.x - h)) / (2 * h), rel=1e-3)
    assert rows[3].factorial == 120.0 and rows[1].trigamma == pytest.approx(math.pi**2 / 6, rel=1e-11)
    assert rows[-4].gamma is None and rows[-3].gamma is None and math.isnan(rows[-2].gamma) and math.isnan(rows[-1].digamma)
