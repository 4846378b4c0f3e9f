"""Lazy document frames: verbs that record a query on a Spark DataFrame and return a new frame.

Filters and computed columns go into the DataFrame plan at once (nothing runs until a result is asked for), so later verbs
see them. Column clip, sort order, bounds and facets are deferred: a later ``fields="*"`` restores columns, a later sort
takes precedence over an earlier one, and head, tail and window compose over the filtered, sorted rows.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docframe.functions import aggs, exprs
from docframe.functions.aggs import Stat, column_of
from docframe.plans import bounds, columns, formula
from docframe.plans.formula import Term

#: Ids above this number are looked up by a join, not by a list in the filter.
MAX_ID_LIST = 1024


@dataclass(frozen=True)
class SortKey:
    column: Column
    descending: bool

    def order(self, flip: bool = False) -> Column:
        """Missing values come last in either direction; in a flipped order (rows from the end) they come first."""
        down = self.descending != flip
        if flip:
            return self.column.desc_nulls_first() if down else self.column.asc_nulls_first()
        return self.column.desc_nulls_last() if down else self.column.asc_nulls_last()


@dataclass(frozen=True)
class FacetSpec:
    name: str
    df: DataFrame
    terms: tuple[Term, ...]
    stats: tuple[tuple[str, Any], ...]
    use_na: bool
    sort: str | None
    decreasing: bool
    limit: int | None
    drop: bool


def expression(x: Any) -> Column:
    """Strings are SQL expressions."""
    return x.column if isinstance(x, Stat) else F.expr(x) if isinstance(x, str) else exprs.col(x)


@dataclass(frozen=True)
class DocFrame:
    df: DataFrame
    key: str | None = None
    clip: tuple[str, ...] | None = None
    order: tuple[SortKey, ...] = ()
    slices: tuple[tuple, ...] = ()
    facet_specs: tuple[FacetSpec, ...] = ()
    #: Columns whose every value is a literal NA; they do not appear in results.
    void: tuple[str, ...] = field(default=())

    @classmethod
    def open(cls, spark: SparkSession, path: str, key: str | None = None, normalize_nan: bool = False) -> DocFrame:
        """A frame over a Parquet table. ``normalize_nan`` turns NaN into missing on load."""
        df = spark.read.parquet(path)
        if normalize_nan:
            df = df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c, t in df.dtypes if t in ("double", "float")})
        return cls(df, key)

    # Filters and columns

    def subset(self, *predicates: Column | str, fields: Sequence[str] | str | None = None, select: Sequence[str] | str | None = None) -> DocFrame:
        """Rows where all predicates hold (a missing one drops the row); ``fields`` are globs, ``select`` ranges and exclusions."""
        out = self
        for p in predicates:
            out = replace(out, df=out.df.where(expression(p)))
        if select is not None:
            out = replace(out, clip=tuple(columns.selected(select, out.df.columns)))
        if fields is not None:
            out = replace(out, clip=(fields,) if isinstance(fields, str) else tuple(fields))
        return out

    def transform(self, **new: Any) -> DocFrame:
        """Columns computed side by side from the present ones; a column that is a literal NA disappears from results."""
        cols = {k: expression(v) if v is not None else F.lit(None) for k, v in new.items()}
        df = self.df.withColumns(cols)
        void = {k for k, v in new.items() if v is None or df.schema[k].dataType.typeName() == "void"}
        return replace(self, df=df, void=tuple((set(self.void) - set(new)) | void), clip=self.clip and (*self.clip, *[k for k in new if k not in self.clip]))

    def within(self, f: Callable[[DocFrame], Mapping[str, Any]]) -> DocFrame:
        """Columns from a function of the frame."""
        return self.transform(**f(self))

    def rename(self, **new_from_old: str) -> DocFrame:
        for old in new_from_old.values():
            if old not in self.df.columns:
                raise KeyError(f"no column {old!r}")
        back = {old: new for new, old in new_from_old.items()}
        return replace(self, df=self.df.withColumnsRenamed(back), key=back.get(self.key, self.key), clip=self.clip and tuple(back.get(c, c) for c in self.clip))

    def __getitem__(self, item: Any) -> Any:
        """A column by name; columns by a list of names or globs; rows by a slice (from 1, inclusive), predicate or ids."""
        if isinstance(item, str):
            return F.col(item)
        if isinstance(item, Column):
            return self.subset(item)
        if isinstance(item, slice):
            return self.window(item.start or 1, item.stop) if item.stop is not None else self.tail(1 - (item.start or 1))
        if isinstance(item, tuple):
            return self[item[0]].subset(fields=item[1])
        return self.subset(fields=list(item))

    def docs_by_id(self, ids: Sequence, ordered: bool = True) -> DocFrame:
        """Rows with the given keys, in their order; unknown ids have no row."""
        key = self._key()
        ids = list(ids)
        if not ordered and len(ids) <= MAX_ID_LIST:
            return self.subset(F.col(key).isin(ids))
        wanted = self.df.sparkSession.createDataFrame([(i, n) for n, i in enumerate(ids)], f"{key} {self.df.schema[key].dataType.simpleString()}, __at long")
        df = self.df.join(F.broadcast(wanted) if len(ids) <= MAX_ID_LIST else wanted, key)
        return replace(self, df=df, order=(SortKey(F.col("__at"), False),), clip=self.clip or tuple(c for c in df.columns if c != "__at"))

    def doc(self, doc_id: Any) -> dict | None:
        """One document as a dict without its missing fields; None if there is none."""
        row = self.df.where(F.col(self._key()) == F.lit(doc_id)).limit(1).collect()
        return {k: v for k, v in row[0].asDict().items() if v is not None} if row else None

    def eval(self, f: Callable[[DocFrame], Any]) -> Any:
        return f(self)

    def index(self, path: str, text: str = "text"):
        """Write the frame's search index (see ``operators.search``) to ``path``; it holds the rows as they are now."""
        from docframe.operators.search import SearchIndex

        return SearchIndex.build(self.df, self._key(), text, path)

    def search_docs(self, query: str, text: str = "text", index: Any = None) -> DocFrame:
        """Rows with a word of the query, best score first (see ``operators.search``); with an index only matching rows are scored."""
        from docframe.operators.search import score_documents

        df = self.df.join(index.scores(query), self._key()) if index is not None else score_documents(self.df, query, text, matching=True)
        return replace(self, df=df, order=(SortKey(F.col("score"), True), *([SortKey(F.col(self.key), False)] if self.key else [])))

    # Joins and sets

    def semi_join(self, column: str, other: DocFrame | DataFrame, other_column: str) -> DocFrame:
        """Rows whose column is among the other frame's values."""
        right = _frame_of(other).select(F.col(other_column).alias("__in")).where("__in is not null")
        return replace(self, df=self.df.join(right, F.col(column) == F.col("__in"), "left_semi"))

    def anti_join(self, column: str, other: DocFrame | DataFrame, other_column: str) -> DocFrame:
        """Rows whose column is present and not among the other frame's values."""
        right = _frame_of(other).select(F.col(other_column).alias("__in")).where("__in is not null")
        return replace(self, df=self.df.where(F.col(column).isNotNull()).join(right, F.col(column) == F.col("__in"), "left_anti"))

    def rbind(self, other: DocFrame) -> DocFrame:
        """Rows of both; columns that one lacks are missing there."""
        return replace(self, df=self.result().unionByName(other.result(), allowMissingColumns=True), order=(), slices=(), clip=None)

    def cbind(self, other: DocFrame) -> DocFrame:
        """Columns of both frames side by side, rows matched by the unique key; a column that both have is the other's."""
        right = other.result().withColumnRenamed(other._key(), "__id")
        new = [c for c in right.columns if c != "__id"]
        df = self.df.drop(*[c for c in new if c in self.df.columns]).join(right, F.col(self._key()) == F.col("__id")).drop("__id")
        return replace(self, df=df, clip=self.clip and (*self.clip, *[c for c in new if c not in self.clip]))

    def with_ids(self, ids: Any) -> DocFrame:
        """The unique key set to an expression's values; a frame without one gets the column ``id``."""
        key = self.key or "id"
        return replace(self.transform(**{key: ids}), key=key)

    def with_names(self, names: Sequence[str]) -> DocFrame:
        """New names for the shown columns, in their order."""
        return self.rename(**dict(zip(names, self.names(), strict=True)))

    def unique(self, *names: str) -> DocFrame:
        """Distinct rows over the given (or all shown) columns, missing ones included, in their order."""
        shown = list(names) or self.names()
        return replace(self, df=self.df.select(*shown).distinct(), order=tuple(SortKey(F.col(c), False) for c in shown), slices=(), clip=None)

    # Order and bounds

    def sort(self, *by: Column | str, decreasing: bool = False) -> DocFrame:
        """One direction for all keys of a call; they take precedence over earlier ones."""
        if not by:
            if "score" not in self.df.columns:
                raise ValueError("sort needs a key: there is no score")
            by = ("score",)
        keys = tuple(SortKey(expression(b), decreasing) for b in by)
        return replace(self, order=keys + self.order)

    def rev(self) -> DocFrame:
        """All keys in the other direction."""
        if not self.order and "score" in self.df.columns:
            return self.sort("score")
        return replace(self, order=tuple(SortKey(k.column, not k.descending) for k in self._order()))

    def head(self, n: int = 6) -> DocFrame:
        return replace(self, slices=(*self.slices, ("head", n)))

    def tail(self, n: int = 6) -> DocFrame:
        return replace(self, slices=(*self.slices, ("tail", n)))

    def window(self, start: int, end: int) -> DocFrame:
        return replace(self, slices=(*self.slices, ("window", start, end)))

    def _key(self) -> str:
        if not self.key:
            raise ValueError("the frame has no unique key")
        return self.key

    def _order(self) -> tuple[SortKey, ...]:
        if self.order:
            return self.order
        if self.key:
            return (SortKey(F.col(self.key), False),)
        raise ValueError("rows have no order: sort the frame or give it a unique key")

    # Results

    def names(self) -> list[str]:
        present = [c for c in self.df.columns if c not in self.void]
        return present if self.clip is None else columns.matching([c for c in self.clip if c not in self.void], present)

    def result(self) -> DataFrame:
        """The plan: filters and computed columns, then order, bounds and clip."""
        df = self.df
        if self.slices:
            order = self._order()
            if len(self.slices) == 1 and self.slices[0][0] == "tail" and self.slices[0][1] >= 0:
                # the last rows are the first of the flipped order: a top-n, with no count and no full sort
                last = df.orderBy(*[k.order(flip=True) for k in order]).limit(self.slices[0][1])
                df = last.orderBy(*[k.order() for k in order])
            else:
                offset, limit = bounds.fold(self.slices, self.df.count)
                df = df.orderBy(*[k.order() for k in order])
                df = df.offset(offset) if offset else df
                df = df if limit is None else df.limit(limit)
        elif self.order:
            df = df.orderBy(*[k.order() for k in self.order])
        return df.select(*[F.col(f"`{c}`") for c in self.names()])

    def collect(self) -> list:
        return self.result().collect()

    def docs(self) -> list[dict]:
        """Documents as dicts without missing fields."""
        return [{k: v for k, v in r.asDict().items() if v is not None} for r in self.collect()]

    def to_pandas(self, fill: bool = True):
        """A data frame of the result; without ``fill`` columns that are missing throughout go."""
        out = self.result().toPandas()
        return out if fill else out.dropna(axis=1, how="all")

    def ndoc(self) -> int:
        offset, limit = (0, None) if not self.slices else bounds.fold(self.slices, self.df.count)
        n = max(0, self.df.count() - offset)
        return n if limit is None else min(n, limit)

    nrow = ndoc

    def ncol(self) -> int:
        return len(self.names())

    nfield = ncol

    def dim(self) -> tuple[int, int]:
        return self.ndoc(), self.ncol()

    def ids(self) -> DataFrame:
        return self.subset(fields=[self._key()]).result()

    def explain(self, mode: str = "formatted") -> None:
        self.result().explain(mode)

    def __repr__(self) -> str:
        return f"DocFrame({', '.join(self.names())}; {len(self.order)} sort keys, bounds {list(self.slices)})"

    # Groups

    def group(self, by: str | Sequence | Term):
        from docframe.operators.grouped import GroupedDocFrame

        return GroupedDocFrame(self, tuple(formula.parse(by)[1]))

    def aggregate(self, by: Any = None, *fun: Any, subset: Any = None, na_action: str = "omit", count: bool = False, na_rm: bool = False, simplify: bool = True, keep: int = 6, **stats: Any) -> DataFrame:
        """One row for each group, ordered by the group keys; a row for the whole frame without ``by`` (none if it is empty).

        ``by`` is a formula or terms; ``"y ~ g"`` with a function name or callable gives the column ``y_fun``. Groups with a
        missing key are dropped unless ``na_action`` is "pass". "heads", "tails" (``keep`` values in the frame's order) and
        "unique" give arrays; where every array has one value, ``simplify`` gives the values instead.
        """
        left, terms = formula.parse(by)
        df = self.df if subset is None else self.df.where(expression(subset))
        if left and terms and len(fun) == 1 and fun[0] in LISTING:
            return listed(replace(self, df=df), left, terms, fun[0], keep, simplify, na_action == "pass")
        named: list[tuple[str, Any]] = [("count", aggs.ndoc())] if count else []
        for f in fun:
            if isinstance(f, Stat):
                named.append((f.name, f))
            elif left:
                made = [(aggs.BY_NAME[f] if isinstance(f, str) else f)(y, na_rm=na_rm) for y in left]
                named += [(m.name if isinstance(m, Stat) else f"{y}_{getattr(f, '__name__', 'fun')}", m) for y, m in zip(left, made, strict=True)]
            else:
                got = f(self)
                named += list(got.items()) if isinstance(got, Mapping) else [(got.name if isinstance(got, Stat) else getattr(f, "__name__", "fun"), got)]
        named += list(stats.items())
        return summarize(df, terms, named, na_pass=na_action == "pass")

    def xtabs(self, by: Any, subset: Any = None, use_na: bool = False, drop_unused: bool = False, exclude: Sequence = (), add_na: bool = False) -> DataFrame:
        """Counts over all combinations of levels, zero cells included unless ``drop_unused``.

        Rows with a value of ``exclude`` in a plain field are left out; ``add_na`` is another name for ``use_na``.
        """
        df = self.df if subset is None else self.df.where(expression(subset))
        terms = formula.parse(by)[1]
        for t in terms if exclude else ():
            if t.levels is None and t.unit is None:
                df = df.where(t.column.isNull() | ~t.column.isin(list(exclude)))
        return cross_table(df, terms, use_na or add_na, drop_unused)

    table = xtabs

    def ftable(self, by: Any, **options: Any) -> DataFrame:
        """A flat table: a row for each combination of the terms but the last, a column for each level of the last."""
        *rows, last = formula.parse(by)[1]
        long = self.xtabs([*rows, last], **options)
        names = [t.name for t in rows]
        return long.groupBy(*names).pivot(last.name).agg(F.sum("count")).orderBy(*[F.col(n).asc_nulls_last() for n in names])

    def facet(self, by: Any = None, *stats: Stat, name: str | None = None, use_na: bool = False, sort: str | None = None, decreasing: bool = False, limit: int | None = None, drop: bool = False, **named: Any) -> DocFrame:
        """Ask for a facet over the rows as filtered so far: later filters, sorts and bounds do not change it."""
        terms = tuple(formula.parse(by)[1])
        if self.slices:
            warnings.warn("facets count all rows that pass the filters: head, tail and window do not bound them", stacklevel=2)
        if use_na and any(t.levels for t in terms):
            raise ValueError("use_na is for plain fields")
        spec = FacetSpec(name or ".".join(t.name for t in terms) or "all", self.df, terms, tuple([(s.name, s) for s in stats] + list(named.items())), use_na, sort, decreasing, limit, drop)
        return replace(self, facet_specs=(*self.facet_specs, spec))

    def facets(self):
        from docframe.operators.facets import Facets

        return Facets(self.facet_specs)

    def summary(self, maxsum: int = 6, approximate: bool = False):
        """Long form (column, statistic, value); ``approximate`` quartiles take bounded memory."""
        from docframe.operators.summary import summarize_frame

        return summarize_frame(self.result(), maxsum, approximate)

    # Whole-frame computations

    def rescale(self, column: str, low: float = 0.0, high: float = 1.0, into: str | None = None) -> DocFrame:
        """Min-max scaling over the rows; missing where all values are equal. The ends come from one pre-aggregated row."""
        ends = self.df.agg(F.min(column).alias("__low"), F.max(column).alias("__high"))
        scaled = (F.col(column) - F.col("__low")) / F.nullif(F.col("__high") - F.col("__low"), F.lit(0)) * (high - low) + low
        df = self.df.join(F.broadcast(ends)).withColumn(into or column, scaled).drop("__low", "__high")  # one row
        return replace(self, df=df)

    def cumulative(self, fun: str, column: str, by: Sequence[str], order: Sequence[str], into: str | None = None) -> DocFrame:
        """cumsum, cummax, cummin or cumprod within groups ``by`` in the given order; missing from the first missing value on."""
        w = Window.partitionBy(*by).orderBy(*[F.col(o).asc_nulls_last() for o in order]).rowsBetween(Window.unboundedPreceding, 0)
        f = {"cumsum": F.sum, "cummax": F.max, "cummin": F.min, "cumprod": F.product}[fun]
        return replace(self, df=self.df.withColumn(into or f"{column}_{fun}", F.when(F.count_if(F.col(column).isNull()).over(w) == 0, f(column).over(w))))


def _frame_of(x: DocFrame | DataFrame) -> DataFrame:
    return x.result() if isinstance(x, DocFrame) else x


def with_terms(df: DataFrame, terms: Sequence[Term]) -> DataFrame:
    """``df`` with a column for each term; a multi-valued field gives a row for each distinct value."""
    made = df.withColumns({f"__t{i}": F.array_distinct(t.column) if t.explode else t.column for i, t in enumerate(terms)}) if terms else df
    for i, t in enumerate(terms):
        if t.explode:
            made = made.withColumn(f"__t{i}", F.explode_outer(f"__t{i}"))
    return made


def summarize(df: DataFrame, terms: Sequence[Term], stats: Sequence[tuple[str, Any]], na_pass: bool = False, ordered: bool = True) -> DataFrame:
    """Grouped statistics with the group columns first; global ones over no rows give no row."""
    keys = [f"__t{i}" for i in range(len(terms))]
    rows = with_terms(df, terms)
    if terms and not na_pass:
        rows = rows.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    centres = {s.centre[0]: aggs.percentiles(s.centre[1], 0.5, s.centre[2]) for _, s in stats if isinstance(s, Stat) and s.centre}
    if centres:
        # medians of the groups first, handed back to the rows by a join on the group
        middle = rows.groupBy(*keys).agg(*[c.alias(name) for name, c in centres.items()])
        if keys:
            marked = middle.withColumnsRenamed({k: f"{k}c" for k in keys})
            rows = rows.join(marked, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{k}c")) for k in keys]))
        else:
            rows = rows.join(F.broadcast(middle))  # one row
    out = [column_of(s).alias(n) for n, s in stats] or [F.count(F.lit(1)).alias("count")]
    if not terms:
        return rows.agg(*out, F.count(F.lit(1)).alias("__n")).where("__n > 0").drop("__n")
    done = rows.groupBy(*keys).agg(*out).withColumnsRenamed({k: t.name for k, t in zip(keys, terms, strict=True)})
    return done.orderBy(*[F.col(t.name).asc_nulls_last() for t in terms]) if ordered else done


def levels_of(df: DataFrame, term: Term, use_na: bool) -> DataFrame:
    """The domain of a term: its fixed levels, all calendar bins from the first to the last, or the values that occur."""
    if term.levels is not None:
        return df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(v) for v in term.levels])).alias(term.name))
    if term.unit is not None:
        low, high = term.ends or (None, None)
        first = F.min(term.column) if low is None else F.date_trunc(term.unit, F.lit(low).cast("timestamp"))
        last = F.max(term.column) if high is None else F.date_trunc(term.unit, F.lit(high).cast("timestamp"))
        step = F.expr("INTERVAL 3 MONTH" if term.unit == "quarter" else f"INTERVAL 1 {term.unit}")
        ends = df.agg(first.alias("first"), last.alias("last"))  # one row
        return ends.select(F.explode(F.sequence("first", "last", step)).alias(term.name))
    return with_terms(df, [term]).select(F.col("__t0").alias(term.name)).where("true" if use_na else "__t0 is not null").distinct()


LISTING = ("heads", "tails", "unique")


def listed(frame: DocFrame, left: Sequence[str], terms: Sequence[Term], fun: str, n: int, simplify: bool, na_pass: bool) -> DataFrame:
    """Arrays of each group's first, last or distinct values of the columns ``left``."""
    kept = frame if na_pass else replace(frame, df=frame.df.where(reduce(lambda a, b: a & b, [t.column.isNotNull() for t in terms])))
    groups = kept.group(list(terms))
    if fun == "unique":
        out = groups.unique(*left)
    else:
        out = (groups.heads(n) if fun == "heads" else groups.tails(n)).group(list(terms)).lists(*left)
    # with one value at most for each group the check needs no job
    if simplify and ((fun != "unique" and n == 1) or out.agg(F.max(F.greatest(*[F.size(c) for c in left], F.lit(0))).alias("n")).first()["n"] == 1):
        out = out.withColumns({c: F.get(c, F.lit(0)) for c in left})
    return out.withColumnsRenamed({c: f"{c}_{fun}" for c in left}).orderBy(*[F.col(t.name).asc_nulls_last() for t in terms])


def cross_table(df: DataFrame, terms: Sequence[Term], use_na: bool = False, drop_unused: bool = False) -> DataFrame:
    """Long form: a column for each term and ``count``."""
    counts = summarize(df, terms, [("count", aggs.ndoc())], na_pass=use_na, ordered=False)
    names = [t.name for t in terms]
    if drop_unused:
        return counts.orderBy(*[F.col(n).asc_nulls_last() for n in names])
    # all cells of the table are its result, so their number is the product of the numbers of levels by definition
    cells = reduce(lambda a, b: a.crossJoin(b), [levels_of(df, t, use_na) for t in terms])
    other = counts.withColumnsRenamed({n: f"__{n}" for n in names})
    full = cells.join(other, reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"__{n}")) for n in names]), "left")
    return full.select(*names, F.coalesce("count", F.lit(0)).alias("count")).orderBy(*[F.col(n).asc_nulls_last() for n in names])
