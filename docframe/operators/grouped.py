"""Grouped frames: slices of each group, list columns, and slices over groups."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docframe.functions.aggs import Stat
from docframe.operators.frame import DocFrame, summarize, with_terms
from docframe.plans.formula import Term, parse


@dataclass(frozen=True)
class GroupedDocFrame:
    frame: DocFrame
    terms: tuple[Term, ...]

    def group(self, by) -> GroupedDocFrame:
        """More grouping."""
        return replace(self, terms=self.terms + tuple(parse(by)[1]))

    def ungroup(self) -> DocFrame:
        return self.frame

    def grouping(self) -> list[str]:
        return [t.name for t in self.terms]

    def _keyed(self) -> tuple[DataFrame, list[str]]:
        return with_terms(self.frame.df, self.terms), [f"__t{i}" for i in range(len(self.terms))]

    # Slices within groups

    def windows(self, start: int, end: int) -> DocFrame:
        """Rows ``start`` to ``end`` (from 1) of each group, in the frame's order. Spark keeps only the leading rows of each group before the shuffle."""
        df, keys = self._keyed()
        order = [k.order() for k in self.frame._order()]
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        kept = df.withColumn("__place", place).where(F.col("__place").between(max(1, start), end)).drop("__place", *keys)
        return replace(self.frame, df=kept)

    def heads(self, n: int = 6) -> DocFrame:
        """First n rows of each group, or all but the last -n."""
        return self.windows(1, n) if n >= 0 else self._but(-n, flip=True)

    def tails(self, n: int = 6) -> DocFrame:
        """Last n rows of each group, or all but the first -n."""
        df, keys = self._keyed()
        if n < 0:
            return self._but(-n, flip=False)
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*[k.order(flip=True) for k in self.frame._order()]))
        return replace(self.frame, df=df.withColumn("__place", place).where(F.col("__place") <= n).drop("__place", *keys))

    def _but(self, n: int, flip: bool) -> DocFrame:
        df, keys = self._keyed()
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*[k.order(flip=flip) for k in self.frame._order()]))
        return replace(self.frame, df=df.withColumn("__place", place).where(F.col("__place") > n).drop("__place", *keys))

    # Groups as rows

    def aggregate(self, *stats: Stat, na_action: str = "omit", **named) -> DataFrame:
        return summarize(self.frame.df, self.terms, [(s.name, s) for s in stats] + list(named.items()), na_pass=na_action == "pass")

    def ngroup(self) -> int:
        df, keys = self._keyed()
        return df.select(*keys).distinct().count()

    nrow = ngroup

    def ndoc(self) -> DataFrame:
        return self.aggregate(na_action="pass")

    def rownames(self) -> DataFrame:
        """Group keys joined by dots."""
        df, keys = self._keyed()
        return df.select(F.concat_ws(".", *keys).alias("name")).distinct().orderBy("name")

    def lists(self, *names: str) -> DataFrame:
        """A row for each group; each column is the array of the group's values in the frame's order. Arrays hold whole groups by definition."""
        df, keys = self._keyed()
        keyed = self.frame._order()
        order = [k.column for k in keyed]
        down = [k.descending for k in keyed]

        def before(left, right):
            """-1, 0 or 1 by the first sort key that differs; missing values last in either direction."""
            out = F.lit(0)
            for i in reversed(range(len(order))):
                x, y, first = left[f"__o{i}"], right[f"__o{i}"], F.lit(1 if down[i] else -1)
                out = F.when(x.isNull() & y.isNull(), out).when(x.isNull(), 1).when(y.isNull(), -1).when(x < y, first).when(x > y, -first).otherwise(out)
            return out

        rest = [n for n in names or self.frame.names()]
        rows = F.collect_list(F.struct(*[c for i, o in enumerate(order) for c in (o.isNull().alias(f"__m{i}"), o.alias(f"__o{i}"))], *[F.col(n).alias(f"__v{i}") for i, n in enumerate(rest)]))
        packed = F.array_sort(rows, before) if any(down) else F.array_sort(rows)
        out = df.groupBy(*keys).agg(packed.alias("__all"))
        return out.select(*[F.col(k).alias(t.name) for k, t in zip(keys, self.terms, strict=True)], *[F.col("__all")[f"__v{i}"].alias(n) for i, n in enumerate(rest)])

    def unique(self, *names: str) -> DataFrame:
        """Sorted distinct values of each group."""
        df, keys = self._keyed()
        out = df.groupBy(*keys).agg(*[F.array_sort(F.collect_set(n)).alias(n) for n in names])
        return out.withColumnsRenamed({k: t.name for k, t in zip(keys, self.terms, strict=True)})

    def _groups(self) -> DocFrame:
        df, keys = self._keyed()
        names = self.grouping()
        groups = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]).distinct()
        return DocFrame(groups).sort(*names)

    def sort(self, *by: str, decreasing: bool = False) -> GroupedDocFrame:
        """Another order of the rows of each group."""
        return replace(self, frame=self.frame.sort(*by, decreasing=decreasing))

    def head(self, n: int = 6) -> GroupedDocFrame:
        return self._only(self._groups().head(n))

    def tail(self, n: int = 6) -> GroupedDocFrame:
        return self._only(self._groups().tail(n))

    def window(self, start: int, end: int) -> GroupedDocFrame:
        return self._only(self._groups().window(start, end))

    def _only(self, groups: DocFrame) -> GroupedDocFrame:
        kept = groups.result().withColumnsRenamed({n: f"__g{i}" for i, n in enumerate(self.grouping())})
        cond = None
        for i, t in enumerate(self.terms):
            same = t.column.eqNullSafe(F.col(f"__g{i}"))
            cond = same if cond is None else cond & same
        return replace(self, frame=replace(self.frame, df=self.frame.df.join(kept, cond, "left_semi")))

    def transform(self, **new) -> DocFrame:
        """Columns relative to the group: aggregates in the expressions are taken over the row's group."""
        df, keys = self._keyed()
        w = Window.partitionBy(*keys)
        out = df.withColumns({k: v(w) for k, v in new.items()})
        return replace(self.frame, df=out.drop(*keys))


def unlist(frame: DocFrame, columns: Sequence[str]) -> DocFrame:
    """List columns of equal length back to one row for each value."""
    rest = [c for c in frame.df.columns if c not in columns]
    zipped = frame.df.select(*rest, F.explode(F.arrays_zip(*columns)).alias("__z"))
    return replace(frame, df=zipped.select(*rest, *[F.col(f"__z.{c}").alias(c) for c in columns]))
