"""Facets: trees of counts and statistics over the rows as they were when each facet was asked for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docframe.functions import aggs
from docframe.functions.aggs import column_of
from docframe.operators.frame import FacetSpec, cross_table, summarize, with_terms
from docframe.plans.formula import parse


class Facets:
    """``facets["a"]`` is the table of a facet; a facet over several terms also has a table of counts for each prefix."""

    def __init__(self, specs: Sequence[FacetSpec]):
        self.specs = {s.name: s for s in specs}

    def names(self) -> list[str]:
        return list(self.specs)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.specs and "~" in name:
            name = ".".join(t.name for t in parse(name)[1])
        return facet_table(self.specs[name])

    def stats(self) -> dict[str, DataFrame]:
        return {n: self[n] for n in self.specs}

    def tree(self, name: str) -> DataFrame:
        """All levels in one table by grouping sets: ``level`` terms are given, the others missing. Statistics are of each level's rows."""
        s = self.specs[name]
        rows = with_terms(s.df, s.terms)
        keys = [f"__t{i}" for i in range(len(s.terms))]
        if not s.use_na:
            rows = rows.dropna(subset=keys)
        sets = [[F.col(k) for k in keys[: i + 1]] for i in range(len(keys))]
        out = rows.groupingSets(sets, *keys).agg(F.sum(F.lit(0)).alias("__zero"), (F.lit(len(keys)) - sum((F.grouping(k) for k in keys), F.lit(0))).cast("int").alias("level"), F.count(F.lit(1)).alias("count"), *[column_of(v).alias(n) for n, v in s.stats])
        return out.drop("__zero").withColumnsRenamed({k: t.name for k, t in zip(keys, s.terms, strict=True)})

    def as_table(self, name: str) -> DataFrame:
        """Counts in long form with all cells."""
        s = self.specs[name]
        return cross_table(s.df, s.terms, s.use_na, s.drop)

    def pivot(self, name: str) -> DataFrame:
        """Counts of a two-term facet with a column for each level of the second."""
        s = self.specs[name]
        first, second = s.terms
        return self.as_table(name).groupBy(first.name).pivot(second.name).agg(F.sum("count"))


def facet_table(s: FacetSpec) -> DataFrame:
    """Counts (and statistics) of the full combination; ``limit`` keeps the first buckets under each parent."""
    if not s.stats and not s.drop and all(t.levels for t in s.terms) and s.terms:
        table = cross_table(s.df, s.terms, s.use_na)
    else:
        table = summarize(s.df, s.terms, [("count", aggs.ndoc()), *s.stats], na_pass=s.use_na, ordered=False)
    keys = [t.name for t in s.terms]
    by = s.sort or None
    order = ([F.col(by).desc_nulls_last() if s.decreasing else F.col(by).asc_nulls_last()] if by else []) + [F.col(k).desc_nulls_last() if s.decreasing and not by else F.col(k).asc_nulls_last() for k in keys]
    if s.limit is not None and len(keys) == 1:
        return table.orderBy(*order).limit(s.limit)
    if s.limit is not None and keys:
        place = F.row_number().over(Window.partitionBy(*keys[:-1]).orderBy(*order))
        table = table.withColumn("__place", place).where(F.col("__place") <= s.limit).drop("__place")
    return table.orderBy(*order) if keys else table
