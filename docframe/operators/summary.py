"""Summaries of a frame in long form: (column, statistic, value)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

from docframe.functions.aggs import percentiles

NAMES = ("min", "q1", "median", "mean", "q3", "max", "nas")


def numeric_summary(df: DataFrame, names: list[str], approximate: bool = False) -> DataFrame:
    """min, quartiles, mean, max and number of missing values of all numeric columns in one pass."""
    out = []
    for c in names:
        x = F.col(c).cast("double")
        q = percentiles(x, [0.25, 0.5, 0.75], approximate)
        out.append(F.array(F.min(x), q[0], q[1], F.avg(x), q[2], F.max(x), F.count_if(x.isNull()).cast("double")).alias(c))
    wide = df.agg(*out)
    rows = [F.struct(F.lit(c).alias("column"), F.lit(s).alias("statistic"), F.col(c)[i].cast("string").alias("value")) for c in names for i, s in enumerate(NAMES)]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def date_summary(df: DataFrame, names: list[str]) -> DataFrame:
    out = [F.array(F.min(c).cast("string"), F.max(c).cast("string"), F.count_if(F.col(c).isNull()).cast("string")).alias(c) for c in names]
    rows = [F.struct(F.lit(c).alias("column"), F.lit(s).alias("statistic"), F.col(c)[i].alias("value")) for c in names for i, s in enumerate(("min", "max", "nas"))]
    return df.agg(*out).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def top_values(df: DataFrame, name: str, maxsum: int) -> DataFrame:
    """The most frequent values (ties by value) with their counts, the rest as "(Other)", missing values as "NA's"."""
    counts = df.where(F.col(name).isNotNull()).groupBy(F.col(name).cast("string").alias("statistic")).agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.desc("n"), "statistic").limit(maxsum)
    total = df.agg(F.count(name).alias("all"), F.count_if(F.col(name).isNull()).alias("nas"))
    shown = top.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("shown"))
    rest = total.join(F.broadcast(shown)).select(F.explode(F.array(F.struct(F.lit("(Other)").alias("statistic"), (F.col("all") - F.col("shown")).alias("n")), F.struct(F.lit("NA's").alias("statistic"), F.col("nas").alias("n")))).alias("r"))
    both = top.unionByName(rest.select("r.*").where("n > 0"))
    return both.select(F.lit(name).alias("column"), "statistic", F.col("n").cast("string").alias("value"))


def summarize_frame(df: DataFrame, maxsum: int = 6, approximate: bool = False) -> DataFrame:
    numbers = [f.name for f in df.schema if isinstance(f.dataType, NumericType)]
    dates = [f.name for f in df.schema if isinstance(f.dataType, (DateType, TimestampType, TimestampNTZType))]
    rest = [f.name for f in df.schema if f.name not in (*numbers, *dates) and f.dataType.typeName() in ("string", "boolean")]
    parts = ([numeric_summary(df, numbers, approximate)] if numbers else []) + ([date_summary(df, dates)] if dates else []) + [top_values(df, c, maxsum) for c in rest]
    if not parts:
        raise ValueError("no column to summarize")
    return reduce(DataFrame.unionByName, parts)
