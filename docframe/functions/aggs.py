"""Aggregates that respect missing values: unless ``na_rm`` is set, one missing input makes the result missing.

Each returns a ``Stat``: a Column with a default name. Arithmetic on stats gives ordinary Columns, so everything after
aggregation stays one Spark expression.
"""

from __future__ import annotations

import operator
import zlib
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from docframe.functions.exprs import Value, col


class Stat:
    """An aggregate, its default name and, for two-step ones, what the frame has to prepare."""

    def __init__(self, column: Column, name: str, centre: tuple[str, Column, bool] | None = None):
        self.column, self.name, self.centre = column, name, centre


def column_of(x) -> Column:
    return x.column if isinstance(x, Stat) else x if isinstance(x, Column) else F.lit(x)


def _delegate(op, swap=False):
    return lambda self, other=None: op(column_of(other), self.column) if swap else op(self.column, column_of(other))


for _name in ("add", "sub", "mul", "truediv", "lt", "le", "gt", "ge", "eq", "ne", "and_", "or_"):
    _op = getattr(operator, _name)
    setattr(Stat, f"__{_name.rstrip('_')}__", _delegate(_op))
    if _name in ("add", "sub", "mul", "truediv"):
        setattr(Stat, f"__r{_name}__", _delegate(_op, True))
Stat.__hash__ = object.__hash__
Stat.__neg__ = lambda self: -self.column
Stat.__invert__ = lambda self: ~self.column


def _label(x: Value) -> str:
    return x if isinstance(x, str) else "value"


def _na(agg: Column, x: Column, na_rm: bool) -> Column:
    return agg if na_rm else F.when(F.count_if(x.isNull()) == 0, agg)


def _simple(fn: str, build):
    def of(x: Value, na_rm: bool = False) -> Stat:
        return Stat(_na(build(col(x)), col(x), na_rm), f"{_label(x)}_{fn}")

    of.__name__ = fn
    return of


sum_ = _simple("sum", F.sum)
min_ = _simple("min", F.min)
max_ = _simple("max", F.max)
mean = _simple("mean", F.avg)
var = _simple("var", F.var_samp)
sd = _simple("sd", F.stddev_samp)
prod = _simple("prod", F.product)


def range_(x: Value, na_rm: bool = False) -> Stat:
    """struct(min, max)."""
    x_ = col(x)
    return Stat(F.struct(_na(F.min(x_), x_, na_rm).alias("min"), _na(F.max(x_), x_, na_rm).alias("max")), f"{_label(x)}_range")


def any_(x: Value, na_rm: bool = False) -> Stat:
    """True if any value is; else missing if one is missing; else false."""
    x_ = col(x)
    rest = F.lit(False) if na_rm else F.when(F.count_if(x_.isNull()) == 0, F.lit(False))
    return Stat(F.when(F.bool_or(x_), F.lit(True)).otherwise(rest), f"{_label(x)}_any")


def all_(x: Value, na_rm: bool = False) -> Stat:
    """False if any value is; else missing if one is missing; else true."""
    x_ = col(x)
    rest = F.lit(True) if na_rm else F.when(F.count_if(x_.isNull()) == 0, F.lit(True))
    return Stat(F.when(~F.bool_and(x_), F.lit(False)).otherwise(rest), f"{_label(x)}_all")


def nunique(x: Value, na_rm: bool = False, approximate: bool = False) -> Stat:
    """Number of distinct values; without ``na_rm`` missing counts as one more."""
    x_ = col(x)
    n = F.approx_count_distinct(x_) if approximate else F.count_distinct(x_)
    if not na_rm:
        n = n + F.coalesce(F.max(x_.isNull().cast("int")), F.lit(0))
    return Stat(n.cast("int"), f"{_label(x)}_nunique")


#: Rank error of approximate quantiles is one part in this number.
ACCURACY = 10_000


def percentiles(x: Column, probs: float | Sequence[float], approximate: bool = False) -> Column:
    """Exact ones interpolate (type 7) and hold the distinct values of a group in memory; approximate ones are a sketch of
    bounded size, for groups of any size."""
    return F.percentile_approx(x, probs if isinstance(probs, float) else list(probs), ACCURACY).cast("double" if isinstance(probs, float) else "array<double>") if approximate else F.percentile(x, probs)


def quantile(x: Value, probs: Sequence[float] = (0.0, 0.25, 0.5, 0.75, 1.0), na_rm: bool = False, approximate: bool = False) -> Stat:
    """Array of quantiles."""
    return Stat(_na(percentiles(col(x), [float(p) for p in probs], approximate), col(x), na_rm), f"{_label(x)}_quantile")


def median(x: Value, na_rm: bool = False, approximate: bool = False) -> Stat:
    return Stat(_na(percentiles(col(x), 0.5, approximate), col(x), na_rm), f"{_label(x)}_median")


def iqr(x: Value, na_rm: bool = False, approximate: bool = False) -> Stat:
    q = percentiles(col(x), [0.25, 0.75], approximate)
    return Stat(_na(q[1] - q[0], col(x), na_rm), f"{_label(x)}_iqr")


def mad(x: Value, na_rm: bool = False, constant: float = 1.4826, approximate: bool = False) -> Stat:
    """constant * median(|x - median(x)|). The frame computes the group's median first and joins it."""
    x_ = col(x)
    centre = f"__centre_{zlib.crc32(f'{x_} {approximate}'.encode())}"
    away = F.abs(x_ - F.col(centre))
    return Stat(_na(constant * percentiles(away, 0.5, approximate), x_, na_rm), f"{_label(x)}_mad", (centre, x_, approximate))


def weighted_mean(x: Value, w: Value, na_rm: bool = False) -> Stat:
    """sum(x w) / sum(w). ``na_rm`` drops rows with a missing x; a missing weight of another row still gives missing."""
    x_, w_ = col(x), col(w)
    used = x_.isNotNull()
    bad = F.count_if(used & w_.isNull()) if na_rm else F.count_if(x_.isNull() | w_.isNull())
    total = F.sum(F.when(used, w_))
    return Stat(F.when((bad == 0) & (total != 0), F.sum(x_ * w_) / total), f"{_label(x)}_weighted_mean")


def any_na(x: Value) -> Stat:
    return Stat(F.coalesce(F.bool_or(col(x).isNull()), F.lit(False)), f"{_label(x)}_any_na")


def n_na(x: Value) -> Stat:
    return Stat(F.count_if(col(x).isNull()), f"{_label(x)}_nas")


def ndoc() -> Stat:
    """Rows of the group."""
    return Stat(F.count(F.lit(1)), "count")


BY_NAME = {"sum": sum_, "min": min_, "max": max_, "mean": mean, "var": var, "sd": sd, "median": median, "prod": prod, "range": range_, "any": any_, "all": all_, "nunique": nunique, "quantile": quantile, "iqr": iqr, "mad": mad, "any_na": any_na}
