"""Column helpers with R-style missing values: a missing input gives a missing result unless a docstring says otherwise."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Value = Column | str | float | int | bool


def col(x: Value) -> Column:
    """Strings name columns; other values that are no Columns become literals."""
    if isinstance(x, Column):
        return x
    return F.col(x) if isinstance(x, str) else F.lit(x)


def _any_null(*xs: Column) -> Column:
    return reduce(lambda a, b: a | b, [x.isNull() for x in xs])


# Predicates


def is_na(x: Value) -> Column:
    """Never missing itself."""
    return col(x).isNull()


def complete_cases(*xs: Value) -> Column:
    """True where none of the columns is missing."""
    return reduce(lambda a, b: a & b, [col(x).isNotNull() for x in xs])


def exists(x: Value) -> Column:
    return col(x).isNotNull()


def in_(x: Value, values: Sequence) -> Column:
    """Two-valued membership: a missing ``x`` is in nothing."""
    return F.coalesce(col(x).isin(list(values)), F.lit(False))


def truth(x: Value) -> Column:
    """A number as a predicate: true where it is not 0."""
    return col(x) != 0


def grepl(pattern: str, x: Value, fixed: bool = False, search: bool = False) -> Column:
    """Java regular expression over the whole value; ``search`` looks for it anywhere; ``fixed`` compares literally."""
    if fixed:
        return F.contains(col(x), F.lit(pattern)) if search else col(x) == pattern
    return col(x).rlike(pattern if search else f"^(?:{pattern})$")


def contains_term(xs: Value, value) -> Column:
    """A multi-valued column holds ``value``; missing columns hold nothing."""
    return F.coalesce(F.array_contains(col(xs), value), F.lit(False))


# Arithmetic


def div(a: Value, b: Value) -> Column:
    """Division of doubles: x/0 is an infinity of x's sign, 0/0 is NaN."""
    a, b = col(a).cast("double"), col(b).cast("double")
    by_zero = F.when((a == 0) | F.isnan(a), F.lit(float("nan"))).when(a > 0, F.lit(float("inf"))).otherwise(F.lit(float("-inf")))
    return F.when(_any_null(a, b), None).when(b == 0, by_zero).otherwise(F.try_divide(a, b))


def floordiv(a: Value, b: Value) -> Column:
    """floor(a / b); by zero as ``div``."""
    q = div(a, b)
    finite = ~F.isnan(q) & (F.abs(q) != float("inf"))
    return F.when(finite, F.floor(F.when(finite, q)).cast("double")).otherwise(q)


def mod(a: Value, b: Value) -> Column:
    """Remainder with the sign of ``b``; NaN for b = 0."""
    a, b = col(a).cast("double"), col(b).cast("double")
    return F.when(b == 0, F.when(a.isNotNull(), F.lit(float("nan")))).otherwise(a - b * floordiv(a, b))


def power(a: Value, b: Value) -> Column:
    return F.pow(col(a), col(b))


def sign(x: Value) -> Column:
    """-1, 0 or 1."""
    return F.signum(col(x).cast("double"))


def trunc(x: Value) -> Column:
    """Towards zero."""
    x = col(x).cast("double")
    return F.signum(x) * F.floor(F.abs(x))


def round_half_even(x: Value, digits: int = 0) -> Column:
    scale = float(10**digits)
    return F.rint(col(x) * scale) / scale


def signif(x: Value, digits: int = 6) -> Column:
    """``digits`` significant digits; 0 stays 0."""
    x = col(x).cast("double")
    scale = F.pow(F.lit(10.0), F.lit(digits - 1) - F.floor(F.log10(F.when(x != 0, F.abs(x)))))
    return F.when(x == 0, F.lit(0.0)).otherwise(F.rint(x * scale) / scale)


DIRECT = {
    "abs": F.abs, "sqrt": F.sqrt, "ceiling": F.ceil, "floor": F.floor, "log": F.log, "log10": F.log10, "log2": F.log2, "exp": F.exp, "sin": F.sin, "cos": F.cos, "tan": F.tan,
    "sinh": F.sinh, "cosh": F.cosh, "tanh": F.tanh, "asin": F.asin, "acos": F.acos, "atan": F.atan, "asinh": F.asinh, "acosh": F.acosh, "atanh": F.atanh, "log1p": F.log1p, "expm1": F.expm1,
    "sign": sign, "trunc": trunc,
    "sinpi": lambda x: F.sin(F.lit(math.pi) * x), "cospi": lambda x: F.cos(F.lit(math.pi) * x), "tanpi": lambda x: F.tan(F.lit(math.pi) * x),
}


def math_(name: str, x: Value) -> Column:
    """A mathematical function by its usual name."""
    if name in GAMMA:
        return _gamma(name, col(x))
    return DIRECT[name](col(x))


#: Coefficients of the Lanczos approximation (g = 7, nine terms).
LANCZOS = (0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059, 12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7)
SHIFT = 10


def _lanczos(x: Column) -> tuple[Column, Column]:
    """(series, t) with gamma(x) = sqrt(2 pi) t^(x - 1/2) e^-t series for positive x."""
    terms = [F.lit(c) / (x + F.lit(float(i - 1))) for i, c in enumerate(LANCZOS[1:], 1)]
    return reduce(lambda a, b: a + b, terms, F.lit(LANCZOS[0])), x + F.lit(6.5)


def _lgamma_positive(x: Column) -> Column:
    series, t = _lanczos(x)
    return F.lit(0.5 * math.log(2 * math.pi)) + (x - 0.5) * F.log(t) - t + F.log(series)


def _gamma_positive(x: Column) -> Column:
    series, t = _lanczos(x)
    half = F.pow(t, (x - 0.5) / 2)  # in two factors, which overflow later
    return F.lit(math.sqrt(2 * math.pi)) * half * F.exp(-t) * half * series


def _whole(x: Column) -> Column:
    """Zero and negative whole numbers, where these functions have their poles."""
    return (x <= 0) & (x == F.floor(x))


def _digamma_positive(x: Column) -> Column:
    """Recurrence to x + SHIFT, then the asymptotic series."""
    z = x + F.lit(float(SHIFT))
    y = 1 / (z * z)
    steps = reduce(lambda a, b: a + b, [1 / (x + F.lit(float(k))) for k in range(SHIFT)])
    return F.log(z) - 0.5 / z - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y * (1 / 240 - y / 132)))) - steps


def _trigamma_positive(x: Column) -> Column:
    z = x + F.lit(float(SHIFT))
    y = 1 / (z * z)
    steps = reduce(lambda a, b: a + b, [1 / ((x + F.lit(float(k))) * (x + F.lit(float(k)))) for k in range(SHIFT)])
    return 1 / z + y / 2 + y / z * (1 / 6 - y * (1 / 30 - y * (1 / 42 - y / 30))) + steps


def _gamma(name: str, x: Column) -> Column:
    """The gamma family in native expressions: reflection below one half, NaN (trigamma: infinity) at the poles."""
    x = x.cast("double")
    x = F.when(~F.isnan(x), x)
    if name == "factorial":
        return _gamma("gamma", x + 1)
    # gamma(x) gamma(1 - x) = pi / sin(pi x): below one half the function of 1 - x stands in, written once to keep the code small
    pi, low, up = F.lit(math.pi), x < 0.5, F.greatest(x, 1 - x)
    choose = lambda yes, no: F.when(low, yes).otherwise(F.lit(no))
    sign_ = choose(F.lit(-1.0), 1.0)
    if name == "gamma":
        value = choose(pi / F.sin(pi * x), 1.0) * F.pow(_gamma_positive(up), sign_)
        return F.when(_whole(x), F.lit(math.nan)).when((x == F.floor(x)) & (x <= 18), F.factorial((x - 1).cast("int")).cast("double")).otherwise(value)
    if name == "lgamma":
        return F.when(_whole(x), F.lit(math.nan)).otherwise(choose(F.log(pi / F.abs(F.sin(pi * x))), 0.0) + sign_ * _lgamma_positive(up))
    if name == "digamma":
        return F.when(_whole(x), F.lit(math.nan)).otherwise(_digamma_positive(up) - choose(pi / F.tan(pi * x), 0.0))
    edge = choose(F.pow(pi / F.sin(pi * x), 2.0), 0.0)
    return F.when(_whole(x), F.lit(math.inf)).otherwise(edge + sign_ * _trigamma_positive(up))


GAMMA = ("gamma", "lgamma", "factorial", "digamma", "trigamma")


# Choice


def ifelse(test: Value, yes: Value, no: Value) -> Column:
    """A missing test gives a missing result."""
    t = col(test)
    return F.when(t.isNull(), None).when(t, col(yes)).otherwise(col(no))


def replace_where(x: Value, where: Value, value: Value) -> Column:
    """``x`` with ``value`` where the predicate holds; a missing predicate leaves ``x``."""
    return F.when(col(where), col(value)).otherwise(col(x))


def map_range(x: Value, low: Value, high: Value, target: Value, otherwise: Value) -> Column:
    x = col(x)
    return F.when(x.isNull(), None).when(x.between(col(low), col(high)), col(target)).otherwise(col(otherwise))


def _parallel(pick, xs: Sequence[Value], na_rm: bool) -> Column:
    cols = [col(x) for x in xs]
    if len(cols) == 1:
        return cols[0]
    return pick(*cols) if na_rm else F.when(~_any_null(*cols), pick(*cols))


def pmin(*xs: Value, na_rm: bool = False) -> Column:
    """Least value of each row; with ``na_rm`` missing ones are skipped."""
    return _parallel(F.least, xs, na_rm)


def pmax(*xs: Value, na_rm: bool = False) -> Column:
    return _parallel(F.greatest, xs, na_rm)


# Bins


def cut(x: Value, breaks: Sequence[float], include_lowest: bool = False, right: bool = True) -> Column:
    """Number (from 1) of the interval that holds ``x``, missing outside. Intervals are closed on the right by default."""
    x, edges = col(x), list(breaks)
    if len(edges) < 2 or any(a >= b for a, b in zip(edges, edges[1:], strict=False)):
        raise ValueError("breaks must be two or more increasing values")
    passed = reduce(lambda a, b: a + b, [F.when((x > F.lit(e)) if right else (x >= F.lit(e)), 1).otherwise(0) for e in edges])
    code = F.when(x.isNotNull() & passed.between(1, len(edges) - 1), passed)
    if include_lowest:
        edge, number = (edges[0], 1) if right else (edges[-1], len(edges) - 1)
        code = F.when(x == F.lit(edge), F.lit(number)).otherwise(code)
    return code


def cut_labels(breaks: Sequence[float], include_lowest: bool = False, right: bool = True) -> list[str]:
    """Interval names in the usual notation, three significant digits."""
    edges = [f"{b:.3g}" if isinstance(b, (int, float)) else str(b) for b in breaks]
    out = [f"({a},{b}]" if right else f"[{a},{b})" for a, b in zip(edges, edges[1:], strict=False)]
    if include_lowest and right:
        out[0] = "[" + out[0][1:]
    elif include_lowest:
        out[-1] = out[-1][:-1] + "]"
    return out


def cut_label(x: Value, breaks: Sequence[float], include_lowest: bool = False, right: bool = True) -> Column:
    labels = F.array(*[F.lit(s) for s in cut_labels(breaks, include_lowest, right)])
    return F.get(labels, cut(x, breaks, include_lowest, right) - 1)


def cut_date(x: Value, unit: str) -> Column:
    """Calendar bin: the first moment of the year, quarter, month, week, day, hour or minute."""
    return F.date_trunc(unit, col(x))


# Coercions

as_logical = lambda x: col(x).cast("boolean")
as_integer = lambda x: col(x).cast("int")
as_numeric = lambda x: col(x).cast("double")
as_character = lambda x: col(x).cast("string")
as_date = lambda x: F.to_date(col(x))
as_timestamp = lambda x: F.to_timestamp(col(x))
as_factor = as_character


def lengths(x: Value) -> Column:
    """Number of values of a multi-valued column; 0 where it is missing."""
    return F.when(col(x).isNull(), 0).otherwise(F.size(col(x)))
