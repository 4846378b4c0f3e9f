"""Grouping terms: plain fields, logical expressions and cuts, given as objects or as a formula string."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from docframe.functions import exprs


@dataclass(frozen=True, eq=False)
class Term:
    """``levels`` is the fixed domain of a logical or cut term, None for a field; ``explode`` splits a multi-valued field.

    A calendar term has its ``unit`` and, if its bins do not follow the data, the ``ends`` of its domain.
    """

    name: str
    column: Column = field(repr=False)
    levels: tuple | None = None
    explode: bool = False
    unit: str | None = None
    ends: tuple | None = None


def Field(name: str, multi: bool = False) -> Term:  # noqa: N802
    return Term(name, F.col(name), None, multi)


def I(condition: Column | str, name: str | None = None) -> Term:  # noqa: E743, N802
    """Two buckets, FALSE and TRUE; rows where the condition is missing are in neither."""
    expr = F.expr(condition) if isinstance(condition, str) else condition
    return Term(name or (re.sub(r"\W+", "_", condition).strip("_") if isinstance(condition, str) else "condition"), expr.cast("boolean"), (False, True))


def Cut(x: str | Column, breaks: Sequence[float], include_lowest: bool = False, right: bool = True, name: str | None = None) -> Term:  # noqa: N802
    """Interval labels; empty intervals stay in cross-tabulations."""
    return Term(name or (f"{x}_cut" if isinstance(x, str) else "cut"), exprs.cut_label(x, breaks, include_lowest, right), tuple(exprs.cut_labels(breaks, include_lowest, right)))


def DateCut(x: str | Column, unit: str, name: str | None = None, low: object = None, high: object = None) -> Term:  # noqa: N802
    """Calendar bins. Cross-tabulations keep empty ones from the first to the last date, or from ``low`` to ``high``; dates outside are missing."""
    column = exprs.cut_date(x, unit)
    for end, outside in ((low, lambda a, b: a < b), (high, lambda a, b: a > b)):
        if end is not None:
            column = F.when(~outside(column, F.date_trunc(unit, F.lit(end).cast("timestamp"))), column)
    return Term(name or f"{x}_{unit}", column, unit=unit.lower(), ends=(low, high))


def _split(text: str) -> list[str]:
    """At plus signs outside parentheses."""
    out, depth = [""], 0
    for c in text:
        depth += (c == "(") - (c == ")")
        if c == "+" and depth == 0:
            out.append("")
        else:
            out[-1] += c
    return [x.strip() for x in out if x.strip()]


def parse(formula: str | Term | Sequence[str | Term] | None) -> tuple[list[str], list[Term]]:
    """(left-hand names, terms). ``"y ~ a + I(b > 3) + cut(c, 0, 5, 10)"``; conditions are SQL expressions."""
    if formula is None:
        return [], []
    if isinstance(formula, Term):
        return [], [formula]
    if not isinstance(formula, str):
        return [], [t for f in formula for t in parse(f)[1]]
    left, tilde, right = formula.partition("~")
    if not tilde:
        left, right = "", formula
    terms = []
    for part in _split(right):
        if m := re.fullmatch(r"I\((.*)\)", part, re.S):
            terms.append(I(m[1]))
        elif m := re.fullmatch(r"cut\((\w+)\s*,(.*)\)", part, re.S):
            args = [a.strip() for a in m[2].split(",")]
            flags = {k.strip(): v.strip().upper() == "TRUE" for k, _, v in (a.partition("=") for a in args if "=" in a)}
            terms.append(Cut(m[1], [float(a) for a in args if "=" not in a], **flags))
        elif part not in ("1", "."):
            terms.append(Field(part))
    return _split(left), terms
