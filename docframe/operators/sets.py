"""Set operations on columns: distinct values, missing ones left out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docframe.operators.frame import DocFrame, _frame_of


def values(frame: DocFrame | DataFrame, column: str) -> DataFrame:
    return _frame_of(frame).select(F.col(column).alias("value")).where("value is not null")


def intersect(x, x_column: str, y, y_column: str) -> DataFrame:
    return values(x, x_column).intersect(values(y, y_column))


def setdiff(x, x_column: str, y, y_column: str) -> DataFrame:
    return values(x, x_column).join(values(y, y_column), "value", "left_anti").distinct()


def union(x, x_column: str, y, y_column: str) -> DataFrame:
    return values(x, x_column).union(values(y, y_column)).distinct()
