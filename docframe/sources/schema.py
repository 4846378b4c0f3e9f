"""Document schemas: declared fields, dynamic name patterns, derivation from data."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, replace
from fnmatch import fnmatchcase

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructField, StructType


@dataclass(frozen=True)
class FieldInfo:
    """A field, or with ``dynamic`` a pattern for the names of fields."""

    name: str
    type: str
    multi_valued: bool = False
    required: bool = False
    indexed: bool = True
    stored: bool = True
    doc_values: bool = True

    @property
    def dynamic(self) -> bool:
        return "*" in self.name

    @property
    def hidden(self) -> bool:
        return self.name.startswith("_") and self.name.endswith("_")

    def spark_type(self) -> str:
        return f"array<{self.type}>" if self.multi_valued else self.type


@dataclass(frozen=True)
class DocSchema:
    name: str
    fields: tuple[FieldInfo, ...]
    unique_key: str | None = None
    version: float = 1.0
    #: (source, destination) pairs whose values are copied on load.
    copy_fields: tuple[tuple[str, str], ...] = ()

    def __getitem__(self, name: str) -> FieldInfo:
        """The field itself, else the first dynamic pattern that fits, in schema order."""
        for f in self.fields:
            if f.name == name:
                return f
        for f in self.fields:
            if f.dynamic and fnmatchcase(name, f.name):
                return replace(f, name=name)
        raise KeyError(f"no field {name!r} in schema {self.name!r}")

    def __contains__(self, name: str) -> bool:
        return any(f.name == name or f.dynamic and fnmatchcase(name, f.name) for f in self.fields)

    def static_names(self) -> list[str]:
        return [f.name for f in self.fields if not f.dynamic]

    def field_types(self) -> list[str]:
        return sorted({f.type for f in self.fields})

    def struct(self, names: Sequence[str] | None = None) -> StructType:
        return StructType([StructField(f.name, DataType.fromDDL(f.spark_type()), not f.required) for f in (self[n] for n in names or self.static_names())])

    def conform(self, df: DataFrame, fill: bool = True) -> DataFrame:
        """Cast to declared types; unknown columns are errors; static fields that are absent are missing columns with ``fill``."""
        cols = [F.col(f"`{c}`").cast(self[c].spark_type()).alias(c) for c in df.columns]
        have = set(df.columns)
        cols += [F.col(f"`{a}`").cast(self[b].spark_type()).alias(b) for a, b in self.copy_fields if a in have and b not in have]
        have |= {b for a, b in self.copy_fields if a in have}
        if fill:
            cols += [F.lit(None).cast(f.spark_type()).alias(f.name) for f in self.fields if not f.dynamic and f.name not in have]
        return df.select(*cols)

    def to_json(self) -> str:
        return json.dumps({"name": self.name, "version": self.version, "unique_key": self.unique_key, "copy_fields": self.copy_fields, "fields": [vars(f) for f in self.fields]})

    @classmethod
    def from_json(cls, text: str) -> DocSchema:
        d = json.loads(text)
        return cls(d["name"], tuple(FieldInfo(**f) for f in d["fields"]), d["unique_key"], d["version"], tuple(map(tuple, d["copy_fields"])))

    @classmethod
    def derive(cls, df: DataFrame, name: str, unique_key: str | None = None, required: Sequence[str] | None = None, version_field: bool = False) -> DocSchema:
        """Types from the frame; required are columns without missing values or empty strings, counted in one pass."""
        if required is None:
            checks = [F.count_if(F.col(f"`{f.name}`").isNull() | ((F.col(f"`{f.name}`") == "") if f.dataType.typeName() == "string" else F.lit(False))).alias(f.name) for f in df.schema]
            row = df.agg(*checks).first().asDict()
            required = [c for c, n in row.items() if n == 0]
        fields = []
        for f in df.schema:
            multi = isinstance(f.dataType, ArrayType)
            kind = f.dataType.elementType if multi else f.dataType
            fields.append(FieldInfo(f.name, kind.simpleString(), multi, f.name in required or f.name == unique_key))
        if version_field:
            fields.append(FieldInfo("_version_", "bigint"))
        return cls(name, tuple(fields), unique_key)


def field_names(df: DataFrame, present_only: bool = False, include_hidden: bool = True) -> list[str]:
    """Column names; ``present_only`` leaves out columns without any value (one aggregation)."""
    names = [c for c in df.columns if include_hidden or not (c.startswith("_") and c.endswith("_"))]
    if present_only and names:
        row = df.agg(*[F.count(f"`{c}`").alias(c) for c in names]).first().asDict()
        names = [c for c in names if row[c]]
    return names


def split_meta(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Visible and hidden (``_x_``) columns."""
    hidden = [c for c in df.columns if c.startswith("_") and c.endswith("_")]
    return df.drop(*hidden), df.select(*hidden)
