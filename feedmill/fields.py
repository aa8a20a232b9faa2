"""Field descriptors, layouts and the type vocabulary of a feed."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import types as T

from feedmill.functions.names import column_name

# Declared type name -> Spark type.
TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "str": T.StringType(),
    "int": T.IntegerType(),
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "decimal": T.DecimalType(18, 4),
    "number": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(),
    "bool": T.BooleanType(),
    "binary": T.BinaryType(),
    "bytes": T.BinaryType(),
}
NUMERIC = frozenset(
    {"int", "integer", "long", "bigint", "double", "float", "decimal", "number"}
)
INTEGRAL = frozenset({"int", "integer", "long", "bigint"})


@dataclass(frozen=True)
class Field:
    """One declared field; ``start`` is 1-based and 0 means "after the previous"."""

    name: str
    type: str = "string"
    length: int = 1
    start: int = 0
    nullable: bool = True
    format: str = ""
    precision: int = 0
    just_right: bool = False
    record_type: str = "DATA"
    expression: str = ""

    @classmethod
    def of(cls, spec: "Field | Mapping[str, Any]") -> "Field":
        """Build a field from a declaration; ``begin`` is accepted for ``start``."""
        if isinstance(spec, Field):
            return spec
        if not spec.get("name"):
            raise ValueError(f"field without a name: {dict(spec)}")
        return cls(
            name=spec["name"],
            type=str(spec.get("type") or "string").lower(),
            length=int(spec.get("length") or 0),
            start=int(spec.get("start") or spec.get("begin") or 0),
            nullable=bool(spec.get("nullable", True)),
            format=str(spec.get("format") or "").strip(),
            precision=int(spec.get("precision") or 0),
            just_right=bool(spec.get("just_right", False)),
            record_type=str(spec.get("record_type") or "DATA").upper(),
            expression=str(spec.get("expression") or "").strip(),
        )

    @property
    def column(self) -> str:
        return column_name(self.name)

    @property
    def numeric(self) -> bool:
        return self.type in NUMERIC

    @property
    def implied(self) -> bool:
        """True for decimals whose point is implied by ``precision``."""
        return self.type == "decimal" and self.precision > 0

    @property
    def end(self) -> int:
        return self.start + self.length - 1

    def spark_type(self) -> T.DataType:
        if self.type == "decimal" and self.precision > 0:
            return T.DecimalType(18, self.precision)
        return TYPES.get(self.type, T.StringType())


@dataclass(frozen=True)
class Layout:
    """Positional layout: every field with its resolved start."""

    fields: tuple[Field, ...]
    record_length: int = 0

    @classmethod
    def of(
        cls,
        specs: "Layout | Iterable[Field | Mapping[str, Any]]",
        record_length: int = 0,
    ) -> "Layout":
        if isinstance(specs, Layout):
            return specs
        placed: list[Field] = []
        cursor = 1
        for spec in specs:
            field = Field.of(spec)
            field = replace(
                field, start=field.start or cursor, length=field.length or 1
            )
            cursor = field.end + 1
            placed.append(field)
        return cls(tuple(placed), record_length)

    @property
    def width(self) -> int:
        """Declared record length, or the last position any field reaches."""
        return self.record_length or max((f.end for f in self.fields), default=0)

    @property
    def columns(self) -> list[str]:
        return [f.column for f in self.fields]

    def shifted(self, offset: int) -> "Layout":
        """The layout with ``offset`` taken off every start."""
        return replace(
            self,
            fields=tuple(replace(f, start=f.start - offset) for f in self.fields),
        )
