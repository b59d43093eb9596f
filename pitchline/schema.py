"""The match schema: an immutable list of columns with a type and a role."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

from .errors import SchemaMismatchError

TYPES = {"date": T.TimestampType(), "string": T.StringType(), "float": T.DoubleType(), "integer": T.LongType()}


@dataclass(frozen=True)
class Field:
    name: str
    kind: str = "integer"
    role: str = "numeric"
    required: bool = True


@dataclass(frozen=True)
class MatchSchema:
    fields: tuple[Field, ...]

    def _names(self, keep) -> list[str]:
        return [f.name for f in self.fields if keep(f)]

    @property
    def required(self) -> list[str]:
        return self._names(lambda f: f.required)

    @property
    def optional(self) -> list[str]:
        return self._names(lambda f: not f.required)

    @property
    def categorical(self) -> list[str]:
        return self._names(lambda f: f.role == "categorical")

    @property
    def numeric(self) -> list[str]:
        return self._names(lambda f: f.role == "numeric")

    def kind(self, name: str) -> str:
        return {f.name: f.kind for f in self.fields}[name]

    def kinds(self) -> dict[str, str]:
        return {f.name: f.kind for f in self.fields}

    def with_column(self, field: Field) -> "MatchSchema":
        return replace(self, fields=tuple(f for f in self.fields if f.name != field.name) + (field,))

    def without_column(self, name: str) -> "MatchSchema":
        return replace(self, fields=tuple(f for f in self.fields if f.name != name))

    def require(self, columns) -> None:
        missing = [c for c in self.required if c not in set(columns)]
        if missing:
            raise SchemaMismatchError(missing)

    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, TYPES[f.kind], not f.required) for f in self.fields])


#: The columns of a match record, in their order.
COUNTS = ("FTHG", "FTAG", "HS", "AS", "HST", "AST", "HC", "AC", "HY", "AY", "HR", "AR")
MATCHES = MatchSchema(
    (Field("Date", "date", "date"), Field("HomeTeam", "string", "categorical"), Field("AwayTeam", "string", "categorical"))
    + tuple(Field(c) for c in COUNTS[:2])
    + (Field("FTR", "string", "categorical"),)
    + tuple(Field(c) for c in COUNTS[2:])
)
SEQ = "match_seq"
