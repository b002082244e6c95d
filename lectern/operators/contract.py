"""What a step takes from a table: each column by the first of its names that is there, checked when the plan is composed."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Types that a value of the kind can be made of.
_FROM = {
    "string": (T.AtomicType,),
    "bigint": (T.NumericType, T.StringType),
    "double": (T.NumericType, T.StringType),
    "boolean": (T.BooleanType, T.StringType),
}


@dataclass(frozen=True)
class Field:
    """A column `name` of type `kind`, from the first of `sources` that the table has, by default one of its own name."""

    name: str
    kind: str
    sources: tuple[str, ...] = ()
    needed: bool = True

    def source(self, columns: Sequence[str]) -> str | None:
        return next((s for s in self.sources or (self.name,) if s in columns), None)


class ContractError(ValueError):
    """A table lacks columns that a step needs, or has them in types that can't be read."""


def check(df: DataFrame, fields: Sequence[Field]) -> None:
    """Raises ContractError that names every field without a column and every column of a wrong type."""
    wrong = []
    for f in fields:
        source = f.source(df.columns)
        if source is None:
            wrong += [f"{f.name} (none of {', '.join(f.sources or (f.name,))})"] if f.needed else []
        elif not isinstance(df.schema[source].dataType, (*_FROM[f.kind], T.NullType)):
            wrong.append(f"{f.name} ({source} is {df.schema[source].dataType.simpleString()}, not {f.kind})")
    if wrong:
        raise ContractError("the table doesn't fit: " + "; ".join(wrong))


def project(df: DataFrame, fields: Sequence[Field], lenient: bool = False) -> list[Column]:
    """The fields as columns of `df`, checked; those that may be missing and are, are null. lenient: what can't be read is null."""
    check(df, fields)

    def one(f: Field) -> Column:
        source = f.source(df.columns)
        value = F.lit(None) if source is None else F.col(f"`{source}`")
        return (value.try_cast(f.kind) if lenient else value.cast(f.kind)).alias(f.name)

    return [one(f) for f in fields]
