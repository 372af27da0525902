"""Structs, maps and arrays of structs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nest(df: DataFrame, name: str, fields: Mapping[str, str | Sequence[str]]) -> DataFrame:
    """Gather columns into one struct; a list of names becomes a struct inside it."""
    parts = [F.col(spec).alias(field) if isinstance(spec, str) else F.struct(*spec).alias(field)
             for field, spec in fields.items()]
    return df.select(F.struct(*parts).alias(name))


def flatten(df: DataFrame, *paths: str) -> DataFrame:
    """Lift all fields of the structs at ``paths`` to the top level."""
    return df.select(*[f"{path}.*" for path in paths])


def at_path(column: str, *steps: str | int) -> Column:
    """Walk into structs by name and arrays by index; NULL where the way ends."""
    value = F.col(column)
    for step in steps:
        value = F.get(value, F.lit(step)) if isinstance(step, int) else value.getField(step)
    return value


def field_of_each(column: str, *fields: str) -> Column:
    """A field, or a field within it, of every array element."""
    value = F.col(column)
    for field in fields:
        value = value.getField(field)
    return value


def map_value(column: str, key: str) -> Column:
    """Map entry by key; NULL when absent."""
    return F.try_element_at(F.col(column), F.lit(key))
