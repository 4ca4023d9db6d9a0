"""Declared types and NOT NULL, enforced on write or shown as rejects.

A Parquet table takes any value, so a declared schema holds only if something checks it. Both forms are
projections: they add no pass over the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def _rule(field: T.StructField) -> str:
    return f"{field.name} {field.dataType.simpleString().upper()}" + ("" if field.nullable else " NOT NULL")


def _typed(df: DataFrame, field: T.StructField) -> Column:
    if field.name not in df.columns:
        return F.lit(None).cast(field.dataType)
    given = F.col(field.name)
    return given if df.schema[field.name].dataType == field.dataType else given.try_cast(field.dataType)


def _breaks(df: DataFrame, field: T.StructField) -> Column | None:
    """The value is missing where one is required, or does not fit its type."""
    typed = _typed(df, field)
    if not field.nullable:
        return typed.isNull()
    if field.name in df.columns and df.schema[field.name].dataType != field.dataType:
        return typed.isNull() & F.col(field.name).isNotNull()
    return None


def broken_rules(df: DataFrame, schema: T.StructType) -> Column:
    """The declared rules that a row breaks, as an array in column order; empty for a valid row."""
    found = [(_breaks(df, f), _rule(f)) for f in schema]
    flags = [F.when(c, F.lit(rule)) for c, rule in found if c is not None]
    return F.array_compact(F.array(*flags)) if flags else F.array().cast("array<string>")


def split(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns in their types, and BrokenRules: valid rows have none, the others are the
    reject side. One projection serves both; write it partitioned by `size(BrokenRules) = 0`, or filter."""
    columns = [_typed(df, f).alias(f.name) for f in schema]
    return df.select(*columns, broken_rules(df, schema).alias("BrokenRules"))


def enforced(df: DataFrame, schema: T.StructType, table: str) -> DataFrame:
    """The declared columns in their types; the first row that breaks a rule fails the job that writes it,
    as a table with NOT NULL columns would."""

    def checked(field: T.StructField) -> Column:
        broken, typed = _breaks(df, field), _typed(df, field)
        if broken is None:
            return typed.alias(field.name)
        message = F.raise_error(F.lit(f"{table}: {_rule(field)} is broken"))
        return F.when(broken, message.cast(field.dataType)).otherwise(typed).alias(field.name)

    return df.select(*[checked(f) for f in schema])
