"""Typed metadata columns: schema from a dictionary, binding of names, and validation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = {"string": "string", "categorical": "string", "boolean": "int", "integer": "bigint", "float": "double", "date": "date"}


def schema(columns: Mapping[str, Mapping]) -> str:
    """The table schema of a dictionary ``{name: {"type": ..., "values": [...]}}``."""
    return ", ".join(f"`{name}` {KINDS[spec['type']]}" for name, spec in columns.items())


def typed(df: DataFrame, columns: Mapping[str, Mapping]) -> DataFrame:
    """Columns of the dictionary in its types, what can't be read as null; others as they are."""
    return df.select(*[F.expr(f"try_cast(`{c}` as {KINDS[columns[c]['type']]})").alias(c) if c in columns else F.col(c) for c in df.columns])


def violations(df: DataFrame, columns: Mapping[str, Mapping]) -> DataFrame:
    """(column, value, n) of values outside the dictionary: of another type, or not listed."""
    checks = []
    for name, spec in columns.items():
        if name in df.columns:
            value = F.col(name).cast("string")
            bad = value.isNotNull() & F.expr(f"try_cast(`{name}` as {KINDS[spec['type']]})").isNull()
            if spec.get("values"):
                bad = bad | (value.isNotNull() & ~value.isin([str(v) for v in spec["values"]]))
            checks.append(F.when(bad, F.struct(F.lit(name).alias("column"), value.alias("value"))))
    rows = df.select(F.explode(F.filter(F.array(*checks), lambda x: x.isNotNull())).alias("v"))
    return rows.select("v.*").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def bound(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Physical columns under their logical names."""
    return df.withColumnsRenamed({physical: logical for logical, physical in names.items() if physical in df.columns})
