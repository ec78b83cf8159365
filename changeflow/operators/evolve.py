"""Old and new versions of a table read as one, nested row images included."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Numeric types from narrow to wide.
INTEGERS = ("tinyint", "smallint", "int", "bigint")
FLOATS = ("float", "double")


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds all values of both: the wider number, or a struct with the fields of both.

    A double holds every integer up to 32 bits, but not every bigint: bigint with float or double is refused.
    """
    if a == b:
        return a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return unified_schema(a, b)
    names = [a.simpleString(), b.simpleString()]
    for kind in (INTEGERS, FLOATS):
        if all(n in kind for n in names):
            return max(a, b, key=lambda t: kind.index(t.simpleString()))
    if "bigint" in names or not all(n in INTEGERS + FLOATS for n in names):
        raise ValueError(f"no common type for {names[0]} and {names[1]}")
    return T.DoubleType()


def unified_schema(*schemas: T.StructType) -> T.StructType:
    """All columns of all versions in order of first appearance, numbers widened."""
    types: dict[str, T.DataType] = {}
    for schema in schemas:
        for f in schema:
            types[f.name] = wider(types[f.name], f.dataType) if f.name in types else f.dataType
    return T.StructType([T.StructField(n, t) for n, t in types.items()])


def conform(column: Column, have: T.DataType, want: T.DataType) -> Column:
    """A column in the shape of a unified type, NULL in the fields it lacks."""
    if not isinstance(want, T.StructType) or have == want:
        return column.cast(want)
    fields = [
        conform(column[f.name], have[f.name].dataType, f.dataType) if f.name in have.names else F.lit(None).cast(f.dataType)
        for f in want
    ]
    return F.when(column.isNotNull(), F.struct(*[c.alias(f.name) for c, f in zip(fields, want)]))


def conform_sql(expr: str, have: T.DataType, want: T.DataType) -> str:
    """:func:`conform` as SQL text, for views."""
    if have == want:
        return expr
    if not isinstance(want, T.StructType):
        return f"CAST({expr} AS {want.simpleString()})"
    fields = []
    for f in want:
        inner = conform_sql(f"{expr}.`{f.name}`", have[f.name].dataType, f.dataType) if f.name in have.names else None
        fields.append(f"'{f.name}', {inner or f'CAST(NULL AS {f.dataType.simpleString()})'}")
    return f"if({expr} IS NULL, NULL, named_struct({', '.join(fields)}))"


def union_sql(tables: dict[str, T.StructType]) -> str:
    """:func:`union_versions` of named tables as SQL text."""
    schema = unified_schema(*tables.values())
    parts = []
    for name, have in tables.items():
        columns = [
            conform_sql(f"`{f.name}`", have[f.name].dataType, f.dataType) if f.name in have.names
            else f"CAST(NULL AS {f.dataType.simpleString()})"
            for f in schema
        ]
        named = [f"{c} AS `{f.name}`" for c, f in zip(columns, schema, strict=True)]
        parts.append(f"SELECT {', '.join(named)} FROM {name}")
    return " UNION ALL ".join(parts)


def to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows under a unified schema."""
    return df.select(
        *[
            (conform(F.col(f.name), df.schema[f.name].dataType, f.dataType) if f.name in df.columns
             else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )


def union_versions(*versions: DataFrame) -> DataFrame:
    """Rows of all versions under the unified schema, NULL where a version lacks a column."""
    schema = unified_schema(*[v.schema for v in versions])
    return reduce(DataFrame.unionByName, [to_schema(v, schema) for v in versions])
