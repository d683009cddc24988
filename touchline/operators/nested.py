"""Flattening, column maps and defaults."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, StructField, StructType


def _is_record(kind: DataType) -> bool:
    return isinstance(kind, StructType)


def _is_record_list(kind: DataType) -> bool:
    return isinstance(kind, ArrayType) and isinstance(kind.elementType, StructType)


def _refuse_collisions(names: Iterable[str]) -> None:
    seen: set[str] = set()
    for name in names:
        if name.lower() in seen:
            raise ValueError(f"flatten would produce the column '{name}' twice")
        seen.add(name.lower())


def unroll(df: DataFrame, column: str, separator: str = "_") -> DataFrame:
    """One row per array element, its fields appended as ``{column}{sep}{field}``.

    A null or empty array keeps its row with null fields.
    """
    fields = df.schema[column].dataType.elementType.names
    names = [f"{column}{separator}{field}" for field in fields]
    kept = [c for c in df.columns if c != column]
    _refuse_collisions([*kept, *names])
    return df.select(*[_quoted(c) for c in kept], F.inline_outer(_quoted(column)).alias(*names))


def open_records(df: DataFrame, separator: str = "_") -> DataFrame:
    """Replace every struct column, in place, by its fields (one level)."""
    pairs: list[tuple[str, Column]] = []
    for field in df.schema:
        pairs += _opened(field, separator) if _is_record(field.dataType) else [
            (field.name, _quoted(field.name))
        ]
    _refuse_collisions(name for name, _ in pairs)
    return df.select(*[value.alias(name) for name, value in pairs])


def _opened(field: StructField, separator: str) -> list[tuple[str, Column]]:
    parent = _quoted(field.name)
    return [
        (f"{field.name}{separator}{inner}", parent.getField(inner))
        for inner in field.dataType.names
    ]


def _quoted(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")


def flatten(df: DataFrame, separator: str = "_") -> DataFrame:
    """C4: open structs and arrays of structs until only plain columns are left.

    Each pass unrolls the arrays of structs present at its start, in column order, then
    opens all structs by one level, to the end of the schema.  Several arrays in one row
    multiply.  Arrays of plain values stay.  Only the schema is walked; the result is a
    chain of projections and generators.
    """
    while True:
        lists = [f.name for f in df.schema if _is_record_list(f.dataType)]
        if not lists and not any(_is_record(f.dataType) for f in df.schema):
            return df
        for column in lists:
            df = unroll(df, column, separator)
        df = open_records(df, separator)


def parse_envelope(
    df: DataFrame, schema: StructType | str, column: str = "json_data"
) -> DataFrame:
    """A5: replace a JSON text column, in place, by the top-level fields of its schema."""
    parsed = F.from_json(_quoted(column), schema).alias(column)
    opened = df.select(*[parsed if c == column else _quoted(c) for c in df.columns])
    return opened.select(
        *[F.col(f"`{c}`.*") if c == column else _quoted(c) for c in opened.columns]
    )


def map_columns(df: DataFrame, mapping: Sequence[tuple[str, str, str | None]]) -> DataFrame:
    """Project (source, target, type) triples; type None keeps the type."""
    return df.select(
        *[
            (_quoted(source) if kind is None else _quoted(source).cast(kind)).alias(target)
            for source, target, kind in mapping
        ]
    )


def column_or(df: DataFrame, name: str, default: object, kind: str) -> Column:
    """The column when the frame has it, else a typed literal."""
    source = _quoted(name) if name in df.columns else F.lit(default)
    return source.cast(kind).alias(name)


def with_literals(df: DataFrame, **values: tuple[object, str]) -> DataFrame:
    """Add typed literal columns; a value of None gives a typed null."""
    return df.withColumns({n: F.lit(v).cast(kind) for n, (v, kind) in values.items()})


def complete_rows(df: DataFrame, *paths: str) -> DataFrame:
    """Keep rows in which none of the (possibly nested) columns is null."""
    for path in paths:
        df = df.filter(F.col(path).isNotNull())
    return df
