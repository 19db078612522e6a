"""JSON text from columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEEP_NULLS = {"ignoreNullFields": "false"}


def quoted(value: Column) -> Column:
    """A JSON string. to_json of a one-element array does the escaping."""
    text = F.to_json(F.array(value))
    return F.substring(text, F.lit(2), F.length(text) - 2)


def rendered(value: Column, kind: str) -> Column:
    """JSON of a column by its Spark type name, nulls inside kept, a null itself as null."""
    if kind == "string":
        return quoted(value)
    if kind.startswith(("struct", "array", "map")):
        return F.to_json(value, KEEP_NULLS)
    return value.cast("string")


def shallow_object(fields: dict[str, tuple[Column, str]]) -> Column:
    """An object of the fields that aren't null; nulls deeper down stay, unlike with to_json's own rule."""
    parts = [F.when(c.isNotNull(), F.concat(F.lit(f'"{name}":'), rendered(c, kind))) for name, (c, kind) in fields.items()]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def whole_object(fields: dict[str, Column]) -> Column:
    """An object of fields that are JSON text already."""
    parts = [F.concat(F.lit(f'"{name}":'), c) for name, c in fields.items()]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def fixed(value: Column, kind: str = "decimal(10,6)") -> Column:
    """A number as a string of fixed decimals."""
    return value.cast(kind).cast("string")
