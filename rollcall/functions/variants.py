"""Helpers for values of unknown shape (JSON text and VARIANT)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.functions.text import let


def kind(v: Column) -> Column:
    """'OBJECT', 'ARRAY', 'VOID', or the scalar type name of a VARIANT; null stays null."""
    return F.regexp_extract(F.schema_of_variant(v), r"^[A-Z]+", 0)


def text_of(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def parse_whole(text: Column) -> Column:
    """VARIANT of a text that is one JSON value from end to end; null for any other.

    Spark's parser ignores what follows a value ("7 pm" is the number 7), but in brackets nothing
    may follow it, unless it closes them itself, which then fails in braces.
    """
    def only(v: Column) -> Column:
        alone = ~text.contains("]") | F.try_parse_json(
            F.concat(F.lit('{"v":'), text, F.lit("}"))).isNotNull()
        return F.when(v.isNotNull() & F.try_variant_get(v, "$[1]", "variant").isNull() & alone,
                      F.try_variant_get(v, "$[0]", "variant"))

    return let(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), only)


def canonical(json_text: Column) -> Column:
    """JSON text with sorted keys and one number spelling, so equal values compare equal.

    Text that is not JSON stands for itself.
    """
    return F.coalesce(F.to_json(parse_whole(json_text)), json_text)


def as_list(v: Column) -> Column:
    """A list stays, null becomes empty, anything else becomes a one-element list."""
    return (
        F.when(v.isNull() | F.is_variant_null(v), F.expr("array()").cast("array<variant>"))
        .when(kind(v) == "ARRAY", F.try_variant_get(v, "$", "array<variant>"))
        .otherwise(F.array(v))
    )


def strict_boolean(v: Column) -> Column:
    """The boolean in a VARIANT; null when it is anything but a boolean."""
    return F.when(kind(v) == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
