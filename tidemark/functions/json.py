"""JSON access helpers (nested objects, arrays, scalars), all built in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType


def json_path(text, path: str) -> Column:
    """The value at a JSON path ('$.a.b[0]') as a string; NULL when absent."""
    c = F.col(text) if isinstance(text, str) else text
    return F.get_json_object(c, path)


def json_field(text, schema) -> Column:
    """Parse JSON text into a typed struct (``from_json``, permissive)."""
    c = F.col(text) if isinstance(text, str) else text
    return F.from_json(c, schema)


def json_scalar_fields(text, keys: Sequence[str]) -> Column:
    """Parse a JSON object into a struct of string fields ``keys``.

    Scalars are read as their text (numbers keep their spelling), nested
    values as their JSON text. Text that is not exactly one JSON object (JSON
    ``null``, trailing text, two objects, single quotes, a bare ``NaN``) gives
    NULL. Duplicate keys resolve to the last occurrence.

    ``from_json`` ignores what follows the first value, so the text is parsed
    as the one element of an array. Only a text with a ``]`` of its own could
    close that array early; such a text must also parse as a member of an
    object, and none can leave both.
    """
    c = F.col(text) if isinstance(text, str) else text
    fields = StructType([StructField(k, StringType(), True) for k in keys])
    strict = {"mode": "PERMISSIVE", "allowSingleQuotes": "false",
              "allowNonNumericNumbers": "false"}
    listed = F.from_json(F.concat(F.lit("["), c, F.lit("]")), ArrayType(fields), strict)
    member = F.from_json(F.concat(F.lit('{"v":'), c, F.lit("}")),
                         StructType([StructField("v", StringType(), True)]), strict)
    whole = ~F.contains(c, F.lit("]")) | F.coalesce(member["v"].isNotNull(), F.lit(False))
    return F.when((F.size(listed) == 1) & whole, listed[0])


def json_variant(text) -> Column:
    """JSON text as a VARIANT, which keeps the types of its values; NULL for text that is no JSON."""
    return F.try_parse_json(F.col(text) if isinstance(text, str) else text)


def variant_kind(v: Column, path: str = "$") -> Column:
    """The type at a path (BIGINT, DECIMAL(p,s), DOUBLE, STRING, BOOLEAN, VOID for JSON null, ARRAY<...>,
    OBJECT<...>); NULL when nothing is there."""
    return F.schema_of_variant(F.try_variant_get(v, path, "variant"))


def variant_number(v: Column, path: str, as_type: str = "bigint") -> Column:
    """The number at a path; NULL when there is none or the value is a string that only looks like one."""
    return F.when(variant_kind(v, path).rlike("^(BIGINT|DECIMAL.*|DOUBLE|FLOAT)$"), F.try_variant_get(v, path, as_type))


def variant_text(v: Column, path: str) -> Column:
    """The string at a path; NULL when there is none or the value is not a string."""
    return F.when(variant_kind(v, path) == "STRING", F.try_variant_get(v, path, "string"))
