"""Column-level helpers: all built-in Spark expressions, no Python UDFs."""

from tidemark.functions.scalars import (
    as_instant,
    epoch_seconds,
    ieee_divide,
    is_strict_double,
    one_hot,
    profile_key,
    strict_double,
    trim_spaces,
)
from tidemark.functions.json import (
    json_field,
    json_path,
    json_scalar_fields,
    json_variant,
    variant_kind,
    variant_number,
    variant_text,
)

__all__ = [
    "as_instant", "epoch_seconds", "ieee_divide", "is_strict_double", "one_hot", "profile_key",
    "strict_double", "trim_spaces", "json_field", "json_path", "json_scalar_fields", "json_variant",
    "variant_kind", "variant_number", "variant_text",
]
