"""Scalar expressions with the exact semantics of the original pipelines.

* ``ieee_divide``: IEEE-754 division (x/0 = +-Inf, 0/0 = NaN) that also holds
  with ANSI mode on, where a bare ``/`` would raise DIVIDE_BY_ZERO.
* ``strict_double``: string -> double that rejects everything a strict
  number parser rejects ('1.0d', ' 2 ', '1e400', ...). Hex floats with a
  binary exponent ('0x1.8p3') are numbers.
* ``trim_spaces``: strips ASCII spaces only (tabs stay).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from tidemark.config import USER_KEY_TEMPLATE

# Fixed value: the accepted spelling of a floating point number, decimal or
# hexadecimal, including signed infinities and NaN, anchored at the very end of text.
NUMBER_PATTERN = (
    r"^(?:[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
    r"|[+-]?0[xX](?:[0-9a-fA-F]+\.?[0-9a-fA-F]*|\.[0-9a-fA-F]+)[pP][+-]?[0-9]+"
    r"|[+-]?(?i:inf|infinity)|(?i:nan))\z"
)


def _pos_inf() -> Column:
    return F.lit(float("inf"))


def _neg_inf() -> Column:
    return F.lit(float("-inf"))


def _nan() -> Column:
    return F.lit(float("nan"))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ieee_divide(num, den) -> Column:
    """``num / den`` with IEEE results for a zero divisor (signed zeros
    included), ANSI-safe; NULL when either side is."""
    n, d = _col(num).cast("double"), _col(den).cast("double")
    # Spark orders NaN above every number and holds -0.0 equal to 0.0
    same_sign = (n > 0) == (d.cast("string") == "0.0")
    return (
        F.when(n.isNull() | d.isNull(), F.lit(None).cast("double"))
        .when((d == 0) & (F.isnan(n) | (n == 0)), _nan())
        .when(d == 0, F.when(same_sign, _pos_inf()).otherwise(_neg_inf()))
        .otherwise(n / F.when(d != 0, d))
    )


def is_strict_double(text) -> Column:
    """True when ``text`` is a complete number a strict parser accepts.

    Overflowing literals such as '1e400' are rejected; spelled-out infinities
    ('inf', '-Infinity') are accepted.
    """
    t = _col(text)
    overflow = F.coalesce(F.abs(t.try_cast("double")) == _pos_inf(), F.lit(False))
    return t.rlike(NUMBER_PATTERN) & (t.rlike("(?i)inf") | ~overflow)


def strict_double(text) -> Column:
    """The double value of ``text`` or NULL when ``is_strict_double`` fails."""
    t = _col(text)
    return F.when(is_strict_double(t), t.try_cast("double"))


def trim_spaces(text) -> Column:
    """Strip leading and trailing ASCII spaces (not tabs or newlines)."""
    return F.trim(_col(text), F.lit(" "))


def one_hot(kind, value) -> Column:
    """1 when ``kind == value`` else 0, as bigint."""
    return (_col(kind) == F.lit(value)).cast("bigint")


def epoch_seconds(df, column: str) -> Column:
    """Whole seconds since the epoch of a timestamp column, floor semantics.

    ``timestamp_ntz`` is read as wall-clock UTC; the result does not depend on
    the session time zone.
    """
    dtype = df.schema[column].dataType
    if isinstance(dtype, (TimestampNTZType, TimestampType)):
        return F.unix_timestamp(F.col(column))
    return F.col(column).cast("bigint")


def profile_key(user, template: str = USER_KEY_TEMPLATE) -> Column:
    """Keyed-store key of a user profile."""
    return F.format_string(template, _col(user))


def as_instant(df, column: str) -> Column:
    """A ``timestamp`` (instant) column for event-time use (watermarks need it).

    ``timestamp_ntz`` is read as UTC wall-clock time without consulting the
    session time zone: epoch micros = whole seconds + the second's fraction.
    """
    dtype = df.schema[column].dataType
    c = F.col(column)
    if isinstance(dtype, TimestampNTZType):
        frac = (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("bigint") % 1_000_000
        return F.timestamp_micros(F.unix_timestamp(c) * 1_000_000 + frac)
    return c
