"""Column parsers: null where a text doesn't parse, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INTEGER = r"^\s*[+-]?\d+\s*\z"
NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*\z"
MOMENT = r"^\d{4}-\d{1,2}-\d{1,2}\s+\d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,6})?\z"
#: Numbers that ``number`` holds: products of two of them fit a decimal too.
SHORT = r"^\s*[+-]?(\d{1,10}(\.\d{0,8})?|\.\d{1,8})\s*\z"


def integer(text: Column) -> Column:
    return F.when(text.rlike(INTEGER), F.trim(text).try_cast("bigint"))


def number(text: Column) -> Column:
    """A number of ten digits and eight fraction digits at most, else null; never rounded.

    ``numeric`` says whether it is a number at all, and ``scaled`` holds longer ones.
    """
    return F.when(text.rlike(SHORT), F.trim(text).try_cast("decimal(18,8)"))


def power(exponent: Column) -> Column:
    """10 to a whole exponent of 0 or more; null beyond 38 digits."""
    return F.when(exponent.between(0, 37), F.rpad(F.lit("1"), exponent + 1, F.lit("0")).try_cast("decimal(38,0)"))


def scaled(text: Column) -> Column:
    """The digits and the scale (0 or more) of a number that ``number`` doesn't hold, as a struct."""
    plain = F.regexp_replace(F.regexp_replace(text, r"\s", ""), "[eE].*", "")
    exponent = F.coalesce(F.regexp_extract(text, r"[eE]([+-]?\d+)", 1).try_cast("int"), F.lit(0))
    more = exponent - F.length(F.regexp_extract(plain, r"\.(\d*)", 1))
    digits = F.try_multiply(F.replace(plain, F.lit("."), F.lit("")).try_cast("decimal(38,0)"), power(F.greatest(more, F.lit(0))))
    return F.when(numeric(text), F.struct(digits.alias("digits"), F.greatest(-more, F.lit(0)).alias("scale")))


def numeric(text: Column) -> Column:
    return text.rlike(NUMBER)


def moment(text: Column) -> Column:
    """Date and time, one or more blanks between, up to six fraction digits, no zone."""
    tidy = F.regexp_replace(text, r"\s+", " ")
    return F.when(text.rlike(MOMENT), tidy.try_cast("timestamp_ntz"))


def is_uuid(text: Column) -> Column:
    """32 hex digits, hyphens anywhere, braces and the ``urn:uuid:`` prefix allowed."""
    bare = F.regexp_replace(F.regexp_replace(text, "urn:|uuid:", ""), r"^[{}]+|[{}]+$|-", "")
    return bare.rlike("^[0-9a-fA-F]{32}$")
