"""Scalars from text: flags, key=value pairs, dynamically typed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed words that mean false; everything else is true.
FALSE_WORDS = ("0", "false", "no", "off")


def parse_strict(value: Column) -> Column:
    return ~F.lower(F.trim(value)).isin(*FALSE_WORDS)


def split_pair(item: Column) -> tuple[Column, Column]:
    """Key and value around the first '='; both null without one."""
    at = F.instr(item, "=")
    ok = at > 0
    return F.when(ok, F.substring(item, F.lit(1), at - 1)), F.when(ok, F.substring(item, at + 1, F.length(item)))


def split_list(raw: Column) -> Column:
    """Items between commas and blanks, without empty ones."""
    return F.filter(F.split(raw, "[, ]"), lambda x: x != "")


def scalar_type(value: Column) -> Column:
    """bool, null, int, float or str: the first that the text can be read as."""
    low, v = F.lower(value), F.trim(value)
    return (
        F.when(low.isin("true", "false"), "bool").when(low == "null", "null")
        .when(v.rlike(r"^[+-]?[0-9]+(_[0-9]+)*$"), "int")
        .when(v.rlike(r"^[+-]?([0-9]+(_[0-9]+)*\.?([0-9]+(_[0-9]+)*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"), "float")
        .when(F.lower(v).rlike(r"^[+-]?(nan|inf|infinity)$"), "float")
        .otherwise("str")
    )


def scalar_text(value: Column) -> Column:
    """The value in canonical text: lower-case flags, numbers without separators."""
    kind = scalar_type(value)
    bare = F.replace(F.trim(value), F.lit("_"), F.lit(""))
    return (
        F.when(kind.isin("bool", "null"), F.lower(value))
        .when(kind == "int", bare.try_cast("decimal(38,0)").cast("string"))
        .when(kind == "float", F.when(F.lower(bare).rlike("nan|inf"), F.lower(bare)).otherwise(bare.try_cast("double").cast("string")))
        .otherwise(value)
    )


def shell_word(value: Column) -> Column:
    """The text as one word of a shell command: special characters behind backslashes, quotes for nothing, $'...' for control characters."""
    plain = F.regexp_replace(value, r"([^A-Za-z0-9_@%+=:,./\u0080-\x{10FFFF}-])", r"\\$1")
    quoted = F.regexp_replace(value, r"([\\'])", r"\\$1")
    for code, name in ((7, "a"), (8, "b"), (9, "t"), (10, "n"), (11, "v"), (12, "f"), (13, "r"), (27, "E")):
        quoted = F.replace(quoted, F.lit(chr(code)), F.lit(f"\\{name}"))
    for code in (c for c in range(1, 32) if c not in (7, 8, 9, 10, 11, 12, 13, 27)):
        quoted = F.replace(quoted, F.lit(chr(code)), F.lit(f"\\{code:03o}"))
    return F.when(value == "", "''").when(value.rlike(r"[\x01-\x1f]"), F.concat(F.lit("$'"), quoted, F.lit("'"))).otherwise(plain)
