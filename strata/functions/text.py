"""String column functions (STR1-STR20, NUL1-NUL3, TYP1).  All built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def leading_number(c: Column | str, type_: str = "bigint") -> Column:
    """STR1: the number a text starts with ('60 Minutes' -> 60); NULL when none."""
    return F.nullif(F.regexp_extract(_c(c), r"^\s*(\d+)", 1), F.lit("")).try_cast(type_)


def before_first_blank(c: Column | str) -> Column:
    """STR2: prefix before the first blank, the whole text when there is none."""
    return F.substring_index(_c(c), " ", 1)


def safe_cast(c: Column | str, type_: str) -> Column:
    """STR3/TYP1: cast that gives NULL for malformed input (ANSI mode stays on)."""
    return _c(c).try_cast(type_)


def capitalize(c: Column | str) -> Column:
    """STR6: first letter upper case, the rest lower case."""
    col = _c(c)
    return F.concat(F.upper(F.substring(col, 1, 1)), F.lower(F.substring(col, 2, 1 << 30)))


def title(c: Column | str) -> Column:
    """STR7: title case (each blank-separated word capitalised)."""
    return F.initcap(_c(c))


def first_word(c: Column | str) -> Column:
    """STR8."""
    return F.element_at(F.split(F.trim(_c(c)), r"\s+"), 1)


def last_word(c: Column | str) -> Column:
    """STR8."""
    return F.element_at(F.split(F.trim(_c(c)), r"\s+"), -1)


def split_two(c: Column | str) -> tuple[Column, Column]:
    """STR9: split at the first run of blanks into (head, rest)."""
    parts = F.split(F.trim(_c(c)), r"\s+", 2)
    return F.get(parts, 0), F.get(parts, 1)


def first_number(c: Column | str, type_: str = "double") -> Column:
    """STR10: first run of digits inside a text, NULL when there is none."""
    return F.nullif(F.regexp_extract(_c(c), r"(\d+)", 1), F.lit("")).try_cast(type_)


def strip_unit(c: Column | str, unit: str, type_: str = "bigint") -> Column:
    """STR11: remove a unit text, then cast (NULL when the rest is not a number)."""
    return F.trim(F.regexp_replace(_c(c), unit, "")).try_cast(type_)


def data_megabytes(c: Column | str) -> Column:
    """STR11 + quirk 3: '500MB' -> 500, '1.5 GB' -> 1536, malformed -> NULL."""
    col = F.upper(F.trim(_c(c)))
    number = F.regexp_extract(col, r"^([0-9]+(\.[0-9]+)?)", 1).try_cast("double")
    return (
        F.when(col.rlike(r"^[0-9.]+\s*GB$"), number * 1024)
        .when(col.rlike(r"^[0-9.]+\s*MB$"), number)
        .otherwise(F.lit(None).cast("double"))
    )


def minutes(c: Column | str) -> Column:
    """STR12: a talk-time text normalised to minutes (hours x 60), converted once."""
    col = _c(c)
    n = first_number(col, "double")
    return F.when(col.contains("Hours"), n * 60).otherwise(n)


def with_unit(c: Column | str, unit: str) -> Column:
    """STR13: '<value> <unit>'."""
    return F.concat(_c(c).cast("string"), F.lit(" " + unit))


def mask_ssn(c: Column | str) -> Column:
    """STR14: keep the last four digits only."""
    return F.concat(F.lit("***-**-"), F.right(_c(c).cast("string"), F.lit(4)))


def mask_last_four(c: Column | str) -> Column:
    """STR15: replace the last four characters by stars."""
    s = _c(c).cast("string")
    return F.concat(F.left(s, F.greatest(F.length(s) - 4, F.lit(0))), F.lit("****"))


def prefix(c: Column | str, n: int) -> Column:
    """STR16: first n characters of the text form (area code, country code)."""
    return F.left(_c(c).cast("string"), F.lit(n))


def text_length(c: Column | str) -> Column:
    """STR17."""
    return F.length(_c(c).cast("string"))


def contains_flag(c: Column | str, needle: str) -> Column:
    """STR18: 1 when the text contains the needle, else 0."""
    return F.coalesce(_c(c).contains(needle).cast("int"), F.lit(0))


def replace_value(c: Column | str, old: str, new: str) -> Column:
    """STR19."""
    col = _c(c)
    return F.when(col == F.lit(old), F.lit(new)).otherwise(col)


def currency_us(c: Column | str) -> Column:
    """STR20: en-US currency text, '$1,234.50' and '-$1,234.50'."""
    col = _c(c)
    return F.when(col < 0, F.concat(F.lit("-$"), F.format_number(-col, 2))).otherwise(
        F.concat(F.lit("$"), F.format_number(col, 2))
    )


def fill(c: Column | str, default) -> Column:
    """NUL1/NUL2."""
    return F.coalesce(_c(c), F.lit(default))


def null_safe_divide(a: Column | str, b: Column | str) -> Column:
    """NUL3: NULL instead of an error when the divisor is 0 or NULL."""
    return F.try_divide(_c(a).cast("double"), _c(b))
