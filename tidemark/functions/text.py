"""String predicates and renderings used by the quality rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# E-mail patterns of the record/stream rules and of the declared rules.
EMAIL_PATTERN = r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+$"
DECLARED_EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"

# Every character a record producer would strip, Unicode blanks included.
_BLANK = r"[\s\x{1c}-\x{1f}\x{85}\p{Z}]"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"^{_BLANK}+|{_BLANK}+\z", "")


def is_blank(text: Column) -> Column:
    """True for null, empty and whitespace-only text."""
    return text.isNull() | (strip(text) == "")


def is_email(text: Column) -> Column:
    """Format test on the stripped text; null and empty are no addresses."""
    return F.coalesce(strip(text).rlike(EMAIL_PATTERN), F.lit(False))


def is_non_negative(value: Column) -> Column:
    """True for numbers >= 0; false for null, NaN and text that is no number."""
    x = value.try_cast("double")
    return F.coalesce((x >= 0) & ~F.isnan(x), F.lit(False))


def show_text(value: Column) -> Column:
    """A value inside a message; null reads ``None``."""
    return F.coalesce(value.cast("string"), F.lit("None"))


def show_float(value: Column) -> Column:
    """A double inside a message: shortest digits, positional from 1e-4 up to 1e16,
    otherwise a two-digit signed exponent."""
    x = value.cast("double")
    text = x.cast("string")
    size = F.abs(x)
    digits = F.regexp_replace(text.try_cast("decimal(38,20)").cast("string"), r"0+$", "")
    positional = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    mantissa = F.regexp_replace(F.regexp_extract(text, r"^(.*)E", 1), r"\.0$", "")
    exponent = F.regexp_extract(text, r"E(.*)$", 1).try_cast("int")
    scientific = F.concat(
        mantissa,
        F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.lpad(F.abs(exponent).cast("string"), 2, "0"),
    )
    return F.coalesce(
        F.when(F.isnan(x), F.lit("nan"))
        .when(size == float("inf"), F.when(x > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .when(~text.contains("E"), text)
        .when((size >= 1e-4) & (size < 1e16), positional)
        .otherwise(scientific),
        F.lit("None"),
    )
