"""Numbers written by people: separators, units and signs of several publishers. Null where none is meant."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.arrays import bound

# Tokens that stand for a missing number.
MISSING = ["", "-", "—", ":", "..", "....", "n.d.", "n/a"]

_PLAIN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _double(text: Column) -> Column:
    """Cast of what is a plain number; words that Java takes for one ("NaN", "5d") are none."""
    return bound(text, lambda t: F.when(t.rlike(_PLAIN), t.try_cast("double")))


def _token(text: Column) -> Column:
    trimmed = F.trim(F.regexp_replace(text, "[\\u00a0\\s]+", " "))
    return bound(trimmed, lambda t: F.when(F.lower(t).isin(MISSING), None).otherwise(t))


def dotted_thousands(text: Column) -> Column:
    """Dots are thousands, the comma is decimal: "1.234,5" is 1234.5 (and "1.5" is 15)."""
    return _double(F.replace(F.replace(_token(text), F.lit("."), F.lit("")), F.lit(","), F.lit(".")))


def inferred_separators(text: Column) -> Column:
    """The rightmost of dot and comma is decimal where both occur; a lone comma is decimal; other characters go."""

    def number(kept: Column) -> Column:
        dot, comma = F.instr(F.reverse(kept), "."), F.instr(F.reverse(kept), ",")
        italian = F.replace(F.replace(kept, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
        english = F.replace(kept, F.lit(","), F.lit(""))
        return F.when((comma > 0) & ((dot == 0) | (comma < dot)), italian).when((comma > 0) & (dot > 0), english).otherwise(kept)

    return _double(bound(F.regexp_replace(_token(text), "[^0-9,.+\\-]", ""), number))


def percent_or_number(text: Column) -> Column:
    """Drops % and spaces; the comma is decimal only where there is no dot."""
    number = lambda kept: F.when(F.instr(kept, ".") == 0, F.replace(kept, F.lit(","), F.lit("."))).otherwise(F.replace(kept, F.lit(","), F.lit("")))
    return _double(bound(F.regexp_replace(_token(text), "[%\\s]", ""), number))


def strict_percent(text: Column) -> Column:
    """A number of up to three digits and two decimals from 0 to 100, with or without %."""
    token = _token(text)
    value = _double(F.replace(F.regexp_extract(token, r"^([+-]?\d{1,3}(?:[.,]\d{1,2})?)\s*%?$", 1), F.lit(","), F.lit(".")))
    return bound(value, lambda v: F.when(v.between(0, 100), v))


def year_token(text: Column) -> Column:
    trimmed = F.trim(text)
    return F.when(trimmed.rlike(r"^(19|20)\d{2}$"), trimmed.try_cast("int"))


def exact_round(value: Column, digits: int) -> Column:
    """Rounds the binary value of a double, halves to even: 2.675 is a little less than it reads and gives 2.67.

    The fraction becomes an integer of 80 bits, so that no step rounds; magnitudes below 2**53 / 10**digits.
    """
    integer = lambda x: x.cast("decimal(25,0)")
    size = F.abs(value)
    whole = F.floor(size)
    high = F.floor((size - whole) * 2.0**40)
    rest = ((size - whole) * 2.0**40 - high) * 2.0**40
    low = F.floor(rest)
    unit = F.lit(str(2**80)).cast("decimal(25,0)")
    scaled = (integer(high) * F.lit(str(2**40)).cast("decimal(13,0)") + integer(low)).cast("decimal(26,0)") * F.lit(10**digits).cast("decimal(11,0)")
    part = scaled % unit
    units = whole * 10**digits + ((scaled - part) / unit).cast("bigint")
    half = F.lit(str(2**79)).cast("decimal(25,0)")
    up = (part > half) | ((part == half) & ((rest > low) | (units % 2 == 1)))
    return F.signum(value) * (units + F.when(up, 1).otherwise(0)) / float(10**digits)


# From where each publisher's form writes millions, thousands without decimals, and one decimal.
STYLES = {"series": (1_000_000, 10_000, None), "wellbeing": (None, 1_000, 100), "cities": (None, 1_000, None), "national": (1_000_000, 10_000, None), "green": (1_000_000, 1_000, None)}


def locale_format(value: Column, style: str = "series") -> Column:
    """A number with a decimal comma and dots for thousands: "1,23 mln", "12.345", else up to two decimals."""
    millions, thousands, one = STYLES[style]
    size = F.abs(value)
    comma = lambda text: F.replace(text, F.lit("."), F.lit(","))
    fixed = lambda x, digits: F.format_string(f"%.{digits}f", exact_round(x, digits))
    short = comma(F.regexp_replace(F.regexp_replace(fixed(value, 2), "0+$", ""), "\\.$", ""))
    cases = []
    if millions:
        cases.append(F.when(size >= millions, F.concat(comma(fixed(value / 1_000_000, 2)), F.lit(" mln"))))
    cases.append(F.when(size >= thousands, F.translate(F.format_number(exact_round(value, 0), 0), ",", ".")))
    if one:
        cases.append(F.when(size >= one, comma(fixed(value, 1))))
    return F.coalesce(*cases, short)


def significant(value: Column, digits: int) -> Column:
    """A number to so many significant digits."""
    return F.format_string(f"%.{digits - 1}e", value).cast("double")


def zero_filled(code: Column, width: int) -> Column:
    """Zeros in front up to a width; longer codes stay whole."""
    return F.when(F.length(code) < width, F.lpad(code, width, "0")).otherwise(code)


def movement(now: Column, before: Column) -> Column:
    return F.when(now > before, "sale").when(now < before, "scende").otherwise("resta stabile")
