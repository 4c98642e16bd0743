"""Cleaning, typing and decoding of raw text columns.

All functions take a column and give a column, so Catalyst fuses them into one
projection over the scan and drops those a query does not ask for.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Invisible characters removed from every raw value, and the
# Unicode space separators trimmed from both ends.
INVISIBLE = "\t\n\r\x00\x0c"
SPACES = "".join(
    chr(code)
    for code in (0x20, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000)
)
CODE_PATTERN = r"^[A-Z][0-9]{2,3}\z"


def quoted(name: str) -> Column:
    """A column by its exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def apart(c: Column) -> Column:
    """The same value, by a higher-order function, which keeps its projection out of whole-stage code.

    There all columns of a wide projection, and those of its neighbours, share one method, too long for the JVM to
    compile; outside each column has methods of its own.  One such column is enough for a projection.
    """
    return F.transform(F.array(c), lambda value: value)[0]


def trim_spaces(c: Column) -> Column:
    """Outer space separators off; text of one byte per character has only plain spaces to lose."""
    return F.when(F.octet_length(c) == F.char_length(c), F.trim(c)).otherwise(F.btrim(c, F.lit(SPACES)))


def _has_invisible(c: Column) -> Column:
    """One search for all of them."""
    return c.rlike(r"[\t\n\r\x00\x0c]")


def visible(c: Column) -> Column:
    """Text without invisible characters; only values that hold one are rewritten, since hardly any does."""
    text = c.cast("string")
    return F.when(_has_invisible(text), F.translate(text, INVISIBLE, "")).otherwise(text)


def not_empty(c: Column) -> Column:
    return F.when(c != "", c)


def clean(c: Column) -> Column:
    """Text without invisible characters and outer spaces; NULL when nothing is left."""
    return not_empty(trim_spaces(visible(c)))


def clean_upper(c: Column) -> Column:
    """The upper-casing variant: line and tab characters become spaces, blanks stay blank."""
    text = c.cast("string")
    spaced = F.when(_has_invisible(text), F.translate(text, INVISIBLE, "   ")).otherwise(text)
    return trim_spaces(upper(spaced))


def upper(c: Column) -> Column:
    """Upper case letter by letter: a sharp s becomes its capital, not two letters."""
    return F.upper(F.replace(c, F.lit("ß"), F.lit("ẞ")))


_DAY, _MONTH, _YEAR = "(0[1-9]|[12][0-9]|3[01])", "(0[1-9]|1[0-2])", "[0-9]{4}"


def parse_date(c: Column, allow_future: bool = False) -> Column:
    """First valid reading as YYYYMMDD, DDMMYYYY, DMMYYYY or a written date.

    A reading is tried only where month and day can be right, rearranged to ISO
    text and cast: that needs no date formatter and leaves hardly any cast to
    fail.  Readings after today are rejected unless ``allow_future``.
    """

    def reading(layout: str, *parts: Column) -> Column:
        day = F.concat_ws("-", *parts).try_cast("date")
        shaped = c.rlike(layout)
        return F.when(shaped if allow_future else shaped & (day <= F.current_date()), day)

    def part(start: int, length: int) -> Column:
        return F.substring(c, start, length)

    day_only = F.substring_index(F.substring_index(c, " ", 1), "T", 1)
    return F.coalesce(
        reading(rf"^{_YEAR}{_MONTH}{_DAY}\z", part(1, 4), part(5, 2), part(7, 2)),
        reading(rf"^{_DAY}{_MONTH}{_YEAR}\z", part(5, 4), part(3, 2), part(1, 2)),
        reading(rf"^[1-9]{_MONTH}{_YEAR}\z", part(4, 4), part(2, 2), F.concat(F.lit("0"), part(1, 1))),
        reading(r"^[0-9]{4}[-/][0-9]{1,2}[-/][0-9]{1,2}([ T]|\z)", F.replace(day_only, F.lit("/"), F.lit("-"))),
    )


# Range of the whole-number types.
RANGES = {
    "tinyint": (-(2**7), 2**7 - 1),
    "smallint": (-(2**15), 2**15 - 1),
    "int": (-(2**31), 2**31 - 1),
    "bigint": (-(2**63), 2**63 - 1),
}


def to_integer(c: Column, kind: str, largest: int | None = None) -> Column:
    """Whole number of type ``kind``; text with a fraction or exponent is rounded half up.

    Only text that is a number gets cast, to a wide type, and the range is
    compared: a cast that fails raises inside the engine, which is slow for
    columns whose codes outgrow their type.  ``largest`` guards columns that are
    unsigned in the record layout.
    """
    whole = F.when(c.rlike(r"^[+-]?[0-9]{1,18}\z"), c.cast("bigint"))
    other = F.when(c.rlike(r"^[+-]?[0-9.]+([eE][+-]?[0-9]+)?\z"), F.round(c.try_cast("decimal(38,10)")).try_cast("bigint"))
    number = F.coalesce(whole, other)
    low, high = RANGES[kind] if largest is None else (0, largest)
    return F.when(number.between(low, high), number.cast(kind))


NUMBER = r"(?i)^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|inf(inity)?|nan)\z"


def to_float(c: Column) -> Column:
    """Single-precision number; the JVM's ``12d`` and ``12f`` spellings are not numbers."""
    return F.when(c.rlike(NUMBER), c.cast("float"))


def to_boolean(
    c: Column,
    true: Iterable[str] = ("1", "true", "TRUE"),
    false: Iterable[str] = ("0", "false", "FALSE"),
) -> Column:
    return F.when(c.isin(*true), True).when(c.isin(*false), False)


def parse_time(c: Column) -> Column:
    """``HHMM`` or ``HH:MM`` as ``HH:mm:ss``; anything out of range is NULL."""
    valid = c.rlike(r"^([01][0-9]|2[0-3]):?[0-5][0-9]\z")
    return F.when(valid, F.concat(F.substring(c, 1, 2), F.lit(":"), F.right(c, F.lit(2)), F.lit(":00")))


def diagnosis_code(c: Column) -> Column:
    """Upper-case code without dots, or NULL when it is not a letter and 2 or 3 digits."""
    code = F.replace(F.upper(c), F.lit("."), F.lit(""))
    return F.when(code.rlike(CODE_PATTERN), code)


def diagnosis_list(c: Column) -> Column:
    """Valid codes of a ``*`` or ``/`` separated list; NULL when none is valid."""
    tokens = F.split(F.translate(trim_spaces(F.upper(c)), "/", "*"), r"\*")
    codes = F.filter(tokens, lambda token: token.rlike(CODE_PATTERN))
    # Bound by the outer function, so that the list is split and searched once, not for the test and the value.
    return F.transform(F.array(codes), lambda found: F.when(F.size(found) > 0, found))[0]


def recode(c: Column, mapping: Mapping[str, str], default: str | None = None) -> Column:
    """Label of a code; codes with the same label share one test."""
    by_label: dict[str, list[str]] = {}
    for code, label in mapping.items():
        by_label.setdefault(label, []).append(code)
    text = c.cast("string")
    labels = F.lit(default).cast("string")
    for label, codes in reversed(by_label.items()):
        labels = F.when(text.isin(*codes), F.lit(label)).otherwise(labels)
    return labels


def age_value(c: Column) -> Column:
    """Number of the encoded age: unit digit, then two digits; unit 5 counts from 100."""
    unit = F.substring(c, 1, 1)
    number = to_integer(F.substring(c, 2, 2), "int")
    known = (F.length(trim_spaces(c)) >= 3) & ~unit.isin("0", "9")
    return F.when(known, number + F.when(unit == "5", 100).otherwise(0)).cast("smallint")


# Unit digit of an encoded age.
AGE_UNITS = {"1": "minutos", "2": "horas", "3": "meses", "4": "anos", "5": "anos", "9": "ignorado"}


def age_unit(c: Column) -> Column:
    return F.when(F.length(trim_spaces(c)) >= 3, recode(F.substring(c, 1, 1), AGE_UNITS))


def age_in_years(value: Column, unit: Column) -> Column:
    """Years of a decoded age; units below a year count as 0, unknown units as NULL."""
    return F.when(unit == "anos", value.cast("int")).when(
        unit.isin("minutos", "horas", "meses") & value.isNotNull(), 0
    )


def six_digit_municipality(c: Column) -> Column:
    """Municipality code without its check digit; only 7-digit codes are shortened."""
    return F.when(c.between(1000000, 9999999), F.floor(c / 10)).otherwise(c).cast("int")
