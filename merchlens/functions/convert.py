"""Report text to typed values. Unreadable text gives null; callers list it as a reject.

A strip costs more than most conversions, so a caller that needs a text more than once strips it once
(``text.strip_or_null``) and passes it with ``stripped``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from merchlens.functions.text import strip, strip_or_null

MONEY = "decimal(18,4)"
TRUE_WORDS = ("true", "1", "yes", "y")
FALSE_WORDS = ("false", "0", "no", "n")


def _text(column: Column | str, stripped: bool) -> Column:
    return column if stripped else strip_or_null(column)


def to_int(column: Column | str, stripped: bool = False) -> Column:
    """Whole number text only."""
    text = _text(column, stripped)
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("int"))


def to_int_lenient(column: Column | str, stripped: bool = False) -> Column:
    """Boolean words give 1/0; numbers lose thousands commas and are cut toward zero."""
    text = _text(column, stripped)
    low = F.lower(text)
    number = F.replace(text, F.lit(","), F.lit("")).try_cast("decimal(38,10)")
    return (
        F.when(low.isin("true", "yes", "y"), F.lit(1))
        .when(low.isin("false", "no", "n"), F.lit(0))
        .otherwise(number.try_cast("int"))
    )


def to_decimal(column: Column | str, dtype: str = MONEY, stripped: bool = False) -> Column:
    return _text(column, stripped).try_cast(dtype)


def to_decimal_lenient(column: Column | str, dtype: str = MONEY, stripped: bool = False) -> Column:
    return F.replace(_text(column, stripped), F.lit(","), F.lit("")).try_cast(dtype)


def to_bool(column: Column | str, stripped: bool = False) -> Column:
    low = F.lower(_text(column, stripped))
    return F.when(low.isin(*TRUE_WORDS), F.lit(True)).when(low.isin(*FALSE_WORDS), F.lit(False))


# The offset stands behind the first blank or T of the text.
OFFSET = r"[T ].*([+-]\d{2}:?\d{2})$"


def to_utc(column: Column | str, stripped: bool = False) -> Column:
    """ISO-8601 text to a UTC timestamp without zone, whatever the session zone is.

    A cast to timestamp_ntz reads the wall clock and ignores the offset, so the
    offset is read apart and subtracted. Text without one is already UTC.
    """
    text = _text(column, stripped)
    offset = F.regexp_extract(text, OFFSET, 1)
    # hhmm, and 0000 where there is none: a cast that fails costs more than all the rest.
    digits = F.lpad(F.translate(offset, "+-:", ""), 4, "0")
    minutes = F.substring(digits, 1, 2).cast("int") * 60 + F.substring(digits, 3, 2).cast("int")
    sign = 1 - 2 * F.startswith(offset, F.lit("-")).cast("int")
    return text.try_cast("timestamp_ntz") - F.make_dt_interval(mins=sign * minutes)


def api_int(column: Column | str) -> Column:
    """API number or text, cut toward zero; anything else is null, never an error."""
    return strip_or_null(column).try_cast("decimal(38,10)").try_cast("bigint")


def api_decimal(column: Column | str) -> Column:
    return strip_or_null(column).try_cast("decimal(20,6)")


def unreadable(name: str, source: Column | str, value: Column, stripped: bool = False) -> Column:
    """Message for text that is present but did not convert, else null."""
    text = source if stripped else strip(source)
    return F.when(value.isNull() & (text != ""), F.concat(F.lit(f"{name}: "), text))

