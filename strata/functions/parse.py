"""Text to typed values.

Column in, Column out. Text that cannot be read becomes null; nothing throws,
whether the session runs in ANSI mode or not.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Noise characters and date layouts of the source systems.
MONEY_NOISE = r"[\$,\s]"
PERCENT_NOISE = r"[%,\s]"
ORDER_DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy", "MM-dd-yyyy")
SHIPMENT_DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy")

_WHOLE_PART = r"^[\s\p{Cntrl}]*([+-]?\d+)(?:\.\d*)?[\s\p{Cntrl}]*$"
_FRACTION_ONLY = r"^[\s\p{Cntrl}]*[+-]?\.\d*[\s\p{Cntrl}]*$"


def parse_money(text: Column, to: str = "double") -> Column:
    """``$1,250.00`` -> 1250.00. ``to`` may be ``decimal(18,2)`` for exact sums."""
    return F.regexp_replace(text, MONEY_NOISE, "").try_cast(to)


def parse_percent(text: Column, to: str = "double") -> Column:
    """``15%`` -> 15.0."""
    return F.regexp_replace(text, PERCENT_NOISE, "").try_cast(to)


def parse_int(text: Column) -> Column:
    """Plain number text to int, dropping decimals as a lenient cast does.

    ``3.7`` -> 3, `` 5 `` -> 5; exponents, blanks, words and values that do not
    fit an int give null.
    """
    whole = F.regexp_extract(text, _WHOLE_PART, 1).try_cast("int")
    return F.when(text.rlike(_FRACTION_ONLY), F.lit(0)).otherwise(whole)


def parse_date(text: Column, formats: Sequence[str] = ORDER_DATE_FORMATS) -> Column:
    """First of ``formats`` that reads the text; no partial or rolled-over dates.

    A layout that fails costs an exception for each row, many times the price of one that
    reads; layouts that the third character rules out are therefore not tried.
    """
    return F.coalesce(*[_read_date(text, layout) for layout in formats])


def _read_date(text: Column, layout: str) -> Column:
    day, third = F.try_to_date(text, layout), F.substring(text, 3, 1)
    if layout.startswith("yyyy"):  # four digits or more, with a sign perhaps
        return F.when(third.between("0", "9"), day)
    if re.match(r"(dd|MM)[-/. ]", layout):  # two digits, then this character
        return F.when(third == layout[2], day)
    return day
