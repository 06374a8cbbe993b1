"""Column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER_PATTERN = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:nan|inf|infinity))$"
DATE_PATTERNS = {
    "yyyy-M-d": r"^\d{4}-\d{1,2}-\d{1,2}$",
    "yyyy/M/d": r"^\d{4}/\d{1,2}/\d{1,2}$",
    "d-M-yyyy": r"^\d{1,2}-\d{1,2}-\d{4}$",
    "d.M.yyyy": r"^\d{1,2}\.\d{1,2}\.\d{4}$",
}


def strip(text: Column) -> Column:
    """Trim every kind of white space, including no-break and narrow spaces."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def safe_number(text: Column) -> Column:
    """Double, or NULL where the text is not a plain number ('1d' is not)."""
    trimmed = strip(text.cast("string"))
    return F.when(trimmed.rlike(NUMBER_PATTERN), trimmed.try_cast("double"))


def parse_date(text: Column) -> Column:
    """First matching format wins, else NULL."""
    attempts = [
        F.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(fmt)))
        for fmt, shape in DATE_PATTERNS.items()
    ]
    return F.coalesce(*attempts).cast("date")


def date_key(date: Column) -> Column:
    return (F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)).cast("int")


def date_of_key(key: Column) -> Column:
    return F.make_date(F.floor(key / 10000).cast("int"), F.floor(key / 100).cast("int") % 100, key % 100)


def pct_change(new: Column, old: Column) -> Column:
    """Percent change, NULL when the base is zero or missing."""
    return F.try_divide(new - old, old) * 100


def price_text(raw: Column) -> tuple[Column, Column]:
    """(number, trailing currency text) from an offer price such as ``10 250,5 грн``."""
    cleaned = strip(F.translate(raw, "\u00a0", " "))
    digits = F.regexp_extract(cleaned, r"(?U)\d+[\d\s,\.]*", 0)
    found = digits != ""
    value = safe_number(F.translate(F.replace(digits, F.lit(" "), F.lit("")), ",", "."))
    rest = strip(F.regexp_extract(cleaned, r"(?Us)\d+[\d\s,\.]*(.*)$", 1))
    return F.when(found, value), F.when(found & (rest != ""), rest)
