"""Scalar parsing and cleaning of raw string columns (FN1-FN7).

Every function returns a ``Column`` built from built-in expressions, so it stays
inside whole-stage codegen. Invalid input becomes null plus an ``*_invalid``
flag that the contract check (``operators.contracts``) turns into an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Strings that count as "missing" after trim + lower-case.
MISSING_STRINGS = ("", "nan", "nat", "none", "<na>")

# A decimal / scientific number, optionally signed, or an infinity literal.
# Spark's string->double cast also accepts forms such as '1d' or '1f', so the
# text is checked before the cast.
_NUMERIC_PATTERN = r"^[+-]?((\d+\.?\d*)|(\.\d+))([eE][+-]?\d+)?$|^[+-]?(inf|infinity)$"
_DATE_PATTERN = r"^\d{8}$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Characters that count as white space around a value (ASCII blanks and line ends,
# separators, no-break and other Unicode spaces).
WHITE_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def trimmed(c) -> Column:
    """The text without white space of any kind at its ends."""
    return F.btrim(_col(c).cast("string"), F.lit(WHITE_SPACE))


def is_missing_string(c) -> Column:
    """FN1: null, or one of the missing markers after trim (case-insensitive)."""
    t = trimmed(c)
    return t.isNull() | F.lower(t).isin(*MISSING_STRINGS)


def parse_yyyymmdd(c) -> Column:
    """FN2: strict ``YYYYMMDD`` parse; missing or malformed text gives null."""
    t = trimmed(c)
    ok = ~is_missing_string(c) & t.rlike(_DATE_PATTERN)
    return F.when(ok, F.try_to_date(t, "yyyyMMdd"))


def date_invalid(c, required: bool = True) -> Column:
    """True where the text is not a valid date (missing counts only when required)."""
    parsed_null = parse_yyyymmdd(c).isNull()
    if required:
        return parsed_null
    return parsed_null & ~is_missing_string(c)


def parse_number(c) -> Column:
    """FN3: strict numeric parse to double; missing or malformed text gives null."""
    t = trimmed(c)
    ok = ~is_missing_string(c) & F.lower(t).rlike(_NUMERIC_PATTERN)
    return F.when(ok, F.regexp_replace(F.lower(t), "infinity$", "inf").try_cast("double"))


def number_invalid(c, required: bool = True) -> Column:
    parsed_null = parse_number(c).isNull()
    if required:
        return parsed_null
    return parsed_null & ~is_missing_string(c)


def parse_is_open(c) -> Column:
    """FN4: '0'/'1' (numeric text equal to 0 or 1) -> boolean; anything else null."""
    n = parse_number(c)
    return F.when(n == 1.0, F.lit(True)).when(n == 0.0, F.lit(False))


def clean_exchange(c, default: str = "SSE") -> Column:
    """FN5: missing -> default, otherwise trimmed and upper-cased."""
    return F.upper(F.when(is_missing_string(c), F.lit(default)).otherwise(trimmed(c)))


def float_equal(a, b, tolerance: float = 1e-8) -> Column:
    """FN6: ``|a - b| <= tolerance``; null on either side is ``False``."""
    return F.coalesce(F.abs(_col(a) - _col(b)) <= F.lit(tolerance), F.lit(False))


def ts_code_valid(c) -> Column:
    """Security code ``<digits>.<SZ|SH|BJ>`` (QC2 code rule)."""
    return F.coalesce(_col(c).rlike(r"^\d+\.(SZ|SH|BJ)$"), F.lit(False))
