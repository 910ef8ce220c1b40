"""Numeric cleaning (NUM-1..3) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# A plain decimal number, optionally signed, optionally with an exponent.
# Java's parser would also take "12d" or "0x1p3"; pandas would not.
_NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
# Currency marker, thousands separators and every blank are removed first.
_MONEY_NOISE = r"[R,\s\p{Z}]"


def money_text(c) -> Column:
    """The text left after removing the currency marker, commas and blanks."""
    return F.regexp_replace(as_col(c).cast("string"), _MONEY_NOISE, "")


def clean_money(c) -> Column:
    """NUM-1: ``'R 1 200.50'`` -> 1200.5; unparseable, NaN and infinite -> NULL.

    The numeric pattern admits no NaN or infinity spelling; an exponent that
    overflows (``1e999``) still casts to infinity and is rejected here.
    """
    # every step names the one before it once: a CASE would clean the text again in each of its branches
    v = F.regexp_extract(money_text(c), _NUMBER, 0).try_cast("double")
    return F.nullif(F.nullif(v, F.lit(float("inf"))), F.lit(float("-inf")))


def money_unparseable(c) -> Column:
    """AGG-12 predicate: a non-NULL raw value that ``clean_money`` turns into NULL."""
    return as_col(c).isNotNull() & clean_money(c).isNull()


def floor_div(a, b) -> Column:
    """NUM-2: Python ``//`` (floors; Spark ``div`` truncates toward zero)."""
    return F.floor(as_col(a) / as_col(b))


def money_sum(c) -> Column:
    """Exact sum of money: add as DECIMAL(18,2), return DOUBLE.

    Double addition depends on the order rows arrive in; decimal addition
    does not, so re-runs and the oracle agree to the cent.
    """
    return F.sum(as_col(c).cast("decimal(18,2)")).cast("double")


def money_round(c) -> Column:
    """SNK-5: round money to cents at export."""
    return F.round(as_col(c), 2)
