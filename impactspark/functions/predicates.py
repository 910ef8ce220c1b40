"""Row predicates and CASE rules (FLT-6..13, CASE-1..3) as Column expressions.

Every predicate keeps SQL three-valued logic on purpose: a NULL result drops
the row in ``filter``, exactly as a WHERE clause does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# Fixed value: the nationality text that counts as a citizen by self-report.
CITIZEN_NATIONALITY = "South African"
# 13 ASCII digits and nothing after them (Java's $ would accept a trailing newline).
_ID13 = r"^[0-9]{13}\z"


def valid_national_id(id_number) -> Column:
    """13 digits after trimming spaces."""
    return F.trim(as_col(id_number)).rlike(_ID13)


def national_id_eligible(id_number, citizen, nationality) -> Column:
    """FLT-6: a valid id decides (11th digit 0 = citizen); otherwise self-report."""
    idn = as_col(id_number)
    valid = valid_national_id(idn)
    by_id = valid & (F.substring(F.trim(idn), 11, 1) == "0")
    by_report = (idn.isNull() | ~valid) & self_reported_citizen(citizen, nationality)
    return by_id | by_report


def self_reported_citizen(citizen, nationality) -> Column:
    """FLT-7 part: ``citizen = TRUE OR nationality = 'South African'``."""
    return (as_col(citizen) == F.lit(True)) | (as_col(nationality) == F.lit(CITIZEN_NATIONALITY))


def not_employed_not_test(employed, test_account) -> Column:
    """FLT-8: both flags must be FALSE; NULL drops the row."""
    return (as_col(employed) == F.lit(False)) & (as_col(test_account) == F.lit(False))


def outcome_counts(result_id, reason_id) -> Column:
    """FLT-10: result 2, or result 1 with a recorded reason."""
    r = as_col(result_id)
    return (r == 2) | ((r == 1) & as_col(reason_id).isNotNull())


def on_or_after_or_null(d, cutoff) -> Column:
    """FLT-11: ``d >= cutoff OR d IS NULL``."""
    d = as_col(d)
    return (d >= F.lit(cutoff).cast("timestamp_ntz")) | d.isNull()


def not_in(c, values) -> Column:
    """FLT-3, pandas flavour: ``~isin``; a NULL value is kept (SQL would drop it)."""
    return F.coalesce(~as_col(c).isin(list(values)), F.lit(True))


def backfill_type(type_col, name_col, name_value="Internship",
                  named_type="Placement", default_type="Experience gig") -> Column:
    """CASE-1: fill a missing type from the name; a NULL name takes the default."""
    t, n = as_col(type_col), as_col(name_col)
    return (F.when(t.isNull() & n.eqNullSafe(F.lit(name_value)), F.lit(named_type))
             .when(t.isNull(), F.lit(default_type))
             .otherwise(t))


def ordered_override(base: Column, rules) -> Column:
    """CASE-3: ``rules`` is [(predicate, value), ...]; the earliest true rule wins,
    else ``base``.  List the strongest rule first."""
    out = None
    for pred, value in rules:
        v = value if isinstance(value, Column) else F.lit(value)
        out = F.when(pred, v) if out is None else out.when(pred, v)
    return base if out is None else out.otherwise(base)


def flag_label(flag, true_label, false_label) -> Column:
    """CASE-2."""
    return F.when(as_col(flag), F.lit(true_label)).otherwise(F.lit(false_label))
