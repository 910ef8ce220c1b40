"""String cleaning as Column -> Column expressions (STR-1..11).

All of these are built-in Spark expressions and stay inside whole-stage
codegen; the only Python is the NFKC helper, which is an Arrow-batched
pandas UDF that is called only for values holding a non-ASCII character.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ._util import as_col

# Python's str.strip() removes every Unicode blank; Spark's trim() removes
# only ASCII spaces unless it is given the characters: the separators (category
# Z, NBSP among them), the ASCII controls, U+001C..U+001F and U+0085.
_BLANKS = "".join(map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                            0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def strip(c) -> Column:
    """STR-2: strip leading and trailing Unicode blanks (Python ``str.strip``)."""
    return F.trim(as_col(c).cast("string"), F.lit(_BLANKS))


@F.pandas_udf(StringType())
def _nfkc_batch(s: pd.Series) -> pd.Series:
    return s.map(lambda v: unicodedata.normalize("NFKC", v) if isinstance(v, str) else v)


def nfkc(c) -> Column:
    """STR-3: Unicode NFKC.

    Spark evaluates a Python UDF for every row even inside a CASE, so ASCII
    values (already NFKC) are handed over as NULL -- a bit in the Arrow
    batch -- and only text with a non-ASCII character is normalised in Python.
    """
    c = as_col(c)
    return F.coalesce(_nfkc_batch(F.when(c.rlike(r"[^\x00-\x7F]"), c)), c)


def normalize_email(c, nfkc_fold: bool = False) -> Column:
    """STR-1: strip + lower (+ NFKC when ``nfkc_fold``)."""
    out = F.lower(strip(c))
    return nfkc(out) if nfkc_fold else out


def strip_columns(df, columns=None):
    """STR-2 over a frame: strip every (or the named) string column."""
    names = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.withColumns({n: strip(n) for n in names})


def split_list(c, pattern: str) -> Column:
    """STR-4: regex split that keeps trailing empty items (pandas ``str.split``)."""
    return F.split(as_col(c), pattern, -1)


def pad_id(c, width: int = 13, fill: str = "0") -> Column:
    """STR-5: left-pad to ``width`` without truncating longer values (``lpad`` truncates)."""
    c = as_col(c)
    return F.when(F.length(c) < width, F.lpad(c, width, fill)).otherwise(c)


def complete_seconds(c) -> Column:
    """STR-6: ``yyyy-mm-dd hh:mm`` (16 chars) gets ``:00`` appended."""
    c = as_col(c)
    return F.when(F.length(c) == 16, F.concat(c, F.lit(":00"))).otherwise(c)


def replace_values(c, mapping: dict) -> Column:
    """STR-7: exact-value replacement from a small literal dict; other values kept."""
    c = as_col(c)
    if not mapping:
        return c
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(m, c), c)


def full_name(first, last, fallback=None) -> Column:
    """PRJ-8 / STR-10: ``first + ' ' + last`` (NULL-propagating), else ``fallback``."""
    name = F.concat(as_col(first), F.lit(" "), as_col(last))
    return name if fallback is None else F.coalesce(name, as_col(fallback))


def is_blank(c) -> Column:
    """STR-11: NULL or only blanks."""
    return F.coalesce(strip(c), F.lit("")) == ""


def contains_ci(c, needle: str) -> Column:
    """FLT-13: case-insensitive contains; NULL counts as no match."""
    return F.coalesce(F.lower(as_col(c)).contains(needle.lower()), F.lit(False))


def not_ilike(c, pattern: str) -> Column:
    """FLT-12: ``NOT ILIKE`` with SQL three-valued logic (NULL stays NULL)."""
    return ~as_col(c).ilike(pattern)
