from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def listify(x):
    if x is None:
        return []
    return [x] if isinstance(x, (str, Column)) else list(x)


def null_safe_on(left: DataFrame, right: DataFrame, keys, right_keys=None) -> Column:
    """Join condition where NULL equals NULL on every key (pandas merge semantics, T1)."""
    keys = listify(keys)
    right_keys = listify(right_keys) or keys
    return reduce(lambda a, b: a & b,
                  [left[l].eqNullSafe(right[r]) for l, r in zip(keys, right_keys)])


def prefixed(df: DataFrame, prefix: str, keep=()) -> DataFrame:
    """Rename every column except ``keep`` with a prefix (to join without clashes)."""
    return df.select([F.col(c) if c in keep else F.col(c).alias(prefix + c) for c in df.columns])
