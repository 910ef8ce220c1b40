"""Aggregations (AGG-1..14).  All are built-in aggregates with map-side
partial aggregation, so a hot key is combined inside every map task before
anything is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._util import as_col
from ._keys import listify


def first_non_null_cols(order, cols) -> list:
    """AGG-6 as aggregate expressions, to combine with others in one ``agg``."""
    order = as_col(order)
    return [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c) for c in cols]


def first_non_null(df: DataFrame, keys, order, cols) -> DataFrame:
    """AGG-6: per key and per column, the value of the first row (in ``order``)
    where that column is not NULL -- one output row may mix input rows, as
    pandas ``groupby.first`` does.  ``order`` is one Column (use a struct for
    a compound order)."""
    return df.groupBy(*listify(keys)).agg(*first_non_null_cols(order, cols))


def sorted_distinct(c) -> Column:
    """AGG-7: sorted list of distinct non-NULL values."""
    return F.array_sort(F.collect_set(as_col(c)))


def joined_distinct(c, sep: str = ", ") -> Column:
    """AGG-5: ``STRING_AGG(DISTINCT c, sep ORDER BY c)``; NULL when no value."""
    s = F.collect_set(as_col(c))
    return F.when(F.size(s) > 0, F.array_join(F.array_sort(s), sep))


def count_rows(df: DataFrame, keys, name: str = "n_rows") -> DataFrame:
    """AGG-1: rows per key; NULL keys form their own group."""
    return df.groupBy(*listify(keys)).agg(F.count(F.lit(1)).alias(name))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """AGG-11: number of surplus copies of identical rows (one-row frame)."""
    return (df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
              .agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows")))


def value_frequency(df: DataFrame, raw: str, bad: Column) -> DataFrame:
    """AGG-12: how often each offending raw value occurs."""
    return (df.filter(bad).groupBy(raw).agg(F.count(F.lit(1)).alias("n_rows")))


def distinct_list_by_key(df: DataFrame, keys, value: str, out: str, sep: str = ", ",
                         mins: dict | None = None) -> DataFrame:
    """AGG-5 in two steps: distinct (key, value) pairs first -- a hash
    aggregate combined map-side -- then one sorted, ``sep``-joined list per
    key (NULL when the key has no non-NULL value).  ``mins`` carries
    ``{name: column}`` minimums through both steps."""
    keys, mins = listify(keys), dict(mins or {})
    pairs = df.groupBy(*keys, value).agg(*[F.min(c).alias(n) for n, c in mins.items()])
    lst = F.array_sort(F.collect_list(value))
    return pairs.groupBy(*keys).agg(
        *[F.min(n).alias(n) for n in mins],
        F.when(F.size(lst) > 0, F.array_join(lst, sep)).alias(out))
