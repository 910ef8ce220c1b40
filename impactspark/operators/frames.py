"""Projection, filter, set and ordering helpers (PRJ-1..10, FLT-1/2/5, SET-1/3, SRT-1..7).

Thin on purpose: each is one DataFrame call, named after the reference's
vocabulary so pipelines read like the reports they build.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._keys import listify


def select_contract(df: DataFrame, columns) -> DataFrame:
    """PRJ-1: exact column subset in contract order (raises on a missing one)."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing contract columns: {missing}")
    return df.select(*columns)


def rename_positional(df: DataFrame, names) -> DataFrame:
    """PRJ-3: rename the first ``len(names)`` columns by position."""
    names = list(names)
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(df.columns, names)])


def drop_if_present(df: DataFrame, cols) -> DataFrame:
    """PRJ-4."""
    return df.drop(*[c for c in cols if c in df.columns])


def all_but(df: DataFrame, cols) -> DataFrame:
    """PRJ-10: every column except ``cols``."""
    skip = set(cols)
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in skip])


def drop_null_any(df: DataFrame, subset) -> DataFrame:
    """FLT-1: drop rows with a NULL in any of ``subset`` (empty string is kept)."""
    return df.dropna(how="any", subset=listify(subset))


def drop_null_all(df: DataFrame, subset) -> DataFrame:
    """FLT-2: drop rows where every column of ``subset`` is NULL."""
    return df.dropna(how="all", subset=listify(subset))


def in_window(df: DataFrame, col: str, start, as_of) -> DataFrame:
    """FLT-5: keep rows dated in ``[start, as_of]``; NULL dates are dropped."""
    d = F.col(col)
    return df.filter(d.isNotNull() & (d >= F.lit(start).cast("timestamp_ntz"))
                     & (d <= F.lit(as_of).cast("timestamp_ntz")))


def union_all(frames, allow_missing: bool = False) -> DataFrame:
    """SET-1: bag union by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def column_gaps(df: DataFrame, required, allowed=None) -> tuple[list, list]:
    """SET-3: (missing required columns, unexpected extra columns)."""
    cols = set(df.columns)
    missing = [c for c in required if c not in cols]
    extra = [] if allowed is None else [c for c in df.columns if c not in set(allowed)]
    return missing, extra


def top_k(df: DataFrame, k: int, order) -> DataFrame:
    """SRT-5: first ``k`` rows in ``order`` (Spark plans TakeOrderedAndProject)."""
    return df.orderBy(*listify(order)).limit(k)


def sort_output(df: DataFrame, cols, descending=(), nulls_first: bool = False) -> DataFrame:
    """SRT-1/2/3: order at the sink only (Spark keeps no order between stages).

    PostgreSQL sorts NULLs last ascending; Spark sorts them first, so the
    null placement is always explicit here.
    """
    return df.orderBy(*sort_keys(cols, descending, nulls_first))


def sort_keys(cols, descending=(), nulls_first: bool = False) -> list[Column]:
    """The sort keys of ``sort_output``, null placement written out."""
    desc, keys = set(descending), []
    for c in listify(cols):
        col = F.col(c)
        if c in desc:
            keys.append(col.desc_nulls_first() if nulls_first else col.desc_nulls_last())
        else:
            keys.append(col.asc_nulls_first() if nulls_first else col.asc_nulls_last())
    return keys


def worst(df: DataFrame, key: str, value: str) -> DataFrame:
    """SRT-6: the ``key`` with the largest absolute ``value`` (one-row frame)."""
    return df.agg(F.max_by(F.col(key), F.abs(F.col(value))).alias(key),
                  F.max(F.abs(F.col(value))).alias(f"max_abs_{value}"))


def preview(df: DataFrame, n: int = 10, seed: int = 0) -> DataFrame:
    """SRT-7: ``n`` rows for human review (never an output), the same ones on any partitioning.

    The rows with the smallest content hash: a uniform choice that ``seed``
    changes; every task keeps its own ``n`` and those are merged.
    """
    from .quality import row_hash
    return df.orderBy(row_hash(df, seed)).limit(n)
