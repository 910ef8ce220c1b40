"""Label maps and field lookups (LKP-1..6, STR-7, SET-2).

A literal map of a few dozen entries is compiled into a ``map`` literal and
looked up per row inside generated code -- no join and no shuffle.  A map
that lives in a table is joined; it is broadcast only when the caller says
its size is bounded (``bounded=True``), otherwise AQE decides from the
measured size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._util import as_col


def map_literal(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def map_label(c, mapping: dict, default=None, keep_targets: bool = False) -> Column:
    """LKP-2/3/4/6 as an expression.

    Unmapped values become ``default`` (NULL if none).  ``keep_targets`` makes
    the remap idempotent (T10): a value that is already a target label maps
    to itself instead of to NULL.
    """
    c = as_col(c)
    out = F.try_element_at(map_literal(mapping), c) if mapping else F.lit(None).cast("string")
    if keep_targets:
        targets = sorted({v for v in mapping.values() if v is not None})
        out = F.coalesce(out, F.when(c.isin(targets), c))
    if default is not None:
        out = F.coalesce(out, F.lit(default))
    return out


def map_frame(spark, mapping: dict, key: str, value: str) -> DataFrame:
    """A literal map as a two-column frame (for joins and for SET-2)."""
    return spark.createDataFrame(list(mapping.items()), f"{key} string, {value} string")


def join_map(df: DataFrame, col: str, mapping: DataFrame, key: str, value: str,
             out: str, default=None) -> DataFrame:
    """LKP-2..6 with the map held in a table (one row per key is enforced); the planner broadcasts it by its measured size."""
    m = mapping.dropDuplicates([key]).select(F.col(key).alias("__mk"), F.col(value).alias("__mv"))
    j = df.join(m, df[col] == m["__mk"], "left")
    v = F.col("__mv") if default is None else F.coalesce(F.col("__mv"), F.lit(default))
    return j.withColumn(out, v).drop("__mk", "__mv")


def unmapped_values(df: DataFrame, col: str, mapping: dict) -> DataFrame:
    """SET-2 / coverage check: distinct non-NULL values with no map entry."""
    keys = list(mapping.keys())
    return (df.select(col).filter(F.col(col).isNotNull() & ~F.col(col).isin(keys))
              .groupBy(col).agg(F.count(F.lit(1)).alias("n_rows")))


def merge_maps(base: DataFrame, override: DataFrame, key: str, value: str) -> DataFrame:
    """LKP-5: union of two maps by key, ``override`` wins where it has a value."""
    b = base.select(F.col(key), F.col(value).alias("__b"))
    o = override.select(F.col(key), F.col(value).alias("__o"))
    return (b.join(o, key, "full_outer")
             .select(key, F.coalesce(F.col("__o"), F.col("__b")).alias(value)))


def field_lookup(df: DataFrame, filters: dict, fields) -> DataFrame:
    """LKP-1: rows whose every filtered field is in its value list.

    No filter means no rows (the reference returns an empty list).  The IN
    lists are pushed down to the scan (Parquet row groups / JDBC WHERE).
    """
    if not filters:
        return df.select(*fields).limit(0)
    cond = reduce(lambda a, b: a & b, [F.col(k).isin(list(v)) for k, v in filters.items()])
    return df.filter(cond).select(*fields)
