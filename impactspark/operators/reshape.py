"""Explode, wide->long and pivots (ARR-1/2, RSH-1..6, PRJ-9, SRC-5 naming).

Pivots always take an explicit value list so the output schema is known
when the plan is built and Spark runs one two-phase aggregate (partial
per map task, final after the shuffle) instead of a distinct pass plus a
pivot pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.strings import split_list
from ._keys import listify

# Fixed value: the opportunity block layout (2 id columns, then blocks of 5).
BLOCK_FIELDS = ("payment", "date_service_accessed", "earning_opportunity_extra_info",
                "earning_opportunity_type", "earning_opportunity_name")
ID_FIELDS = ("umuzi_email", "cohort")


def split_explode(df: DataFrame, col: str, pattern: str, out: str | None = None) -> DataFrame:
    """ARR-1: one row per item of a delimited list; NULL lists keep one NULL row."""
    return df.withColumn(out or col, F.explode_outer(split_list(col, pattern)))


def block_names(width: int, ids=ID_FIELDS, fields=BLOCK_FIELDS) -> list[str]:
    """SRC-5: names for a ``len(ids) + k*len(fields)`` wide layout, validated."""
    extra = width - len(ids)
    if extra <= 0 or extra % len(fields):
        raise ValueError(f"layout of {width} columns is not {len(ids)} + k*{len(fields)}")
    return list(ids) + [f"{f}_{i}" for i in range(1, extra // len(fields) + 1) for f in fields]


def blocks_to_rows(df: DataFrame, ids, fields, n_blocks: int, keep_if: str | None = None,
                   block_col: str | None = None) -> DataFrame:
    """RSH-1: ``(ids, f_1.., f_2.., ...)`` -> one row per block, via ``inline``.

    One projection, no shuffle.  ``keep_if`` drops blocks whose field is NULL.
    """
    ids = listify(ids)
    structs = []
    for i in range(1, n_blocks + 1):
        parts = [F.col(f"{f}_{i}").alias(f) for f in fields]
        if block_col:
            parts.append(F.lit(i).alias(block_col))
        structs.append(F.struct(*parts))
    out = df.select(*ids, F.inline(F.array(*structs)))
    return out.filter(F.col(keep_if).isNotNull()) if keep_if else out


def pivot(df: DataFrame, index, key: str, values: list, aggs: dict,
          name=lambda v, m: f"{v}_{m}", fill=None) -> DataFrame:
    """RSH-2..5: ``groupBy(index).pivot(key, values)`` with named metrics.

    ``aggs`` maps a metric name to an aggregate Column; output columns are
    named ``name(value, metric)`` in (value, metric) order; missing cells are
    ``fill`` when given.
    """
    index = listify(index)
    metrics = list(aggs)
    agg_cols = [a.alias(m) for m, a in aggs.items()]
    p = df.groupBy(*index).pivot(key, list(values)).agg(*agg_cols)
    sel = [F.col(c) for c in index]
    for v in values:
        for m in metrics:
            src = f"{v}_{m}" if len(metrics) > 1 else f"{v}"
            c = F.col(f"`{src}`")
            if fill is not None:
                c = F.coalesce(c, F.lit(fill))
            sel.append(c.alias(name(v, m)))
    return p.select(*sel)


def grid(df: DataFrame, index, columns: list, fill=None) -> DataFrame:
    """PRJ-9: reindex to a fixed column list, absent columns as NULL/``fill``."""
    have = set(df.columns)
    sel = [F.col(c) for c in listify(index)]
    for c in columns:
        v = F.col(f"`{c}`") if c in have else F.lit(None)
        sel.append((F.coalesce(v, F.lit(fill)) if fill is not None else v).alias(c))
    return df.select(*sel)


def interleave(df: DataFrame, index, pairs) -> DataFrame:
    """RSH-6: ``[(value_col, gig_col), ...]`` -> index, v1, g1, v2, g2, ..."""
    cols = [F.col(c) for c in listify(index)]
    for v, g in pairs:
        cols += [F.col(f"`{v}`"), F.col(f"`{g}`")]
    return df.select(*cols)


def count_lit() -> Column:
    """``count(*)`` for use inside a pivot (``count('*')`` is rejected there)."""
    return F.count(F.lit(1))
