"""Ranking operators (WIN-1..3).

Ranking inside a key is the one place where a hot key cannot be combined
map-side.  ``row_number_in_key`` over named order columns splits every key
into deterministic buckets of its order -- all order columns but the last,
plus ``floor(last / chunk)`` of the final integral column (a row number or
id) -- ranks rows locally per (key, bucket), and adds the number of the
key's rows in earlier buckets, read from a small table of the buckets that have
any.  A key holding a third of all rows is spread over many tasks of at
most ``chunk`` rows each, and the result equals ``row_number()`` exactly,
also where key or order columns are NULL.  The same plan runs at every size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._keys import listify

DEFAULT_CHUNK = 1 << 20


def row_number_in_key(df: DataFrame, keys, order, out: str, skew_safe: bool = False,
                      chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """1-based ``row_number()`` of each row inside its key, in ``order``.

    With ``skew_safe`` the order must be plain ascending columns (names),
    unique inside a key, the last one integral.  Without it the plain window
    runs; use that only where a key's rows are few by construction.
    """
    keys, order = listify(keys), listify(order)
    if not isinstance(skew_safe, bool):
        raise ValueError("skew_safe is True or False; it does not depend on the data")
    if not skew_safe:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(out, F.row_number().over(w))
    if not all(isinstance(o, str) for o in order):
        raise ValueError("skew_safe ranking needs the order as column names")
    # struct equality and order treat NULL fields as equal and first, so the
    # join below is NULL-safe on keys and buckets and uses the window's own partitioning;
    # the columns inside the structs are not carried a second time
    last = order[-1]
    held = {n.lower(): f"__bucket.b{i}" for i, n in enumerate(order[:-1])} | {k.lower(): f"__key.k{i}" for i, k in enumerate(keys)}
    held.pop(last.lower(), None)
    own = [F.col(held[c.lower()]).alias(c) if c.lower() in held else F.col(f"`{c}`") for c in df.columns]
    d = df.withColumn("__key", F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])).withColumn(
        "__bucket", F.struct(*[F.col(n).alias(f"b{i}") for i, n in enumerate(order[:-1])],
                             F.floor(F.col(last) / chunk).alias("chunk"))).drop(*held)
    local = Window.partitionBy("__key", "__bucket").orderBy(last)     # the other order columns are the bucket's
    d = d.withColumn("__local", F.row_number().over(local))
    # sizes come from the ranked frame itself, so both branches share its exchange
    sizes = d.groupBy("__key", "__bucket").agg(F.max("__local").alias("__n"))
    before = Window.partitionBy("__key").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    # only a key of several buckets has rows in earlier ones
    offsets = sizes.select(F.col("__key").alias("__ok"), F.col("__bucket").alias("__ob"),
                           F.sum("__n").over(before).alias("__off")).filter("__off > 0")
    j = d.join(offsets, (d["__key"] == offsets["__ok"]) & (d["__bucket"] == offsets["__ob"]), "left")
    return j.select(*own, (F.col("__local") + F.coalesce("__off", F.lit(0))).cast("int").alias(out))


def running_index(df: DataFrame, keys, order, out: str = "row_id", skew_safe: bool = False) -> DataFrame:
    """WIN-1: 0-based position of each row inside its key, in ``order``
    (pandas ``cumcount`` with an explicit order instead of input order)."""
    out_df = row_number_in_key(df, keys, order, "__rn1", skew_safe)
    return out_df.withColumn(out, (F.col("__rn1") - 1).cast("int")).drop("__rn1")


def rank_within(df: DataFrame, keys, order, out: str = "rank", skew_safe: bool = False) -> DataFrame:
    """WIN-2: 1-based rank (``row_number``) inside each key."""
    out_df = row_number_in_key(df, keys, order, "__rn1", skew_safe)
    return out_df.withColumn(out, F.col("__rn1").cast("int")).drop("__rn1")


def count_once(df: DataFrame, key: str, order_cols, baseline: DataFrame | None = None,
               baseline_key: str | None = None, out: str = "count_marker",
               first_label: str = "1", other_label: str = "Counted") -> DataFrame:
    """WIN-3: mark the first row of each person with ``first_label`` unless the
    person is in ``baseline``; every other row gets ``other_label``.

    The first row per key is found with a ``min(struct(order))`` aggregate
    (partial aggregation; a hot key is combined map-side) and joined back, so
    no task sorts a whole hot group.  ``order_cols`` must be unique within a
    key (end it with a tie-break column).
    """
    order_cols = listify(order_cols)
    ord_struct = F.struct(*[F.col(c) for c in order_cols])
    firsts = df.groupBy(key).agg(F.min(ord_struct).alias("__first"))
    if baseline is not None:
        b = baseline.select(F.col(baseline_key or key).alias("__bk")).distinct()
        firsts = (firsts.join(b, firsts[key] == b["__bk"], "left")
                        .withColumn("__base", F.col("__bk").isNotNull()).drop("__bk"))
    else:
        firsts = firsts.withColumn("__base", F.lit(False))
    f = firsts.withColumnRenamed(key, "__fk")
    j = df.join(f, df[key].eqNullSafe(f["__fk"]), "left")
    is_first = (ord_struct == F.col("__first")) & ~F.col("__base")
    return (j.withColumn(out, F.when(is_first, F.lit(first_label)).otherwise(F.lit(other_label)))
             .drop("__fk", "__first", "__base"))
