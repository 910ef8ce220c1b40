"""Joins: enrichment, identity resolution, membership and review lists (JN-1..12).

No join here forces a broadcast of a frame whose size grows with the data.
Dimensions are joined plainly; AQE turns the join into a broadcast at run
time when the *measured* side is under
``spark.sql.adaptive.autoBroadcastJoinThreshold`` and into a skew-split
sort-merge join otherwise.  Only fixed-size literal tables are broadcast
explicitly (see ``lookups``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import stage_table
from ._keys import listify, null_safe_on, prefixed
from .dedup import highest_per_key
from .quality import counts_of

#: Tasks over which the rows of a left join with a NULL key are spread.
NULL_SALTS = 64


def lookup_join(df: DataFrame, dim: DataFrame, key, dim_key: str) -> DataFrame:
    """Left join of ``df`` to ``dim`` (unique on ``dim_key``, which is dropped), safe for hot and NULL keys.

    ``dim`` was usually just made unique on its key, and a side that reuses
    that aggregate's partitioning cannot be split by the skew join; it is
    stored once, so both sides are plain exchanges.  Rows with a NULL key
    match nothing; a second join column, a hash of the row on the left and a
    stored constant on the right, deals them out instead of sending them all
    to one task.
    """
    key = F.col(key) if isinstance(key, str) else key
    d = stage_table(dim.filter(F.col(dim_key).isNotNull()).withColumn("__salt", F.lit(-1)), "lookup")
    salt = F.when(key.isNull(), F.pmod(F.xxhash64(*df.columns), F.lit(NULL_SALTS)).cast("int")).otherwise(-1)
    left = df.withColumn("__lk", key).withColumn("__ls", salt)
    return (left.join(d, (F.col("__lk") == F.col(dim_key)) & (F.col("__ls") == F.col("__salt")), "left")
            .drop("__lk", "__ls", "__salt", dim_key))


def left_chain(fact: DataFrame, steps) -> DataFrame:
    """JN-2: a chain of left joins ``[(dim, fact_key_col, dim_key_col, {dim_col: out_name})]``."""
    out = fact
    for i, (dim, fkey, dkey, cols) in enumerate(steps):
        tag = f"__d{i}_"
        d = dim.select(F.col(dkey).alias(tag + "k"), *[F.col(c).alias(tag + c) for c in cols])
        fk = fkey if not isinstance(fkey, str) else F.col(fkey)
        out = out.join(d, fk == F.col(tag + "k"), "left")
        out = out.select(*[c for c in out.columns if not c.startswith(tag)],
                         *[F.col(tag + c).alias(name) for c, name in cols.items()])
    return out


def null_safe_join(left: DataFrame, right: DataFrame, keys, how: str = "left") -> DataFrame:
    """JN-7: equi-join where NULL keys match NULL keys (pandas ``merge``)."""
    keys = listify(keys)
    r = prefixed(right, "__r_")
    joined = left.join(r, null_safe_on(left, r, keys, ["__r_" + k for k in keys]), how)
    extra = [F.col("__r_" + c).alias(c) for c in right.columns if c not in keys]
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.select(*[left[k] for k in left.columns], *extra)


def remap_identity(df: DataFrame, col: str, mapping: DataFrame,
                   from_col: str, to_col: str, id_col: str | None = None,
                   out: str | None = None) -> DataFrame:
    """JN-5: ``map.get(x, x)``: replace ``col`` by its mapped value when one exists.

    The map is made unique first (T3): NULL keys dropped, highest ``id_col``
    kept per key.  Single pass, not transitive.
    """
    m = mapping.filter(F.col(from_col).isNotNull())
    if id_col:
        m = highest_per_key(m, [from_col], id_col)
    else:
        m = m.dropDuplicates([from_col])
    m = m.select(F.col(from_col).alias("__from"), F.col(to_col).alias("__to"))
    joined = lookup_join(df, m, col, "__from")
    return joined.withColumn(out or col, F.coalesce(F.col("__to"), F.col(col))).drop("__to")


def flag_members(df: DataFrame, keys, members: DataFrame, flag: str,
                 member_keys=None) -> DataFrame:
    """JN-8: boolean column, true when the row's key is in ``members`` (no fan-out)."""
    keys = listify(keys)
    mk = listify(member_keys) or keys
    m = members.select(*[F.col(a).alias("__m_" + b) for a, b in zip(mk, keys)]).distinct()
    m = stage_table(m.withColumn("__hit", F.lit(True)), "members")      # stored: hot keys of df can be split
    cond = None
    for k in keys:
        c = df[k] == m["__m_" + k]
        cond = c if cond is None else cond & c
    out = df.join(m, cond, "left")
    return (out.withColumn(flag, F.coalesce(F.col("__hit"), F.lit(False)))
               .drop("__hit", *["__m_" + k for k in keys]))


def unmatched(df: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None,
              by=None) -> DataFrame:
    """JN-9: keys of ``df`` absent from ``dim``, counted (per ``by``)."""
    dk = dim_key or key
    d = dim.select(F.col(dk).alias("__dk")).filter(F.col("__dk").isNotNull())
    miss = df.filter(F.col(key).isNotNull()).join(d, F.col(key) == F.col("__dk"), "left_anti")
    return miss.groupBy(*(listify(by) + [key])).agg(F.count(F.lit(1)).alias("n_rows"))


def enrich_checked(df: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None):
    """JN-3: left join to a dimension plus a fan-out guard.

    Returns ``(enriched, dup_keys)``; ``dup_keys`` lists dimension keys that
    occur more than once (a non-empty frame means the join would fan out).
    Checking the right side's uniqueness costs one aggregate instead of
    counting the fact twice.
    """
    dk = dim_key or key
    dups = dim.groupBy(dk).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    d = dim.withColumnRenamed(dk, "__dk") if dk == key else dim
    joined = df.join(d, df[key] == d["__dk" if dk == key else dk], "left")
    return joined.drop("__dk" if dk == key else dk), dups


@dataclass(frozen=True)
class Enriched:
    """A stored left join and what its job counted."""
    table: DataFrame
    rows_before: int
    rows_after: int
    repeated: DataFrame | None      #: (key, n) of the dimension keys that multiply rows; None when no row was multiplied


def enrich_counted(df: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> Enriched:
    """JN-3: left join to a dimension that is stored, with a fan-out guard that costs no pass of its own.

    The job that stores the result counts the rows before and after the
    join.  Only when they differ is the dimension looked at for the keys that
    occur more than once.  (A task that is tried again below a shuffle can be
    counted twice; that costs a look, not a wrong answer.)
    """
    dk = dim_key or key
    before, after = Observation(), Observation()
    own = dim.withColumnRenamed(dk, "__dk")
    joined = df.observe(before, F.count(F.lit(1)).alias("n")).join(own, F.col(key) == F.col("__dk"), "left").drop("__dk")
    table = stage_table(joined.observe(after, F.count(F.lit(1)).alias("n")), "enriched")
    n, m = (int(counts_of(seen).get("n") or 0) for seen in (before, after))
    repeated = None
    if n != m:
        twice = dim.filter(F.col(dk).isNotNull()).groupBy(F.col(dk).alias(key)).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        repeated = stage_table(twice.join(df.select(key).distinct(), key, "left_semi"), "repeated-keys")
    return Enriched(table, n, m, repeated)


def fold_tiers(tiers, fields, key: str = "__key") -> DataFrame:
    """Several dimensions of one key as one table: ``key`` and, per field, the best tier that has a value and the value.

    ``tiers`` is ``[(number, dim, dim_key), ...]``; each dimension must be
    unique on its key.  One aggregate of their union, combined map-side.
    """
    parts = [dim.select(F.col(dkey).alias(key), F.lit(n).alias("__tier"),
                        *[(F.col(f) if f in dim.columns else F.lit(None)).alias(f) for f in fields])
             for n, dim, dkey in tiers]
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    filled = lambda f: F.when(F.col(f).isNotNull(), F.col("__tier"))
    picks = [F.struct(F.min(filled(f)).alias("tier"), F.min_by(F.col(f), filled(f)).alias("value")).alias(f) for f in fields]
    return both.filter(F.col(key).isNotNull()).groupBy(key).agg(*picks)


def enrich_tiers(df: DataFrame, tiers, fields) -> DataFrame:
    """JN-6: per-column fallback over several dimensions.

    ``tiers`` is ``[(dim, fact_key, dim_key), ...]`` in priority order; each
    dimension must be unique on its key.  For every field the first tier
    with a non-NULL value wins (``combine_first``), column by column.  Tiers
    that look up the same fact key are folded into one table first, so the
    fact is joined, and shuffled, once for each different key.
    """
    keys: dict[str, list] = {}
    for n, (dim, fkey, dkey) in enumerate(tiers):
        keys.setdefault(fkey, []).append((n, dim, dkey))
    out = df
    cells: dict[str, list] = {f: [] for f in fields}
    for i, (fkey, own) in enumerate(keys.items()):
        held = [f for f in fields if any(f in dim.columns for _, dim, _ in own)]
        folded = fold_tiers(own, held, key=f"__t{i}_key")
        out = lookup_join(out, folded.withColumnsRenamed({f: f"__t{i}_{f}" for f in held}), fkey, f"__t{i}_key")
        for f in held:
            cells[f].append(F.when(F.col(f"__t{i}_{f}.tier").isNotNull(), F.col(f"__t{i}_{f}")))
    merged = {f: F.lit(None) if not c else (c[0] if len(c) == 1 else F.array_min(F.array(*c)))["value"] for f, c in cells.items()}
    out = out.withColumns(merged)
    return out.drop(*[c for c in out.columns if c.startswith("__t")])


def fill_where(df: DataFrame, cond, dim: DataFrame, key: str, fields, dim_key=None) -> DataFrame:
    """PIPE-4b: for rows where ``cond`` holds, take ``fields`` from the dimension
    (one left join, then a per-column CASE); other rows keep their values."""
    dk = dim_key or key
    d = dim.select(F.col(dk).alias("__fk"), *[F.col(f).alias("__f_" + f) for f in fields])
    out = df.join(d, df[key] == d["__fk"], "left")
    out = out.withColumns({f: F.when(cond, F.col("__f_" + f)).otherwise(F.col(f)) for f in fields})
    return out.drop("__fk", *["__f_" + f for f in fields])


def resolve_ids(df: DataFrame, id_col: str, dim: DataFrame, dim_id_col: str,
                value_col: str, out_col: str, order_col: str | None = None):
    """JN-4: look up ``value_col`` by an identifier; returns ``(resolved, unresolved)``.

    The dimension is made unique on the identifier first (highest
    ``order_col`` wins) so a repeated id number cannot fan rows out.
    """
    d = dim.filter(F.col(dim_id_col).isNotNull())
    d = highest_per_key(d, [dim_id_col], order_col) if order_col else d.dropDuplicates([dim_id_col])
    d = d.select(F.col(dim_id_col).alias("__id"), F.col(value_col).alias(out_col))
    j = lookup_join(df, d, id_col, "__id")
    return j.filter(F.col(out_col).isNotNull()), j.filter(F.col(out_col).isNull())


@dataclass(frozen=True)
class Identifier:
    """One kind of identifier: how a value of it looks, its normal form, and the dimensions that know it.

    ``dims`` is ``[(dim, key_col, value_col, order_col), ...]`` in priority
    order: an identifier that several know takes the first one's value, and
    the highest ``order_col`` inside one.
    """
    kind: str
    looks: Callable[[Column], Column]
    normal: Callable[[Column], Column]
    dims: tuple


def resolve_identifiers(df: DataFrame, col: str, kinds, out: str, outcome: str = "outcome") -> DataFrame:
    """JN-4 / T15: a column that mixes kinds of identifiers, resolved by kind in one join.

    A value belongs to the first kind that it looks like.  All dimensions
    become one table keyed by (kind, identifier), which is joined once.
    ``outcome`` is ``<kind>`` for a resolved row, ``unknown <kind>`` where no
    dimension knows the value, ``unreadable`` where it looks like none and
    ``missing`` where it is NULL or blank; ``out`` is NULL in those.
    """
    raw = F.col(col)
    parts, kind, normal = [], None, None
    for k in kinds:
        kind = F.when(k.looks(raw), k.kind) if kind is None else kind.when(k.looks(raw), k.kind)
        normal = F.when(k.looks(raw), k.normal(raw)) if normal is None else normal.when(k.looks(raw), k.normal(raw))
        for n, (dim, key_col, value_col, order_col) in enumerate(k.dims):
            parts.append(dim.select(F.lit(k.kind).alias("__kind"), k.normal(F.col(key_col)).alias("__id"),
                                    F.struct(F.lit(-n).alias("tier"), F.col(order_col).cast("decimal(38,0)").alias("o"),
                                             F.col(value_col).alias("v")).alias("__best")))
    known = parts[0]
    for p in parts[1:]:
        known = known.unionByName(p)
    known = (known.filter(F.col("__id").isNotNull() & F.col("__best.v").isNotNull())
             .groupBy(F.concat_ws(":", "__kind", "__id").alias("__known")).agg(F.max("__best").alias("__best")))
    tagged = df.withColumn("__kind", kind)
    joined = lookup_join(tagged, known, F.when(F.col("__kind").isNotNull(), F.concat_ws(":", "__kind", normal)), "__known")
    state = (F.when(F.coalesce(F.trim(raw), F.lit("")) == "", "missing").when(F.col("__kind").isNull(), "unreadable")
             .when(F.col("__best").isNull(), F.concat(F.lit("unknown "), F.col("__kind"))).otherwise(F.col("__kind")))
    return joined.withColumns({out: F.col("__best.v"), outcome: state}).drop("__kind", "__best")


def align_full(a: DataFrame, b: DataFrame, keys, a_val: str, b_val: str) -> DataFrame:
    """JN-11: full outer alignment of two keyed series, missing side = 0."""
    keys = listify(keys)
    j = a.join(b, keys, "full_outer")
    return j.withColumns({a_val: F.coalesce(F.col(a_val), F.lit(0)),
                          b_val: F.coalesce(F.col(b_val), F.lit(0))})
