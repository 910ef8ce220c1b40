"""Deduplication and multiset operators (DED-1..11, SET-4).

Scale notes.  ``row_number() == 1`` lets Catalyst insert a partial
``WindowGroupLimit`` before the shuffle, so a key holding a third of all
rows is cut to one row per map task before it is exchanged.  Duplicate
listings use an aggregate (map-side combine) plus a join instead of a
``count() over (partition by key)`` window, so no task ever has to hold a
whole hot group.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._keys import listify, null_safe_on

_RN = "__rn"


def latest_preferred(df: DataFrame, keys, order) -> DataFrame:
    """DED-1 / WIN-4: one row per key, the first in ``order`` (``DISTINCT ON``).

    ``order`` is a list of sort Columns with explicit null placement, e.g.
    ``[F.desc_nulls_first(pref), F.desc_nulls_first("date_created"), F.desc("id")]``;
    PostgreSQL's ``DESC`` puts NULL first (T2), Spark's puts it last.
    """
    w = Window.partitionBy(*listify(keys)).orderBy(*listify(order))
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def keep_first(df: DataFrame, keys, order, exempt: Column | None = None,
               skew_safe: bool = False) -> DataFrame:
    """DED-2/4/8/9: keep the first row per key in ``order``; a later row with
    the same key is dropped unless ``exempt`` is true for it (pandas
    ``~duplicated(keys) | exempt``).  NULL key values group together and a
    NULL ``exempt`` is not an exemption.

    Without an exemption this is ``rn == 1`` and gets the partial top-1
    before the shuffle; with one, every row of a key is ranked --
    ``skew_safe`` (order given as column names, last one integral) spreads a
    hot key over bounded buckets (see ``windows.row_number_in_key``).  Where
    the exemption names key columns only, ``skew_safe`` ranks nothing: exempt
    rows pass without a shuffle and the other keys are found as without an
    exemption, which reads ``df`` twice.
    """
    from .windows import row_number_in_key
    keys = listify(keys)
    if exempt is None:
        return latest_preferred(df, keys, order)
    spared = F.coalesce(exempt, F.lit(False))
    if skew_safe and _resolves(df.select(*keys), exempt):
        return latest_preferred(df, keys, order).filter(~spared).unionByName(df.filter(spared))
    return row_number_in_key(df, keys, order, _RN, skew_safe).filter((F.col(_RN) == 1) | spared).drop(_RN)


def keep_first_passes(df: DataFrame, passes, order) -> DataFrame:
    """DED-3/4: several ``keep_first`` passes in one order, made by one exchange.

    ``passes`` is ``[(keys, exempt), ...]``.  Rows that share the keys of a
    pass must share those of every later one, and ``exempt`` (or None) may
    only depend on the keys of its pass.  Then a row is dropped exactly where
    it is not the first of the rows that share the keys of the last pass that
    does not spare them: earlier passes only remove rows behind the first,
    later ones spare it.  That is one ``rn == 1`` over the pass's number and
    keys, cut before the shuffle.  Rows that every pass spares are not
    exchanged; where there can be any, ``df`` is read twice.
    """
    last, held = F.lit(None).cast("int"), {}
    for n, (keys, exempt) in enumerate(passes):
        last = F.lit(n) if exempt is None else F.when(~F.coalesce(exempt, F.lit(False)), F.lit(n)).otherwise(last)
        for k in listify(keys):
            held.setdefault(k, []).append(n)
    # the column of a key that not all passes have is NULL in the others; the number tells them apart
    group = [F.col(k) if len(own) == len(passes) else F.when(last.isin(own), F.col(k)) for k, own in held.items()]
    if any(exempt is None for _, exempt in passes):
        return latest_preferred(df, [last, *group], order)
    return latest_preferred(df.filter(last.isNotNull()), [last, *group], order).unionByName(df.filter(last.isNull()))


def _resolves(df: DataFrame, c: Column) -> bool:
    """Whether ``c`` only names columns of ``df``."""
    try:
        df.select(c)
    except AnalysisException:
        return False
    return True


def highest_per_key(df: DataFrame, keys, id_col: str) -> DataFrame:
    """DED-2: keep the row with the highest non-NULL ``id_col`` per key."""
    return keep_first(df, keys, [F.desc_nulls_last(id_col)])


def drop_exact_duplicates(df: DataFrame, subset=None) -> DataFrame:
    """DED-3 / DED-10: exact duplicate rows (NULL-safe) collapse to one."""
    return df.dropDuplicates(listify(subset) or None)


def duplicate_report(df: DataFrame, by) -> DataFrame:
    """DED-3 report: rows removed by exact dedup, per ``by`` group."""
    cols = df.columns
    return (df.groupBy(*cols).count()
              .groupBy(*listify(by))
              .agg(F.sum(F.col("count") - 1).cast("bigint").alias("duplicates_removed")))


def duplicate_members(df: DataFrame, keys) -> DataFrame:
    """DED-7: every row whose key occurs more than once (NULL keys equal)."""
    keys = listify(keys)
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1).drop("count")
    return df.join(dup, null_safe_on(df, dup, keys), "left_semi")


def key_violations(df: DataFrame, keys) -> DataFrame:
    """DED-11: keys that are not unique, with their multiplicity."""
    return (df.groupBy(*listify(keys)).agg(F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") > 1))


def cross_source_repeats(df: DataFrame, keys, source: str = "source") -> DataFrame:
    """DED-6: keys reported more than once by more than one source.

    Rows with a NULL key are left out, as a pandas ``groupby`` would.
    """
    keys = listify(keys)
    nonnull = df.filter(F.greatest(*[F.col(k).isNull() for k in keys]) == F.lit(False))
    return (nonnull.groupBy(*keys)
                   .agg(F.count(F.lit(1)).alias("n_rows"),
                        F.count_distinct(source).alias("n_sources"))
                   .filter((F.col("n_rows") > 1) & (F.col("n_sources") > 1)))


def drop_covered(live: DataFrame, state: DataFrame, keys, order, covered=None,
                 skew_safe: bool = False):
    """DED-5 / SET-4: remove from ``live`` the rows already present in ``state``.

    Multiset semantics: if the state holds a key ``c`` times, the first ``c``
    covered live rows with that key (in ``order``) are dropped; any further
    copies survive and are returned as back-fills.  ``covered`` restricts
    which live rows may be matched at all (e.g. ``date <= covered_through``).
    Keys compare NULL-safely.  Returns ``(kept, dropped)``.

    Where a key's rows are few by construction, the keys of the state and the
    covered live rows meet in one window, the state's first.  With
    ``skew_safe`` the state is reduced to one count per key by an aggregate
    (combined map-side) and joined NULL-safely to the covered live rows; only
    those whose key it holds are ranked inside their key.  Uncovered rows are
    not exchanged at all.
    """
    from .windows import row_number_in_key
    keys = listify(keys)
    if not skew_safe:
        cand = F.coalesce(covered, F.lit(True)) if covered is not None else F.lit(True)
        both = live.filter(cand).withColumn("__held", F.lit(0)).unionByName(
            state.select(*keys, F.lit(1).alias("__held")), allowMissingColumns=True)
        w = Window.partitionBy(*keys).orderBy(F.desc("__held"), *listify(order))
        met = both.withColumns({"__rank": F.row_number().over(w), "__c": F.sum("__held").over(
            w.rowsBetween(Window.unboundedPreceding, Window.currentRow))}).filter("__held = 0")
        again = F.col("__rank") - F.col("__c") <= F.col("__c")     # its place among the live rows
        kept, dropped = (met.filter(c).select(*live.columns) for c in (~again, again))
        return live.filter(~cand).unionByName(kept), dropped
    counts = state.groupBy(*keys).agg(F.count(F.lit(1)).alias("__c"))
    c = counts.select(*[F.col(k).alias("__k_" + k) for k in keys], "__c")
    cand = F.coalesce(covered, F.lit(True)) if covered is not None else F.lit(True)
    flagged = live.filter(cand)
    # filtered twice, the join's exchanges are made once
    joined = flagged.join(c, null_safe_on(flagged, c, keys, ["__k_" + k for k in keys]), "left").drop(*["__k_" + k for k in keys])
    ranked = row_number_in_key(joined.filter("__c IS NOT NULL"), keys, order, "__rank", skew_safe)
    drop_me = F.col("__rank") <= F.col("__c")
    kept = joined.filter("__c IS NULL").drop("__c").unionByName(ranked.filter(~drop_me).drop("__c", "__rank"))
    return live.filter(~cand).unionByName(kept), ranked.filter(drop_me).drop("__c", "__rank")
