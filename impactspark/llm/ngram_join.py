"""N-gram Jaccard join by a grouped prefix join.

Documents link when the Jaccard similarity of their sets of distinct 5-word
shingles is at least 0.8.  The shingles of every set are put in one global
order, rare ones first; two sets that link share a shingle among the first
``n - ceil(0.8 n) + 1`` of each (the prefix).

1. Documents with the same prefix and size form one group; only the group's
   head posts its prefix, and lists with one head go at once.
2. The heads of each list pair with one of them; pairs that meet in many
   lists are verified, and so are the other sets of a group with its head,
   which connects most of what is close.
3. Lists whose groups are not connected with all their sets (a head's links
   say nothing of its group's other sets) give group pairs: by size, by the places
   of the shared shingle and the number of shared ones, then by the whole
   prefixes.  What passes is expanded to the groups' members and verified.
4. The alike heads of a long list, a group of several sets and an expanded
   pair of such groups become a *family*: its members are kept as their differences from
   one of them, the pivot (see ``_families``).  Differences give the distance
   of any two members without their texts, and members that differ in the
   same shared shingles form one group again, so a family costs pairs of
   groups of differences and not pairs of members.

Two sets link when ``(100 + percent)`` times the size of their symmetric
difference is at most ``(100 - percent)`` times the sum of their sizes; all
bounds below are this one.  No link between different components is lost.

The global order is the load of a shingle's cell in a fixed-size table of
counts over all shingles of all documents, then its hash.  Any order gives
the same links; this one keeps frequent passages out of the prefixes.  Sets
hold 64-bit hashes.

Null or empty texts have no shingles and link with nothing; equal texts are
one set; a row without an id links with nothing and has a null component;
an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import free_name, released, staged, stored_bytes
from .components import connected_components
from .texthash import mix, shingle_sets

WORDS, PERCENT = 5, 80
#: Share of a prefix that a pair with a list's pivot must have in common in lists with the same pivot.
FIRST_SHARE = 0.3
#: Lists of up to this many heads give all their pairs; of larger ones, heads whose lists have this share of their
#: prefix in common with the pivot are a family, and only pairs with others are made.
DIRECT, FAMILY_SHARE = 16, 0.25
#: A head is joined on the pivot of its lists where they are more than this many and this share of its prefix.
FEW, OFTEN_SHARE = 4, 0.125
#: Cells of the count table and cells of one block of it (fixed size: 4 MB, whatever the input).
CELLS, BLOCK = 1 << 20, 1 << 14
#: Ids are broadcast only when their stored table has at most this many bytes, else joined by shuffle.
BROADCAST_BYTES = 8 << 20

_SHIFT = np.uint64(64 - 20)


def _texts(column: pd.Series) -> list[str]:
    return [t if isinstance(t, str) else "" for t in column]


def cell_loads(docs: DataFrame, text: str) -> np.ndarray:
    """Counts of all shingles of all documents by cell; what reaches the driver is the fixed-size table."""
    @released
    def count(batches):
        total = np.zeros(CELLS, np.int64)
        for df in batches:
            sets = shingle_sets(_texts(df["text"]), WORDS)
            total += np.bincount((np.concatenate([*sets, np.empty(0, np.uint64)]) >> _SHIFT).astype(np.int64),
                                 minlength=CELLS)
        yield pd.DataFrame({"block": range(CELLS // BLOCK),
                            "counts": [x.astype("<i4").tobytes() for x in np.minimum(total, 2**31 - 1).reshape(-1, BLOCK)]})

    @released
    def add(batches):
        total: dict[int, np.ndarray] = {}
        for df in batches:
            for k, x in zip(df["block"], df["counts"], strict=True):
                got = np.frombuffer(x, "<i4").astype(np.int64)
                total[k] = total[k] + got if k in total else got
        if total:
            yield pd.DataFrame({"block": list(total), "counts": [x.astype("<i8").tobytes() for x in total.values()]})

    schema = "block int, counts binary"
    parts = docs.select(F.col(f"`{text}`").alias("text")).mapInPandas(count, schema)
    rows = parts.repartition("block").mapInPandas(add, schema).collect()
    loads = np.zeros(CELLS, np.int64)
    for r in rows:
        loads[r["block"] * BLOCK:(r["block"] + 1) * BLOCK] = np.frombuffer(r["counts"], "<i8")
    return loads


def prefix_length(n: int, percent: int) -> int:
    return n - -(-n * percent // 100) + 1


def _prefixes(docs: DataFrame, loads, percent: int) -> DataFrame:
    """``(id, n, set digest, prefix digest, prefix)`` of every document."""
    @released
    def run(batches):
        load = loads.value
        for df in batches:
            rows = []
            for i, s in zip(df["id"], shingle_sets(_texts(df["text"]), WORDS), strict=True):
                n = len(s)
                if n == 0:
                    rows.append((i, 0, 0, 0, 0, np.empty(0, np.int64)))
                    continue
                p = prefix_length(n, percent)
                order = np.lexsort((s, load[(s >> _SHIFT).astype(np.int64)]))
                first = s[order[:p]]
                with np.errstate(over="ignore"):
                    d1, d2 = mix(s).sum(dtype=np.uint64), mix(s ^ np.uint64(0x5555555555555555)).sum(dtype=np.uint64)
                    g = mix(mix(first) * np.arange(1, p + 1, dtype=np.uint64)).sum(dtype=np.uint64)
                rows.append((i, n, *(int(x.astype(np.int64)) for x in (d1, d2, g)), first.astype(np.int64)))
            yield pd.DataFrame(rows, columns=["id", "n", "d1", "d2", "g", "prefix"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInPandas(run, f"id {kind}, n bigint, d1 bigint, d2 bigint, g bigint, prefix array<bigint>")


def _prefix(n: Column, percent: int) -> Column:
    """``prefix_length`` of a column."""
    return n - F.ceil(n * percent / 100) + 1


def _bounded(ids: DataFrame) -> DataFrame:
    """``ids`` (staged), broadcast when its stored size is bounded."""
    return F.broadcast(ids) if stored_bytes(ids) <= BROADCAST_BYTES else ids


def _least_common(nx: Column, ny: Column, percent: int) -> Column:
    """How many prefix shingles two sets of these sizes must share at least in order to link.

    They need ``percent / (100 + percent)`` of both sizes in common, and of
    one set no more than what lies beyond its prefix can be common outside
    the prefixes.
    """
    beyond = F.greatest(nx - _prefix(nx, percent), ny - _prefix(ny, percent))
    return F.ceil((nx + ny) * percent / (100 + percent)) - beyond


def _with_both(pairs: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
    """``pairs`` with the columns of ``table`` (keyed by id) for u and for v, suffixed."""
    for end in ("u", "v"):
        side = table.select(F.col("id").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in columns])
        pairs = pairs.join(side, end)
    return pairs


def _ends(pairs: DataFrame, *columns: str) -> DataFrame:
    """The ids in these columns, once."""
    return staged(pairs.select(F.explode(F.array(*columns)).alias("id")).distinct(), "join-needed")


def _share_prefixes(pairs: DataFrame, coded: DataFrame, percent: int) -> DataFrame:
    """The pairs (columns u and v) whose prefixes, a fifth of the sets, share enough for a link."""
    pairs = staged(pairs, "join-pairs")
    prefixes = coded.select("id", "n", "prefix").join(_bounded(_ends(pairs, "u", "v")), "id", "left_semi")
    shared = F.size(F.array_intersect("prefix_u", "prefix_v"))
    both = _with_both(pairs, staged(prefixes, "join-some-prefixes"), "n", "prefix")
    return staged(both.where(shared >= _least_common(F.col("n_u"), F.col("n_v"), percent)).select("u", "v"), "join-pairs")


def _sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``(id, s)``: the whole sets of these ids, read again from their texts."""
    @released
    def run(batches):
        for df in batches:
            sets = shingle_sets(_texts(df["text"]), WORDS)
            yield pd.DataFrame({"id": df["id"], "s": [s.astype(np.int64) for s in sets]})

    kind = docs.schema["id"].dataType.simpleString()
    return staged(docs.join(_bounded(ids), "id", "left_semi").mapInPandas(run, f"id {kind}, s array<bigint>"), "join-sets")


def _verify(pairs: DataFrame, docs: DataFrame, coded: DataFrame, percent: int) -> DataFrame:
    """The pairs (columns u and v) whose whole sets reach the similarity.

    First the prefixes are intersected; only pairs that share enough of them
    have their texts read again.
    """
    pairs = _share_prefixes(pairs, coded, percent)
    both = _with_both(pairs, _sets(docs, _ends(pairs, "u", "v")), "s")
    common = F.size(F.array_intersect("s_u", "s_v"))
    return both.where(100 * common >= percent * (F.size("s_u") + F.size("s_v") - common)).select("u", "v").distinct()


def _lists(coded: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(sets, members, lists)``.

    ``sets``: each distinct set with its first id; ``members``: ``(head,
    rep)`` for the groups of several sets; ``lists``: the prefix shingles
    that several heads share.
    """
    sets = staged(coded.where("n > 0 and id is not null").groupBy("g", "n", "d1", "d2").agg(F.min("id").alias("rep")),
                  "join-classes")
    groups = staged(sets.groupBy("g", "n").agg(F.min("rep").alias("head"), F.count("*").alias("sets")), "join-groups")
    heads = groups.select(F.col("head").alias("id"))
    rest = staged(coded.select("id").join(heads, "id", "left_anti").distinct(), "join-rest")
    posts = (coded.where("n > 0 and id is not null").join(_bounded(rest), "id", "left_anti")
             .select("id", "n", F.posexplode("prefix").alias("pos", "token")))
    own = Window.partitionBy("token")
    lists = posts.withColumn("heads", F.count("*").over(own)).where("heads > 1")
    lists = staged(lists, "join-lists")
    # a head's prefix shingles in any list, and how often other heads have one of them
    held = staged(lists.groupBy("id").agg(F.count("*").alias("shared"), F.sum("heads").alias("met")), "join-held")
    lists = lists.join(held, "id")
    many = staged(groups.where("sets > 1").select("g", "n", "head"), "join-many")
    members = staged(sets.join(many, ["g", "n"]).select("head", "rep"), "join-members")
    return sets, members, lists


def _star_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """Pairs of each list's heads with the smallest of them, by steps of size (100 / percent)."""
    step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent)))
    span = Window.partitionBy("token", "step")
    both = lists.withColumn("step", step).withColumn("pivot", F.min("id").over(span)).where("pivot != id")
    return (both.groupBy(F.col("pivot").alias("u"), F.col("id").alias("v"))
            .agg(F.count("*").alias("c"), F.max("n").alias("n"))
            .where(F.col("c") >= FIRST_SHARE * _prefix(F.col("n"), percent)).select("u", "v"))


def _group_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of heads of a list that no family holds, whose groups are not all connected, and that could link.

    ``label``: the component of all sets of a head's group, null if they have several.

    They could by their sizes, by the places of the list's shingle, and by
    how many of their prefix shingles are in any list at all.

    They meet once for each pivot: heads that are in many lists of one pivot
    are joined on it, with their shingles of those lists; a head that is in
    few of them is joined on each shingle.
    """
    held = F.sort_array(F.collect_list(F.struct("rest", "token")), asc=False)
    tied = (rows.groupBy("pivot", (F.col("heads") > DIRECT).alias("long"), "id", "n", "label", "shared", "of_family").agg(held.alias("s"))
            .withColumn("often", (F.size("s") > FEW) & (F.size("s") >= OFTEN_SHARE * _prefix(F.col("n"), percent))))
    tied = staged(tied, "join-heads")
    col = lambda c: (F.col(f"x.{c}"), F.col(f"y.{c}"))
    nx, ny = col("n")
    least = _least_common(nx, ny, percent)
    could = (~(F.col("x.of_family") & F.col("y.of_family")) & F.coalesce(F.col("x.label") != F.col("y.label"), F.lit(True))
             & (100 * F.least(nx, ny) >= percent * F.greatest(nx, ny)) & (F.least(*col("shared")) >= least))
    # the first shingle that a linking pair shares has the others that it must share behind it
    first = lambda a: F.transform(F.filter(F.col(f"{a}.s"), lambda t: t["rest"] >= least), lambda t: t["token"])
    many = tied.where("often")
    x, y = many.alias("x"), many.alias("y")
    made = x.join(y, (F.col("x.pivot") == F.col("y.pivot")) & (F.col("x.long") == F.col("y.long")) & (F.col("x.id") < F.col("y.id"))
                  & could & F.arrays_overlap(first("x"), first("y")))
    posts = tied.select("id", "n", "label", "shared", "of_family", "often", F.inline("s"))
    x, y = posts.where("not often").alias("x"), posts.alias("y")
    few = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.id") != F.col("y.id"))
                 & (F.col("y.often") | (F.col("x.id") < F.col("y.id"))) & could & (F.least(*col("rest")) >= least))
    pairs = made.select(F.col("x.id").alias("u"), F.col("y.id").alias("v"))
    return pairs.unionByName(few.select(F.least(*col("id")).alias("u"), F.greatest(*col("id")).alias("v"))).distinct()


def _families(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """``(pivot, id, n, d, w, delta)`` of the members of each family, the pivot among them.

    ``delta`` is the symmetric difference of a member and its pivot, ``d`` its
    size.  With ``w = (100 + percent) d - (100 - percent) n`` two members of a
    family link exactly when ``w_x + w_y <= 2 (100 + percent) |delta_x & delta_y|``.
    """
    pairs = staged(pairs.distinct(), "join-families")
    sets = _sets(docs, _ends(pairs, "pivot", "id"))
    both = (pairs.join(sets.select("id", "s"), "id")
            .join(sets.select(F.col("id").alias("pivot"), F.col("s").alias("p")), "pivot"))
    delta = both.select("pivot", "id", F.size("s").alias("n"),
                        F.concat(F.array_except("s", "p"), F.array_except("p", "s")).alias("delta"))
    weighed = delta.withColumn("d", F.size("delta")).withColumn("w", (100 + percent) * F.col("d") - (100 - percent) * F.col("n"))
    return staged(weighed.dropDuplicates(["pivot", "id"]), "join-deltas")


def _near_links(families: DataFrame) -> DataFrame:
    """Links of members that are close whatever their differences share.

    These are the pairs with ``w_x + w_y <= 0``; each member of one links to
    the member of least ``w``, so links to that one connect them all.
    """
    least = families.groupBy("pivot").agg(F.min(F.struct("w", "id")).alias("m"))
    return (families.select("pivot", "id", "w").join(staged(least, "join-nearest"), "pivot")
            .where("w + m.w <= 0 and id != m.id").select(F.col("m.id").alias("u"), F.col("id").alias("v")))


def _signature(tokens: Column) -> Column:
    """64 bits of an array of hashes: the bits that its members set."""
    bit = lambda t: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(t, F.lit(64)).cast("int"))
    return F.aggregate(tokens, F.lit(0).cast("bigint"), lambda bits, t: bits.bitwiseOR(bit(t)))


def _far_links(families: DataFrame, known: DataFrame, percent: int, star: bool = False) -> DataFrame:
    """Links of members of different components whose differences from the pivot share enough.

    ``star``: only those of each list of a shared difference with its member of least ``w``, which are no more than
    the list is long; they connect most of a dense family, whose links among all would grow with its square.

    Shingles that one member of the family differs in are never shared; what
    is left, rare ones first, is joined like prefixes.  Members of the same
    size, number of differences and shared ones are one group: a pair of
    groups links with all members or none, so its heads are verified, and a
    group that links to any is connected.
    """
    twice = 2 * (100 + percent)
    label = F.coalesce("component", F.col("id"))
    named = families.join(known.withColumnRenamed("id", "of"), F.col("id") == F.col("of"), "left").withColumn("label", label)
    named = staged(named.drop("of", "component"), "join-named")
    # a family that is connected throughout has nothing left to find
    apart = named.groupBy("pivot").agg(F.min("label").alias("a"), F.max("label").alias("b"), F.min("w").alias("least")).where("a != b")
    apart = staged(apart.select("pivot", "least"), "join-apart")
    named = named.join(apart.select("pivot"), "pivot", "left_semi")
    each = named.select("pivot", "id", "n", "d", "w", "label", F.explode("delta").alias("token"))
    counts = staged(each.groupBy("pivot", "token").agg(F.count("*").alias("c")).where("c > 1"), "join-differences")
    named = staged(each.join(counts, ["pivot", "token"]).groupBy("pivot", "id", "n", "d", "w", "label")
                   .agg(F.array_sort(F.collect_list(F.struct("c", "token"))).alias("s"))
                   .withColumn("shared", F.col("s.token")).drop("s"), "join-shared")
    groups = staged(named.groupBy("pivot", "n", "d", "w", "shared").agg(
        F.min("id").alias("head"), F.count("*").alias("members"), F.min("label").alias("a"), F.max("label").alias("b")), "join-delta-groups")

    posts = (groups.join(apart, "pivot")
             .select("pivot", "head", "w", "a", "b", "least", F.size("shared").alias("size"), _signature(F.col("shared")).alias("bits"),
                     F.posexplode("shared").alias("pos", "token"))
             .withColumn("rest", F.col("size") - F.col("pos"))
             .where(twice * F.col("rest") >= F.col("w") + F.col("least")).drop("pos", "least"))
    posts = staged(posts, "join-delta-posts")
    least = F.min(F.struct("w", "head", *[c for c in posts.columns if c not in ("pivot", "token", "w", "head")]))
    first = posts.groupBy("pivot", "token").agg(least.alias("m")).select("pivot", "token", "m.*") if star else posts
    x, y = first.alias("x"), posts.alias("y")
    col = lambda c: (F.col(f"x.{c}"), F.col(f"y.{c}"))
    total = F.col("x.w") + F.col("y.w")
    # each bit that only one of them has stands for a shingle, at least, that the other lacks
    own = lambda a, b: F.col(f"{a}.size") - F.bit_count(F.col(f"{a}.bits").bitwiseAND(F.bitwise_not(F.col(f"{b}.bits"))))
    made = x.join(y, (F.col("x.pivot") == F.col("y.pivot")) & (F.col("x.token") == F.col("y.token"))
                  & (F.col("x.head") != F.col("y.head") if star else F.col("x.head") < F.col("y.head")) & (total > 0)
                  & (twice * F.least(*col("rest"), own("x", "y"), own("y", "x")) >= total)
                  & ~((F.col("x.a") == F.col("x.b")) & (F.col("y.a") == F.col("y.b")) & (F.col("x.a") == F.col("y.a"))))
    pairs = staged(made.select("x.pivot", F.col("x.head").alias("u"), F.col("y.head").alias("v")).distinct(), "join-delta-pairs")
    for end in ("u", "v"):
        pairs = pairs.join(groups.select("pivot", F.col("head").alias(end), F.col("w").alias(f"w_{end}"),
                                         F.col("shared").alias(f"s_{end}")), ["pivot", end])
    linked = staged(pairs.where(twice * F.size(F.array_intersect("s_u", "s_v")) >= F.col("w_u") + F.col("w_v"))
                    .select("pivot", "u", "v"), "join-links")
    # groups whose members are connected: by each other, or by a group that all of them link to
    own = groups.where((F.col("members") > 1) & (twice * F.size("shared") >= 2 * F.col("w"))).select("pivot", "head")
    met = linked.select("pivot", F.explode(F.array("u", "v")).alias("head"))
    one = staged(own.unionByName(met).distinct(), "join-one")
    inside = (named.join(groups.where("members > 1").join(one, ["pivot", "head"]).select("pivot", "n", "d", "w", "shared", "head"),
                         ["pivot", "n", "d", "w", "shared"])
              .where("id != head").select(F.col("head").alias("u"), F.col("id").alias("v")))
    return linked.select("u", "v").unionByName(inside).distinct()


def link_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of every row; see the module's docstring."""
    spark = docs.sparkSession
    own = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    loads = spark.sparkContext.broadcast(cell_loads(own, "text"))
    coded = staged(_prefixes(own, loads, percent), "join-prefixes")
    sets, members, lists = _lists(coded)

    first = staged(_verify(_star_pairs(lists, percent), own, coded, percent), "join-links")
    groups = _families(members.select(F.col("head").alias("pivot"), F.col("rep").alias("id")), own, percent)
    known = staged(connected_components(first.unionByName(_near_links(groups))), "join-known")

    # lists whose heads' groups are not all connected, with every set of theirs
    label = F.coalesce("component", "id")
    spans = staged(members.select("head", F.col("rep").alias("id")).join(known, "id", "left")
                   .groupBy(F.col("head").alias("id")).agg(F.min(label).alias("low"), F.max(label).alias("high")), "join-spans")
    # no label where a group's sets have several
    named = lists.join(known, "id", "left").join(spans, "id", "left").select(
        "token", "id", "n", "pos", "heads", "shared", "met", F.when(F.coalesce(F.col("low") == F.col("high"), F.lit(True)), label).alias("label"))
    span = Window.partitionBy("token")
    open_ = named.withColumn("a", F.min("label").over(span)) \
        .withColumn("b", F.when(F.count("label").over(span) == F.col("heads"), F.max("label").over(span))) \
        .withColumn("pivot", F.max(F.struct("met", "id")).over(span)["id"]).where("a != b or b is null").drop("a", "b", "met")
    open_ = staged(open_.withColumn("rest", _prefix(F.col("n"), percent) - F.col("pos")).drop("pos"), "join-mixed")
    # in a list of many heads, those that have much in common with its pivot are a family; all other pairs are made
    related = open_.where(F.col("heads") > DIRECT).groupBy("pivot", "id").agg(F.count("*").alias("c"), F.max("n").alias("n")) \
        .where((F.col("c") >= FAMILY_SHARE * _prefix(F.col("n"), percent)) | (F.col("id") == F.col("pivot")))
    related = staged(related.select("pivot", "id", F.lit(True).alias("of_family")), "join-related")
    open_ = open_.join(related, ["pivot", "id"], "left").withColumn(
        "of_family", F.coalesce("of_family", F.lit(False)) & (F.col("heads") > DIRECT))
    near = _share_prefixes(_group_pairs(open_, percent), coded, percent)
    several = spans.select("id")
    with_u = near.join(several.withColumnRenamed("id", "u"), "u", "left_semi")
    with_v = near.join(several.withColumnRenamed("id", "v"), "v", "left_semi")
    grouped = staged(with_u.unionByName(with_v.select("u", "v")).distinct(), "join-grouped")
    alone = near.join(grouped, ["u", "v"], "left_anti")
    more = staged(_verify(alone, own, coded, percent), "join-links")

    # families of heads, then of all their groups' members
    heads = (related.select("pivot", "id")
             .unionByName(grouped.select(F.col("u").alias("pivot"), F.col("v").alias("id"))))
    heads = staged(heads.unionByName(heads.select("pivot", F.col("pivot").alias("id"))).distinct(), "join-family-heads")
    expanded = heads.join(members.withColumnRenamed("head", "id"), "id").select("pivot", F.col("rep").alias("id"))
    families = _families(heads.unionByName(expanded), own, percent)
    # a family of heads whose pivot stands for a group holds that group too
    families = families.unionByName(groups.join(heads.select("pivot").distinct(), "pivot", "left_anti"))
    edges = known.select(F.col("id").alias("u"), F.col("component").alias("v")).unionByName(more).unionByName(_near_links(families))
    known = staged(connected_components(edges), "join-known")
    stars = staged(_far_links(families, known, percent, star=True), "join-links")
    known = staged(connected_components(known.select(F.col("id").alias("u"), F.col("component").alias("v")).unionByName(stars)), "join-known")
    last = staged(_far_links(families, known, percent), "join-links")
    final = staged(connected_components(known.select(F.col("id").alias("u"), F.col("component").alias("v"))
                                        .unionByName(last)), "join-components")

    labelled = staged(sets.join(final, sets["rep"] == final["id"], "left").select(
        "g", "n", "d1", "d2", F.coalesce("component", "rep").alias("component_id")), "join-labels")
    slim = coded.select("id", "n", "d1", "d2", "g")
    found = slim.where("n > 0 and id is not null").join(labelled, ["g", "n", "d1", "d2"]).select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")
    alone = slim.where("n = 0 or id is null").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("id").alias("component_id"))
    return found.unionByName(alone)


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One document of each component stays (the smallest id); rows without an id or words stay."""
    ids = free_name(docs, "_id")
    found = link_components(docs, doc_id, text, percent)
    gone = staged(found.where("doc_id != component_id").select(F.col("doc_id").alias(ids)).distinct(), "join-dropped")
    return docs.join(_bounded(gone), docs[doc_id] == F.col(ids), "left_anti")
