"""Embedding near-dedup by a join of tiles whose vectors are stored once.

Vectors are scaled to length 1 and rotated, so that few leading axes carry
most of the spread.  A label's points are laid in tiles of bounded size, a
binary row each; a label of several tiles has its points dealt to them by
their nearest pivot.  Tiles of a label meet pairwise by reading them again,
not by copies of their points, so what is written grows with the input only,
however large a label is; the pairs that are looked at still grow with the
square of a label.

Three exact bounds keep that small.  With ``e`` the distance that the cosine
allows, points x of pivot p and y of pivot q link only if
``(x - y) (p - q) <= e |p - q|``; what passes links only if the leading axes
and the lengths of the rest allow the cosine; and what passes that is
computed on all axes, where single precision is in doubt once more in double
precision from the vectors as given.

The rotation, the number of leading axes and the pivots are taken from a
bounded sample (``SAMPLE`` vectors with the smallest hashes); they decide
speed, never the result.  Equal vectors of a label are one point with a
weight.  No pairs are returned: each pair of tiles sums link counts and sends
every vector's local component, from which the components follow.

Only vectors with equal, non-null labels are compared.  A vector that is
null, zero or of odd length, or that holds null or non-finite components,
links with nothing; so does a row without an id (its component is null, it
is not kept).  Repeated rows count as vectors of their own; an empty table
gives an empty result.
"""

from __future__ import annotations

import contextlib
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import released, staged, stored_bytes
from .components import connected_components

COSINE = 0.93
BLOCKS, SAMPLE = 8, 2000
#: Points of a tile (also bounded by bytes) and pairs that are verified at once in double precision.
TILE, TILE_BYTES, PAIRS = 16_384, 4 << 20, 50_000
#: Pivots of a tile, on average, and rows and columns of the matrix that is compared at once.
PIVOTS, ROWS, COLUMNS = 16, 512, 1024
#: Share of the sample's pairs that may pass the leading axes without a link.
PASSING = 1e-5
#: Vectors of one Arrow batch; stored bytes of tiles that one task reads of each side.
BATCH, READ_BYTES = 1024, 64 << 20
#: Tables of labels and copies are broadcast only when stored in at most this many bytes, else joined by shuffle.
BROADCAST_BYTES = 8 << 20


@contextlib.contextmanager
def _batches(spark: SparkSession, rows: int):
    """Arrow batches of this many rows for the jobs that run inside."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _bounded(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if stored_bytes(table) <= BROADCAST_BYTES else table


def _doubt(dim: int) -> float:
    """More than single precision can be off in the cosine of two rotated vectors."""
    return (dim + 16) * 1e-6


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; one whose length is beyond double precision is 0 and links with nothing."""
    with np.errstate(over="ignore", under="ignore"):
        length = np.linalg.norm(x, axis=1, keepdims=True)
        return np.divide(x, length, out=np.zeros_like(x), where=(length > 0) & np.isfinite(length))


class Rotation:
    """A rotation fitted on a sample of unit vectors, and how many of its axes are compared first.

    ``limit`` is the squared distance that the cosine allows, ``cuts`` the leading axes and the others.
    """

    def __init__(self, sample: np.ndarray, dim: int, cosine: float, blocks: int = BLOCKS):
        spread = sample - sample.mean(axis=0) if len(sample) else np.zeros((1, dim))
        _, axes = np.linalg.eigh(spread.T @ spread / max(1, len(spread)))
        self.axes = np.ascontiguousarray(axes[:, ::-1])
        self.limit = np.array([2 - 2 * cosine])
        y = self.turned(sample)
        found = np.count_nonzero(y @ y.T >= cosine)
        ends = [int(x[-1]) + 1 for x in np.array_split(np.arange(dim), min(blocks, dim))]
        for lead in ends:
            p = leading(y, lead)
            if np.count_nonzero(p @ p.T >= cosine) - found <= PASSING * len(y) ** 2:
                break
        self.lead = lead
        self.cuts = [(0, lead), (lead, dim)] if lead < dim else [(0, dim)]

    def turned(self, unit: np.ndarray) -> np.ndarray:
        return unit.astype(np.float32) @ self.axes.astype(np.float32)


def leading(y: np.ndarray, lead: int) -> np.ndarray:
    """The leading axes and the length of the rest: their products are never below the cosine of the whole."""
    if lead >= y.shape[1]:
        return y
    return np.column_stack([y[:, :lead], np.sqrt((y[:, lead:] ** 2).sum(axis=1))])


class Model:
    """What the sample decides, by the length of the vectors: rotations and rotated pivots."""

    def __init__(self, sample: list[np.ndarray], cosine: float):
        by_dim: dict[int, list[np.ndarray]] = {}
        for v in sample:
            by_dim.setdefault(len(v), []).append(_unit(v[None])[0])
        self.rotations = {dim: Rotation(np.stack(v), dim, cosine) for dim, v in by_dim.items()}
        self.pivots = {dim: self.rotations[dim].turned(np.stack(v)) for dim, v in by_dim.items()}

    def turned(self, x: np.ndarray) -> np.ndarray:
        unit = _unit(x.astype(np.float64))
        rot = self.rotations.get(x.shape[1])
        return rot.turned(unit) if rot else unit.astype(np.float32)

    def lead(self, dim: int) -> int:
        return self.rotations[dim].lead if dim in self.rotations else dim


class Tile:
    """The points of a tile, those of one group side by side.

    ``shared``: all have one label, and groups are pivots; else a group holds whole labels.
    """

    def __init__(self, row, model: Model, kind: str, end: str = ""):
        of = lambda c: getattr(row, c + end)
        group = np.frombuffer(of("groups"), "<i4")
        order = np.argsort(group, kind="stable")
        self.group, self.x = group[order], np.frombuffer(of("x"), kind).reshape(len(group), -1)[order]
        self.code = np.frombuffer(of("codes"), "<i4")[order]
        self.weight = np.frombuffer(of("weights"), "<i8")[order]
        self.rep = pd.Series(list(of("reps"))).to_numpy()[order]
        self.shared = of("shared")
        self.y = model.turned(self.x)
        self.p = np.ascontiguousarray(leading(self.y, model.lead(self.x.shape[1])))
        start = np.flatnonzero(np.diff(self.group, prepend=-1))
        self.ranges = list(zip(self.group[start].tolist(), start.tolist(), [*start[1:].tolist(), len(group)], strict=True))


def _cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows of ``a`` and ``b`` as given, in double precision."""
    a, b = a.astype(np.float64), b.astype(np.float64)
    return np.einsum("ij,ij->i", a, b) / (np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1))


def _block_links(a: Tile, i: np.ndarray, b: Tile, j: np.ndarray, cosine: float):
    """Index pairs of the linked points among ``i`` of ``a`` and ``j`` of ``b``."""
    doubt = _doubt(a.x.shape[1])
    least = np.float32(cosine - doubt)
    for r in range(0, len(i), ROWS):
        rows = i[r:r + ROWS]
        left = a.p[rows]
        for c in range(0, len(j), COLUMNS):
            columns = j[c:c + COLUMNS]
            if a is b and columns[-1] <= rows[0]:
                continue
            first = left @ b.p[columns].T
            if first.max() < least:
                continue
            k = rows[first.max(axis=1) >= least]
            m = columns[first.max(axis=0) >= least]
            whole = a.y[k] @ b.y[m].T
            u, v = np.nonzero(whole >= least)
            own = whole[u, v]
            u, v = k[u], m[v]
            sure = own >= cosine + doubt
            for e in range(0, len(unsure := np.flatnonzero(~sure)), PAIRS):
                at = unsure[e:e + PAIRS]
                sure[at] = _cosines(a.x[u[at]], b.x[v[at]]) >= cosine
            if a is b:
                sure &= u < v
            if not a.shared:
                sure &= a.code[u] == b.code[v]
            if sure.any():
                yield u[sure], v[sure]


def _tile_links(a: Tile, b: Tile, model: Model, cosine: float):
    """Index pairs of the linked points of two tiles, or of one (``a is b``)."""
    dim = a.x.shape[1]
    reach, doubt = float(np.sqrt(2 - 2 * cosine)), 4 * _doubt(dim)
    pivots = model.pivots.get(dim)
    if a.shared and pivots is not None:
        at_a, at_b = pivots[[g for g, _, _ in a.ranges]], pivots[[g for g, _, _ in b.ranges]]
        to_a, to_b = b.y @ at_a.T, a.y @ at_b.T
        own_a, own_b = np.einsum("ij,ij->i", a.y, pivots[a.group]), np.einsum("ij,ij->i", b.y, pivots[b.group])
    for s, (g, a0, a1) in enumerate(a.ranges):
        for t, (h, b0, b1) in enumerate(b.ranges):
            if (a is b and h < g) or (not a.shared and g != h):
                continue
            i, j = np.arange(a0, a1), np.arange(b0, b1)
            if g != h and pivots is not None:
                most = reach * float(np.linalg.norm(at_a[s] - at_b[t])) + doubt
                x, y = own_a[a0:a1] - to_b[a0:a1, t], own_b[b0:b1] - to_a[b0:b1, s]
                i, j = i[x <= most - y.min()], j[y <= most - x.min()]
            if len(i) and len(j):
                yield from _block_links(a, i, b, j, cosine)


def _local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _summed(a: Tile, b: Tile, model: Model, cosine: float) -> pd.DataFrame:
    """``(rep, n, root)`` of the points of two tiles, or of one, that have links."""
    size, shift = (len(a.x), 0) if a is b else (len(a.x) + len(b.x), len(a.x))
    n, root = np.zeros(size), np.arange(size)
    for i, j in _tile_links(a, b, model, cosine):
        wa, wb = a.weight[i], b.weight[j]
        j = j + shift
        n += np.bincount(i, wb, size) + np.bincount(j, wa, size)
        u, v = root[i], root[j]
        if (apart := u != v).any():
            root = _local_components(size, u[apart], v[apart])[root]
    rep = a.rep if a is b else np.concatenate([a.rep, b.rep])
    k = np.flatnonzero(n > 0)
    return pd.DataFrame({"rep": rep[k], "n": n[k].astype(np.int64), "root": rep[root[k]]})


def _component(vectors: DataFrame, embedding: str) -> str:
    """``float`` for vectors of floats, else ``double``: what holds their components as given."""
    element = vectors.select(F.col(f"`{embedding}`")).schema[0].dataType.elementType.simpleString()
    return "float" if element == "float" else "double"


def _packed(vectors: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """``(id, label, size, key, x)``: the vector's bytes and their digest, null where it links with nothing."""
    kind = _component(vectors, embedding)
    v = vectors.select(F.col(f"`{vec_id}`").alias("id"), F.col(f"`{label}`").alias("label"),
                       F.col(f"`{embedding}`").cast(f"array<{kind}>").alias("e"))
    fine = F.coalesce(F.col("label").isNotNull() & F.col("id").isNotNull() & (F.size("e") > 0) &
                      F.forall("e", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) &
                      F.exists("e", lambda c: c != 0), F.lit(False))
    rows = v.select("id", "label", F.when(fine, F.col("e")).alias("e"))

    def run(batches):
        for b in batches:
            e = b.column("e")
            flat = np.ascontiguousarray(e.flatten().to_numpy(zero_copy_only=False), "<f4" if kind == "float" else "<f8")
            raw, sizes = flat.tobytes(), e.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.concatenate([[0], np.cumsum(sizes * flat.itemsize)]).tolist()
            x = [raw[p:q] or None for p, q in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([
                b.column("id"), b.column("label"), pa.array(sizes.astype(np.int32)),
                pa.array([t and hashlib.blake2b(t, digest_size=16).digest() for t in x], pa.binary()),
                pa.array(x, pa.binary())], ["id", "label", "size", "key", "x"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return rows.mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, size int, key binary, x binary")


def _room(size: Column, width: int) -> Column:
    """How many vectors of this length a tile takes."""
    return F.greatest(F.lit(1), F.least(F.lit(TILE), F.floor(F.lit(TILE_BYTES) / (size * width))))


def _tiles(packed: DataFrame, slim: DataFrame, copies: DataFrame, shared, width: int) -> tuple[DataFrame, bool]:
    """The distinct points of all labels in tiles, and whether any label has several."""
    rows = slim.where("key is not null").groupBy("label", "size").agg(F.count("*").alias("rows"))
    extra = copies.groupBy("label", "size").agg(F.sum(F.col("weight") - 1).alias("extra"))
    sizes = staged(rows.join(extra, ["label", "size"], "left")
                   .select("label", "size", (F.col("rows") - F.coalesce("extra", F.lit(0))).alias("points")), "embed-sizes")
    room = _room(F.col("size"), width)
    total = sizes.agg(F.sum(F.col("points") / room)).first()[0]
    buckets = int(total or 0) + 1
    wanted = F.pow(F.lit(2), F.ceil(F.log2(F.col("points") * PIVOTS / room)))
    large = staged(sizes.where(F.col("points") > room).select("label", "size", F.least(F.lit(SAMPLE), wanted.cast("int")).alias("pivots")),
                   "embed-large")

    joined = packed.where("key is not null").join(_bounded(copies.select("label", "key", "rep", "weight")), ["label", "key"], "left")
    points = (joined.where("rep is null or rep = id")
              .select("label", "size", F.coalesce("rep", "id").alias("rep"), F.coalesce("weight", F.lit(1)).alias("weight"), "x")
              .join(_bounded(large), ["label", "size"], "left"))

    def nearest(batches):
        model = shared.value
        for df in batches:
            group = np.zeros(len(df), np.int32)
            wanted = df["pivots"].fillna(0).astype(int)
            for (size, k), part in df.groupby([df["size"], wanted]).indices.items():
                pivots = model.pivots.get(size)
                if k and pivots is not None:
                    x = np.frombuffer(b"".join(df["x"].iloc[part]), "<f4" if width == 4 else "<f8").reshape(len(part), size)
                    group[part] = np.argmax(model.turned(x) @ pivots[:k].T, axis=1)
            yield df.assign(pivots=wanted, pivot=group)

    kinds = {f.name: f.dataType.simpleString() for f in points.schema.fields}
    near = points.mapInPandas(nearest, ", ".join(f"{c} {kinds[c]}" for c in points.columns) + ", pivot int")
    of = ["label", "size", "pivot"]
    if several := not large.isEmpty():
        # pivots of few points share a tile, one of many has tiles of its own
        counts = near.where("pivots > 0").groupBy(*of).agg(F.count("*").alias("points"))
        few = F.col("points") <= room
        before = F.sum(F.when(few, F.col("points")).otherwise(0)).over(
            Window.partitionBy("label", "size").orderBy("pivot").rowsBetween(Window.unboundedPreceding, -1))
        places = staged(counts.select(*of, F.when(few, F.floor(F.coalesce(before, F.lit(0)) / room)).otherwise(-1 - F.col("pivot")).alias("tile"),
                                      F.ceil(F.col("points") / room).alias("parts")), "embed-places")
        near = near.join(_bounded(places), of, "left")
    else:
        near = near.select("*", F.lit(None).cast("bigint").alias("tile"), F.lit(None).cast("bigint").alias("parts"))
    placed = near.select(
        "label", "size", "rep", "weight", "x", "pivot", F.when(F.col("pivots") > 0, F.col("label")).alias("of"),
        F.coalesce("tile", F.pmod(F.xxhash64("label"), F.lit(buckets))).cast("bigint").alias("tile"),
        F.coalesce(F.pmod(F.xxhash64("x"), F.col("parts")), F.lit(0)).cast("bigint").alias("part"))
    keys = ["size", "of", "tile", "part"]

    def build(df: pd.DataFrame) -> pd.DataFrame:
        df = df.drop_duplicates(["label", "x"])
        shared_label = bool(df["of"].notna().all())
        code = pd.factorize(df["label"])[0].astype("<i4")
        group = df["pivot"].to_numpy().astype("<i4") if shared_label else code % np.int32(64)
        first = df.iloc[0]
        return pd.DataFrame({
            "size": [first["size"]], "of": pd.Series([first["of"]], dtype=df["of"].dtype), "tile": [first["tile"]], "part": [first["part"]],
            "shared": [shared_label], "reps": [df["rep"].tolist()], "weights": [df["weight"].to_numpy().astype("<i8").tobytes()],
            "codes": [code.tobytes()], "groups": [group.astype("<i4").tobytes()], "x": [b"".join(df["x"])]})

    built = placed.groupBy(*keys).applyInPandas(
        build, f"size int, of {kinds['label']}, tile bigint, part bigint, shared boolean, reps array<{kinds['rep']}>, "
               "weights binary, codes binary, groups binary, x binary")
    return staged(built, "embed-tiles"), several


def _links(tiles: DataFrame, several: bool, shared, cosine: float, width: int) -> DataFrame:
    """``(rep, n, root)``: partial link counts and local components of tiles and pairs of tiles."""
    spark = tiles.sparkSession
    kind = "<f4" if width == 4 else "<f8"
    schema = f"rep {tiles.schema['reps'].dataType.elementType.simpleString()}"
    schema = f"{schema}, n bigint, {schema.replace('rep', 'root', 1)}"

    @released
    def inside(batches):
        for df in batches:
            for row in df.itertuples(index=False):
                tile = Tile(row, shared.value, kind)
                yield _summed(tile, tile, shared.value, cosine)

    @released
    def between(batches):
        held, a = None, None
        for df in batches:
            for row in df.itertuples(index=False):
                if (row.size_a, row.of_a, row.tile_a, row.part_a) != held:
                    held, a = (row.size_a, row.of_a, row.tile_a, row.part_a), Tile(row, shared.value, kind, "_a")
                yield _summed(a, Tile(row, shared.value, kind, "_b"), shared.value, cosine)

    with _batches(spark, 1):
        found = staged(tiles.mapInPandas(inside, schema), "embed-links")
        if not several:
            return found
        # every pair of a label's tiles once, in either order alike often; tasks read tiles, none are copied
        tasks = max(-(-stored_bytes(tiles) // READ_BYTES), int(np.ceil(np.sqrt(4 * spark.sparkContext.defaultParallelism))))
        a, b = (tiles.where("shared").select(*[F.col(c).alias(f"{c}_{end}") for c in tiles.columns]).coalesce(tasks) for end in "ab")
        mark = lambda end: F.xxhash64(f"tile_{end}", f"part_{end}")
        place = lambda end: F.struct(F.col(f"tile_{end}").alias("t"), F.col(f"part_{end}").alias("p"))
        even = mark("a").bitwiseXOR(mark("b")).bitwiseAND(F.lit(1)) == 0
        pairs = a.hint("shuffle_replicate_nl").join(b, (F.col("size_a") == F.col("size_b")) & (F.col("of_a") == F.col("of_b"))
                                                    & (place("a") != place("b")) & (even == (place("a") < place("b"))))
        return found.unionByName(staged(pairs.mapInPandas(between, schema), "embed-links"))


def link_components(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
                    cosine: float = COSINE) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row; see the module's docstring."""
    spark = vectors.sparkSession
    packed = _packed(vectors, vec_id, embedding, label)
    kind = "<f4" if _component(vectors, embedding) == "float" else "<f8"
    width = int(kind[-1])
    with _batches(spark, BATCH):
        slim = staged(packed.drop("x"), "embed-rows")
        some = packed.where("key is not null").orderBy(F.xxhash64("id", "key"), "key").limit(SAMPLE).select("x").collect()
        shared = spark.sparkContext.broadcast(Model([np.frombuffer(r["x"], kind).astype(np.float64) for r in some], cosine))
        copies = staged(slim.where("key is not null").groupBy("label", "key").agg(
            F.min("id").alias("rep"), F.count("*").alias("weight"), F.first("size").alias("size")).where("weight > 1"), "embed-copies")
        tiles, several = _tiles(packed, slim, copies, shared, width)
    links = _links(tiles, several, shared, cosine, width)
    edges = links.where("rep != root").select(F.col("rep").alias("u"), F.col("root").alias("v"))
    comp = connected_components(edges).withColumnRenamed("id", "rep")
    count = links.groupBy("rep").agg(F.sum("n").alias("n"))
    known = staged(count.join(comp, "rep", "left"), "embed-known")
    rows = (slim.where("key is not null").select("id", "label", "key").join(_bounded(copies.drop("size")), ["label", "key"], "left")
            .select("id", F.coalesce("rep", "id").alias("rep"), F.coalesce("weight", F.lit(1)).alias("weight")))
    both = rows.join(known, "rep", "left").select(
        "id", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    alone = slim.where("key is null").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    return both.unionByName(alone).select(
        F.col("id").alias("vec_id"), "n_links", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
