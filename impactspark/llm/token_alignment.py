"""Cross-tokenizer alignment with an identity-map fast path.

Every text is encoded by a byte-level tokenizer A (with a space before it)
and by a sentence-piece tokenizer B (which adds that space itself).  Byte
offsets where a token of A and one of B both end cut the tokens into groups;
at each cut the two tokens that end there are linked.

1. The identity map gives for each id of A the id of B with the same bytes.
   A group of one token on either side that follows the map is counted in a
   vector over A's vocabulary, one for each task; the vectors are summed by
   id.
2. Only the links of irregular groups become pairs.  A task gathers them in
   blocks of documents, so a pair leaves a block once with its count; blocks'
   pairs are summed and joined back to the blocks that hold them.
3. Vectors and the highest count of each id of B are as long as the
   vocabularies and are broadcast; a document's links then meet the counts of
   the map without a shuffle and those of pairs in its block.

Where the merges of A are proven to be those of its ranks (``merge_ranks``), a
faster library for rank files encodes that side; the ids are the same.

Long texts are encoded in segments.  Before a single space between two
visible ASCII characters A always starts a token (see ``token_counts``), and
so does B if no piece holds a space after another character, which is proven
from its vocabulary; otherwise B takes the whole text.

A text that is null or empty, or whose tokens do not spell space + text on
either side, has no tokens: zeros and an empty ``groups_sha256``.  Every row
gives one row, repeated rows and null ids included; other columns are kept,
but for ``text`` and those that clash with the results; an empty table gives
an empty result and no pairs.
"""

from __future__ import annotations

import hashlib
import json
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe_codec import PATTERN
from .common import free_name, read_bytes, released, staged
from .rank_merges import byte_of_char, merge_ranks
from .token_counts import read_tokenizer

#: Documents and different pairs of one block at most, characters encoded at once, and of a segment at least.
BLOCK_DOCS, BLOCK_PAIRS, BATCH_CHARS, SEGMENT = 512, 1 << 16, 1 << 20, 1 << 16
#: A pair's key is ``a * PAIR + b``; no vocabulary has so many ids.
PAIR = 1 << 31

RESULT = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
_COUNTS = RESULT[:3]
_CUT = re.compile(r"(?<=[!-~]) (?=[!-~])")


def bytes_a(spec: str) -> list[bytes]:
    """The bytes of each id of a byte-level tokenizer (its JSON)."""
    model, of = json.loads(spec), byte_of_char()
    table = {i: bytes(of[c] for c in s) for s, i in model["model"]["vocab"].items() if all(c in of for c in s)}
    table |= {t["id"]: t["content"].encode() for t in model.get("added_tokens", ())}
    return [table.get(i, b"") for i in range(max(table, default=-1) + 1)]


def bytes_b(model: bytes) -> list[bytes]:
    """The bytes of each id of a sentence-piece model."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    return [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]


def identity_map(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """For each id of A the id of B with the same bytes, -1 where there is none.

    Of several ids of B the largest counts: pieces come after the bytes of
    the fallback, which an encoder only uses where no piece fits.
    """
    at = {x: i for i, x in enumerate(b) if x}
    return np.array([at.get(x, -1) if x else -1 for x in a], np.int64)


class Pair:
    """Both tokenizers inside a worker."""

    def __init__(self, spec: str, model: bytes, ranks: dict[bytes, int] | None = None):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        if ranks is None:
            self.a = Tokenizer.from_str(spec)
            self.a.no_truncation()
            self.a.no_padding()
            self.a.encode_special_tokens = True
        else:
            self.ranked = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.lossless = ranks is not None  # every byte has an id, and ids only join bytes
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bytes_a, self.bytes_b = bytes_a(spec), bytes_b(model)
        self.len_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.len_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.map = identity_map(self.bytes_a, self.bytes_b)
        self.cuts = not any(b" " in x.lstrip(b" ") for x in self.bytes_b)
        self.digits = _digits(max(len(self.bytes_a), len(self.bytes_b)))

    def segments(self, text: str) -> list[str]:
        """Pieces of a text without the spaces between them; the space before each is what both encoders add."""
        if len(text) <= SEGMENT or not self.cuts:
            return [text]
        out, at = [], 0
        while len(text) - at > SEGMENT and (m := _CUT.search(text, at + SEGMENT)):
            out.append(text[at:m.start()])
            at = m.end()
        return [*out, text[at:]]

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both sides of each text; none where either does not spell space + text."""
        parts, owner = [], []
        for k, t in enumerate(texts):
            if t:
                s = self.segments(t)
                parts += s
                owner += [k] * len(s)
        none = np.empty(0, np.int64)
        a: list[list] = [[] for _ in texts]
        b: list[list] = [[] for _ in texts]
        for i in range(0, len(parts), 64):
            some = parts[i:i + 64]
            for k, left, right in zip(owner[i:i + 64], self._ids_a([" " + p for p in some]), self.b.encode(some, num_threads=1), strict=True):
                a[k].append(np.array(left, np.int64))
                b[k].append(np.array(right, np.int64))
        out = []
        for t, x, y in zip(texts, a, b, strict=True):
            x, y = np.concatenate([none, *x]), np.concatenate([none, *y])
            if len(x):
                raw = b" " + t.encode("utf-8", "surrogatepass")
                if self._spelt(self.bytes_b, y) != raw or not (self.lossless or self._spelt(self.bytes_a, x) == raw):
                    x = y = none
            out.append((x, y))
        return out

    def _ids_a(self, texts: list[str]) -> list:
        if self.lossless:
            return [self.ranked.encode_to_numpy(t, disallowed_special=()) for t in texts]
        return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]

    @staticmethod
    def _spelt(table: list[bytes], ids: np.ndarray) -> bytes:
        return b"".join(map(table.__getitem__, ids.tolist()))

    def groups(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in both sides of the last token of each group."""
        ends_a, ends_b = np.cumsum(self.len_a[x]), np.cumsum(self.len_b[y])
        _, i, j = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
        return i, j

    def written(self, x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> bytes:
        """``a1,a2|b1;a3|b2,b3``: the ids of each group in decimal."""
        if not len(i):
            return b""
        comma, bar, end = ord(","), ord("|"), ord(";")
        mark_a, mark_b = np.full(len(x), comma, np.uint8), np.full(len(y), comma, np.uint8)
        mark_a[i], mark_b[j] = bar, end
        # tokens of a group of A, then those of B: the place of a token is its own number and those of the other side before
        size_a, size_b = np.diff(i, prepend=-1), np.diff(j, prepend=-1)
        at_a = np.arange(len(x)) + np.repeat(j - size_b + 1, size_a)
        at_b = np.arange(len(y)) + np.repeat(i + 1, size_b)
        ids, marks = np.empty(len(x) + len(y), np.int64), np.empty(len(x) + len(y), np.uint8)
        ids[at_a], ids[at_b], marks[at_a], marks[at_b] = x, y, mark_a, mark_b
        cells = self.digits[ids]
        cells[:, -1] = marks
        return cells[cells > 0].tobytes()[:-1]


def _digits(n: int) -> np.ndarray:
    """Decimal digits of each number below ``n`` as ASCII, zero bytes before them and one behind."""
    width = len(str(max(1, n - 1)))
    numbers = np.arange(n)[:, None] // 10 ** np.arange(width)[::-1]
    cells = np.where(numbers > 0, numbers % 10 + ord("0"), 0)
    cells[0, -1] = ord("0")
    return np.concatenate([cells, np.zeros((n, 1), np.int64)], axis=1).astype(np.uint8)


def _counted(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    got, n = np.unique(ids, return_counts=True)
    return got.astype(np.int32), n.astype(np.int32)


class Aligned(NamedTuple):
    """What ``align`` returns."""

    docs: DataFrame   #: the rows with the columns of ``RESULT``
    pairs: DataFrame  #: ``(a, b, n)``: the ids that are linked and how often, over all texts


_ROW = (("block", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
        ("groups_sha256", pa.string()), ("own", pa.list_(pa.int32())), ("own_n", pa.list_(pa.int32())),
        ("odd", pa.list_(pa.int32())), ("odd_n", pa.list_(pa.int32())), ("pairs", pa.list_(pa.int64())),
        ("pairs_n", pa.list_(pa.int64())), ("vector", pa.list_(pa.int64())))
_SQL = {pa.int64(): "bigint", pa.string(): "string", pa.list_(pa.int32()): "array<int>", pa.list_(pa.int64()): "array<bigint>"}


class _Block:
    """Pairs of the documents gathered so far."""

    def __init__(self, number: int):
        self.number, self.docs, self.index, self.n = number, 0, {}, []

    def add(self, keys: np.ndarray) -> tuple[list[int], np.ndarray]:
        """Places of a document's pairs in the block, and how often it has each."""
        got, n = np.unique(keys, return_counts=True)
        index, at = self.index, []
        for key, k in zip(got.tolist(), n.tolist(), strict=True):
            p = index.setdefault(key, len(index))
            if p == len(self.n):
                self.n.append(0)
            self.n[p] += k
            at.append(p)
        self.docs += 1
        return at, n.astype(np.int32)

    @property
    def full(self) -> bool:
        return self.docs >= BLOCK_DOCS or len(self.index) >= BLOCK_PAIRS


def _encoded(docs: DataFrame, shared, text: str, kept: list[str], names: dict[str, str]) -> DataFrame:
    """A row for each document with its links, one for each block with its pairs, one for each task with its vector."""
    fields = [T.StructField(c, docs.schema[c].dataType, True) for c in kept]
    own = T.StructType.fromDDL(", ".join(f"`{names[c]}` {_SQL[t]}" for c, t in _ROW))
    schema = T.StructType([*fields, *own.fields])

    @released
    def run(batches):
        pair = _pair(shared)
        vector = np.zeros(len(pair.bytes_a), np.int64)
        task = TaskContext.get()
        block, blocks, types = _Block((task.partitionId() if task else 0) << 32), 0, None

        def rows(n: int, columns: dict, keep=None):
            arrays = [keep.column(k) if keep is not None else pa.nulls(n, t) for k, t in enumerate(types)]
            arrays += [pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in _ROW]
            return pa.RecordBatch.from_arrays(arrays, names=schema.names)

        def closed():
            return rows(1, {"block": [block.number], "pairs": [list(block.index)], "pairs_n": [block.n]})

        for batch in batches:
            keep = batch.select(kept) if kept else None
            types = [batch.schema.field(c).type for c in kept]
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            at = 0
            while at < len(texts):
                upto, chars = at, 0
                while upto < len(texts) and (upto == at or chars + len(texts[upto] or "") <= BATCH_CHARS) \
                        and upto - at < BLOCK_DOCS - block.docs:
                    chars += len(texts[upto] or "")
                    upto += 1
                out: dict[str, list] = {c: [] for c, _ in _ROW[:9]}
                for x, y in pair.encode([t or "" for t in texts[at:upto]]):
                    i, j = pair.groups(x, y)
                    a, b = x[i], y[j]
                    regular = (np.diff(i, prepend=-1) == 1) & (np.diff(j, prepend=-1) == 1) & (pair.map[a] == b)
                    ids, n = _counted(a[regular])
                    vector[ids] += n
                    odd, odd_n = block.add(a[~regular] * PAIR + b[~regular])
                    line = pair.written(x, y, i, j)
                    for c, v in zip(out, (block.number, len(x), len(y), len(i), hashlib.sha256(line).hexdigest() if line else "",
                                          ids, n, odd, odd_n), strict=True):
                        out[c].append(v)
                yield rows(upto - at, out, keep.slice(at, upto - at) if keep is not None else None)
                at = upto
                if block.full:
                    yield closed()
                    blocks += 1
                    block = _Block(((task.partitionId() if task else 0) << 32) + blocks)
        if types is not None:
            if block.docs:
                yield closed()
            yield rows(1, {"vector": [vector]})

    return docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("string").alias(text)) \
        .mapInArrow(run, schema)


_PAIRS: dict[int, Pair] = {}


def _pair(shared) -> Pair:
    spec, model, ranks = shared.value
    key = hash((spec, model))
    if key not in _PAIRS:
        _PAIRS.clear()
        _PAIRS[key] = Pair(spec, model, ranks)
    return _PAIRS[key]


def _regular(rows: DataFrame, shared, known, kept: list[str], names: dict[str, str]) -> DataFrame:
    """Documents with the best links and the count sum of their regular groups, which need no shuffle."""
    fields = [T.StructField(c, rows.schema[c].dataType, True) for c in kept]
    columns = ["block", *_COUNTS, "groups_sha256", "odd", "odd_n"]
    schema = T.StructType([*fields, *[rows.schema[names[c]] for c in columns],
                           T.StructField(names["best"], T.LongType()), T.StructField(names["sum"], T.LongType())])

    def run(batches):
        of = known.value
        highest = of["own"] == np.where(of["map"] >= 0, of["best"][of["map"]], -1)
        for batch in batches:
            ids, n = batch.column(names["own"]), batch.column(names["own_n"])
            flat = ids.flatten().to_numpy(zero_copy_only=False)
            times = n.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            size = ids.value_lengths().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(size)), size)
            best, total = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            np.add.at(best, row, times * highest[flat])
            np.add.at(total, row, times * of["own"][flat])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *[batch.column(names[c]) for c in columns],
                                              pa.array(best), pa.array(total)], names=schema.names)

    slim = rows.where(F.col(names["n_a"]).isNotNull()).select(
        *[F.col(f"`{c}`") for c in kept], *[names[c] for c in (*columns, "own", "own_n")])
    return slim.mapInArrow(run, schema)


def _irregular(docs: DataFrame, counts: DataFrame, known, kept: list[str], names: dict[str, str], schema: T.StructType) -> DataFrame:
    """Documents meet the counts of their block's pairs."""
    def run(left, right):
        best = known.value["best"]
        pairs = right.column("pair").to_numpy().astype(np.int64) if right.num_rows else np.empty(0, np.int64)
        n = np.zeros(len(pairs), np.int64)
        place = right.column("i").to_numpy() if right.num_rows else np.empty(0, np.int64)
        top = np.zeros(len(pairs), bool)
        if right.num_rows:
            total = right.column("n").to_numpy()
            n[place], top[place] = total, best[pairs % PAIR] == total
        good, whole = [], []
        for at, k in zip(left.column(names["odd"]).to_pylist(), left.column(names["odd_n"]).to_pylist(), strict=True):
            at, k = np.array(at, np.int64), np.array(k, np.int64)
            good.append(int((k * top[at]).sum()))
            whole.append(int((k * n[at]).sum()))
        col = lambda c: left.column(names[c])
        add = lambda c, more: pa.chunked_array([pa.array(np.array(col(c).to_pylist(), np.int64) + np.array(more, np.int64))])
        return pa.Table.from_arrays([*[left.column(c) for c in kept], col("n_a"), col("n_b"), col("n_groups"), col("n_groups"),
                                     add("best", good), add("sum", whole), col("groups_sha256")], names=schema.names)

    return docs.groupBy(names["block"]).cogroup(counts.groupBy("block")).applyInArrow(run, schema)


def align(docs: DataFrame, path_a: str, path_b: str, text: str = "text") -> Aligned:
    """Align both tokenizers on every text; see the module's docstring."""
    spark = docs.sparkSession
    spec, model = read_tokenizer(path_a), read_bytes(path_b)
    shared = spark.sparkContext.broadcast((spec, model, merge_ranks(spec)))
    taken = {c.lower() for c in RESULT}
    kept = [c for c in docs.columns if c != text and c.lower() not in taken]
    inner = docs.select(*[F.col(f"`{c}`") for c in kept])
    names = {c: free_name(inner, f"_{c}") for c in [*[c for c, _ in _ROW], "best", "sum"]}
    rows = staged(_encoded(docs, shared, text, kept, names), "align-links")
    col = lambda c: F.col(names[c])

    # counts: vectors by id of A, pairs by key; both combine before they shuffle
    vectors = rows.where(col("vector").isNotNull()).select(F.posexplode(col("vector")).alias("a", "n")).where("n > 0")
    own = staged(vectors.groupBy("a").agg(F.sum("n").alias("n")), "align-identity")
    parts = (rows.where(col("pairs").isNotNull())
             .select(col("block").alias("block"), F.posexplode(F.arrays_zip(col("pairs").alias("pair"), col("pairs_n").alias("n")))
                     .alias("i", "p")).select("block", "i", F.col("p.pair").alias("pair"), F.col("p.n").alias("n")))
    total = staged(parts.groupBy("pair").agg(F.sum("n").alias("n")), "align-pairs")

    # as long as the vocabularies, whatever the input
    size_a, table_b = bytes_a(spec), bytes_b(model)
    same = identity_map(size_a, table_b)
    vector, best = np.zeros(len(size_a), np.int64), np.zeros(len(table_b), np.int64)
    for r in own.collect():
        vector[r["a"]] = r["n"]
    hit = np.flatnonzero(same >= 0)
    np.maximum.at(best, same[hit], vector[hit])
    for r in total.groupBy((F.col("pair") % PAIR).alias("b")).agg(F.max("n").alias("n")).collect():
        best[r["b"]] = max(best[r["b"]], r["n"])
    known = spark.sparkContext.broadcast({"own": vector, "best": best, "map": same})

    counts = parts.drop("n").join(total, "pair").select("block", "i", "pair", "n")
    done = T.StructType([*[T.StructField(c, rows.schema[c].dataType, True) for c in kept],
                         *[T.StructField(c, T.StringType() if c == "groups_sha256" else T.LongType()) for c in RESULT]])
    regular = _regular(rows, shared, known, kept, names)
    result = _irregular(regular, counts, known, kept, names, done)
    to_b = spark.createDataFrame([(int(i), int(same[i])) for i in hit], "a int, b int")
    pairs = (own.join(to_b, "a").select(F.col("a").cast("bigint").alias("a"), F.col("b").cast("bigint").alias("b"), "n")
             .unionByName(total.select(F.expr(f"pair div {PAIR}").alias("a"), (F.col("pair") % PAIR).alias("b"), "n")))
    return Aligned(result, pairs)
