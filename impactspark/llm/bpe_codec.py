"""Byte-level BPE encoding and decoding by a two-tier lookup.

Tier 1: the distinct pre-tokens of a batch are hashed together and looked up
in a minimal perfect hash over the vocabulary (hash and displace; exactly one
slot per token, the stored key is compared), which resolves every pre-token
that is a token itself.  Tier 2: the rest are merged lowest rank first,
leftmost on ties, with a heap over linked bytes; results are kept in a
bounded memo.

Null texts count as empty (no ids); every row gives one row, repeated rows
and extra columns are kept; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import released, without

#: Fixed value: the pattern that splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Merged pre-tokens in each of a worker's two memo generations, and the longest one kept.
MEMO, MEMO_BYTES = 200_000, 64

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file in order of their rank (read on the driver)."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    return [t for _, t in sorted((int(r), base64.b64decode(t)) for t, r in pairs)]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def hash_keys(keys: list[bytes]) -> np.ndarray:
    """64-bit hash of each key: a polynomial over its bytes and its length, all keys at once."""
    size = np.fromiter(map(len, keys), np.int64, len(keys))
    flat = np.frombuffer(b"".join(keys), np.uint8).astype(np.uint64) + np.uint64(1)
    end = np.cumsum(size)
    at = np.arange(len(flat)) - np.repeat(end - size, size)
    top = int(size.max()) if len(size) else 0
    with np.errstate(over="ignore"):
        power = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(top, _BASE)]))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(flat * power[at])])
        return _mix(total[end] - total[end - size] + size.astype(np.uint64) * _M2)


class PerfectHash:
    """Minimal perfect hash by hash and displace: as many slots as keys."""

    def __init__(self, keys: list[bytes]):
        n = len(keys)
        self.slots, self.buckets = n, max(1, n // 3)
        h = hash_keys(keys)
        bucket = (h % np.uint64(self.buckets)).astype(np.int64)
        self.shift = np.zeros(self.buckets, np.int64)
        self.key_of = np.full(n, -1, np.int64)
        order = np.argsort(bucket, kind="stable")
        starts = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        sizes = np.diff(starts)
        for size in range(int(sizes.max(initial=0)), 1, -1):  # large buckets first
            left = np.flatnonzero(sizes == size)
            own = order[starts[left][:, None] + np.arange(size)]
            d = 0
            while len(left):
                d += 1
                at = self._slot(h[own], np.full(own.shape, d))
                ranked = np.sort(at, axis=1)
                fits = (self.key_of[at] < 0).all(axis=1) & (ranked[:, 1:] != ranked[:, :-1]).all(axis=1)
                for k in np.flatnonzero(fits).tolist():  # a bucket before it may have taken a slot
                    if (self.key_of[at[k]] < 0).all():
                        self.key_of[at[k]] = own[k]
                        self.shift[left[k]] = d
                    else:
                        fits[k] = False
                left, own = left[~fits], own[~fits]
        free = iter(np.flatnonzero(self.key_of < 0).tolist())
        for b in np.flatnonzero(sizes == 1):  # a bucket of one key names its slot
            slot = next(free)
            self.shift[b] = -1 - slot
            self.key_of[slot] = order[starts[b]]
        self.check = h[self.key_of]

    def _slot(self, h: np.ndarray, d: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (_mix(h + d.astype(np.uint64) * _BASE) % np.uint64(self.slots)).astype(np.int64)

    def find(self, keys: list[bytes]) -> np.ndarray:
        """The key number in each key's slot, -1 where the slot's hash differs."""
        if not keys:
            return np.empty(0, np.int64)
        h = hash_keys(keys)
        d = self.shift[(h % np.uint64(self.buckets)).astype(np.int64)]
        slot = np.where(d < 0, -1 - d, self._slot(h, np.maximum(d, 0)))
        return np.where(self.check[slot] == h, self.key_of[slot], -1)


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: pairs merge lowest rank first, leftmost on ties.

    A token is its start; ``end`` links it to the next one and ``before`` to
    the one before.  A heap entry names two neighbours by their bounds and is
    stale once either has changed.
    """
    n = len(piece)
    get = ranks.get
    end = list(range(1, n + 1))
    before = list(range(-1, n))
    heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := get(piece[i:i + 2])) is not None]
    heapify(heap)
    while heap:
        _, i, mid, e = heappop(heap)
        if end[i] != mid or end[mid] != e:
            continue
        end[i], end[mid] = e, -1
        if e < n:
            before[e] = i
            if (r := get(piece[i:end[e]])) is not None:
                heappush(heap, (r, i, e, end[e]))
        p = before[i]
        if p >= 0 and (r := get(piece[p:e])) is not None:
            heappush(heap, (r, p, i, e))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


class Codec:
    """Encoder and decoder of one vocabulary inside a worker."""

    def __init__(self, tokens: list[bytes], table: PerfectHash, pattern: str = PATTERN):
        self.tokens, self.table = tokens, table
        self.ranks = {t: k for k, t in enumerate(tokens)}
        self.split = regex.compile(pattern).findall
        self.ids = [np.array([k], "<u4").tobytes() for k in range(len(tokens))]
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _merged(self, piece: str, raw: bytes) -> bytes:
        ids = self.memo.get(piece) or self.older.get(piece)
        if ids is None:
            ids = b"".join([self.ids[i] for i in merge(raw, self.ranks)])
        if len(raw) <= MEMO_BYTES:
            if len(self.memo) >= MEMO:  # two generations: what was not used for a while goes
                self.memo, self.older = {}, self.memo
            self.memo[piece] = ids
        return ids

    def _resolve(self, pieces: list[str]) -> dict[str, bytes]:
        raw = [p.encode() for p in pieces]
        tokens, ids = self.tokens, self.ids
        return {p: ids[k] if k >= 0 and tokens[k] == b else self._merged(p, b)
                for p, b, k in zip(pieces, raw, self.table.find(raw).tolist(), strict=True)}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, little-endian unsigned 32-bit."""
        pieces = [self.split(t) for t in texts]
        ids = self._resolve(list(set().union(*pieces)))
        return [b"".join(map(ids.__getitem__, ps)) for ps in pieces]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_CODECS: dict[tuple, Codec] = {}


def _codec(shared) -> Codec:
    """One codec per worker process and broadcast vocabulary."""
    tokens, table, pattern = shared.value
    key = (len(tokens), hash(tuple(tokens[-50:])), pattern)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(tokens, table, pattern)
    return _CODECS[key]


def share(spark, path: str, pattern: str = PATTERN):
    """Broadcast the vocabulary and its perfect hash (a fixed size: about 3 MB for 50k tokens)."""
    tokens = read_ranks(path)
    if len(tokens) >= 1 << 22 or any(not t for t in tokens):
        raise ValueError("a rank file of fewer than 4M non-empty tokens is expected")
    return spark.sparkContext.broadcast((tokens, PerfectHash(tokens), pattern))


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "token_ids", pattern: str = PATTERN) -> DataFrame:
    """``docs`` with ``ids``: the token ids of the whole text, little-endian unsigned 32-bit, as binary."""
    docs = without(docs, ids, keep=(text,))
    shared = share(docs.sparkSession, path, pattern)
    schema = T.StructType([*docs.schema.fields, T.StructField(ids, T.BinaryType())])

    @released
    def run(batches):
        codec = _codec(shared)
        for df in batches:
            found = codec.encode([t if isinstance(t, str) else "" for t in df[text]])
            yield df.assign(**{ids: pd.Series(found, index=df.index, dtype=object)})

    return docs.mapInPandas(run, schema)


def decode(rows: DataFrame, path: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """``rows`` with ``out``: the bytes that the ids stand for (null ids: no bytes)."""
    rows = without(rows, out, keep=(ids,))
    shared = share(rows.sparkSession, path)
    schema = T.StructType([*rows.schema.fields, T.StructField(out, T.BinaryType())])

    @released
    def run(batches):
        codec = _codec(shared)
        for df in batches:
            yield df.assign(**{out: pd.Series([codec.decode(x or b"") for x in df[ids]], index=df.index, dtype=object)})

    return rows.mapInPandas(run, schema)


def encode_and_decode(docs: DataFrame, path: str, text: str = "text", ids: str = "token_ids", out: str = "decoded",
                      pattern: str = PATTERN) -> DataFrame:
    """``encode`` and then ``decode`` of its ids in one worker: one vocabulary in memory instead of two."""
    docs = without(docs, ids, out, keep=(text,))
    shared = share(docs.sparkSession, path, pattern)
    schema = T.StructType([*docs.schema.fields, T.StructField(ids, T.BinaryType()), T.StructField(out, T.BinaryType())])

    @released
    def run(batches):
        codec = _codec(shared)
        for df in batches:
            found = codec.encode([t if isinstance(t, str) else "" for t in df[text]])
            yield df.assign(**{ids: pd.Series(found, index=df.index, dtype=object),
                               out: pd.Series([codec.decode(x) for x in found], index=df.index, dtype=object)})

    return docs.mapInPandas(run, schema)
