"""Target-distribution importance resampling over hashed n-grams.

Features of a text are all runs of one to ``size`` consecutive words of the
text with A-Z lower-cased, joined by one space.  A feature's bucket is the
CRC-32 of its bytes modulo ``buckets``; a bucket's gain is the floored
logarithm (times 1000) of how much likelier it is in the target texts than
in the documents, with one added to every bucket.  A document's weight is
the floored mean of its features' gains; its score adds Gumbel noise that
its id and the seed fix, so the highest scores are a sample without
replacement with odds by weight.

Each batch of texts interns its n-grams in an open-addressed NumPy table:
slots are found by xxhash64, an n-gram takes a slot only if its bytes equal
those of the slot's owner (else it probes on), and a slot stores the bucket
and the count.  The counts of slots are added up by bucket over all
documents; in a second pass each occurrence gathers its gain by its slot.

The draw needs no global sort: scores have fewer than 2^18 values whatever
the input, so a histogram finds the score where the draw ends, and only the
rows from there up are sorted by range and numbered.

Null and empty texts have no features and weight 0.  A row whose id is null
has no score and is never drawn or counted among the candidates; rows with
equal score and id are ranked in any order.  Each row gives one row, columns
of the results' names are replaced, others kept; an empty table gives an
empty result.  No target text leaves every ``t`` at 0.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, released, staged
from .texthash import LOWER, flatten

BUCKETS, SIZE, SEED, LEAST_WORDS, PERCENT = 10_000, 2, 7, 20, 25
#: Bytes of the texts that share a table (a longer text has a table of its own).
BATCH_BYTES = 1 << 19

#: Fixed value: bytes that words are made of: digits, lower-case letters and all beyond ASCII.
WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = WORD[0x61:0x7B] = WORD[0x80:] = True

RESULT = ("n_features", "weight", "score", "rank")
_TAIL = np.array([(1 << 8 * r) - 1 for r in range(8)] + [(1 << 64) - 1], np.uint64)


class Ngrams:
    """The n-grams of some texts: where each occurrence stands, and whose it is."""

    def __init__(self, texts: list[str], size: int):
        flat, at = flatten(texts)
        flat = LOWER[flat]
        inside = WORD[flat]
        before = np.concatenate([[False], inside[:-1]])
        keep = inside | before  # a word and the byte behind it, which becomes the space
        self.flat = np.where(inside, flat, np.uint8(0x20))[keep]
        first = np.flatnonzero(inside & ~before)
        place = np.cumsum(keep) - 1
        start = place[first]
        end = np.flatnonzero(self.flat == 0x20)
        owner = np.searchsorted(at, first, side="right") - 1
        self.words = np.bincount(owner, minlength=len(texts))
        parts = [(start, end, owner)]
        for k in range(1, size):
            same = owner[k:] == owner[:-k]
            parts.append((start[:-k][same], end[k:][same], owner[k:][same]))
        self.start, self.end, self.owner = (np.concatenate(x) for x in zip(*parts, strict=True))


class Table:
    """Open-addressed table of the distinct n-grams of a batch."""

    def __init__(self, grams: Ngrams, buckets: int):
        from xxhash import xxh64_intdigest

        n = len(grams.start)
        raw = grams.flat.tobytes()
        bounds = grams.start.tolist(), grams.end.tolist()
        keys = np.fromiter((xxh64_intdigest(raw[a:b]) for a, b in zip(*bounds, strict=True)), np.uint64, n)
        size = 1 << max(4, (2 * n - 1).bit_length())
        self.owner = np.full(size, -1, np.int64)
        self.slots = self._intern(keys, np.frombuffer(raw + bytes(8), np.uint8), grams.start, grams.end - grams.start)
        self.count = np.bincount(self.slots, minlength=size)
        self.bucket = np.zeros(size, np.int64)
        used = np.flatnonzero(self.owner >= 0)
        first = self.owner[used]
        self.bucket[used] = [zlib.crc32(raw[a:b]) % buckets
                             for a, b in zip(grams.start[first].tolist(), grams.end[first].tolist(), strict=True)]

    def _intern(self, keys: np.ndarray, raw: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Slot of each occurrence; all that still probe move on together."""
        words = np.lib.stride_tricks.as_strided(raw.view(), (max(0, len(raw) - 7), 8), (1, 1)) if len(raw) >= 8 else None
        mask, owner = np.uint64(len(self.owner) - 1), self.owner
        slot = (keys & mask).astype(np.int64)
        todo = np.arange(len(keys))
        while len(todo):
            at = slot[todo]
            free = owner[at] < 0
            owner[at[free]] = todo[free]
            holder = owner[at]
            same = (keys[holder] == keys[todo]) & (length[holder] == length[todo])
            check = np.flatnonzero(same & (holder != todo))
            same[check] = _equal(words, start[holder[check]], start[todo[check]], length[todo[check]])
            todo = todo[~same]
            slot[todo] = (slot[todo] + 1) & int(mask)
        return slot


def _equal(words: np.ndarray | None, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the bytes from ``a`` and from ``b`` on are the same, eight at a time."""
    same = np.ones(len(a), bool)
    todo, k = np.flatnonzero(length > 0), 0
    while len(todo):
        x = np.ascontiguousarray(words[a[todo] + k]).view(np.uint64).ravel()
        y = np.ascontiguousarray(words[b[todo] + k]).view(np.uint64).ravel()
        good = ((x ^ y) & _TAIL[np.minimum(length[todo] - k, 8)]) == 0
        same[todo[~good]] = False
        k += 8
        todo = todo[good & (length[todo] > k)]
    return same


def _batches(texts: list[str]):
    """Bounds of runs of texts of up to ``BATCH_BYTES`` characters."""
    at = 0
    while at < len(texts):
        upto, size = at + 1, len(texts[at])
        while upto < len(texts) and size + len(texts[upto]) <= BATCH_BYTES:
            size += len(texts[upto])
            upto += 1
        yield at, upto
        at = upto


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS, size: int = SIZE) -> list[int]:
    """How many features of all texts fall in each bucket; the driver gets these ``buckets`` numbers only."""
    @released
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            some = [t or "" for t in batch.column(0).to_pylist()]
            for a, b in _batches(some):
                table = Table(Ngrams(some[a:b], size), buckets)
                total += np.bincount(table.bucket, weights=table.count, minlength=buckets).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.int64()))], names=["counts"])

    parts = texts.select(F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(run, "counts array<bigint>")
    out = [0] * buckets
    for r in parts.select(F.posexplode("counts").alias("bucket", "n")).where("n > 0").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(own: list[int], target: list[int]) -> np.ndarray:
    """Gain of each bucket from the features of the documents and of the target texts in it."""
    k, s_all, t_all = len(own), sum(own), sum(target)
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + k) / ((s + 1) * (t_all + k))))
                     for s, t in zip(own, target, strict=True)], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, text: str, size: int, names: tuple[str, str, str], keep_text: bool) -> DataFrame:
    """Documents with their number of words, of features, and their weight."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)
    kept = [c for c in docs.columns if keep_text or c != text]
    schema = T.StructType([*[T.StructField(c, docs.schema[c].dataType, True) for c in kept],
                           *[T.StructField(c, T.LongType()) for c in names]])
    body = free_name(docs, "_body")

    @released
    def run(batches):
        gain = shared.value
        for batch in batches:
            some = [t or "" for t in batch.column(body).to_pylist()]
            out = np.zeros((3, len(some)), np.int64)
            for a, b in _batches(some):
                grams = Ngrams(some[a:b], size)
                table = Table(grams, len(gain))
                n = np.bincount(grams.owner, minlength=b - a)
                total = np.bincount(grams.owner, weights=gain[table.bucket[table.slots]], minlength=b - a).astype(np.int64)
                out[:, a:b] = grams.words, n, np.where(n > 0, total // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *map(pa.array, out)], names=schema.names)

    return docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("string").alias(body)).mapInArrow(run, schema)


def numbered(rows: DataFrame, order: list, place: str) -> DataFrame:
    """``rows`` in a global order with their place from 1 on, by sorted ranges instead of one sorted partition."""
    spark = rows.sparkSession
    part, at = free_name(rows, "_part"), free_name(rows, "_at")
    schema = T.StructType([*rows.schema.fields, T.StructField(part, T.IntegerType()), T.StructField(at, T.LongType())])

    def count(batches):
        done, me = 0, TaskContext.get().partitionId()
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, me, np.int32)),
                                              pa.array(np.arange(done + 1, done + n + 1))], names=schema.names)
            done += n

    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = staged(rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).mapInArrow(count, schema), "sample-order")
    offsets, before = [], 0
    for r in sorted(ordered.groupBy(part).count().collect(), key=lambda r: r[part]):  # a row for each range
        offsets.append((r[part], before))
        before += r["count"]
    base = free_name(ordered, "_before")
    table = spark.createDataFrame(offsets, f"`{part}` int, `{base}` bigint")
    return (ordered.join(F.broadcast(table), part)
            .select(*[F.col(f"`{c}`") for c in rows.columns], (F.col(base) + F.col(at)).alias(place)))


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
             buckets: int = BUCKETS, size: int = SIZE, seed: int = SEED, least_words: int = LEAST_WORDS,
             percent: int = PERCENT, keep_text: bool = False) -> DataFrame:
    """All documents with ``n_features``, ``weight``, ``score`` and ``rank`` (null: not drawn).

    ``floor(percent * N / 100)`` of the N documents with ``least_words`` words
    are drawn by score, ties to the smaller id.
    """
    taken = {c.lower() for c in RESULT}
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c in (doc_id, text) or c.lower() not in taken])
    gain = gains(bucket_counts(docs, text, buckets, size), bucket_counts(target, target_text, buckets, size))
    words = free_name(docs, "_words")
    weighed = weigh(docs, gain, text, size, (words, "n_features", "weight"), keep_text)
    noise = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col(f"`{doc_id}`").cast("string")).cast("binary"), 256), 1, 8), 16, 10)
    uniform = (noise.cast("bigint").cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    scored = staged(weighed.withColumn("score", F.col("weight") + F.floor(F.lit(-1000.0) * F.log(-F.log(uniform)))), "sample-scores")

    able = (F.col(words) >= least_words) & F.col("score").isNotNull()
    steps = sorted(((r["score"], r["count"]) for r in scored.where(able).groupBy("score").count().collect()), reverse=True)
    draw, upto, least = percent * sum(n for _, n in steps) // 100, 0, None
    for least, n in steps:  # noqa: B007 -- the score where the draw ends
        upto += n
        if upto >= draw:
            break
    chosen = able & (F.col("score") >= F.lit(least)) if draw else F.lit(False)
    rest = scored.where(~chosen).withColumn("rank", F.lit(None).cast("bigint"))
    if draw:
        top = numbered(scored.where(chosen), [F.col("score").desc(), F.col(f"`{doc_id}`").asc()], "rank")
        rest = rest.unionByName(top.withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank"))))
    return rest.drop(words)
