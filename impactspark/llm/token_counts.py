"""Token counts of whole texts, huge ones by overlap resynchronisation.

A text of more than ``chunk`` characters is cut at nominal places; every
chunk is encoded with offsets together with ``overlap`` characters on either
side, on its own row.  Two neighbours are spliced at the first *stable*
token boundary after their nominal cut that both encodings show: a space
between two visible characters.  The pre-tokenizer can only join a space to
what follows it, and nothing before a visible character looks past it, so a
token starts at that space whatever stands left and right of the chunk.  A
cut without such a place in the overlap fails to align; its document is
encoded again with wider overlaps and chunks until all cuts align (at the
widest it is one chunk).

Shorter texts are encoded in one piece.  Where the merges are proven to be
those of the ranks (``rank_merges``) the faster library for rank files
encodes, otherwise the tokenizer's own; the tokens are the same.

Null texts count as empty (0 tokens); each row gives one row, extra columns
are kept; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe_codec import PATTERN
from .common import free_name, released, staged, without
from .rank_merges import merge_ranks

CHUNK, OVERLAP = 32_768, 512
#: Short texts that are encoded together.
TOGETHER = 32

_STABLE = re.compile(r"(?<=[!-~]) (?=[!-~])")


def read_tokenizer(path: str) -> str:
    """The tokenizer's JSON, read on the driver.

    Only a byte-level pre-tokenizer that splits by its own pattern, without a
    normalizer, has the stable boundaries this module relies on.
    """
    with open(path, encoding="utf-8") as f:
        text = f.read()
    spec = json.loads(text)
    kind = spec.get("pre_tokenizer") or {}
    if kind.get("type") != "ByteLevel" or not kind.get("use_regex", True) or kind.get("add_prefix_space") \
            or spec.get("normalizer") or any(t.get("lstrip") or t.get("rstrip") for t in spec.get("added_tokens", ())):
        raise ValueError("a byte-level tokenizer without normalizer or prefix space is expected")
    return text


def special_tokens(spec: str) -> dict[str, int] | None:
    """The strings that stand for a token of their own, or None if they are not plain ones that only one rule can find."""
    added = json.loads(spec).get("added_tokens", ())
    names = [t["content"] for t in added]
    plain = all(t.get("special") and not t.get("single_word") for t in added)
    apart = not any(x != y and y.startswith(x) for x in names for y in names)
    return {t["content"]: t["id"] for t in added} if plain and apart and all(names) else None


class Counter:
    """Counts by one tokenizer inside a worker; ``ranks`` are given where they are proven to give the same tokens."""

    def __init__(self, spec: str, ranks: dict[bytes, int] | None = None):
        self.ranked, special = None, special_tokens(spec)
        if ranks is not None and special is not None:
            import tiktoken

            self.ranked = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
            sizes = {i: len(x) for x, i in ranks.items()} | {i: len(x.encode()) for x, i in special.items()}
            self.size = np.array([sizes.get(i, 0) for i in range(max(sizes) + 1)], np.int64)
            return
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

    def whole(self, texts: list[str]) -> list[int]:
        """Token counts of texts, each encoded as a whole."""
        if self.ranked is not None:
            return [len(self.ranked.encode_to_numpy(t, allowed_special="all")) for t in texts]
        return [len(e) for k in range(0, len(texts), TOGETHER)
                for e in self.tokenizer.encode_batch_fast(texts[k:k + TOGETHER], add_special_tokens=False)]

    def starts(self, text: str) -> np.ndarray:
        """Byte offset of the start of each token of a text, and of its end."""
        raw = np.zeros(1, np.int64)
        if self.ranked is not None:
            return np.concatenate([raw, np.cumsum(self.size[self.ranked.encode_to_numpy(text, allowed_special="all")])])
        coded = self.tokenizer.encode(text, add_special_tokens=False)
        chars = np.array([b for _, b in coded.offsets], np.int64)  # a token's end; what starts there may leave out a space
        size = np.fromiter((len(c.encode("utf-8", "surrogatepass")) for c in text), np.int64, len(text))
        return np.concatenate([raw, np.concatenate([raw, np.cumsum(size)])[chars]])

    def chunk(self, text: str, left: tuple[int, int], right: tuple[int, int]) -> tuple[int, int, int]:
        """Splice places (relative, -1: none) in the two overlaps and the tokens between them.

        ``left`` and ``right`` are the ranges to look in; an empty range at a
        text's end stands for that end itself.
        """
        starts = self.starts(text)
        a, first = (0, 0) if left[0] == left[1] == 0 else self._stable(text, starts, *left)
        b, last = (len(text), len(starts) - 1) if right[0] == right[1] == len(text) else self._stable(text, starts, *right)
        return a, b, last - first if a >= 0 and b >= 0 else 0

    @staticmethod
    def _stable(text: str, starts: np.ndarray, low: int, high: int) -> tuple[int, int]:
        """The first stable boundary in the range where a token starts in this encoding, and the tokens before it."""
        at, byte = 0, 0
        for m in _STABLE.finditer(text, max(low, 1), high):
            byte += len(text[at:m.start()].encode("utf-8", "surrogatepass"))
            at = m.start()
            k = int(np.searchsorted(starts, byte))
            if starts[k] == byte:
                return at, k
        return -1, 0


_COUNTERS: dict[int, Counter] = {}


def _counter(shared) -> Counter:
    spec, ranks = shared.value
    key = hash(spec)
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = Counter(spec, ranks)
    return _COUNTERS[key]


def _count_whole(docs: DataFrame, shared, text: str, out: str) -> DataFrame:
    schema = T.StructType([*[f for f in docs.schema.fields if f.name != text], T.StructField(out, T.LongType())])

    @released
    def run(batches):
        counter = _counter(shared)
        for df in batches:
            n = counter.whole([t if isinstance(t, str) else "" for t in df[text]])
            yield df.drop(columns=[text]).assign(**{out: pd.Series(n, index=df.index, dtype="int64")})

    return docs.mapInPandas(run, schema)


def _cut(texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """``(digest, k, chunks, at, text)`` of each text's chunks with their overlaps."""
    @released
    def run(batches):
        for df in batches:
            for digest, t in zip(df["digest"], df["text"], strict=True):
                n = max(1, -(-len(t) // chunk))
                for k in range(n):
                    a, b = max(0, k * chunk - overlap), min(len(t), (k + 1) * chunk + overlap)
                    yield pd.DataFrame({"digest": [digest], "k": [k], "chunks": [n], "at": [a], "text": [t[a:b]]})

    return texts.select("digest", "text").mapInPandas(run, "digest string, k bigint, chunks bigint, at bigint, text string")


def _count_chunks(chunks: DataFrame, shared, chunk: int, overlap: int) -> DataFrame:
    """``(digest, k, chunks, first, last, n)``: the splice places in the text, null where none."""
    @released
    def run(batches):
        counter = _counter(shared)
        for df in batches:
            rows = []
            for digest, k, n, at, t in df.itertuples(index=False):
                left = (0, 0) if k == 0 else (k * chunk - at, min(len(t), k * chunk + overlap - at))
                right = (len(t), len(t)) if k == n - 1 else ((k + 1) * chunk - at, len(t))
                a, b, count = counter.chunk(t, left, right)
                rows.append((digest, k, n, at + a if a >= 0 else -1, at + b if b >= 0 else -1, count))
            yield pd.DataFrame(rows, columns=["digest", "k", "chunks", "first", "last", "n"])

    return chunks.mapInPandas(run, "digest string, k bigint, chunks bigint, first bigint, last bigint, n bigint")


def _count_huge(texts: DataFrame, shared, chunk: int, overlap: int) -> DataFrame:
    """``(digest, n_tokens)`` of distinct texts, by chunks on rows of their own."""
    done, spark = None, texts.sparkSession
    while True:
        # a stated number of partitions: few bytes of text are much work, so they must not be put together
        deal = int(spark.conf.get("spark.sql.shuffle.partitions"))
        pieces = _cut(texts, chunk, overlap).repartition(deal, "digest", "k")
        parts = _count_chunks(pieces, shared, chunk, overlap).groupBy("digest").agg(
            F.array_sort(F.collect_list(F.struct("k", "first", "last", "n"))).alias("c"))
        meets = F.expr("forall(sequence(1, size(c)), i -> i = size(c) or (c[i].first >= 0 and c[i].first = c[i - 1].last))")
        counted = staged(parts.select("digest", meets.alias("aligned"),
                                      F.expr("aggregate(c, 0L, (s, x) -> s + x.n)").alias("n_tokens")), "token-chunks")
        good = counted.where("aligned").select("digest", "n_tokens")
        done = good if done is None else done.unionByName(good)
        failed = counted.where("not aligned").select("digest")
        if failed.isEmpty():
            return done
        texts = texts.join(failed, "digest", "left_semi")
        chunk, overlap = chunk * 4, overlap * 8


def count_tokens(docs: DataFrame, path: str, text: str = "text", out: str = "n_tokens",
                 chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``docs`` without ``text``, with ``out``: the token count of each whole text.

    Texts of up to ``chunk`` characters never shuffle.  Longer ones spread by
    chunk; equal ones are encoded once and joined back by their digest.
    """
    spec = read_tokenizer(path)
    shared = docs.sparkSession.sparkContext.broadcast((spec, merge_ranks(spec)))
    docs = without(docs, out, keep=(text,))
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    long = F.length(body) > chunk
    short = _count_whole(docs.where(~long), shared, text, out)
    key = free_name(docs, "_digest")
    rows = docs.where(long).withColumn(key, F.sha2(body.cast("binary"), 256))
    texts = rows.select(F.col(key).alias("digest"), F.col(f"`{text}`").alias("text")).dropDuplicates(["digest"])
    counts = _count_huge(staged(texts, "token-huge"), shared, chunk, overlap)
    huge = rows.drop(text).join(counts.select(F.col("digest").alias(key), F.col("n_tokens").alias(out)), key)
    return short.unionByName(huge.drop(key).select(*short.columns))
