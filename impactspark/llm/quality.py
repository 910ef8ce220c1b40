"""Quality classifier: hashed word n-gram logistic regression, follow-the-regularised-leader updates.

Features are hashed n-grams of whole texts: single tokens (maximal runs of
letters and digits, or of other visible characters; A-Z lower-cased), pairs
of tokens, and pairs and triples of token shapes (case, digits, repetition;
symbols stand for themselves), which carry over to unseen words.  A document
is the vector of log-damped counts scaled to length 1; its score is the
logistic of a sparse dot product.

Training uses a bounded sample of labelled rows (``MAX_ROWS``, the rows with
the smallest id hashes, dealt to ``SHARDS`` tasks); the shards start each
round from the averaged state of the round before.  Scoring covers every row
and whole texts.

Null and empty texts score as the intercept alone; null labels are not
learned from; each row gives one row, extra columns are kept; without any
labelled row every score is 0.5; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import released, staged, without
from .texthash import LOWER, SPACE, flatten, mix, span_hashes

BITS = 18
MAX_ROWS, SHARDS, ROUNDS = 16_000, 4, 4
ALPHA, BETA, L1, L2 = 4.0, 1.0, 0.005, 1e-4

_CLASS = np.full(256, 2, np.uint8)  # 0 space, 1 letter or digit, 2 other
_CLASS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_CLASS[SPACE] = 0
_UPPER = np.zeros(256, np.int64)
_UPPER[65:91] = 1
_LOWER = np.zeros(256, np.int64)
_LOWER[97:123] = 1
_DIGIT = np.zeros(256, np.int64)
_DIGIT[48:58] = 1


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold`` modulo ``folds``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def _tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and shapes of all tokens, and each text's bounds among them."""
    flat, at = flatten(texts)
    kind = np.concatenate([[0], _CLASS[flat], [0]])
    edge = np.flatnonzero(kind[1:] != kind[:-1])
    start, end = edge[:-1], edge[1:]
    real = kind[start + 1] != 0
    start, end = start[real], end[real]
    h = span_hashes(LOWER[flat], start, end)
    count = lambda table: (lambda c: c[end] - c[start])(np.concatenate([[0], np.cumsum(table[flat])]))
    upper, lower, digit = count(_UPPER), count(_LOWER), count(_DIGIT)
    shape = np.select([_CLASS[flat[start]] == 2, digit > 0, (upper > 0) & (lower == 0), upper > 1, upper == 1],
                      [0, 1, 2, 3, 4], 5).astype(np.uint64) + np.uint64(1)
    shape = np.where(shape == 1, h, shape)
    if len(h):
        same = np.concatenate([[False], h[1:] == h[:-1]])
        shape = np.where(same, np.uint64(9), shape)
    return h, shape, np.searchsorted(start, at)


def features(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Bucket numbers and values of each text; the values have length 1."""
    h, shape, at = _tokens(texts)
    with np.errstate(over="ignore"):
        a, b, c, d = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))
        pair = mix(h[:-1] * a + h[1:] * b)
        s2 = mix(shape[:-1] * c + shape[1:] * d)
        s3 = mix(s2[:-1] * a + shape[2:] * d)
    drop = np.uint64(64 - BITS)
    one, pair, s2, s3 = ((x >> drop).astype(np.int64) for x in (mix(h), pair, s2, s3))
    out = []
    for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if i == j:
            out.append((np.empty(0, np.int32), np.empty(0, np.float32)))
            continue
        n = np.bincount(np.concatenate([one[i:j], pair[i:j - 1], s2[i:j - 1], s3[i:max(i, j - 2)]]), minlength=1) \
            if j - i > 20_000 else None
        if n is not None:
            k = np.flatnonzero(n)
            n = n[k]
        else:
            k, n = np.unique(np.concatenate([one[i:j], pair[i:j - 1], s2[i:j - 1], s3[i:max(i, j - 2)]]),
                             return_counts=True)
        v = np.log1p(n)
        out.append((k.astype(np.int32), (v / np.sqrt((v * v).sum())).astype(np.float32)))
    return out


def _texts(column: pd.Series) -> list[str]:
    return [t if isinstance(t, str) else "" for t in column]


class Leader:
    """State of the updates: the sums ``z`` and ``n`` of each bucket, the intercept last."""

    def __init__(self, z: np.ndarray | None = None, n: np.ndarray | None = None):
        size = (1 << BITS) + 1
        self.z = np.zeros(size) if z is None else z
        self.n = np.zeros(size) if n is None else n

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        free = np.abs(z) > L1
        return np.where(free, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2), 0.0)

    def learn(self, k: np.ndarray, v: np.ndarray, label: int) -> None:
        k = np.append(k, len(self.z) - 1)
        v = np.append(v, 1.0)
        w = self.weights(k)
        p = 1 / (1 + np.exp(-np.clip(w @ v, -35, 35)))
        g = (p - label) * v
        n = self.n[k]
        more = n + g * g
        self.z[k] += g - (np.sqrt(more) - np.sqrt(n)) / ALPHA * w
        self.n[k] = more


def _round(z: np.ndarray, n: np.ndarray):
    """One pass over a shard, from the state that the last round ended with."""
    def learn(df: pd.DataFrame) -> pd.DataFrame:
        state = Leader(z.copy(), n.copy())
        for k, v, y in df.sort_values("turn")[["k", "v", "label"]].itertuples(index=False):
            state.learn(np.asarray(k, np.int64), np.asarray(v, np.float64), y)
        return pd.DataFrame({"z": [state.z.tobytes()], "n": [state.n.tobytes()]})

    return learn


def bounded_sample(labels: DataFrame, doc_id: str, label: str, rows: int) -> DataFrame:
    """At most about ``rows`` labelled ids, by the hash of the id, so the same ones on every run."""
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label")).where(
        "id is not null and label is not null")
    n = known.count()
    part = min(1.0, rows / max(1, n))
    return known.where(F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1 << 20)) < int(part * (1 << 20)))


def train(docs: DataFrame, labels: DataFrame, label: str, doc_id: str = "doc_id", text: str = "text",
          max_rows: int = MAX_ROWS) -> np.ndarray:
    """Weights (the intercept last) learned from a bounded sample of the labelled rows."""
    sample = bounded_sample(labels, doc_id, label, max_rows)
    rows = (docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
            .join(F.broadcast(sample), "id"))  # at most max_rows slim rows

    @released
    def extract(batches):
        for df in batches:
            f = features(_texts(df["text"]))
            yield pd.DataFrame({"id": df["id"], "label": df["label"], "k": [k for k, _ in f], "v": [v for _, v in f]})

    kind = rows.schema["id"].dataType.simpleString()
    coded = staged(rows.mapInPandas(extract, f"id {kind}, label int, k array<int>, v array<float>")
                   .withColumn("turn", F.xxhash64("id", F.lit(5)))
                   .withColumn("shard", F.pmod(F.col("turn"), F.lit(SHARDS)).cast("int")), "quality-sample")
    z = n = np.zeros((1 << BITS) + 1)
    for _ in range(ROUNDS):
        got = coded.groupBy("shard").applyInPandas(_round(z, n), "z binary, n binary").collect()
        if not got:
            break
        z = np.mean([np.frombuffer(r["z"]) for r in got], axis=0)
        n = np.mean([np.frombuffer(r["n"]) for r in got], axis=0)
    return Leader(z, n).weights()


def score(docs: DataFrame, weights: np.ndarray, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` without ``text``, with ``out``: the probability of label 1."""
    docs = without(docs, out, keep=(text,))
    kept = [f for f in docs.schema.fields if f.name != text]
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # 2 MB, whatever the input

    @released
    def run(batches):
        w = shared.value
        for df in batches:
            x = np.array([w[k] @ v for k, v in features(_texts(df[text]))], np.float64)
            p = 1 / (1 + np.exp(-np.clip(x + w[-1], -35, 35)))
            yield df[[f.name for f in kept]].assign(**{out: p})

    return docs.mapInPandas(run, T.StructType([*kept, T.StructField(out, T.DoubleType())]))
