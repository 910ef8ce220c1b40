"""Mixing sources to target weights with soft memberships.

A classifier fitted on a labelled table predicts for every document how
likely it belongs to each domain (hashed-word likelihoods, tempered by the
text's length, so that mixed texts keep mixed memberships).  The domains'
token totals are then expectations over these memberships, and a nonnegative
rate is sought for every document such that the expected totals under the
rates match the targets: least squares over the rates,

    1/2 sum_d (T_d - t_d)^2 / s_d,   T_d = sum_i u_i p_id rate_i,

with u_i = tokens_i / all tokens and s_d the domain's share (T_d at rate 1).
It is minimised by accelerated projected-gradient steps from rate 1,

    rate_i <- max(least, rate_i - sum_d p_id (T_d - t_d) / s_d).

Dividing by the shares makes a step of length 1 safe whatever the data (the
rows of the curvature, M_de / s_d with M_de = sum_i u_i p_id p_ie, sum to 1)
and lets frequent and rare domains converge alike.  Every step needs one sum
over the documents, a row for each domain; the rates are never stored or
collected: each task repeats the steps from the domains' weights.  Steps end
when every total is within ``TOLERANCE`` of the smallest target; targets that
``steps`` do not meet are reported by a warning.

The domains are those of all labelled rows that have a document; a target for
another one is an error.  The classifier is fitted on a bounded sample of
these rows (``MAX_ROWS``, dealt evenly over the domains and in each those with
the smallest id hashes); memberships, totals and rates cover
all documents.  Tokens are those of a given tokenizer, or words where none is
given.  Texts without tokens weigh nothing and get rate 1 (or ``least``); null
domains are not learned from; repeated rows get equal rates; an empty table
gives an empty result.
"""

from __future__ import annotations

import warnings

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, released, staged
from .rank_merges import merge_ranks
from .texthash import words
from .token_counts import Counter, read_tokenizer

MAX_ROWS, BUCKETS, MAX_DOMAINS = 8_000, 1 << 15, 256
STEPS, TOLERANCE = 200, 1e-3


def _texts(column: pd.Series) -> list[str]:
    return [t if isinstance(t, str) else "" for t in column]


class Memberships:
    """Log-likelihoods of hashed words in each domain."""

    def __init__(self, domains: list[str], table: np.ndarray):
        self.domains, self.table = domains, table

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token counts and posteriors (one row for each text)."""
        h, at = words(texts)
        size = np.diff(at)
        rows = self.table[(h % np.uint64(BUCKETS)).astype(np.int64)]
        total = np.concatenate([np.zeros((1, len(self.domains))), np.cumsum(rows, axis=0)])
        logit = (total[at[1:]] - total[at[:-1]]) / np.sqrt(np.maximum(size, 1))[:, None]
        p = np.exp(logit - logit.max(axis=1, keepdims=True))
        return size, p / p.sum(axis=1, keepdims=True)


def _parts(sizes: dict[str, int], rows: int) -> dict[str, float]:
    """The part of each domain's rows to take: small domains whole, the others alike many, ``rows`` in all."""
    out, left = {}, rows
    for k, (d, n) in enumerate(sorted(sizes.items(), key=lambda x: x[1])):
        out[d] = min(1.0, left / (len(sizes) - k) / n)
        left -= out[d] * n
    return out


def fit_domains(docs: DataFrame, labelled: DataFrame, doc_id: str = "doc_id", text: str = "text",
                domain: str = "domain", max_rows: int = MAX_ROWS) -> Memberships:
    """Learns the domains of ``labelled`` (``doc_id``, ``domain``) from a bounded sample of its rows."""
    known = labelled.select(F.col(doc_id).alias("id"), F.col(domain).cast("string").alias("domain")).where(
        "id is not null and domain is not null")
    known = staged(known.join(docs.select(F.col(f"`{doc_id}`").alias("id")), "id", "left_semi"), "mix-labelled")
    sizes = {r["domain"]: r["count"] for r in known.groupBy("domain").count().orderBy(F.col("count").desc(), "domain")
             .limit(MAX_DOMAINS + 1).collect()}
    names = list(sizes)
    if len(names) > MAX_DOMAINS:
        raise ValueError(f"more than {MAX_DOMAINS} domains")
    if not names:
        return Memberships(["all"], np.zeros((BUCKETS, 1)))
    top = 1 << 40
    cut = F.create_map(*[F.lit(x) for d, part in _parts(sizes, max_rows).items() for x in (d, max(1, int(part * top)))])
    some = known.where(F.pmod(F.xxhash64("id", F.lit(17)), F.lit(top)) < cut[F.col("domain")])
    rows = staged(docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
                  .join(F.broadcast(some), "id").select("text", "domain"), "mix-sample")  # max_rows slim rows at most
    number = {d: k for k, d in enumerate(names)}

    @released
    def count(batches):
        total = np.zeros((len(names), BUCKETS))
        for df in batches:
            h, at = words(_texts(df["text"]))
            which = np.repeat(df["domain"].map(number).to_numpy(np.int64), np.diff(at))
            np.add.at(total, (which, (h % np.uint64(BUCKETS)).astype(np.int64)), 1)
        yield pd.DataFrame({"domain": range(len(names)), "counts": [x.tobytes() for x in total]})

    def add(df: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x) for x in df["counts"])
        return pd.DataFrame({"domain": df["domain"].iloc[:1], "counts": [total.tobytes()]})

    schema = "domain int, counts binary"
    got = rows.mapInPandas(count, schema).groupBy("domain").applyInPandas(add, schema).collect()
    total = np.zeros((len(names), BUCKETS))
    for r in got:
        total[r["domain"]] = np.frombuffer(r["counts"])
    total += 0.1
    table = np.log(total / total.sum(axis=1, keepdims=True)).T
    return Memberships(names, np.ascontiguousarray(table - table.max(axis=1, keepdims=True)))


def tempered(share: np.ndarray, power: float) -> np.ndarray:
    """Target weights between the shares themselves (1) and equal weights (0)."""
    w = np.where(share > 0, np.maximum(share, 1e-300) ** power, 0.0)
    return w / w.sum() if w.sum() > 0 else w


def _unfold(p: np.ndarray, history: list[tuple[np.ndarray, float]], least: float) -> np.ndarray:
    """Rates after the steps of ``history``: the domains' weights of each, and its momentum."""
    before = rate = np.ones(len(p))
    for weight, momentum in history:
        moved = np.maximum(least, rate - p @ weight)
        rate = np.maximum(least, moved + momentum * (moved - before))
        before = moved
    return rate


def _totals(slim: DataFrame, history: list[tuple[np.ndarray, float]], least: float, size: int) -> np.ndarray:
    """``sum_i n_i rate_i p_id`` for each domain d; one row for each task reaches the last sum."""
    @released
    def run(batches):
        total = np.zeros(size)
        for df in batches:
            if len(df):
                p = np.stack(df["p"])
                total += (df["n"].to_numpy(np.float64) * _unfold(p, history, least)) @ p
        yield pd.DataFrame([total], columns=names)

    names = [f"s{k}" for k in range(size)]
    parts = slim.select("n", "p").mapInPandas(run, ", ".join(f"{n} double" for n in names))
    return np.array([x or 0.0 for x in parts.agg(*[F.sum(n) for n in names]).first()])


class Mix:
    """What the solver found: shares, targets and reached totals (as shares of all tokens), the steps, and whether all
    targets are met within the tolerance."""

    def __init__(self, domains, share, target, history, least, reached, met):
        self.domains, self.share, self.target, self.history = domains, share, target, history
        self.least, self.reached, self.met = least, reached, met

    def rates(self, p: np.ndarray) -> np.ndarray:
        return _unfold(p, self.history, self.least)


def solve(slim: DataFrame, domains: list[str], targets: dict[str, float] | None, power: float,
          least: float = 0.0, steps: int = STEPS) -> Mix:
    """Rates for ``slim`` (columns n, p).

    ``targets`` are weights by domain (None: the shares to the ``power``).
    With ``least`` > 0 the total grows until every target can be met.
    """
    history: list[tuple[np.ndarray, float]] = []
    total = _totals(slim, history, least, len(domains))
    if targets and total.sum() > 0 and (lost := sorted(set(targets) - set(domains))):
        raise ValueError(f"targets without a domain: {lost}")
    n = max(total.sum(), 1.0)
    share = reached = total / n
    target = tempered(share, power) if targets is None else np.array([targets.get(d, 0.0) for d in domains])
    target = target / target.sum() if target.sum() > 0 else share.copy()
    if least > 0:
        held = target > 0
        target = target * max(1.0, float((least * share[held] / target[held]).max(initial=0.0)))
    scale = np.where(share > 0, share, 1.0)
    near = TOLERANCE * max(1e-9, float(target[target > 0].min(initial=1.0)))
    speed, cost = 1.0, np.inf
    while True:
        gap = reached - target
        last, cost = cost, float((gap ** 2 / scale).sum())
        # with a least rate, a domain may stay over its target because no rate can fall further
        enough = least > 0 and (-gap).max(initial=0.0) <= near and cost > 0.9 * last
        if np.abs(gap).max(initial=0.0) <= near or enough or len(history) >= steps:
            break
        if cost > last:  # momentum carried too far: start it again
            speed = 1.0
        faster = (1 + np.sqrt(1 + 4 * speed * speed)) / 2
        history.append((gap / scale, (speed - 1) / faster))
        speed = faster
        reached = _totals(slim, history, least, len(domains)) / n
    met = bool(np.abs(reached - target).max(initial=0.0) <= near)
    return Mix(domains, share, target, history, least, reached, met)


class Solved:
    """Documents with token counts and memberships (stored once), and the solved rates of the table."""

    def __init__(self, docs: DataFrame, labelled: DataFrame, targets, power, least, doc_id, text, domain, tokens, keep_text):
        model = fit_domains(docs, labelled, doc_id, text, domain)
        spark = docs.sparkSession
        spec = read_tokenizer(tokens) if tokens else None
        shared = spark.sparkContext.broadcast((model, (spec, merge_ranks(spec)) if spec else None))
        self.domains = model.domains
        self.kept = [c for c in docs.columns if keep_text or c != text]
        self.n, self.p, body = free_name(docs, "_n"), free_name(docs, "_p"), free_name(docs, "_body")
        own = T.StructType.fromDDL(f"`{self.n}` bigint, `{self.p}` array<double>")
        schema = T.StructType([*[T.StructField(c, docs.schema[c].dataType, True) for c in self.kept], *own.fields])
        kept, n_name, p_name = self.kept, self.n, self.p

        @released
        def weigh(batches):
            model, counting = shared.value
            counter = Counter(*counting) if counting else None
            for batch in batches:
                texts = [t or "" for t in batch.column(body).to_pylist()]
                n, p = model.of(texts)
                if counter:
                    n = np.array(counter.whole(texts), np.int64)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * p.shape[1]), pa.array(p.ravel()))
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(n, pa.int64()), flat],
                                                 names=[*kept, n_name, p_name])

        source = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("string").alias(body))
        self.rows = staged(source.mapInArrow(weigh, schema), "mix-weighed")
        slim = self.rows.select(F.col(self.n).alias("n"), F.col(self.p).alias("p"))
        self.mix = m = solve(slim, model.domains, targets, power, least)
        if not m.met:
            far = [(abs(r - t), f"{d} {r:.3g} for {t:.3g}") for d, r, t in zip(m.domains, m.reached, m.target, strict=True)]
            warnings.warn(f"targets not met: {', '.join(x for _, x in sorted(far, reverse=True)[:5])}", stacklevel=4)

    def rated(self, names: tuple[str, str, str, str]) -> DataFrame:
        """The documents with token count, likeliest domain, its membership and the rate under ``names``."""
        kinds = ("bigint", "string", "double", "double")
        own = T.StructType.fromDDL(", ".join(f"`{n}` {k}" for n, k in zip(names, kinds, strict=True)))
        schema = T.StructType([*[self.rows.schema[c] for c in self.kept], *own.fields])
        solved, domains, kept, n_name, p_name = self.mix, self.domains, self.kept, self.n, self.p

        def rate(batches):
            for batch in batches:
                n = batch.column(n_name).to_numpy(zero_copy_only=False)
                p = batch.column(p_name).flatten().to_numpy(zero_copy_only=False).reshape(len(n), len(domains))
                best = p.argmax(axis=1)
                rates = np.where(n > 0, solved.rates(p), max(1.0, solved.least))
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], batch.column(n_name),
                                                  pa.array([domains[k] for k in best], pa.string()), pa.array(p[np.arange(len(n)), best]),
                                                  pa.array(rates)], names=schema.names)

        return self.rows.mapInArrow(rate, schema)


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None, power: float = 0.5,
        least: float = 0.0, doc_id: str = "doc_id", text: str = "text", domain: str = "domain",
        tokens: str | None = None, keep_text: bool = True) -> tuple[DataFrame, Mix]:
    """``docs`` with ``n_tokens``, ``domain``, ``membership`` (of that domain) and ``rate``; and what was solved.

    ``tokens`` is the path of a byte-level tokenizer (None: words count).
    Columns of the input with these names are replaced.
    """
    added = ("n_tokens", "domain", "membership", "rate")
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in added or c == text])
    solved = Solved(kept, labelled, targets, power, least, doc_id, text, domain, tokens, keep_text)
    return solved.rated(added), solved.mix


def resample(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None, power: float = 0.5,
             least: float = 0.0, doc_id: str = "doc_id", text: str = "text", domain: str = "domain",
             tokens: str | None = None) -> DataFrame:
    """``docs``, same columns, each row as many times as its rate says: the whole part, and once more when the
    id's hash falls below the rest."""
    names = tuple(free_name(docs, x) for x in ("_tokens", "_domain", "_membership", "_rate"))
    rated = Solved(docs, labelled, targets, power, least, doc_id, text, domain, tokens, True).rated(names)
    rate, copies, one = names[3], free_name(docs, "_copies"), free_name(docs, "_copy")
    chance = F.pmod(F.xxhash64(F.col(f"`{doc_id}`"), F.lit(23)), F.lit(1 << 30)) / float(1 << 30)
    times = F.floor(rate) + F.when(chance < F.col(rate) - F.floor(rate), 1).otherwise(0)
    return (rated.withColumn(copies, times.cast("int")).where(F.col(copies) > 0)
            .withColumn(one, F.explode(F.sequence(F.lit(1), F.col(copies))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
