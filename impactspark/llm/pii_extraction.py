"""Personal data: fixed patterns, and identifiers that bootstrapped contexts discover.

1. *Seeds.*  The base patterns (e-mail address, IPv4 address, card number
   with its check digit, international phone number) give spans in code
   points.  They always stay.
2. *Candidates.*  What else looks like an identifier of a kind, in the text
   that no seed covers: addresses written with ``(at)`` or without a domain
   name, IPv6 addresses, runs of 12 to 19 digits for cards and of 7 to 15 for
   phones, whatever separates them.
3. *Patterns.*  The context of a seed or candidate gives lexical patterns:
   two words before it, a word on either side, and a label before it (a word
   that ends in ``:``, ``=`` or ``#``).  Words are lower-cased, digits are 0.
4. *Graph.*  Patterns and different values form a bipartite graph.  In each
   round a pattern's confidence for a kind is the weight of that kind's known
   values in it over all values in it (of any kind) plus one; a pattern
   counts from ``SUPPORT`` known values and a share of ``PRECISION`` on.  A
   value's score is the noisy-or of its patterns' confidences; from
   ``ACCEPT`` on it is known with that weight in the next round.  Rounds end
   when no value is new.  Copies of a text add nothing, since values and
   patterns count once.
5. Every occurrence of an accepted value becomes a span of its best kind.

Values are held as 64-bit hashes.  Null texts count as empty; each row gives
one row, repeated rows and null ids included; columns of the results' names
are replaced, others kept; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, released, staged

#: Kinds in listing order.
KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
#: Least weight of known values and least share of them in a pattern that counts; least score of an accepted value.
SUPPORT, PRECISION, ACCEPT = 4.0, 0.8, 0.9
#: Characters that a context reaches to the left and right, and those of a word that count.
REACH, WORD = 64, 32

RESULT = ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")

# The base patterns.  An address is found by its @ and domain, then extended to the left; digits do not
# stand before an IPv4 address that starts leftmost; so both take linear time and match what the whole pattern matches.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# candidates
_AT = re.compile(r"(?:\x20?[\[({]\x20?[Aa][Tt]\x20?[\])}]\x20?|@)(?=[A-Za-z0-9])")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:(?:\.|\x20?[\[({]\x20?[Dd][Oo][Tt]\x20?[\])}]\x20?)[A-Za-z0-9-]+)*")
_IP6 = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")
_NUMBER = re.compile(r"(?<![0-9A-Za-z_.])[0-9](?:[\x20./()-]{0,2}[0-9])+(?![0-9A-Za-z_])")

_ZERO = str.maketrans("123456789", "000000000")
_PLAIN = re.compile(r"[^0-9a-z:@.]+")


def _digits(s: str) -> list[int]:
    return [ord(c) - 48 for c in s if "0" <= c <= "9"]


def checks_out(digits: list[int]) -> bool:
    """Whether the last digit is the check digit of the others (Luhn)."""
    doubled = [2 * d - 9 * (d > 4) for d in digits[-2::-2]]
    return (sum(doubled) + sum(digits[-1::-2])) % 10 == 0


def _left(text: str, at: int, least: int) -> int:
    """Where the run of address characters that ends at ``at`` begins, not before ``least``."""
    while at > least and text[at - 1] in _LOCAL:
        at -= 1
    return at


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` of the base patterns, by kind and start; spans of different kinds may overlap."""
    out, done = [], 0
    for m in _DOMAIN.finditer(text):
        start = _left(text, m.start(), done)
        if start < m.start():
            out.append((EMAIL, start, m.end()))
            done = m.end()
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            out.append((IP, m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m[0])) <= 19 and checks_out(d):
            out.append((CARD, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_digits(m[0])) <= 15:
            out.append((PHONE, m.start(), m.end()))
    return out


def _without(text: str, spans) -> str:
    """``text`` with the spans overwritten, so that nothing is found in them or across them."""
    parts, at = [], 0
    for a, b in sorted(spans):
        if b > at:
            parts += text[at:max(a, at)], "\x00" * (b - max(a, at))
            at = b
    return "".join([*parts, text[at:]])


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` of what looks like an identifier outside the base spans; a run of digits can have two kinds."""
    rest = _without(text, [(a, b) for _, a, b in base]) if base else text
    out, done = [], 0
    for m in _AT.finditer(rest):
        start = _left(rest, m.start(), done)
        if start < m.start():
            done = _HOST.match(rest, m.end()).end()
            out.append((EMAIL, start, done))
    if rest.count(":") > 1:
        if out:
            rest = _without(rest, [(a, b) for _, a, b in out])
        out += [(IP, m.start(), m.end()) for m in _IP6.finditer(rest)]
    if out:
        rest = _without(rest, [(a, b) for _, a, b in out])
    for m in _NUMBER.finditer(rest):
        n = len(_digits(m[0]))
        if 12 <= n <= 19:
            out.append((CARD, m.start(), m.end()))
        if 7 <= n <= 15:
            out.append((PHONE, m.start(), m.end()))
    return out


def patterns(text: str, start: int, end: int) -> list[str]:
    """The lexical patterns of a span's context."""
    low = max(0, start - REACH)
    left = text[low:start].lower().translate(_ZERO)
    words = left.split()
    if low and words and not left[:1].isspace():
        words = words[1:]
    words = [w[-WORD:] for w in words[-2:]]
    right = [w[:WORD] for w in text[end:end + REACH].lower().translate(_ZERO).split(None, 1)[:1]]
    out = []
    if len(words) == 2:
        out.append(f"{words[0]} {words[1]} _")
    if words and right:
        out.append(f"{words[-1]} _ {right[0]}")
    if words and words[-1][-1] in ":=#":
        out.append(f"{words[-1]} _")
    return out


def value_hash(s: str) -> int:
    """A value without what separates its parts, as a signed 64-bit hash."""
    plain = _PLAIN.sub("", s.lower())
    return int.from_bytes(hashlib.blake2b(plain.encode(), digest_size=8).digest(), "little", signed=True)


def span_texts(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


_SPAN = "struct<kind: int, start: bigint, end: bigint>"
_SEEN = "array<struct<kind: int, start: bigint, end: bigint, value: bigint, seed: boolean, patterns: array<string>>>"
_SEEN_ARROW = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.int64()),
                                  ("seed", pa.bool_()), ("patterns", pa.list_(pa.string()))]))
_BASE_ARROW = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))


def _scanned(docs: DataFrame, text: str, kept: list[str], names: dict[str, str]) -> DataFrame:
    """Documents with a row number, their base spans, and seeds and candidates with their patterns."""
    body = free_name(docs, "_body")
    own = T.StructType.fromDDL(f"`{names['row']}` bigint, `{names['base']}` array<{_SPAN}>, `{names['seen']}` {_SEEN}")
    schema = T.StructType([*[T.StructField(c, docs.schema[c].dataType, True) for c in kept], *own.fields])

    @released
    def run(batches):
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            base, seen = [], []
            for t in batch.column(body).to_pylist():
                t = t or ""
                own = base_spans(t)
                more = candidates(t, own)
                base.append([{"kind": k, "start": a, "end": b} for k, a, b in own])
                seen.append([{"kind": k, "start": a, "end": b, "value": value_hash(t[a:b]), "seed": seed, "patterns": patterns(t, a, b)}
                             for spans, seed in ((own, True), (more, False)) for k, a, b in spans])
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(range(row, row + n), pa.int64()),
                 pa.array(base, _BASE_ARROW), pa.array(seen, _SEEN_ARROW)], names=schema.names)
            row += n

    return docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("string").alias(body)).mapInArrow(run, schema)


def graph(seen: DataFrame) -> DataFrame:
    """``(kind, pattern, value, weight)``: the edges for each kind, different ones once.

    ``seen`` has the columns kind, value, seed and patterns.  A seed's edge
    counts 1 for its own kind and 0 for the others, a candidate's 0 for the
    kinds that it could be.
    """
    every = F.explode(F.expr(f"IF(seed, sequence(0, {len(KINDS) - 1}), array(kind))")).alias("as")
    edges = (seen.select("kind", "value", "seed", "patterns", every)
             .select(F.col("as").alias("kind"), F.explode("patterns").alias("pattern"), "value",
                     F.when(F.col("seed") & (F.col("as") == F.col("kind")), 1.0).otherwise(0.0).alias("weight")))
    return edges.groupBy("kind", "pattern", "value").agg(F.max("weight").alias("weight"))


def pattern_scores(edges: DataFrame, support: float, precision: float) -> DataFrame:
    """``(kind, pattern, known, n, confidence)`` of the patterns that count."""
    return (edges.groupBy("kind", "pattern").agg(F.sum("weight").alias("known"), F.count("*").alias("n"))
            .where((F.col("known") >= support) & (F.col("known") >= precision * F.col("n")))
            .withColumn("confidence", F.col("known") / (F.col("n") + 1)))


class Found(NamedTuple):
    """What ``extract`` returns."""

    docs: DataFrame      #: the rows with the columns of ``RESULT``
    patterns: DataFrame  #: ``(kind, pattern, known, n, confidence)`` of the induced patterns
    rounds: int          #: rounds until no value was new


def extract(docs: DataFrame, text: str = "text", support: float = SUPPORT, precision: float = PRECISION,
            accept: float = ACCEPT) -> Found:
    """Personal data of every text; see the module's docstring."""
    taken = {c.lower() for c in RESULT}
    kept = [c for c in docs.columns if c != text and c.lower() not in taken]
    inner = docs.select(*[F.col(f"`{c}`") for c in kept])
    names = {c: free_name(inner, f"_{c}") for c in ("row", "base", "seen", "added")}
    rows = staged(_scanned(docs, text, kept, names), "pii-rows")
    seen = rows.where(F.size(names["seen"]) > 0).select(F.col(names["row"]).alias("row"), F.explode(names["seen"]).alias("s")).select("row", "s.*")

    # a pattern that no SUPPORT seeds of a kind share can only come to count by accepted values, so all edges stay
    edges, known, rounds = staged(graph(seen), "pii-edges"), None, 0
    while True:
        rounds += 1
        good = staged(pattern_scores(edges, support, precision), "pii-patterns")
        scored = (edges.where("weight = 0").join(good.select("kind", "pattern", "confidence"), ["kind", "pattern"])
                  .groupBy("kind", "value").agg((1 - F.exp(F.sum(F.log1p(-F.col("confidence"))))).alias("score"))
                  .where(F.col("score") >= accept))
        new = staged(scored, "pii-values")
        if new.isEmpty():
            break
        known = new if known is None else known.unionByName(new)
        edges = staged(edges.join(new, ["kind", "value"], "left")
                       .select("kind", "pattern", "value", F.greatest("weight", F.coalesce("score", F.lit(0.0))).alias("weight")), "pii-edges")

    col = lambda c: F.col(names[c])
    added = None
    if known is not None:
        best = F.max(F.struct("score", (-F.col("kind")).alias("first")))
        added = (seen.where("not seed").select("row", "kind", "start", "end", "value").join(known, ["kind", "value"])
                 .groupBy("row", "start", "end").agg(best.alias("b"))
                 .groupBy("row").agg(F.collect_list(F.struct((-F.col("b.first")).alias("kind"), "start", "end")).alias(names["added"]))
                 .withColumnRenamed("row", names["row"]))
    maybe = F.exists(col("seen"), lambda s: ~s["seed"])
    slim = [*[F.col(f"`{c}`") for c in kept], col("row"), col("base")]
    none = F.expr(f"cast(array() as array<{_SPAN}>)").alias(names["added"])
    if added is None:
        whole = rows.select(*slim, none)
    else:
        # only rows that hold candidates meet the accepted values
        whole = (rows.where(~maybe).select(*slim, none)
                 .unionByName(rows.where(maybe).select(*slim).join(added, names["row"], "left").select(*slim, col("added"))))
    name = F.create_map(*[F.lit(x) for k, kind in enumerate(KINDS) for x in (k, kind)])
    listed = lambda spans: F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", name[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter(col("base"), lambda s: s["kind"] == k)).cast("bigint")
    result = whole.select(*[F.col(f"`{c}`") for c in kept], *[count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
                          F.sha2(listed(col("base")).cast("binary"), 256).alias("base_sha256"),
                          listed(F.concat(col("base"), F.coalesce(col("added"), F.expr(f"cast(array() as array<{_SPAN}>)")))).alias("spans"))
    return Found(result, good, rounds)
