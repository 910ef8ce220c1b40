"""Toxicity: Levenshtein automata intersected with a lexicon trie, scored in context.

The lexicon is learned from labelled rows: words, and stems (prefixes that
stand for every word they begin), whose document counts in toxic rows stand
out by a likelihood-ratio test corrected for the number of terms tried, be
they few or many of the toxic rows.  Words that clean rows hold as well, as
quotations do, count for less; stems must be all but absent there.  All
terms form one trie.  A state of the automaton is the set of (trie node,
edits so far) pairs that a token's characters can have reached; states are
made on first use and kept, so a token costs a table lookup a character and
most tokens die after a few.  Words of five letters or more match within one
edit, from ten within two; stems and short words match exactly.

Misspelled forms that clean labelled rows hold (more than one, unless the form
is all letters), and that are no likelier in toxic ones, are ordinary words and
match nothing.

A hit is scored in its context window: hits inside quotation marks or near
reporting words count as quoted, the rest as abuse, misspelled ones a little
less.  A small logistic model over these counts, fitted on the same labelled
rows around a fixed prior, gives the score.

Labelled rows are a bounded sample (``MAX_ROWS`` of each label).  Scoring
covers every row and whole texts.  Null and empty texts score as texts
without hits; null labels are not learned from; each row gives one row,
extra columns are kept; without labelled rows the lexicon is empty; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import released, staged, without
from .texthash import shingle_sets

#: Bounds of the fit: labelled rows of each label, lexicon terms, misspelled forms known as ordinary words.
MAX_ROWS, MAX_TERMS, MAX_ORDINARY = 8_000, 4_000, 20_000
STEMS = (4, 5, 6)
#: Least logarithm of how much likelier a word is in toxic rows, the one from which it counts in full (the least of a
#: stem), and the least number of toxic rows that hold a term.
LEAST_RATIO, FULL_RATIO, LEAST_ROWS = 1.0, 3.0, 3
#: Least number of clean rows that make a form with digits or signs within reach of a term an ordinary word (plain
#: words need one, as most of a language's words are rare), and of toxic rows that can show it to be likelier there.
LEAST_ORDINARY = 2
#: Tokens on either side of a hit that make up its context.
WINDOW = 6
#: Tokens that a worker remembers as clean, and states that one automaton keeps.
MEMO, STATES = 150_000, 200_000
THRESHOLD = 0.3

#: Words that report what somebody else said, and quotation marks.
REPORTING = frozenset("said says wrote writes called calls quote quoted quotes word term insult slur report reported "
                      "sagte schrieb nannte zitat wort dit écrit appelé citation mot dijo escribió llamó cita palabra".split())
OPEN, CLOSE = "\"“„«‘'", "\"”“»’'"
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_INNER = re.compile(r"[^\W_]+")
#: Prior weights and their strength: intercept, abuse, quoted, abuse in a hundred tokens.
PRIOR = np.array([-2.0, 3.0, 0.4, 0.3])
RIDGE = np.array([1e-3, 0.02, 1.0, 0.3])
#: What a misspelled term counts for: letters swapped for digits or signs, other edits.
SIGNS, EDITS = 0.9, 0.75


class Lexicon:
    """The trie of all terms and the automaton over it."""

    def __init__(self, terms: list[tuple[str, float]]):
        self.terms = terms
        self.children: list[dict[str, int]] = [{}]
        self.word: list[int] = [-1]
        self.stem: list[int] = [-1]
        self.reach: list[int] = [0]  # the most edits a word below may take
        for number, (term, _) in enumerate(terms):
            stem = term.endswith("*")
            text = term[:-1] if stem else term
            edits = 0 if stem or len(text) < 5 else 1 if len(text) < 10 else 2
            node = 0
            self.reach[0] = max(self.reach[0], edits)
            for c in text:
                nxt = self.children[node].get(c)
                if nxt is None:
                    nxt = len(self.children)
                    self.children[node][c] = nxt
                    for column, empty in ((self.children, {}), (self.word, -1), (self.stem, -1), (self.reach, -1)):
                        column.append(empty)
                node = nxt
                self.reach[node] = max(self.reach[node], edits)
            if stem:
                self.stem[node] = number
            else:
                self.word[node] = number
        self.limit = [0 if t.endswith("*") or len(t) < 5 else 1 if len(t) < 10 else 2 for t, _ in terms]
        self._reset()

    def _reset(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.accepts: list[tuple[int, int]] = []  # (term, edits) of the token that ends here, -1: none
        self.stems: list[int] = []
        self.alphabet: list[frozenset] = []
        self.start = self._state(self._close({0: 0}))

    def _close(self, nodes: dict[int, int]) -> frozenset:
        """Adds what is reached by leaving out letters of the lexicon."""
        todo = list(nodes.items())
        while todo:
            node, k = todo.pop()
            for child in self.children[node].values():
                if k + 1 <= self.reach[child] and nodes.get(child, 9) > k + 1:
                    nodes[child] = k + 1
                    todo.append((child, k + 1))
        return frozenset(nodes.items())

    def _state(self, found: frozenset) -> int:
        at = self.states.get(found)
        if at is None:
            at = self.states[found] = len(self.sets)
            self.sets.append(found)
            self.moves.append({})
            hits = [(k, self.word[n]) for n, k in found if self.word[n] >= 0 and k <= self.limit[self.word[n]]]
            k, term = min(hits) if hits else (0, -1)
            self.accepts.append((term, k))
            self.stems.append(max([self.stem[n] for n, k in found if k == 0], default=-1))
            self.alphabet.append(frozenset(c for n, _ in found for c in self.children[n]))
        return at

    def _move(self, state: int, c: str) -> int:
        nodes: dict[int, int] = {}

        def put(node: int, k: int) -> None:
            if k <= self.reach[node] and nodes.get(node, 9) > k:
                nodes[node] = k

        for node, k in self.sets[state]:
            for letter, child in self.children[node].items():
                put(child, k if letter == c else k + 1)
            put(node, k + 1)
        return self._state(self._close(nodes)) if nodes else -1

    def match(self, token: str) -> tuple[int, int] | None:
        """``(term, edits)`` of the nearest term of one token, None if none is near."""
        if len(self.sets) > STATES:
            self._reset()
        state, stem = self.start, -1
        for c in token:
            key = c if c in self.alphabet[state] else ""
            nxt = self.moves[state].get(key)
            if nxt is None:
                nxt = self.moves[state][key] = self._move(state, key or "\0")
            if nxt < 0:
                return (stem, 0) if stem >= 0 else None
            state = nxt
            if self.stems[state] >= 0:
                stem = self.stems[state]
        term, k = self.accepts[state]
        if term >= 0 and (k == 0 or stem < 0):
            return term, k
        return (stem, 0) if stem >= 0 else None


class Scanner:
    """Finds hits in texts and turns them into the model's counts."""

    def __init__(self, terms: list[tuple[str, float]], ordinary: frozenset = frozenset()):
        self.lexicon, self.ordinary = Lexicon(terms), ordinary
        self.hits: dict[str, tuple[int, int, str]] = {}
        self.clean: set[str] = set()
        self.older: set[str] = set()

    def look(self, raw: str) -> tuple[int, int, str] | None:
        """The hit of one white-space token (lower case): term, edits, the matched form."""
        hit = self.hits.get(raw)
        if hit is not None:
            return hit
        if raw in self.clean or raw in self.older:
            return None
        whole = _EDGE.sub("", raw)
        best = None
        for part in dict.fromkeys([whole, *_INNER.findall(whole)]):
            if 2 < len(part) <= 64 and (m := self.lexicon.match(part)) and (best is None or m[1] < best[1]) \
                    and not (m[1] and part in self.ordinary):
                best = (*m, part)
        if best is None:
            if len(self.clean) >= MEMO:
                self.clean, self.older = set(), self.clean
            if len(raw) <= 64:
                self.clean.add(raw)
        elif len(self.hits) < MEMO:
            self.hits[raw] = best
        return best

    def counts(self, text: str) -> np.ndarray:
        """Intercept, abuse, quoted, abuse in a hundred tokens."""
        tokens = text.lower().split()
        found = {t: h for t in set(tokens) if (h := self.look(t)) is not None}
        abuse = quoted = 0.0
        for i, t in enumerate(tokens if found else ()):
            hit = found.get(t)
            if hit is None:
                continue
            term, edits, form = hit
            strength = min(1.0, self.lexicon.terms[term][1] / FULL_RATIO)
            if self._quoted(tokens, i):
                quoted += strength
            else:
                abuse += strength * (1.0 if edits == 0 else EDITS if form.isalpha() else SIGNS)
        return np.array([1.0, math.log2(1 + abuse), math.log2(1 + quoted),
                         min(10.0, 100 * abuse / max(1, len(tokens)))])

    @staticmethod
    def _quoted(tokens: list[str], i: int) -> bool:
        """Whether the token stands inside quotation marks that close near by, or near a reporting word."""
        t = tokens[i]
        if any((p := t.find(a)) >= 0 and t.find(b, p + 1) > p for a, b in zip(OPEN, CLOSE, strict=True) if a != "'"):
            return True
        left, right = tokens[max(0, i - WINDOW):i + 1], tokens[i:i + WINDOW + 1]
        opened = any(x[0] in OPEN and not (len(x) > 1 and x[-1] in CLOSE and k < len(left) - 1)
                     for k, x in enumerate(left))
        closed = any(x.rstrip(".,;:!?")[-1:] in CLOSE and x.rstrip(".,;:!?")[-1:] for x in right)
        if opened and closed:
            return True
        return any(_EDGE.sub("", x) in REPORTING for x in left[:-1] + right[1:])


def _words(text: str) -> set[str]:
    return {w for w in _INNER.findall(text.lower()) if 3 <= len(w) <= 32}


def learn_lexicon(sample: DataFrame) -> list[tuple[str, float]]:
    """Terms with the logarithm of how much likelier they are in toxic rows; ``sample`` has text and label."""
    @released
    def count(batches):
        seen: dict[str, list[int]] = {}
        for df in batches:
            for text, label in zip(df["text"], df["label"], strict=True):
                words = _words(text) if isinstance(text, str) else ()
                terms = set(words)
                for w in words:
                    terms.update(w[:n] + "*" for n in STEMS if len(w) > n)
                for t in terms:
                    seen.setdefault(t, [0, 0])[label] += 1
        if seen:
            yield pd.DataFrame({"term": list(seen), "clean": [c for c, _ in seen.values()],
                                "toxic": [t for _, t in seen.values()]})

    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return []
    counted = sample.select("text", "label").mapInPandas(count, "term string, clean bigint, toxic bigint")
    total = staged(counted.groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
                   .where("toxic + clean > 2"), "toxic-terms")
    tried = max(2, total.count())
    share = n1 / (n0 + n1)
    a, b = F.col("toxic"), F.col("clean")
    part = lambda x, p: F.when(x > 0, x * F.log(x / ((a + b) * p))).otherwise(0.0)
    ratio = F.log(((a + 0.1) / (n1 + 1)) / ((b + 0.1) / (n0 + 1)))
    least = F.when(F.col("term").endswith("*"), FULL_RATIO).otherwise(LEAST_RATIO)
    chosen = (total.withColumn("g", 2 * (part(a, share) + part(b, 1 - share))).withColumn("ratio", ratio)
              .where((F.col("ratio") > least) & (F.col("g") > 2.4 * math.log(tried)) & (a >= LEAST_ROWS))
              .orderBy(F.col("g").desc(), "term").limit((1 + len(STEMS)) * MAX_TERMS).collect())
    order = {r["term"]: k for k, r in enumerate(chosen)}
    kept = _prune([(r["term"], int(r["toxic"]), float(r["ratio"])) for r in chosen])
    best = {t for t, _ in sorted(kept, key=lambda x: order[x[0]])[:MAX_TERMS]}
    return [x for x in kept if x[0] in best]


def _prune(terms: list[tuple[str, int, float]]) -> list[tuple[str, float]]:
    """Keeps a word or a stem of each family: the word when it makes up the stem's rows, else the longest full stem."""
    rows = {t: (n, r) for t, n, r in terms}
    most: dict[str, int] = {}
    for t, (n, _) in rows.items():
        if not t.endswith("*"):
            for k in STEMS:
                if len(t) > k:
                    most[t[:k]] = max(most.get(t[:k], 0), n)
    stems = {t[:-1]: n for t, (n, _) in rows.items() if t.endswith("*") and n > 1.2 * most.get(t[:-1], 0)}
    kept = {s for s, n in stems.items() if not any(len(o) > len(s) and o.startswith(s) and m >= 0.95 * n
                                                   for o, m in stems.items())}
    kept = {s for s in kept if not any(o != s and s.startswith(o) for o in kept)}
    out = [(s + "*", rows[s + "*"][1]) for s in sorted(kept)]
    out += [(t, r) for t, (n, r) in sorted(rows.items())
            if not t.endswith("*") and not any(t.startswith(s) for s in kept)]
    return out


def fit_weights(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic weights around the prior, by Newton's method (a handful of columns)."""
    w = PRIOR.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        grad = x.T @ (p - y) + RIDGE * (w - PRIOR)
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag(RIDGE)
        step = np.linalg.solve(hess, grad)
        w = w - step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    w[1:] = np.maximum(w[1:], 0)
    return w


def sample_labelled(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id",
                    text: str = "text", max_rows: int = MAX_ROWS) -> DataFrame:
    """``(id, text, label)`` of at most about ``max_rows`` labelled rows of each label.

    Of texts with the same smallest shingle (copies and most near copies) one
    is taken, else a large group of them would count as so many witnesses.
    """
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label")).where(
        "id is not null and label in (0, 1)")
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    top = 1 << 20
    cut = F.create_map(*[F.lit(int(x)) for k in (0, 1) for x in (k, int(min(1.0, max_rows / max(1, sizes.get(k, 0))) * top))])
    some = known.where(F.pmod(F.xxhash64("id", F.lit(13)), F.lit(top)) < cut[F.col("label")])
    rows = (docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
            .join(F.broadcast(some), "id"))  # at most 2 * max_rows slim rows

    @released
    def sketch(batches):
        for df in batches:
            sets = shingle_sets([t if isinstance(t, str) else "" for t in df["text"]])
            yield df.assign(low=[int(x[0].astype(np.int64)) if len(x) else 0 for x in sets])

    kind = rows.schema["id"].dataType.simpleString()
    sketched = rows.mapInPandas(sketch, f"id {kind}, text string, label int, low bigint")
    return staged(sketched.dropDuplicates(["low", "label"]).drop("low"), "toxic-sample")


def ordinary_forms(sample: DataFrame, terms: list[tuple[str, float]]) -> frozenset:
    """Forms within an edit of a term that clean rows hold, unless ``LEAST_ORDINARY`` toxic rows or more show them to
    be likelier there (the most frequent ``MAX_ORDINARY``)."""
    @released
    def run(batches):
        scanner = Scanner(terms)
        for df in batches:
            found = []
            for text, label in zip(df["text"], df["label"], strict=True):
                hits = map(scanner.look, set(text.lower().split()) if isinstance(text, str) else ())
                found += [(form, label) for form in {h[2] for h in hits if h is not None and h[1]}]
            yield pd.DataFrame(found, columns=["form", "label"]).astype({"form": object, "label": "int32"})

    if not terms:
        return frozenset()
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    rows = sample.select("text", "label").mapInPandas(run, "form string, label int")
    top = (rows.groupBy("form").agg(F.sum(1 - F.col("label")).alias("clean"), F.sum("label").alias("toxic"))
           .where((F.col("clean") >= F.when(F.col("form").rlike(r"^\p{L}+$"), 1).otherwise(LEAST_ORDINARY))
                  & ((F.col("toxic") < LEAST_ORDINARY)
                     | (F.col("clean") * sizes.get(1, 0) >= F.col("toxic") * sizes.get(0, 0))))
           .orderBy(F.col("clean").desc(), "form").limit(MAX_ORDINARY).collect())
    return frozenset(r["form"] for r in top)


class Model:
    def __init__(self, terms: list[tuple[str, float]], ordinary: frozenset, weights: np.ndarray):
        self.terms, self.ordinary, self.weights = terms, ordinary, weights


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text",
        max_rows: int = MAX_ROWS) -> Model:
    """Lexicon, ordinary words and context weights, from a bounded sample of the labelled rows."""
    sample = sample_labelled(docs, labels, label, doc_id, text, max_rows)
    terms = learn_lexicon(sample)
    ordinary = ordinary_forms(sample, terms)

    @released
    def run(batches):
        scanner = Scanner(terms, ordinary)
        for df in batches:
            x = np.array([scanner.counts(t if isinstance(t, str) else "") for t in df["text"]])
            yield pd.DataFrame({"x": list(x.reshape(-1, len(PRIOR))), "label": df["label"]})

    rows = sample.select("text", "label").mapInPandas(run, "x array<double>, label int").collect()  # 2 * max_rows at most
    if not rows:
        return Model(terms, ordinary, PRIOR.copy())
    x, y = np.array([r["x"] for r in rows]), np.array([r["label"] for r in rows], float)
    return Model(terms, ordinary, fit_weights(x, y))


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score", keep_text: bool = False) -> DataFrame:
    """``docs`` (without ``text`` unless kept) with ``out``: the probability that the text is toxic."""
    docs = without(docs, out, keep=(text,))
    kept = [f for f in docs.schema.fields if keep_text or f.name != text]
    names = [f.name for f in kept]
    shared = docs.sparkSession.sparkContext.broadcast((model.terms, model.ordinary, model.weights))

    @released
    def run(batches):
        terms, ordinary, w = shared.value
        scanner = Scanner(terms, ordinary)
        for df in batches:
            x = np.array([scanner.counts(t if isinstance(t, str) else "") for t in df[text]]).reshape(-1, len(w))
            yield df[names].assign(**{out: 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))})

    return docs.mapInPandas(run, T.StructType([*kept, T.StructField(out, T.DoubleType())]))
