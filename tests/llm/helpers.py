"""Brute-force statements of the operators, without Spark."""

import re
from collections import defaultdict

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return set()
    if len(words) < size:
        return {tuple(words)}
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def components(ids, links):
    near = defaultdict(set)
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    out = {}
    for i in sorted(ids):
        if i in out:
            continue
        todo, out[i] = [i], i
        while todo:
            for n in near[todo.pop()]:
                if n not in out:
                    out[n] = i
                    todo.append(n)
    return out


def jaccard_links(texts, percent=80):
    sets = {i: shingles(t) for i, t in texts.items()}
    ids = sorted(sets)
    return [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]


def docs(spark, texts, start=0):
    return spark.createDataFrame([(start + i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], DOCS)


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}x" for _ in range(n)]
