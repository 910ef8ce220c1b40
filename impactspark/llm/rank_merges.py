"""When a byte-level tokenizer's merges are those of its ranks.

A tokenizer's file lists its merges; a rank file only has tokens in order,
and any two neighbours whose bytes together are a token may merge.  The
library for rank files is several times faster; ``merge_ranks`` proves on the
driver, from the vocabulary alone, that both give the same ids.
"""

from __future__ import annotations

import functools
import json


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable Latin-1 characters stand for themselves, the other bytes for
    the characters from U+0100 on, in order.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


@functools.lru_cache(maxsize=2)
def merge_ranks(spec: str) -> dict[bytes, int] | None:
    """The vocabulary of a byte-level tokenizer as ranks, or None if merging by rank could differ from its merges.

    It can't if ids follow the order of the merges and the bytes of each
    merge's product, merged by lower ranks alone, end as that merge's two
    parts: what stands beside these bytes in a text never merged with them
    then, so the two parts are what a text shows, too.
    """
    model, of = json.loads(spec)["model"], byte_of_char()
    if model.get("type") != "BPE" or model.get("ignore_merges") or model.get("dropout") or not set(of) <= set(model["vocab"]):
        return None
    raw = lambda s: bytes(of.get(c, 0) for c in s)
    ranks = {raw(s): i for s, i in model["vocab"].items() if all(c in of for c in s)}
    last = max(ranks[bytes([b])] for b in range(256))
    for merge in model["merges"]:
        left, right = map(raw, merge if isinstance(merge, list) else merge.split(" "))
        rank = ranks.get(left + right, -1)
        if rank <= last:
            return None
        last = rank
        parts = [bytes([b]) for b in left + right]
        while len(parts) > 2:
            low, k = min((ranks.get(x + y, rank), k) for k, (x, y) in enumerate(zip(parts, parts[1:], strict=False)))
            if low >= rank:
                break
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        if parts != [left, right]:
            return None
    return ranks if len(ranks) == 256 + len(model["merges"]) else None
