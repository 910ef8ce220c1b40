"""Exact dedup by two-pass Bloom filtering (DataFrame functions only).

Pass 1 sets, for every row, two cells of a Bloom filter and keeps the cells
that were hit at least twice.  Pass 2 tests every row against those cells:
a row with a cell that nothing else hit cannot repeat and passes straight
through; only the possibly repeated rows shuffle by the text's digest.  The
filter has no false negatives, so the result is exact whatever its size.

Texts are equal when identical after lower-casing A-Z only; null counts as
empty, so empty and null texts are one group.  Of equal texts the row with
the largest ``doc_id`` stays; a null ``doc_id`` is smaller than any other.
Rows repeated with the same ``doc_id`` count each in the group's size and
one of them stays.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ascii_lower, free_name, staged, stored_bytes

#: Filter cells for each row; two probes a row, so about 1.4 % of the unique rows test positive.
CELLS_PER_ROW = 16
MIN_CELLS, MAX_CELLS = 1 << 16, 1 << 34
#: The filter is broadcast only when its stored size is at most this, else joined by shuffle.
BROADCAST_BYTES = 16 << 20


def text_digest(text: Column) -> Column:
    """Lowercase hex SHA-256 of the normalised text in UTF-8."""
    return F.sha2(ascii_lower(text).cast("binary"), 256)


def _probes(digest: Column, cells: int) -> list[Column]:
    return [F.pmod(F.xxhash64(digest, F.lit(k)), F.lit(cells)) for k in (1, 2)]


def repeat_filter(digests: DataFrame, digest: str, rows: int) -> tuple[DataFrame, int]:
    """Pass 1: words (64 cells each) of the Bloom cells that were hit twice or more, and the cell count.

    Counts combine map-side, so a digest that a third of all rows share
    leaves each task as two rows.
    """
    cells = MIN_CELLS
    while cells < min(MAX_CELLS, rows * CELLS_PER_ROW):
        cells <<= 1
    # the bit of a cell inside its word, in words of 64
    hit = digests.select(F.explode(F.array(*_probes(F.col(digest), cells))).alias("cell"))
    twice = hit.groupBy("cell").agg(F.count("*").alias("n")).where("n >= 2")
    words = (twice.groupBy(F.shiftright("cell", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(cell & 63 as int))")).alias("bits")))
    return words, cells


def possibly_repeated(df: DataFrame, digest: str, words: DataFrame, cells: int, flag: str) -> DataFrame:
    """Pass 2: ``df`` with a boolean column ``flag``; true for every row whose digest repeats.

    The filter is broadcast behind a check of its stored size; a larger one
    is joined like any table (slim shuffle of the probes, results equal).
    """
    small = stored_bytes(words) <= BROADCAST_BYTES
    keep = list(df.columns)
    out, tests = df, []
    for k, probe in enumerate(_probes(F.col(digest), cells)):
        w, b, c = (free_name(df, f"_bf_{x}{k}") for x in "wbc")
        side = words.select(F.col("word").alias(w), F.col("bits").alias(b))
        out = out.withColumn(c, probe)
        out = out.join(F.broadcast(side) if small else side, F.shiftright(F.col(c), 6) == F.col(w), "left")
        tests.append(F.coalesce(F.getbit(F.col(b), F.expr(f"cast(`{c}` & 63 as int)")) == 1, F.lit(False)))
    return out.select(*[F.col(f"`{c}`") for c in keep], (tests[0] & tests[1]).alias(flag))


def _filter(docs: DataFrame, text: str, *ids: str):
    slim = staged(docs.select(*[F.col(f"`{c}`") for c in ids], text_digest(F.col(f"`{text}`")).alias("text_sha256")),
                  "dedup-digests")
    words, cells = repeat_filter(slim, "text_sha256", slim.count())
    return slim, staged(words, "dedup-filter"), cells


def mark(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts never shuffle: the digest table is written once and both passes
    read it.  The per-digest summary of the possibly repeated rows combines
    map-side and is stored before it is joined back, so that a digest which
    a third of all rows share is split by the skew join.
    """
    slim, words, cells = _filter(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")),
                                 "text", "doc_id")
    flagged = possibly_repeated(slim, "text_sha256", words, cells, "again")
    unique = flagged.where(~F.col("again")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256")
    # repeated rows of one doc_id and text fold into a count, expanded again at the end
    rows = staged(flagged.where("again").groupBy("text_sha256", "doc_id").agg(F.count("*").alias("n")), "dedup-again")
    groups = staged(rows.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"),
                                                    F.sum("n").alias("group_size")), "dedup-groups")
    joined = rows.join(groups, "text_sha256").select(
        "doc_id", "keep_id", "group_size", "text_sha256",
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))).alias("copy"))
    repeated = joined.select("doc_id", "keep_id", "group_size",
                             (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
                             "text_sha256")
    return unique.unionByName(repeated)


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, all columns unchanged.

    Rows that the filter clears never shuffle; of the others the top row of
    each digest is taken, cut map-side to one row per digest and task.
    """
    digest, flag, rank = (free_name(docs, x) for x in ("_digest", "_again", "_rank"))
    slim, words, cells = _filter(docs, text)
    flagged = possibly_repeated(docs.withColumn(digest, text_digest(F.col(f"`{text}`"))), digest, words, cells, flag)
    through = flagged.where(~F.col(flag)).drop(digest, flag)
    order = [F.col(f"`{doc_id}`").desc_nulls_last(), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])]
    first = (flagged.where(F.col(flag))
             .withColumn(rank, F.row_number().over(Window.partitionBy(digest).orderBy(*order)))
             .where(F.col(rank) == 1).drop(digest, flag, rank))
    return through.unionByName(first)
