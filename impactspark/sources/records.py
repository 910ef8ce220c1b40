"""CSV records with row numbers from a scan whose files may be split (SRC-1/2/5).

``multiLine`` parsing makes a file one task.  Here lines are scanned in
splits, and what a split cannot know by itself -- whether it starts inside a
quoted cell, and how many records stand before it -- is a prefix over the
splits of its file:

1. One Python pass over the lines of a split follows the CSV grammar from
   both possible starts (outside and inside a quoted cell) and notes for each
   line where it would stand: before, after, and in which record.
2. A split is summed up in one row.  Per file these rows are chained in order
   of their offset, which gives the true start of each split and the number
   of records before it.
3. Lines pick the reading of their split's true start.  Records of one line
   pass straight through; only the lines of records with line breaks are
   gathered by (file, record).

Record numbers are those of a plain reader and do not depend on how files
are split or packed into tasks.  Lines that are empty outside a quoted cell
are not records.  A byte-order mark is dropped.  A file whose last cell is
never closed is refused by name.
"""

from __future__ import annotations

import csv

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import ship_package, stage_table

BOM = "\ufeff"
CSV_OPTIONS = {"escape": '"', "mode": "PERMISSIVE"}

_LINES = "file string, start bigint, i bigint, line string, b0 boolean, b1 boolean, e0 boolean, e1 boolean, k0 bigint, k1 bigint"
_NAMES = ["file", "start", "i", "line", "b0", "b1", "e0", "e1", "k0", "k1"]


def ends_open(line: str, inside: bool) -> bool:
    """Whether a quoted cell is still open behind ``line``, given whether one was before it.

    A quote opens a cell only as its first character; a doubled quote inside
    is a character; what follows a closing quote belongs to the cell up to
    the separator.
    """
    at = 0
    while True:
        if not inside and line[at:at + 1] == '"':
            inside, at = True, at + 1
        while inside:
            end = line.find('"', at)
            if end < 0:
                return True
            inside = line[end + 1:end + 2] == '"'
            at = end + 1 + inside
        at = line.find(",", at) + 1
        if at == 0:
            return False


class _Split:
    """Both readings of the lines of one split so far."""

    def __init__(self):
        self.lines, self.records, self.open = 0, [0, 0], [False, True]

    def read(self, lines: pa.Array, quoted: np.ndarray, blank: np.ndarray):
        """``i``, and for each reading: open before, open behind, number of records begun."""
        n = len(lines)
        i = np.arange(self.lines, self.lines + n)
        self.lines += n
        before, behind = np.zeros((2, n), bool), np.zeros((2, n), bool)
        at = 0
        for q in [*np.flatnonzero(quoted).tolist(), n]:
            for s in (0, 1):
                before[s, at:q + 1] = behind[s, at:q] = self.open[s]
            if q < n:
                line = lines[q].as_py()
                self.open = [ends_open(line, x) for x in self.open]
                behind[:, q] = self.open
            at = q + 1
        begun = np.cumsum(~before & ~blank, axis=1) + np.array(self.records)[:, None]
        self.records = begun[:, -1].tolist()
        return i, before, behind, begun


def _read_lines(batches):
    """The lines of each split with both readings of it."""
    split, seen = _Split(), None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        lines, files, starts = batch.column(0), batch.column(1), batch.column(2).to_numpy(zero_copy_only=False)
        new = np.ones(n, bool)
        new[1:] = (starts[1:] != starts[:-1]) | pc.not_equal(files.slice(1), files.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        edges = [*np.flatnonzero(new).tolist(), n]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            key, part = (files[a].as_py(), int(starts[a])), lines.slice(a, b - a)
            if key != seen:
                split, seen = _Split(), key
                if key[1] == 0 and (part[0].as_py() or "").startswith(BOM):
                    part = pa.concat_arrays([pa.array([part[0].as_py()[len(BOM):]], part.type), part.slice(1)])
            quoted = pc.match_substring(part, '"').to_numpy(zero_copy_only=False)
            blank = pc.equal(pc.utf8_length(part), 0).to_numpy(zero_copy_only=False)
            i, before, behind, begun = split.read(part, quoted, blank)
            yield pa.RecordBatch.from_arrays(
                [files.slice(a, b - a), pa.array(starts[a:b]), pa.array(i), part, *map(pa.array, before), *map(pa.array, behind),
                 *map(pa.array, begun)], names=_NAMES)


def _chain(table: pa.Table) -> pa.Table:
    """The splits of one file in order: whether each starts inside a cell, and the records before it."""
    rows = sorted(table.to_pylist(), key=lambda r: r["start"])
    inside, before, out = False, 0, []
    for r in rows:
        s = int(inside)
        behind, records = r[f"e{s}"], r[f"k{s}"]
        out.append((r["file"], r["start"], inside, before, behind and r is rows[-1]))
        inside, before = behind, before + records
    return pa.Table.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(
        (pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_()))], names=["file", "start", "inside", "before", "unclosed"])


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``(_file, _row, record)``: the records of all files below ``path``, numbered from 0 in each file.

    The files are scanned once; lines and their readings are stored, so the
    numbers do not depend on a second scan being split the same way.
    """
    ship_package(spark)
    text = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    lines = stage_table(text.mapInArrow(_read_lines, _LINES), "csv-lines")
    splits = lines.groupBy("file", "start").agg(
        *[F.max_by(c, "i").alias(c) for c in ("e0", "e1")], F.max("k0").alias("k0"), F.max("k1").alias("k1"))
    placed = stage_table(splits.groupBy("file").applyInArrow(
        _chain, "file string, start bigint, inside boolean, before bigint, unclosed boolean"), "csv-splits")
    broken = [r["file"] for r in placed.filter("unclosed").select("file").take(5)]
    if broken:
        raise ValueError(f"a quoted cell is never closed in {broken}")
    pick = lambda a, b: F.when(F.col("inside"), F.col(b)).otherwise(F.col(a))
    read = (lines.join(placed, ["file", "start"])
            .select(F.col("file").alias("_file"), (F.col("before") + pick("k0", "k1") - 1).alias("_row"),
                    pick("b0", "b1").alias("goes_on"), pick("e0", "e1").alias("open"), "start", "i", "line")
            .filter(F.col("goes_on") | (F.col("line") != "")))
    alone = read.filter(~F.col("goes_on") & ~F.col("open")).select("_file", "_row", F.col("line").alias("record"))
    several = read.filter(F.col("goes_on") | F.col("open")).groupBy("_file", "_row").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "i", "line"))), lambda x: x["line"]), "\n").alias("record"))
    return alone.unionByName(several)


def text_schema(names) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


def cells(records: DataFrame, names) -> DataFrame:
    """The records' cells by position as text columns, before ``_file`` and ``_row``.

    A record's cells are made as the one row of an array: a filter on a cell then stands behind the parser,
    where a filter on a plain expression is moved below it and parses the record again for each cell it names.
    """
    names = list(names)
    schema = text_schema([f"_c{i}" for i in range(len(names))])
    row = F.from_csv("record", schema.simpleString()[len("struct<"):-1].replace(":", " "), CSV_OPTIONS)
    others = [c for c in records.columns if c not in ("record",)]
    return records.select(F.inline(F.array(row)), *others).select(
        *[F.col(f"_c{i}").alias(n) for i, n in enumerate(names)], *others)


def header_names(records: DataFrame) -> list[str]:
    """Column names from the files' first records, which must agree; a file that differs is named.

    Empty names become ``_c<position>``, repeated ones carry their position.
    """
    heads = (records.filter("_row = 0").groupBy("record").agg(F.min("_file").alias("_file"), F.count("*").alias("n"))
             .orderBy(F.col("n").desc(), "_file").take(2))
    if not heads:
        return []
    if len(heads) > 1:
        raise ValueError(f"{heads[1]['_file']}: its header differs from that of {heads[0]['_file']}")
    names, out = next(csv.reader([heads[0]["record"]])), []
    for i, n in enumerate(names):
        repeated = [x.lower() for x in names].count(n.lower()) > 1
        out.append(f"_c{i}" if not n else f"{n}{i}" if repeated else n)
    return out


def filled_width(record: str = "record"):
    """How many cells a record has up to its last filled one (a quoted cell is filled)."""
    plain = F.regexp_replace(record, r'(^|,)"(?:[^"]++|"")*+"[^,]*', "$1q")
    short = F.regexp_replace(plain, r",+$", "")
    return F.when(short == "", 0).otherwise(F.size(F.split(short, ",", -1)))
