"""Scans of team-submitted templates and prior outputs (SRC-1..10).

Templates arrive as CSV files (spreadsheet tabs exported one folder per
sheet: ``<source>/sheet=<i>/*.csv``).  Lead rows are skipped *per file* and
columns are picked by position, so every scan carries an explicit order
key ``(_src_priority, _file, _row)``: keep-first operators downstream use it
instead of pandas' implicit concat order.

Files are scanned in splits (``records``): a large extract is many tasks,
quoted line breaks stay inside their cell, and ``_row`` is the record's place
in its file however the file was split.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.reshape import BLOCK_FIELDS, ID_FIELDS, block_names
from ..session import stage_table
from .records import cells, filled_width, header_names, read_records
from .sinks import STATE_ID, identify, read_state_version

ORDER_COLS = ("_src_priority", "_file", "_row")


@dataclass(frozen=True)
class SourceSpec:
    """SRC-9: one template source.

    ``lead_rows`` counts every row before the first data row (a header that
    pandas would consume counts too).  ``ordinals`` are 0-based positions of
    the kept columns; ``names`` name them left to right.  ``sheets`` maps a
    sheet index to its own ordinals when the layout differs per sheet.
    """
    name: str
    path: str
    ordinals: tuple = ()
    names: tuple = ()
    lead_rows: int = 0
    sheets: dict | None = None
    header: bool = False
    enabled: bool = True
    priority: int = 1
    filter_to_period: bool = False
    constants: dict = field(default_factory=dict)
    kind: str = ""


def read_header_csv(spark: SparkSession, path: str, columns=None) -> DataFrame:
    """SRC-1: headered CSV, every column as text (ids keep leading zeros)."""
    records = read_records(spark, path)
    names = header_names(records)
    df = cells(records.filter("_row > 0").withColumn("_row", F.col("_row") - 1), names)
    if columns:
        df = df.select(*columns, "_file", "_row")
    return df


def read_positional(spark: SparkSession, path: str, ordinals, names, lead_rows: int = 0,
                    width: int | None = None) -> DataFrame:
    """SRC-2: skip ``lead_rows`` per file, keep columns by position, name them.

    The ordinal list is a set (pandas ``usecols`` ignores its order): the kept
    columns are named left to right.
    """
    ords = sorted(set(ordinals))
    if len(ords) != len(names):
        raise ValueError(f"{len(ords)} ordinals but {len(names)} names")
    width = width or (max(ords) + 1)
    return _positional(read_records(spark, path), ords, names, lead_rows, width)


def _positional(records: DataFrame, ords, names, lead_rows: int, width: int) -> DataFrame:
    df = cells(records.filter(F.col("_row") >= lead_rows).withColumn("_row", F.col("_row") - lead_rows),
               [f"_c{i}" for i in range(width)])
    others = [c for c in records.columns if c != "record"]
    return df.select(*[F.col(f"_c{o}").alias(n) for o, n in zip(ords, names)], *others)


def read_sheets(spark: SparkSession, path: str, sheets: dict, names, lead_rows: int) -> DataFrame:
    """SRC-3/4: several sheet extracts of one workbook, each with its own
    ordinals, renamed by position per sheet *before* the union."""
    parts = []
    for sheet, ords in sheets.items():
        p = read_positional(spark, f"{path.rstrip('/')}/sheet={sheet}", ords, names, lead_rows)
        parts.append(p.withColumn("sheet", F.lit(int(sheet))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def scan(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """SRC-9/10: scan one source by its spec and tag it (``source``, ``_src_priority``)."""
    if spec.header:
        df = read_header_csv(spark, spec.path)
    elif spec.sheets:
        df = read_sheets(spark, spec.path, spec.sheets, spec.names, spec.lead_rows)
    else:
        df = read_positional(spark, spec.path, spec.ordinals, spec.names, spec.lead_rows)
    return tag(df, spec.name, spec.priority)


def tag(df: DataFrame, name: str, priority: int) -> DataFrame:
    """SRC-10: source name and its concat priority (the prior state is 0)."""
    return df.withColumn("source", F.lit(name)).withColumn("_src_priority", F.lit(priority))


def layout_widths(records: DataFrame) -> DataFrame:
    """SRC-5: ``(_file, width)``: each file's widest row, up to its last filled cell."""
    return records.groupBy("_file").agg(F.max(filled_width()).alias("width"))


def layout_width(spark: SparkSession, path: str) -> int:
    """SRC-5: the widest row of a template folder, up to its last filled cell."""
    return int(layout_widths(read_records(spark, path)).agg(F.max("width")).first()[0] or 0)


def read_blocks(spark: SparkSession, path: str, lead_rows: int, first_col: int = 1,
                ids=ID_FIELDS, fields=BLOCK_FIELDS) -> tuple[DataFrame, int]:
    """SRC-5: files of self-sizing ``ids + k blocks`` layouts starting at ``first_col``, each by its own width.

    Every file's number of blocks comes from its own widest row; a width that
    is not ``len(ids) + k*len(fields)`` raises and names the file before
    anything is planned.  Returns ``(frame, k)``: the frame has the columns of
    the widest layout (NULL beyond a file's own) and ``_blocks``, the file's
    number of blocks; ``k`` is the largest.  Files without a filled cell have
    no rows.
    """
    records = read_records(spark, path)
    extra = F.col("width") - first_col - len(ids)
    sized = stage_table(layout_widths(records).filter("width > 0").select(
        "_file", "width", F.when((extra > 0) & (extra % len(fields) == 0), (extra / len(fields)).cast("int")).alias("_blocks")),
        "layouts")
    broken = sized.filter("_blocks IS NULL").orderBy("_file").take(3)
    if broken:
        raise ValueError("; ".join(f"{r['_file']}: {r['width'] - first_col} columns are not {len(ids)} + k*{len(fields)}"
                                   for r in broken))
    k = int(sized.agg(F.max("_blocks")).first()[0] or 0)
    if not k:
        raise ValueError(f"{path}: no file has a filled cell")
    names = block_names(len(ids) + k * len(fields), ids, fields)
    ords = list(range(first_col, first_col + len(names)))
    return _positional(records.join(sized.drop("width"), "_file"), ords, names, lead_rows, first_col + len(names)), k


def read_state(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", before: int | None = None,
               ordered: bool = False) -> DataFrame:
    """SRC-7: prior output re-read with an explicit schema; missing -> empty frame.

    ``ordered`` adds an order of its own: ``_file`` is the hash of a row's content and ``_row`` its number among
    equal rows: stored with a state that ``write_state`` wrote (its newest
    version, or the newest older than ``before``), computed for any other
    Parquet or CSV folder.  Either way the order of the rows does not depend
    on how their files are laid out.
    """
    names = [f.name for f in schema.fields]
    df = read_state_version(spark, path, before) if fmt == "parquet" else None
    if df is not None:
        df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields], *STATE_ID)
    elif before is not None:
        df = spark.createDataFrame([], schema)
    else:
        reader = spark.read.schema(schema)
        try:
            df = reader.parquet(path) if fmt == "parquet" else reader.option("header", True).csv(path)
        except Exception as e:  # noqa: BLE001 -- only a missing path is tolerated
            if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
                raise
            df = spark.createDataFrame([], schema)
    if not ordered:
        return df.select(*names)
    if STATE_ID[0] not in df.columns:
        df = identify(df.select(*names))
    return df.withColumnsRenamed({STATE_ID[0]: "_file", STATE_ID[1]: "_row"})


def load_all(spark: SparkSession, specs, shapers: dict, **kw):
    """SRC-9: scan and shape every enabled source; returns ``{name: frame}``.

    ``shapers`` maps ``spec.kind`` (or the name) to ``fn(spark, spec, frame,
    **kw) -> frame``.  Adding a source is a new spec, not a new plan shape.
    """
    out = {}
    for spec in specs:
        if not spec.enabled:
            continue
        shaper = shapers[spec.kind or spec.name]
        out[spec.name] = shaper(spark, spec, scan(spark, spec), **kw)
    return out


def relational(spark: SparkSession, table: str, jdbc_url: str | None = None, properties=None,
               partition_column: str | None = None, bounds=None, num_partitions: int | None = None):
    """SRC-8: a relational table -- a catalog table, or a JDBC table read in
    parallel slices of ``partition_column`` (``bounds=(lower, upper)``)."""
    if jdbc_url is None:
        return spark.table(table)
    kw = {}
    if partition_column:
        kw = dict(column=partition_column, lowerBound=bounds[0], upperBound=bounds[1],
                  numPartitions=num_partitions or 8)
    return spark.read.jdbc(jdbc_url, table, properties=properties or {}, **kw)
