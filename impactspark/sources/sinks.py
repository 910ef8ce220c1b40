"""Sinks (SNK-1..3): CSV extracts, multi-table reports, rolling state.

Every write is a whole-table overwrite, so re-running a job after a failure
(or after a lost executor forced a stage retry) never duplicates rows.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..operators.frames import sort_keys
from ..operators.quality import gate, measured, observed, row_hash
from ..session import ship_package
from .records import cells, header_names, read_records

INTERNAL = ("source", "_src_priority", "_file", "_row")


def _texts(df: DataFrame) -> DataFrame:
    """JSON-1: list cells become text (CSV has no list type)."""
    return df.select(*[F.to_json(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, ArrayType)
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


def write_csv(df: DataFrame, path: str, drop=INTERNAL, single_file: bool = False) -> None:
    """SNK-1: overwrite a headered CSV extract without internal columns.

    ``single_file`` coalesces to one file for hand-off to people; keep it off
    for large outputs.
    """
    out = _texts(df.drop(*[c for c in drop if c in df.columns]))
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_sorted(df: DataFrame, path: str, cols, descending=(), nulls_first: bool = False, files: int | None = None,
                 drop=INTERNAL) -> None:
    """SRT-1..3 / SNK-1: a headered CSV extract in a global order, as files whose names are in that order.

    Rows are dealt by range and sorted inside each, with PostgreSQL's null
    placement (last in both directions) unless ``nulls_first``; no task holds
    the whole table.  Rows of equal keys follow the hash of their content, so
    the files are the same on every run and a hot key is dealt over several.
    """
    out = _texts(df.drop(*[c for c in drop if c in df.columns]))
    keys = [*sort_keys(cols, descending, nulls_first), row_hash(out)]
    files = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (out.repartitionByRange(files, *keys).sortWithinPartitions(*keys)
     .write.mode("overwrite").option("header", True).option("escape", '"').csv(path))


def read_sorted(spark: SparkSession, path: str) -> DataFrame:
    """The rows of ``write_sorted`` as text, with their ``position`` (from 1) in the order of the files' names."""
    records = read_records(spark, path)
    rows = cells(records.filter("_row > 0").withColumn("_row", F.col("_row") - 1), header_names(records))
    sizes = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("__n"))     # a row for each file
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_file", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return (rows.join(F.broadcast(offsets), "_file").withColumn("position", F.col("__before") + F.col("_row") + 1)
            .drop("_file", "_row", "__before"))


def write_template(df: DataFrame, path: str, lead: tuple[str, ...] = (), files: int | None = None) -> None:
    """A template as teams submit it: CSV files without a header row that each begin with the ``lead`` lines.

    Cells are written as they are (blanks kept, quotes doubled, line breaks
    inside quotes); ``files`` deals the rows over that many files.
    """
    ship_package(df.sparkSession)
    line = F.to_csv(F.struct(*[F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate(df.columns)]),
                    {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    lines = df.select(line.alias("value"))
    if files:
        lines = lines.repartition(files, F.xxhash64("value"))

    def with_lead(batches):
        if lead:
            yield pa.RecordBatch.from_arrays([pa.array(lead, pa.string())], names=["value"])
        yield from batches

    lines.mapInArrow(with_lead, "value string").write.mode("overwrite").text(path)


_MANIFEST = "v bigint, table string, folder string"


def _manifest(spark: SparkSession, base: str) -> tuple[int, dict[str, str]]:
    """The newest version of a report and the folder of each of its tables; (0, {}) before the first."""
    try:
        rows = spark.read.schema(_MANIFEST).parquet(f"{base.rstrip('/')}/_manifest")
        newest = rows.agg(F.max("v")).first()[0]
    except Exception as e:  # noqa: BLE001 -- only a missing report is tolerated
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return 0, {}
        raise
    if newest is None:
        return 0, {}
    return newest, {r.table: r.folder for r in rows.filter(F.col("v") == newest).collect()}


def write_report(tables: dict, base: str, create: bool, required=(), checks: dict | None = None) -> DataFrame | None:
    """SNK-2: a report is a set of Parquet tables that become visible together.

    The tables go to a new version folder; a manifest row set of that version
    is written last and makes them the report, so a failure half-way leaves
    the previous version as it was.  ``create=True`` starts a new report (its
    manifest lists only these tables); ``create=False`` adds or replaces
    these tables and requires the ``required`` ones to be there already.

    ``checks`` gives rules for some of the tables (DQ-1, DQ-3).  The job that
    writes a table counts its offenders, so no table is read for its checks;
    the gate stands before the manifest, so a report that breaks an
    error-level rule never becomes visible.  Returns their check table, which
    is also the report's table ``written_checks``.
    """
    base = base.rstrip("/")
    spark = next(iter(tables.values())).sparkSession
    version, existing = _manifest(spark, base)
    if not create:
        if not version:
            raise RuntimeError(f"report at {base} has not been created yet")
        missing = [t for t in required if t not in existing]
        if missing:
            raise RuntimeError(f"report at {base} lacks base tables {missing}")
    version += 1
    folders = {} if create else dict(existing)
    found = None
    for name, df in tables.items():
        folders[name] = f"v={version}/{name}"
        rules = list((checks or {}).get(name, ()))
        watched, seen = observed(df, rules) if rules else (df, None)
        _texts(watched).write.mode("overwrite").parquet(f"{base}/{folders[name]}")
        if rules:
            own = measured(spark, seen, rules)
            found = own if found is None else found.unionByName(own)
    if found is not None:
        gate(found)
        folders["written_checks"] = f"v={version}/written_checks"
        found.coalesce(1).write.mode("overwrite").parquet(f"{base}/{folders['written_checks']}")
    spark.createDataFrame([(version, t, f) for t, f in sorted(folders.items())], _MANIFEST) \
         .coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("v") \
         .parquet(f"{base}/_manifest")
    return found


def read_report(spark: SparkSession, base: str) -> dict:
    """The tables of the report's newest version."""
    _, folders = _manifest(spark, base)
    return {t: spark.read.parquet(f"{base.rstrip('/')}/{f}") for t, f in folders.items()}


#: Identity of a state row: a hash of its content, and its number among equal rows.
STATE_ID = ("entry_hash", "entry_no")
#: Equal rows that one task numbers at once.
_EQUAL_ROWS = 1 << 16


def identify(df: DataFrame) -> DataFrame:
    """``df`` with ``entry_hash`` and ``entry_no``, the same whatever order or files its rows come in.

    Equal rows are interchangeable, so each distinct row is counted (map-side
    first, a hot one leaves a task as one row) and given out again that many
    times, ``_EQUAL_ROWS`` to a task; nothing is ranked.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    content = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n")).withColumn("entry_hash", F.md5(content))
    parts = counted.withColumn("__part", F.explode(F.expr(f"sequence(0, (__n - 1) div {_EQUAL_ROWS})"))).repartition("entry_hash", "__part")
    last = F.expr(f"least(__n, (__part + 1) * {_EQUAL_ROWS}) - 1")
    return parts.select(*columns, "entry_hash", F.explode(F.sequence(F.col("__part") * _EQUAL_ROWS, last)).alias("entry_no"))


def write_state(df: DataFrame, path: str, partition_by=("month",), version: int | None = None) -> int:
    """SNK-3: the whole rolling state of a run as a new version, Parquet, partitioned, rows identified.

    The version's manifest row is written last, so readers see the old state
    or all of the new one; months that the run no longer has are gone from
    it.  A retry that names its ``version`` writes the same one again.
    Returns the version.
    """
    path = path.rstrip("/")
    spark = df.sparkSession
    if version is None:
        version = _manifest(spark, path)[0] + 1
    folder = f"v={version}"
    plain = df.drop(*[c for c in (*INTERNAL, *STATE_ID) if c in df.columns])
    (identify(plain).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_by)
     .parquet(f"{path}/{folder}"))
    spark.createDataFrame([(version, "state", folder)], _MANIFEST).coalesce(1).write.mode("overwrite") \
         .option("partitionOverwriteMode", "dynamic").partitionBy("v").parquet(f"{path}/_manifest")
    return version


def read_state_version(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """The newest version of a state (older than ``before``), with ``STATE_ID``; None where there is none."""
    path = path.rstrip("/")
    try:
        versions = spark.read.schema(_MANIFEST).parquet(f"{path}/_manifest")
        newest = (versions if before is None else versions.filter(F.col("v") < before)).agg(F.max("v")).first()[0]
    except Exception as e:  # noqa: BLE001 -- only a missing state is tolerated
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return None
        raise
    return None if newest is None else spark.read.parquet(f"{path}/v={newest}")
