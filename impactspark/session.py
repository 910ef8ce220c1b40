"""Spark session settings used by the library, the tests and the bench.

Nothing here is required by the operators themselves: every operator takes a
DataFrame and returns one.  These helpers only pin the settings the
operators' results depend on (UTC session time zone, ANSI mode) and the
settings that matter at scale (AQE, skew-join handling, file split size).
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings that decide results; always applied.
RESULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

#: Settings that decide speed at scale; applied unless the caller set them.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "impactspark", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings.

    ``master`` and ``shuffle_partitions`` are only meant for local runs; on a
    cluster the submit command owns them.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(RESULT_CONF)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    ensure_checkpoint_dir(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply result-deciding settings to an existing session (e.g. the driver's)."""
    for k, v in RESULT_CONF.items():
        spark.conf.set(k, v)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the Python workers, once a session (local sessions already have them)."""
    sc = spark.sparkContext
    if sc.master.startswith("local[") or sc.master == "local" or getattr(sc, "_impactspark_sent", False):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    base = os.path.join(tempfile.mkdtemp(prefix="impactspark-code-"), "impactspark")
    sc.addPyFile(shutil.make_archive(base, "zip", os.path.dirname(top), os.path.basename(top)))
    sc._impactspark_sent = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting a local one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is.  Only a local session (tests, bench) without that setting gets a
    scratch folder, so that ``DataFrame.checkpoint()`` works there too.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="impactspark-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path


#: Called with the name and the frame of every table that is about to be staged (tests look at the plans).
on_stage: list = []


def stage_table(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back.

    Cuts lineage: later stages, several consumers and task retries after a
    lost executor read the table instead of recomputing ``df``.
    """
    path = stage_folder(df.sparkSession, name)
    for look in on_stage:
        look(name, df)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_bytes(df: DataFrame) -> int:
    """Size on disk of a stored table, as the planner knows it from its files."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def stage_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder, deleted with the staged tables."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _staged(spark).append(path)
    return path


def _staged(spark: SparkSession) -> list[str]:
    sc = spark.sparkContext
    if not hasattr(sc, "_impactspark_staged"):
        sc._impactspark_staged = []
    return sc._impactspark_staged


def staged_count(spark: SparkSession) -> int:
    """How many tables this session has staged and not deleted."""
    return len(_staged(spark))


def drop_stages(spark: SparkSession, keep: int = 0) -> int:
    """Delete the tables this session has staged but for the first ``keep``; call it once a run's outputs are written."""
    paths, jvm = _staged(spark), spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while len(paths) > keep:
        path = jvm.org.apache.hadoop.fs.Path(paths.pop())
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n
