"""Tables, scratch tables and settings shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import functools
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from impactspark.session import configure, ensure_checkpoint_dir

#: Rows of one Arrow batch; a batch of whole documents stays a few MB.
ARROW_ROWS = 128

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the Python workers, once a session."""
    sc = spark.sparkContext
    if getattr(sc, "_impactspark_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="impactspark-"), "impactspark.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    sc._impactspark_shipped = True


def prepare(spark: SparkSession) -> SparkSession:
    """Result-deciding settings, a bounded Arrow batch, and the package on the workers."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    ship_package(spark)
    return spark


def released(run):
    """A batch function that hands its freed memory back to the system when its partition ends.

    Python workers are reused from stage to stage; without this each keeps
    the largest heap that any of them needed.
    """
    @functools.wraps(run)
    def batches_out(batches):
        yield from run(batches)
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # another C library: it keeps the memory
            pass

    return batches_out


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder (``spark.checkpoint.dir``)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts lineage: what reads the table survives the loss of any executor
    without computing ``df`` again.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_bytes(df: DataFrame) -> int:
    """Size on disk of a staged table, as the planner knows it from its files."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; null counts as empty.

    ``lower`` has a fast path for ASCII text and touches nothing but A-Z
    there; ``translate`` handles the texts that hold other characters.
    """
    t = F.coalesce(text, F.lit(""))
    return F.when(F.length(t) == F.octet_length(t), F.lower(t)).otherwise(F.translate(t, UPPER, LOWER))


def others(df: DataFrame, *used: str) -> list[str]:
    return [c for c in df.columns if c not in used]


def free_name(df: DataFrame, name: str) -> str:
    """``name``, underscored until no column of ``df`` (in any case) has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file (the operators take any path)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def read_bytes(path: str) -> bytes:
    """A small file on the driver, such as a tokenizer's vocabulary."""
    with open(path, "rb") as f:
        return f.read()


def without(df: DataFrame, *names: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``df`` without the columns of these names in any case (``keep`` stay): what a result replaces."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c in keep or c.lower() not in gone])
