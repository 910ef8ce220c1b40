"""Secret scan over an incremental blob ledger (DataFrame functions only).

Every version of every path is content-addressed (SHA-256 of its text, a
"blob").  A blob is scanned once for each rule version: blobs that the
ledger already holds under the current version are left out, the findings
of the new ones are appended, and findings join back to all paths that ever
held the blob.  A span is ``kind:start:end`` in code points, end exclusive.

Null texts count as empty (one blob without findings); repeated rows and
paths keep one result row each; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import free_name, scratch, staged

#: Kind -> (pattern, group whose length counts, least length), in listing order.
RULES = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
)
RULE_VERSION = "base-1"
EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"

LEDGER_SCHEMA = ("blob string, rule_version string, n_assign bigint, n_access bigint, n_hex bigint, "
                 "spans string, base_sha256 string")


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def _hits(text: Column, number: int) -> Column:
    """The matches of one rule as pieces between them, match lengths and counted lengths."""
    kind, pattern, group, _ = RULES[number]
    rx = F.lit(pattern)
    size = lambda xs: F.transform(xs, lambda x: F.length(x))
    whole = size(F.regexp_extract_all(text, rx, F.lit(0)))
    counted = size(F.regexp_extract_all(text, rx, F.lit(group))) if group else whole
    gaps = size(F.split(text, pattern, -1))
    found = F.struct(F.lit(number).alias("rule"), F.arrays_zip(gaps.alias("gap"), whole.alias("len"),
                                                               counted.alias("counted")).alias("hits"))
    return F.when(text.rlike(pattern), found)


def scan_blobs(blobs: DataFrame, blob: str = "blob", text: str = "text") -> DataFrame:
    """Findings of distinct blobs: one row per blob that has any, in the ledger's columns.

    The start of a match is the sum of all gaps up to it and all matches
    before it, so a running sum over the exploded matches gives it in one
    linear pass, whatever the length of the text.
    """
    kinds = F.create_map(*[F.lit(x) for k, r in enumerate(RULES) for x in (k, r[0])])
    least = F.create_map(*[F.lit(x) for k, r in enumerate(RULES) for x in (k, r[3])])
    body = F.coalesce(F.col(text), F.lit(""))
    per_rule = blobs.select(F.col(blob).alias("blob"),
                            F.explode(F.array(*[_hits(body, k) for k in range(len(RULES))])).alias("f"))
    matches = (per_rule.where(F.col("f").isNotNull())
               .select("blob", F.col("f.rule").alias("rule"), F.posexplode("f.hits").alias("pos", "h"))
               .select("blob", "rule", "pos", F.col("h.gap").alias("gap"), F.col("h.len").alias("len"),
                       F.col("h.counted").alias("counted"))
               .where(F.col("len").isNotNull()))
    upto = Window.partitionBy("blob", "rule").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    spans = (matches.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(upto))
             .withColumn("start", F.col("end") - F.col("len"))
             .where(F.col("counted") >= least[F.col("rule")]))
    named = F.transform(F.array_sort(F.collect_list(F.struct("start", "rule", "end"))),
                        lambda s: F.concat_ws(":", kinds[s["rule"]], s["start"].cast("string"), s["end"].cast("string")))
    count = lambda k: F.count(F.when(F.col("rule") == k, 1))
    out = spans.groupBy("blob").agg(count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                                    F.array_join(named, ",").alias("spans"))
    return out.select("blob", F.lit(RULE_VERSION).alias("rule_version"), "n_assign", "n_access", "n_hex", "spans",
                      F.sha2(F.col("spans").cast("binary"), 256).alias("base_sha256"))


def unseen_blobs(versions: DataFrame, ledger: DataFrame | None, text: str = "text") -> DataFrame:
    """``(blob, text)``: one row for each blob that the ledger lacks under this rule version.

    The first row of a blob is taken map-side before the shuffle, so a blob
    that a third of all rows hold leaves each task once.
    """
    one = Window.partitionBy("blob").orderBy("blob")
    found = (versions.select(blob_id(F.col(f"`{text}`")).alias("blob"), F.col(f"`{text}`").alias("text"))
             .withColumn("rank", F.row_number().over(one)).where("rank = 1").drop("rank"))
    if ledger is None:
        return found
    return found.join(ledger.where(F.col("rule_version") == RULE_VERSION).select("blob").distinct(), "blob", "left_anti")


def _joined_back(versions: DataFrame, known: DataFrame, text: str) -> DataFrame:
    """``versions`` with the findings of their blobs (``known``: one row for each blob that has any)."""
    known = known.select("blob", "n_assign", "n_access", "n_hex", "spans", "base_sha256")
    names = {"n_assign", "n_access", "n_hex", "spans", "base_sha256"}
    kept = versions.select(*[F.col(f"`{c}`") for c in versions.columns if c.lower() not in names])
    key = free_name(kept, "_blob")
    paths = kept.withColumn(key, blob_id(F.col(f"`{text}`")))
    joined = paths.join(known.withColumnRenamed("blob", key), key, "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c)
    return joined.select(*[F.col(f"`{c}`") for c in kept.columns], zero("n_assign"), zero("n_access"), zero("n_hex"),
                           F.coalesce("spans", F.lit("")).alias("spans"),
                           F.coalesce("base_sha256", F.lit(EMPTY_SHA256)).alias("base_sha256"))


def scan(versions: DataFrame, ledger: DataFrame | None = None, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Scan all versions; returns (``versions`` with findings, rows to append to the ledger).

    The appended rows hold a row for every newly scanned blob, also those
    without findings, so that no later run scans them again.  A version gets
    the columns n_assign, n_access, n_hex, spans and base_sha256 (clashing
    columns of the input are replaced).
    """
    spark: SparkSession = versions.sparkSession
    new = staged(unseen_blobs(versions, ledger, text), "secret-blobs") if ledger is not None \
        else unseen_blobs(versions, None, text)
    found = staged(scan_blobs(new), "secret-findings")
    cols = ["blob", "n_assign", "n_access", "n_hex", "spans", "base_sha256"]
    known = found.select(*cols)
    if ledger is not None:
        old = ledger.where((F.col("rule_version") == RULE_VERSION) & (F.col("spans") != "")).select(*cols)
        known = known.unionByName(old.dropDuplicates(["blob"]))
    result = _joined_back(versions, known, text)
    clean = new.select("blob").join(found.select("blob"), "blob", "left_anti").select(
        "blob", F.lit(RULE_VERSION).alias("rule_version"), *[F.lit(0).cast("bigint").alias(c) for c in cols[1:4]],
        F.lit("").alias("spans"), F.lit(EMPTY_SHA256).alias("base_sha256"))
    return result, found.unionByName(clean)


def scan_ledger(versions: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Scan what the ledger at ``path`` lacks, append it, and give every version its findings from the ledger.

    Three steps on slim tables and one on texts: the blobs' digests are
    stored and compared with the ledger's; only the texts of unseen ones are
    gathered, once each, and scanned; their rows, also those without
    findings, are appended; then the ledger's findings join back to all
    paths.  A second run over the same versions scans nothing.  A run that
    fails before its append leaves the ledger as it was, and rows that two
    runs appended for one blob count once.
    """
    spark = versions.sparkSession
    ledger = read_ledger(spark, path).where(F.col("rule_version") == RULE_VERSION)
    known = staged(ledger.select("blob").distinct(), "secret-known")
    body = F.col(f"`{text}`")
    unseen = staged(versions.select(blob_id(body).alias("blob")).distinct().join(known, "blob", "left_anti"), "secret-unseen")
    if not unseen.isEmpty():
        one = Window.partitionBy("blob").orderBy("blob")
        texts = versions.select(blob_id(body).alias("blob"), body.alias("text"))
        if not known.isEmpty():
            texts = texts.join(unseen, "blob", "left_semi")
        texts = texts.withColumn("rank", F.row_number().over(one)).where("rank = 1").drop("rank")
        found = staged(scan_blobs(texts), "secret-findings")
        zero = [F.lit(0).cast("bigint").alias(f"n_{r[0]}") for r in RULES]
        clean = unseen.join(found.select("blob"), "blob", "left_anti").select(
            "blob", F.lit(RULE_VERSION).alias("rule_version"), *zero, F.lit("").alias("spans"), F.lit(EMPTY_SHA256).alias("base_sha256"))
        update_ledger(spark, path, found.unionByName(clean))
        ledger = read_ledger(spark, path).where(F.col("rule_version") == RULE_VERSION)
    return _joined_back(versions, ledger.where("spans != ''").dropDuplicates(["blob"]), text)


def update_ledger(spark: SparkSession, path: str, rows: DataFrame) -> None:
    """Append newly scanned blobs to the ledger table at ``path`` (in shared storage)."""
    rows.write.mode("append").parquet(path)


def read_ledger(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The ledger at ``path``; an empty one when no path is given or nothing has been appended there yet."""
    try:
        if path is not None:
            return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    return spark.createDataFrame([], LEDGER_SCHEMA)


def new_ledger_path(spark: SparkSession) -> str:
    return scratch(spark, "secret-ledger")


#: The session setting that names a ledger to go on with.
LEDGER_SETTING = "spark.impactspark.secretLedger"


def ledger_path(spark: SparkSession) -> str:
    """The ledger that the session names, or a new one in the shared folder."""
    return spark.conf.get(LEDGER_SETTING, None) or new_ledger_path(spark)
