"""Month-by-month driving of the earnings cleaning with Structured Streaming.

The reference has no unbounded source: each month new template extracts
arrive and are cleaned against last month's output (SNK-3 / DED-5).  Here
the extracts land as canonical-entry Parquet drops in a folder; a file
stream with ``trigger(availableNow=True)`` picks up exactly the drops not
yet processed (the stream checkpoint remembers them), and ``foreachBatch``
runs the *batch* cleaning path on each micro-batch against the latest state.

Every micro-batch writes a new version of the state (``write_state``, named
by the batch) instead of overwriting the state it read; a retried batch
writes the same version again, so a lost executor or a restarted job never
double-counts.  Rows of the state and of a drop are ordered by their content
and number among equal rows, so the survivors of keep-first passes do not
depend on file layouts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..plans import earnings as earn
from ..sources import identify, read_state, tag, write_state


def latest_state(spark: SparkSession, state_path: str, before: int | None = None) -> DataFrame:
    """The newest state version, or the newest older than batch ``before``
    (empty frame when there is none).  A retried batch must not read the
    version that its first attempt wrote."""
    return read_state(spark, state_path, earn.STATE_SCHEMA, before=before).select(*earn.CANON_COLS)


def process_drop(batch: DataFrame, batch_id: int, state_path: str, rich: DataFrame,
                 cfg: earn.EarningsConfig) -> None:
    """One micro-batch: prior state + new drop -> cleaned entries -> new state version."""
    prev = earn.load_prior(batch.sparkSession, state_path, before=int(batch_id))
    live = identify(batch.select(*earn.CANON_COLS)).withColumnsRenamed({"entry_hash": "_file", "entry_no": "_row"})
    entries, _ = earn.clean_entries([prev, tag(live, "drop", 1)], rich, cfg)
    write_state(entries.select(*earn.CANON_COLS, "month"), state_path, version=int(batch_id))


def run_available(spark: SparkSession, landing: str, state_path: str, checkpoint: str,
                  rich: DataFrame, cfg: earn.EarningsConfig):
    """Process every drop that has landed and stop (``availableNow``).

    ``checkpoint`` must be a shared, reliable folder on a cluster.
    """
    stream = (spark.readStream.schema(earn.STATE_SCHEMA)
                   .option("recursiveFileLookup", True)      # one sub-folder per monthly drop
                   .parquet(landing))
    q = (stream.writeStream
               .foreachBatch(lambda df, bid: process_drop(df, bid, state_path, rich, cfg))
               .option("checkpointLocation", checkpoint)
               .trigger(availableNow=True)
               .start())
    q.awaitTermination()
    return q
