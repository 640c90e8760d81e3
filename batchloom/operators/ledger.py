"""The job ledger: append-only states of submitted batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchloom.operators.grouping import keep_first

# The states a batch ends in.
TERMINAL = ["completed", "failed", "expired", "cancelled"]


def record_job(states: DataFrame, ledger_path: str) -> None:
    """Append states; a state never overwrites another batch's or an earlier one."""
    states.write.mode("append").parquet(ledger_path)


def latest_jobs(ledger: DataFrame, tiebreak: str | None = None) -> DataFrame:
    """The newest state of each batch."""
    order = [F.desc("updated_at")] + ([F.desc(tiebreak)] if tiebreak else [])
    return keep_first(ledger, ["batch_id"], order)


def find_job(ledger: DataFrame, batch_id: str, tiebreak: str | None = None) -> DataFrame:
    """The newest state of one batch; empty if the ledger does not know it."""
    return latest_jobs(ledger.where(F.col("batch_id") == batch_id), tiebreak)


def job_status(ledger: DataFrame, tiebreak: str | None = None) -> DataFrame:
    """Newest states with progress in percent, whether the batch has ended, and how long it took."""
    total = F.col("total_requests")
    done = F.col("completed_requests") + F.col("failed_requests")
    added = {"progress_pct": F.when(total > 0, done / total * 100), "ended": F.col("status").isin(TERMINAL)}
    if {"submitted_at", "completed_at"} <= set(ledger.columns):
        added["elapsed_seconds"] = F.unix_timestamp("completed_at") - F.unix_timestamp("submitted_at")
    return latest_jobs(ledger, tiebreak).withColumns(added)
