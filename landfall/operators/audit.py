"""Audit rows, row-count guards, run summary and batch log."""

import datetime as dt
import logging
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from landfall.operators.publish import put_runs
from landfall.operators.schema import CREATE, MISSING, NO_OP, UNREADABLE

log = logging.getLogger(__name__)

# Columns of the audit and batch log tables, all strings.
AUDIT_COLUMNS = ["process_id", "table", "step", "status", "message", "timestamp", "meta"]
BATCH_LOG_COLUMNS = [
    "batch_id", "source_file", "table_name", "status", "started_at", "finished_at", "message",
]


def process_id(run_ts: dt.datetime) -> str:
    """One id per run."""
    return f"proc_{run_ts:%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}"


def _step(name: str, status: str, message: str | Column = "", **meta: Column) -> Column:
    text = F.lit(message) if isinstance(message, str) else message
    details = F.to_json(F.struct(*[v.alias(k) for k, v in meta.items()])) if meta else F.lit("{}")
    return F.struct(
        F.lit(name).alias("step"), F.lit(status).alias("status"), text.alias("message"), details.alias("meta")
    )


OUTCOMES = "tbl string, action string, target_exists boolean, sync_error string, format_error string"


def without_errors(decisions: DataFrame) -> DataFrame:
    """Outcomes of decisions that were all carried out."""
    errors = [F.lit(None).cast("string").alias(c) for c in ("sync_error", "format_error")]
    return decisions.select("tbl", "action", "target_exists", *errors)


def audit_steps(
    outcomes: DataFrame, run_id: str, run_ts: dt.datetime, landing_db: str, location: str = ""
) -> DataFrame:
    """Audit rows of table syncs, in step order (``seq``).

    ``outcomes``: tbl, action, target_exists, sync_error, format_error. The
    steps, statuses and messages below are fixed values.
    """
    where = F.concat(F.lit(location.rstrip("/") + "/"), F.col("tbl"), F.lit("/"))
    synced = (
        F.when(F.col("sync_error").isNotNull(), _step("FDP_SYNC", "FAILED", F.col("sync_error")))
        .when(F.col("action") == CREATE, _step("FDP_CREATE", "COMPLETED", "Created FDP table", fdp_location=where))
        .when(F.col("action") == NO_OP, _step("SCHEMA_COMPARE", "COMPLETED", "No schema change"))
        .otherwise(_step("SCHEMA_UPDATE", "COMPLETED", "Updated FDP schema from landing"))
    )
    not_found = F.concat(F.lit(f"Landing table {landing_db}."), F.col("tbl"), F.lit(" not found"))
    start = _step("PROCESS_START", "STARTED")
    check = _step("FDP_CHECK", "STARTED", fdp_exists=F.col("target_exists"))
    mark = _step("ICEBERG_CREATE", "STARTED")
    marked = _step("ICEBERG_CREATE", "COMPLETED", "Iceberg table created/updated")
    steps = (
        F.when(F.col("action") == MISSING, F.array(start, _step("PROCESS", "FAILED", not_found)))
        .when(F.col("action") == UNREADABLE, F.array(start, _step("PROCESS", "FAILED", F.col("sync_error"))))
        .when(F.col("sync_error").isNotNull(), F.array(start, check, synced))
        .when(
            F.col("format_error").isNotNull(),
            F.array(start, check, synced, mark, _step("ICEBERG_CREATE", "FAILED", F.col("format_error"))),
        )
        .otherwise(F.array(start, check, synced, mark, marked, _step("PROCESS_END", "COMPLETED")))
    )
    return outcomes.select("tbl", F.posexplode(steps).alias("seq", "s")).select(
        F.lit(run_id).alias("process_id"),
        F.col("tbl").alias("table"),
        F.col("s.step").alias("step"),
        F.col("s.status").alias("status"),
        F.col("s.message").alias("message"),
        F.lit(run_ts.strftime("%Y-%m-%dT%H:%M:%S+00:00")).alias("timestamp"),
        F.col("s.meta").alias("meta"),
        (F.col("seq") + 1).alias("seq"),
    )


def append_audit(spark: SparkSession, rows: DataFrame, db: str, table: str, location: str) -> bool:
    """Add a run's audit rows, once however often it is repeated. A failure is logged and never stops the run."""
    try:
        put_runs(spark, rows.select(*AUDIT_COLUMNS), db, table, location, "process_id")
    except Exception:
        log.exception("audit rows not written")
        return False
    return True


def guard_status(df: DataFrame) -> str:
    """EMPTY or READY, by looking for one row."""
    return "EMPTY" if df.isEmpty() else "READY"


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count and guard status of several tables in one job."""
    counts = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("tbl"), "row_count")
        counts = one if counts is None else counts.unionByName(one)
    status = F.when(F.col("row_count") == 0, "EMPTY").otherwise("READY")
    return counts.withColumn("status", status)


def run_summary(statuses: DataFrame) -> DataFrame:
    """Items per state; a state is the text before a colon (``FAILED: reason``)."""
    state = F.regexp_extract("status", "^([^:]*)", 1)
    return statuses.groupBy(state.alias("status")).agg(F.count("*").alias("items"))


def batch_log(
    statuses: DataFrame, batch_id: str, started_at: dt.datetime, finished_at: dt.datetime
) -> DataFrame:
    """Batch log rows of statuses with source_file, table_name, status, message; all strings."""
    iso = "%Y-%m-%dT%H:%M:%S"
    values = {
        "batch_id": F.lit(batch_id),
        "started_at": F.lit(started_at.strftime(iso)),
        "finished_at": F.lit(finished_at.strftime(iso)),
    }
    return statuses.select(*[values.get(c, F.col(c)).alias(c) for c in BATCH_LOG_COLUMNS])
