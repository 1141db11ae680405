"""Arrival-driven ingest: each new CSV is registered and copied once."""

import datetime as dt
import hashlib

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from landfall.functions.names import catalog_name, failure_text, glob_for, join_location, key_matches, table_name, unit_path
from landfall.operators.audit import batch_log
from landfall.operators.tables import ensure_database
from landfall.plans.ingest import STATUS, FileGroup, sync_group
from landfall.sources.listing import LISTING
from landfall.workspace import written

FILES_PER_BATCH = 500

# What is wrong with a file itself; anything else is a fault of the run and stops it.
DATA_FAULTS = (ValueError, PySparkException)
# One event of a file in the ledger of failures; the one with the highest number tells its state.
RETRY = "path string, modificationTime timestamp, reason string, state string, number bigint"
FAILED, DONE = "failed", "done"


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def new_files(
    spark: SparkSession, source: str, pattern: str = "*.csv", files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """Stream of files as they arrive; contents are not read."""
    return (
        spark.readStream.format("binaryFile")
        .schema(LISTING + ", content binary")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(source)
        .select("path", "modificationTime", "length")
    )


def stream_files(
    spark: SparkSession,
    source: str,
    target: str,
    landing_db: str,
    curated_db: str,
    checkpoint: str,
    log_path: str | None = None,
    prefix: str = "",
    run_ts: dt.datetime | None = None,
    job: str = "stream_files",
    files_per_batch: int = FILES_PER_BATCH,
    **options,
) -> StreamingQuery:
    """Start ingesting the CSV files that arrived since the last run, then stop.

    The checkpoint remembers which files were seen. Every batch writes to its
    own folder, named by checkpoint and batch, in overwrite mode, so a repeated
    batch changes nothing and streams never touch each other's rows. A file
    whose table exists is still processed; its rows are added.

    Files that fail are noted beside the checkpoint, in a ledger that only
    grows, and tried again first by the next run. A retry is named by the newest
    event it starts from and notes all its outcomes in one write, so a run that
    stops anywhere repeats the same retry: no note is lost and no row is added
    twice. A failure that is no fault of the file stops the run after the batch,
    which is then repeated.
    """
    ensure_database(spark, landing_db)
    ensure_database(spark, curated_db)
    stream = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:8]
    retry = checkpoint.rstrip("/") + "-retry"

    def failed_before() -> DataFrame:
        spark.createDataFrame([], RETRY).write.mode("ignore").parquet(join_location(retry, "start"))
        noted = spark.read.schema(RETRY).option("recursiveFileLookup", True).parquet(retry)
        newest = noted.groupBy("path").agg(F.max_by(F.struct("modificationTime", "state", "number"), "number").alias("newest"))
        return newest.select("path", "newest.*").filter(F.col("state") == FAILED)

    # The caller's session does the work, so that its view of the tables is fresh.
    def ingest(batch: DataFrame, batch_id: int, again: bool = False) -> None:
        started = run_ts or _now()
        wanted = batch.filter(key_matches(F.col("path"), prefix, ".csv"))
        # A batch holds at most files_per_batch paths.
        unit = unit_path(F.col("path"))
        found = wanted.select("path", unit.alias("unit"), table_name(unit, lower=True).alias("table"), "modificationTime")
        groups: dict[str, list] = {}
        for file in sorted(found.collect()):
            groups.setdefault(file["table"], []).append(file)
        # The newest file dates the batch, so a repeated batch names the same tables.
        newest = max((f["modificationTime"] for g in groups.values() for f in g), default=started)
        part, rows, events, broken = f"batch-{batch_id:09d}", [], [], None
        number = batch_id + 1 if again else int(_now().timestamp() * 1_000_000)
        folder = f"{'retry' if again else 'batch'}-{stream}-{batch_id:09d}"
        for name, files in groups.items():
            table = catalog_name(name)
            paths, units = [f["path"] for f in files], {f["unit"] for f in files}
            landing, place = {"recursiveFileLookup": "true"}, source
            if len(units) == 1 and units.isdisjoint(paths):
                place = units.pop()
            else:
                landing["pathGlobFilter"] = glob_for(name, "csv", any_case=True)
            try:
                used, count, note = sync_group(
                    spark, FileGroup(name, "csv", table, files=len(paths)), paths, target, landing_db, curated_db,
                    run_ts or newest, job, target_part=folder, landing_path=place, landing_options=landing, **options,
                )
                state = (used, "SUCCEEDED", count, note)
                events += [(f["path"], f["modificationTime"], None, DONE, number) for f in files if again]
            except Exception as error:
                reason = failure_text(error)
                state = (table, f"FAILED: {reason}", None, reason)
                events += [(f["path"], f["modificationTime"], reason, FAILED, number) for f in files]
                if not isinstance(error, DATA_FAULTS):
                    broken = error
            rows += [(p.rpartition("/")[2], *state) for p in paths]
        if rows:
            spark.createDataFrame(events, RETRY).write.mode("overwrite").parquet(join_location(retry, folder))
        if log_path and rows:
            statuses = spark.createDataFrame(rows, STATUS)
            logged = batch_log(statuses, folder if again else part, started, run_ts or _now())
            logged.write.mode("overwrite").parquet(join_location(log_path, folder))
        if broken is not None:
            raise broken

    # Files of earlier runs that failed come first.
    noted = written(spark, failed_before(), "retry")
    newest = noted.agg(F.max("number")).first()[0]
    if newest is not None:
        ingest(noted.select("path", "modificationTime"), newest, again=True)

    return (
        new_files(spark, source, files_per_batch=files_per_batch)
        .writeStream.foreachBatch(ingest)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
