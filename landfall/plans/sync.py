"""Keep curated tables in step with landing tables, and report drift.

Inventory, comparison and decision run for all tables in one plan; only the
catalog statements loop, over the tables that need one.
"""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from landfall.functions.names import failure_text, join_location
from landfall.operators.audit import OUTCOMES, append_audit, audit_steps, process_id
from landfall.operators.clean import INGEST_COLUMNS
from landfall.operators.publish import write_files
from landfall.operators.schema import (
    CREATE, INVENTORY, MISSING, NO_OP, UNREADABLE, compact_ts, compare_zones, current_evolution, decide, read_inventory, report,
)
from landfall.operators.tables import ensure_database, mark_table_format, qualified, table_source, upsert_table
from landfall.workspace import written


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def _bring_in_step(
    spark: SparkSession, landing_db: str, curated_db: str, table: str, action: str, target: str, extra: list[str]
) -> None:
    """Create the curated entry, or give an existing one the landing columns.

    A new entry gets the extra columns too; an existing one keeps those it has.
    """
    landing = spark.table(qualified(landing_db, table)).schema
    known = {f.name.lower() for f in landing}
    place, source = join_location(target, table) + "/", "csv"
    keep = extra
    if action != CREATE:
        have = {c.lower() for c in spark.table(qualified(curated_db, table)).columns}
        keep = [c for c in extra if c.lower() in have]
        source, place = table_source(spark, curated_db, table)
    added = [T.StructField(c, T.StringType()) for c in keep if c.lower() not in known]
    upsert_table(spark, curated_db, table, place, T.StructType([*landing.fields, *added]), source)


def sync_tables(
    spark: SparkSession,
    landing_db: str,
    curated_db: str,
    target: str,
    prefix: str = "",
    tables: list[str] | None = None,
    extra_columns: list[str] = INGEST_COLUMNS,
    strict: bool = False,
    table_format: str = "iceberg",
    properties: dict[str, str] | None = None,
    audit_db: str | None = None,
    audit_table: str = "audit",
    audit_location: str | None = None,
    run_ts: dt.datetime | None = None,
    run_id: str | None = None,
    workers: int = 4,
) -> DataFrame:
    """Bring curated tables to their landing schemas and return the audit rows.

    Curated ingest columns do not count as a difference unless ``strict``. A
    table that cannot be read or fails is reported and does not stop the others.
    Tables stay where their data lies.
    """
    run_ts = run_ts or _now()
    run_id = run_id or process_id(run_ts)
    extra = [] if strict else extra_columns
    ensure_database(spark, curated_db)
    landing, lost = read_inventory(spark, landing_db, prefix)
    curated, lost_curated = read_inventory(spark, curated_db, prefix)
    lost = {**lost_curated, **lost}
    names = spark.createDataFrame([(t,) for t in tables], "tbl string") if tables is not None else None
    pairs = compare_zones(landing, curated, names, ignore=extra)
    decisions = decide(pairs.withColumn("evolved", F.lit(False)))

    def one(row) -> tuple:
        table, action = row["tbl"], row["action"]
        sync_error = format_error = None
        if table in lost:
            return table, UNREADABLE, row["target_exists"], lost[table], None
        if action != MISSING:
            try:
                if action != NO_OP:
                    stamps = extra_columns if action == CREATE else extra
                    _bring_in_step(spark, landing_db, curated_db, table, action, target, stamps)
            except Exception as error:
                sync_error = failure_text(error)
        if action != MISSING and sync_error is None:
            try:
                place = join_location(target, table) + "/"
                mark_table_format(spark, curated_db, table, place, table_format, properties)
            except Exception as error:
                format_error = failure_text(error)
        return table, action, row["target_exists"], sync_error, format_error

    # A few rows per table; unreadable tables are in no inventory and join here.
    rows = decisions.orderBy("tbl").select("tbl", "action", "target_exists").collect()
    known = {r["tbl"] for r in rows}
    wanted = set(tables) if tables is not None else set(lost)
    rows += [{"tbl": t, "action": UNREADABLE, "target_exists": t in lost_curated} for t in sorted(wanted & set(lost) - known)]
    with ThreadPoolExecutor(max_workers=workers) as pool:
        outcomes = list(pool.map(one, rows))
    steps = audit_steps(spark.createDataFrame(outcomes, OUTCOMES), run_id, run_ts, landing_db, target)
    if audit_db:
        ensure_database(spark, audit_db)
        append_audit(spark, steps, audit_db, audit_table, audit_location or join_location(target, audit_table))
    return steps


def record_versions(spark: SparkSession, inventory: DataFrame, history: str, run_ts: dt.datetime) -> DataFrame:
    """Add an inventory to the schema history as the next version of each table.

    Every run has its own folder, written in overwrite mode, so a run that is
    repeated after a failure counts once. Returns the whole history.
    """
    run = f"run-{compact_ts(run_ts)}"
    reader = spark.read.schema(INVENTORY).option("recursiveFileLookup", True)
    spark.createDataFrame([], INVENTORY).write.mode("ignore").parquet(join_location(history, "start"))
    old = reader.parquet(history).filter(~F.col("_metadata.file_path").contains(f"/{run}/"))
    newest = old.groupBy("db", "tbl").agg(F.max("version").alias("last"))
    numbered = inventory.join(newest, ["db", "tbl"], "left").select(
        "db", "tbl", (F.coalesce("last", F.lit(0)) + 1).cast("bigint").alias("version"), "pos", "name", "type"
    )
    # Written aside first, so that nothing reads what is overwritten.
    numbered = written(spark, numbered, "history")
    numbered.write.mode("overwrite").parquet(join_location(history, run))
    return reader.parquet(history)


def schema_report(
    spark: SparkSession,
    landing_db: str,
    curated_db: str,
    target: str,
    history: str,
    prefix: str = "",
    tables: list[str] | None = None,
    report_path: str | None = None,
    run_ts: dt.datetime | None = None,
    apply: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Compare landing tables with their previous version and the curated zone.

    Each run records the landing schemas as a new version. Returns the report
    and the decisions; the curated catalog follows unless ``apply`` is off. The
    decisions' ``error`` says why a table could not be read or brought in step;
    the other tables go on.
    """
    run_ts = run_ts or _now()
    ensure_database(spark, curated_db)
    landing, lost = read_inventory(spark, landing_db, prefix)
    curated, lost_curated = read_inventory(spark, curated_db, prefix)
    lost = {**lost_curated, **lost}
    names = spark.createDataFrame([(t,) for t in tables], "tbl string") if tables is not None else None
    versions = record_versions(spark, landing, history, run_ts).filter(F.col("db") == landing_db)
    evolved = current_evolution(versions).select("tbl", "evolved")
    pairs = compare_zones(landing, curated, names).join(evolved, "tbl", "left")
    decided = decide(pairs.withColumn("evolved", F.coalesce("evolved", F.lit(False))))
    # Fixed now: the catalog statements below would change a later evaluation.
    rows, errors = [tuple(r) for r in decided.orderBy("tbl").collect()], dict(lost)
    place = {name: i for i, name in enumerate(decided.columns)}
    known = {r[place["tbl"]] for r in rows}
    wanted = set(tables) if tables is not None else set(lost)
    blank = {"action": UNREADABLE, "schema_changed": "NO", "landing_exists": True, "target_exists": False, "mismatch": False, "evolved": False}
    rows += [tuple({**blank, "tbl": t}[c] for c in decided.columns) for t in sorted(wanted & set(lost) - known)]
    if apply:
        for row in rows:
            table, action = row[place["tbl"]], row[place["action"]]
            if action not in (MISSING, NO_OP, UNREADABLE) and table not in lost:
                try:
                    _bring_in_step(spark, landing_db, curated_db, table, action, target, [])
                except Exception as error:
                    errors[table] = failure_text(error)
    schema = T.StructType([*decided.schema.fields, T.StructField("error", T.StringType())])
    decisions = spark.createDataFrame([(*r, errors.get(r[place["tbl"]])) for r in rows], schema)
    result = report(decisions, landing, landing_db, run_ts)
    if report_path:
        name = F.concat(F.lit("schema_report_"), F.col("Table"), F.lit(f"_{compact_ts(run_ts)}"))
        named = result.withColumn("report", name).repartition("report")
        write_files(named, report_path, "csv", "append", partition_by=["report"])
    return result, decisions
