"""Queries over whole runs: ingest, sync, report, arrival, audit, summary."""

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from landfall.operators.audit import OUTCOMES, append_audit, audit_steps, batch_log, run_summary, without_errors
from landfall.operators.clean import INGEST_COLUMNS, add_ingest_columns, normalize_names
from landfall.operators.infer import collect_columns, infer_table, storage_values
from landfall.operators.publish import replace_table, write_files
from landfall.operators.schema import as_inventory, catalog_inventory, compare_zones, decide
from landfall.operators.tables import FORMAT_PROPERTY, ensure_table, table_properties, table_source, upsert_table
from landfall.plans.ingest import PATHS_READ, sync_files
from landfall.plans.publish import publish_table
from landfall.plans.sync import schema_report, sync_tables
from landfall.queries.common import RUN_TS, TABLES, land, land_json_arrays, land_loose, load, new_db, types_sql
from landfall.sources.readers import read_csv, read_table
from landfall.streaming.arrival import stream_files
from landfall.workspace import fresh_folder


def _mixed_zone(spark, sf) -> str:
    """A landing zone with one delivery per format."""
    zone = fresh_folder(spark, "zone")
    land(spark, load(spark, sf, "customer"), "customer.csv", zone)
    land(spark, load(spark, sf, "supplier"), "supplier.tsv", zone)
    land(spark, load(spark, sf, "part"), "part.json", zone)
    land(spark, load(spark, sf, "nation"), "nation.xml", zone, rootTag="nations", rowTag="nation")
    land(spark, load(spark, sf, "pages").select("url"), "urls.txt", zone)
    return zone


def _broken_zone(spark, sf) -> str:
    """The mixed zone and a JSON delivery that cannot be read."""
    zone = _mixed_zone(spark, sf)
    broken = load(spark, sf, "supplier").select(F.concat(F.lit('{"a": '), "s_name").alias("value"))
    write_files(broken, f"{zone}/broken.json", "text")
    return zone


def _ingest(spark, zone, tag, **options) -> tuple[DataFrame, str, str]:
    landing, curated = new_db(spark, f"{tag}_l"), new_db(spark, f"{tag}_c")
    status = sync_files(spark, zone, fresh_folder(spark, "curated"), landing, curated, RUN_TS, **options)
    return status, landing, curated


def ingest_zone_status(spark, sf):
    """Status and row count per delivery."""
    return _ingest(spark, _broken_zone(spark, sf), "status")[0]


def ingest_zone_rows(spark, sf):
    """Rows of a JSON delivery in the curated table."""
    _, _, curated = _ingest(spark, _mixed_zone(spark, sf), "rows")
    return read_table(spark, curated, "part")


def ingest_zone_landing(spark, sf):
    """The landing table over the delivered XML."""
    _, landing, _ = _ingest(spark, _mixed_zone(spark, sf), "landing")
    return read_table(spark, landing, "nation")


def ingest_many_files(spark, sf):
    """More loose files of a name than are read by their paths, and a delivered folder that holds a file of that name."""
    zone = fresh_folder(spark, "zone")
    land_loose(spark, load(spark, sf, "orders"), zone, "part.csv", "o_orderkey", 2 * PATHS_READ)
    land_loose(spark, load(spark, sf, "customer"), f"{zone}/big.csv", "part.csv", "c_custkey", 1)
    status, _, curated = _ingest(spark, zone, "many", detect_types=True)
    orders, customers = read_table(spark, curated, "part"), read_table(spark, curated, "big")
    sums = [
        orders.agg(F.lit("part").alias("tbl"), F.count("*").alias("row_count"), F.sum("o_orderkey").alias("keys")),
        customers.agg(F.lit("big").alias("tbl"), F.count("*").alias("row_count"), F.sum("c_custkey").alias("keys")),
    ]
    reported = status.select(F.col("table_name").alias("tbl"), "status", F.col("row_count").alias("reported"))
    return sums[0].unionByName(sums[1]).join(reported, "tbl").select("tbl", "status", "reported", "row_count", "keys")


def ingest_with_detection(spark, sf):
    """CSV columns typed and every row stamped."""
    zone = fresh_folder(spark, "zone")
    land(spark, load(spark, sf, "lineitem"), "lineitem.csv", zone)
    _, _, curated = _ingest(spark, zone, "detect", detect_types=True, ingest_columns=True, job="nightly")
    named = F.col("source_filename").rlike(r"^part-[0-9]{5}-.*\.csv$")
    rows = read_table(spark, curated, "lineitem").withColumn("source_filename", F.when(named, "part file").otherwise(F.col("source_filename")))
    return rows.withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp_ntz"))


def ingest_versioned(spark, sf):
    """A delivery with unknown columns goes to a versioned table."""
    landing, curated, target = new_db(spark, "v_l"), new_db(spark, "v_c"), fresh_folder(spark, "curated")
    first, second = fresh_folder(spark, "zone"), fresh_folder(spark, "zone")
    df = load(spark, sf, "supplier")
    land(spark, df, "supplier.csv", first)
    land(spark, df.withColumn("rating", F.col("s_acctbal") > 0), "supplier.csv", second)
    for zone in (first, second):
        sync_files(spark, zone, target, landing, curated, RUN_TS)
    old, new = "supplier", "supplier__v20250102_030405"
    counts = read_table(spark, curated, new).groupBy("rating").agg(F.count("*").alias("row_count"))
    whole = read_table(spark, curated, old).agg(F.count("*").alias("row_count"))
    return whole.select(F.lit(old).alias("tbl"), F.lit(None).cast("string").alias("rating"), "row_count").unionByName(
        counts.select(F.lit(new).alias("tbl"), "rating", "row_count")
    )


def run_summary_counts(spark, sf):
    """A4: deliveries per state."""
    return run_summary(_ingest(spark, _broken_zone(spark, sf), "summary")[0])


def batch_log_rows(spark, sf):
    """One log row per delivery."""
    return batch_log(_ingest(spark, _broken_zone(spark, sf), "log")[0], "batch-1", RUN_TS, RUN_TS)


def _landed_tables(spark, sf):
    """A landing database with detected types, and an empty curated one."""
    zone = fresh_folder(spark, "zone")
    for name in ("customer", "supplier", "part"):
        land(spark, load(spark, sf, name), f"{name}.csv", zone)
    _, landing, _ = _ingest(spark, zone, "sync", detect_types=True)
    return landing, new_db(spark, "sync_c")


def sync_tables_audit(spark, sf):
    """Two runs over landed tables, as the audit table tells."""
    landing, curated = _landed_tables(spark, sf)
    target = fresh_folder(spark, "curated")
    for run in ("run-1", "run-2"):
        names = ["customer", "supplier", "absent"] if run == "run-1" else ["customer", "supplier"]
        sync_tables(
            spark, landing, curated, target, tables=names, audit_db=curated, run_ts=RUN_TS, run_id=run,
        )
        # Drift for the second run: the supplier table loses a column.
        kept = read_table(spark, curated, "supplier").drop("s_acctbal").schema
        upsert_table(spark, curated, "supplier", f"{target}/supplier/", kept)
    message = F.regexp_replace("message", landing, "landing")
    return read_table(spark, curated, "audit").select("process_id", "table", "step", "status", message.alias("message"))


def sync_tables_schema(spark, sf):
    """Curated columns after a sync: landing columns, then the ingest columns."""
    landing, curated = _landed_tables(spark, sf)
    sync_tables(spark, landing, curated, fresh_folder(spark, "curated"), prefix="s", run_ts=RUN_TS)
    return catalog_inventory(spark, curated).drop("db")


def schema_report_run(spark, sf):
    """Three runs over a landing table that drifts, as the report files tell."""
    landing, curated = _landed_tables(spark, sf)
    target, history, reports = (fresh_folder(spark, n) for n in ("curated", "history", "reports"))
    result = None
    for run in (1, 2, 3):
        if run == 3:
            place = table_source(spark, landing, "part")[1]
            upsert_table(spark, landing, "part", place, read_table(spark, landing, "part").drop("p_size").schema)
        at = RUN_TS + dt.timedelta(hours=run)
        _, decisions = schema_report(spark, landing, curated, target, history, "", report_path=reports, run_ts=at)
        rows = decisions.select(F.lit(run).alias("run"), "tbl", "action", "schema_changed")
        result = rows if result is None else result.unionByName(rows)
    written = read_csv(spark, reports).groupBy(F.col("Table").alias("tbl")).agg(F.count("*").alias("reports"))
    return result.join(written, "tbl")


def stream_new_files(spark, sf):
    """Two waves of arrivals, each ingested once."""
    zone, target, checkpoint = (fresh_folder(spark, n) for n in ("zone", "curated", "checkpoint"))
    landing, curated = new_db(spark, "stream_l"), new_db(spark, "stream_c")
    df = load(spark, sf, "events")
    for wave in (F.col("event_type") == "view", F.col("event_type") != "view"):
        land(spark, df.filter(wave), "Events.csv", zone, mode="append")
        stream_files(spark, zone, target, landing, curated, checkpoint, run_ts=RUN_TS).awaitTermination()
    return read_table(spark, curated, "events").select(
        F.col("event_id").cast("bigint"), F.col("ts").cast("timestamp_ntz"), F.col("user_id").cast("bigint"), "event_type",
        F.col("value").cast("double"), "props",
    )


def stream_batch_log(spark, sf):
    """Arrivals per batch, from the log."""
    zone, target, checkpoint, log = (fresh_folder(spark, n) for n in ("zone", "curated", "checkpoint", "log"))
    landing, curated = new_db(spark, "streamlog_l"), new_db(spark, "streamlog_c")
    for name in ("customer", "supplier"):
        land(spark, load(spark, sf, name), f"{name}.csv", zone)
        stream_files(spark, zone, target, landing, curated, checkpoint, log, run_ts=RUN_TS).awaitTermination()
    rows = spark.read.option("recursiveFileLookup", True).parquet(log)
    return rows.groupBy("batch_id", "table_name", "status").agg((F.count("*") > 0).alias("has_files"))


def publish_then_sync_rows(spark, sf):
    """A published table keeps its rows when the zones are brought in step."""
    landing, curated = new_db(spark, "keep_l"), new_db(spark, "keep_c")
    df = load(spark, sf, "part")
    ensure_table(spark, landing, "part", land(spark, df, "part.csv"), df.schema)
    publish_table(spark, landing, "part", curated, "part", fresh_folder(spark, "published"))
    sync_tables(spark, landing, curated, fresh_folder(spark, "curated"), run_ts=RUN_TS)
    mark = table_properties(spark, curated, "part")[FORMAT_PROPERTY]
    return read_table(spark, curated, "part").withColumn("table_format", F.lit(mark))


def convert_json_texts_to_csv(spark, sf):
    """Free text with line breaks, quotes and blanks through JSON to curated CSV."""
    zone = fresh_folder(spark, "zone")
    df = load(spark, sf, "documents").withColumn("text", F.concat(F.lit('  "'), "text", F.lit('"\\ \n ')))
    land(spark, df, "documents.json", zone)
    _, _, curated = _ingest(spark, zone, "texts")
    return read_table(spark, curated, "documents").select("doc_id", "text", "lang", "source", "n_chars")


def ingest_then_stream(spark, sf):
    """Rows that arrive after an ingest are added to it."""
    first, second = fresh_folder(spark, "zone"), fresh_folder(spark, "zone")
    target, checkpoint = fresh_folder(spark, "curated"), fresh_folder(spark, "checkpoint")
    landing, curated = new_db(spark, "both_l"), new_db(spark, "both_c")
    df = load(spark, sf, "customer")
    early = F.col("c_custkey") % 2 == 0
    land(spark, df.filter(early), "customer.csv", first)
    land(spark, df.filter(~early), "customer.csv", second)
    sync_files(spark, first, target, landing, curated, RUN_TS)
    stream_files(spark, second, target, landing, curated, checkpoint, run_ts=RUN_TS).awaitTermination()
    return read_table(spark, curated, "customer").select(*[F.col(c).cast(t) for c, t in df.dtypes])


def stream_retry(spark, sf):
    """A delivery that cannot be read is tried again by the next run."""
    zone, target, checkpoint = (fresh_folder(spark, n) for n in ("zone", "curated", "checkpoint"))
    landing, curated = new_db(spark, "retry_l"), new_db(spark, "retry_c")
    df = load(spark, sf, "supplier")
    ragged = df.select(F.concat_ws(",", *df.columns, F.lit("over")).alias(",".join(df.columns)))
    land(spark, ragged, "supplier.csv", zone, sep="\t")
    stream_files(spark, zone, target, landing, curated, checkpoint, run_ts=RUN_TS).awaitTermination()
    before = len(spark.catalog.listTables(curated))
    stream_files(spark, zone, target, landing, curated, checkpoint, run_ts=RUN_TS, long_lines="cut").awaitTermination()
    rows = read_table(spark, curated, "supplier").select(*[F.col(f.name).cast(f.dataType) for f in df.schema])
    return rows.withColumn("tables_before", F.lit(before))


def ingest_type_change(spark, sf):
    """A delivery whose values the table's types do not hold goes to a versioned table."""
    landing, curated, target = new_db(spark, "type_l"), new_db(spark, "type_c"), fresh_folder(spark, "curated")
    df = load(spark, sf, "supplier")
    texts = df.withColumn("s_nationkey", F.concat(F.lit("n"), "s_nationkey"))
    for part in (df, texts):
        zone = fresh_folder(spark, "zone")
        land(spark, part, "supplier.csv", zone)
        sync_files(spark, zone, target, landing, curated, RUN_TS, detect_types=True)
    old = read_table(spark, curated, "supplier").withColumn("s_nationkey", F.col("s_nationkey").cast("string"))
    new = read_table(spark, curated, "supplier__v20250102_030405")
    return old.select(F.lit("old").alias("tbl"), *df.columns).unionByName(new.select(F.lit("new").alias("tbl"), *df.columns))


def ingest_json_mixed(spark, sf):
    """One table from files of lines and files of arrays, the arrays with a key more."""
    zone = fresh_folder(spark, "zone")
    df = load(spark, sf, "customer")
    lines = F.col("c_custkey") % 3 == 0
    land_json_arrays(spark, df.filter(~lines).withColumn("extra", F.lit("x")), "customer.json", "c_custkey", zone=zone)
    df.filter(lines).write.json(f"{zone}/customer.json/lines")
    _, _, curated = _ingest(spark, zone, "mixed")
    return read_table(spark, curated, "customer")


def ingest_empty_and_long(spark, sf):
    """A delivery without a byte and one with rows longer than its header."""
    zone = fresh_folder(spark, "zone")
    load(spark, sf, "nation").limit(0).select("n_name").write.text(f"{zone}/void.csv")
    line = F.concat_ws(",", *TABLES["supplier"], F.when(F.col("s_suppkey") % 3 == 0, F.lit("over")))
    land(spark, load(spark, sf, "supplier").select(line.alias(",".join(TABLES["supplier"]))), "supplier.csv", zone, sep="\t")
    strict = _ingest(spark, zone, "strict")[0].select(F.lit("fail").alias("long_lines"), "*")
    return strict.unionByName(_ingest(spark, zone, "cut", long_lines="cut")[0].select(F.lit("cut").alias("long_lines"), "*"))


def sync_type_drift(spark, sf):
    """A curated column of another type is drift, and one entry that cannot be read stops nothing."""
    landing, curated = new_db(spark, "drift_l"), new_db(spark, "drift_c")
    df = load(spark, sf, "orders")
    ensure_table(spark, landing, "orders", land(spark, df, "orders.csv"), df.schema)
    as_texts = df.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))
    ensure_table(spark, curated, "orders", land(spark, as_texts, "orders.csv"), as_texts.schema)
    spark.sql(f"CREATE TABLE {landing}.gone (a INT) USING parquet")
    spark.sql(f"CREATE VIEW {landing}.broken AS SELECT * FROM {landing}.gone")
    spark.sql(f"DROP TABLE {landing}.gone")
    steps = sync_tables(spark, landing, curated, fresh_folder(spark, "curated"), run_ts=RUN_TS)
    rows = read_table(spark, curated, "orders").agg(F.count("*").alias("row_count")).first()["row_count"]
    return steps.select("table", "step", "status", F.lit(rows).cast("bigint").alias("row_count"))


def audit_append(spark, sf):
    """K7: audit rows of two runs in one table, one of them repeated, counted by step."""
    db, place = new_db(spark, "audit"), fresh_folder(spark, "audit")
    columns = collect_columns(infer_table(load(spark, sf, "lineitem")))
    rows = [("lineitem", "CREATE_FDP", False, None, None), *[(c.name, "NO_OP", True, None, None) for c in columns]]
    outcomes = spark.createDataFrame(rows, OUTCOMES)
    for run in ("run-1", "run-2", "run-1"):
        append_audit(spark, audit_steps(outcomes, run, RUN_TS, "landing", "zone"), db, "audit", place)
    return read_table(spark, db, "audit").groupBy("process_id", "step", "status").agg(F.count("*").alias("n"))


def land_clean_publish(spark, sf):
    """Land a table as CSV, infer, clean, stamp, publish, compare and audit; the published rows."""
    db, place = new_db(spark, "flagship"), fresh_folder(spark, "customer")
    messy = load(spark, sf, "customer").toDF(" C_CustKey", "C Name", "c_nationkey", "c_acctbal", "Market Segment")
    landed = normalize_names(read_csv(spark, land(spark, messy, "customer.csv")))
    inferred = infer_table(landed)
    columns = collect_columns(inferred)
    typed = landed.select(*storage_values(landed, columns))
    stamped = add_ingest_columns(typed, RUN_TS, "land_clean_publish", source="customer.csv")
    replace_table(spark, stamped, db, "customer", place)

    published = read_table(spark, db, "customer")
    rows = [("customer", i + 1, c.name, c.type) for i, c in enumerate(columns)]
    before = spark.createDataFrame(rows, "tbl string, pos int, name string, type string")
    after = infer_table(published).withColumn("tbl", F.lit("customer"))
    pairs = compare_zones(as_inventory(before, "landing"), as_inventory(after, "curated"), ignore=INGEST_COLUMNS)
    decisions = decide(pairs.withColumn("evolved", F.lit(False)))
    append_audit(spark, audit_steps(without_errors(decisions), "run-1", RUN_TS, db, place), db, "audit", fresh_folder(spark, "audit"))
    step = read_table(spark, db, "audit").filter("step LIKE 'SCHEMA%'").first()["step"]
    return published.withColumn("audit_step", F.lit(step))


QUERIES = {
    f.__name__: f
    for f in (
        ingest_zone_status, ingest_zone_rows, ingest_zone_landing, ingest_many_files, ingest_with_detection, ingest_versioned,
        run_summary_counts, batch_log_rows, sync_tables_audit, sync_tables_schema, schema_report_run,
        stream_new_files, stream_batch_log, publish_then_sync_rows, convert_json_texts_to_csv, ingest_then_stream, stream_retry,
        ingest_type_change, ingest_json_mixed, ingest_empty_and_long, sync_type_drift, audit_append, land_clean_publish,
    )
}


def _steps(run: str, table: str, *middle: str) -> list[str]:
    mark = ["ICEBERG_CREATE/STARTED/", "ICEBERG_CREATE/COMPLETED/Iceberg table created/updated", "PROCESS_END/COMPLETED/"]
    steps = ["PROCESS_START/STARTED/", *middle] + (mark if table != "absent" else [])
    return [f"SELECT '{run}' AS process_id, '{table}' AS \"table\", " + ", ".join(
        f"'{v}' AS {n}" for v, n in zip(s.split("/", 2), ("step", "status", "message"), strict=True)) for s in steps]


_CHECK = "FDP_CHECK/STARTED/"
_STAMPS = "'2025-01-02T03:04:05' AS ingestion_timestamp, {}'{}' AS job_name, 'ACTIVE' AS record_status"
_DELIVERIES = [("customer.csv", "customer"), ("supplier.tsv", "supplier"), ("part.json", "part"), ("nation.xml", "nation"),
               ("urls.txt", "pages")]
_UNREADABLE = "JSON appears empty or unreadable."

ORACLE = {
    "ingest_zone_status": " UNION ALL ".join(
        f"SELECT '{f}' AS source_file, '{f.partition('.')[0]}' AS table_name, 'SUCCEEDED' AS status,"
        f" count(*) AS row_count, '' AS message FROM {t}"
        for f, t in _DELIVERIES
    ) + f" UNION ALL SELECT 'broken.json', 'broken', 'FAILED: {_UNREADABLE}', NULL, '{_UNREADABLE}'",
    "ingest_zone_rows": "SELECT * REPLACE (CAST(p_size AS BIGINT) AS p_size) FROM part",
    "ingest_zone_landing": """
        SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name, CAST(n_regionkey AS BIGINT) AS n_regionkey FROM nation
    """,
    "ingest_many_files": """
        SELECT 'part' AS tbl, 'SUCCEEDED' AS status, count(*) AS reported, count(*) AS row_count, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders
        UNION ALL SELECT 'big', 'SUCCEEDED', count(*), count(*), CAST(sum(c_custkey) AS BIGINT) FROM customer
    """,
    "ingest_with_detection": f"""
        SELECT * REPLACE (CAST(l_linenumber AS BIGINT) AS l_linenumber),
            {_STAMPS.format("'part file' AS source_filename, ", 'nightly')}
        FROM lineitem
    """,
    "ingest_versioned": """
        SELECT 'supplier' AS tbl, NULL AS rating, count(*) AS row_count FROM supplier
        UNION ALL SELECT 'supplier__v20250102_030405', CAST(s_acctbal > 0 AS VARCHAR), count(*) FROM supplier GROUP BY 2
    """,
    "run_summary_counts": "SELECT 'SUCCEEDED' AS status, CAST(5 AS BIGINT) AS items UNION ALL SELECT 'FAILED', 1",
    "batch_log_rows": " UNION ALL ".join(
        f"SELECT 'batch-1' AS batch_id, '{f}' AS source_file, '{f.partition('.')[0]}' AS table_name, '{s}' AS status,"
        f" '2025-01-02T03:04:05' AS started_at, '2025-01-02T03:04:05' AS finished_at, '{m}' AS message"
        for f, s, m in [
            *[(f, "SUCCEEDED", "") for f, _ in _DELIVERIES], ("broken.json", f"FAILED: {_UNREADABLE}", _UNREADABLE)
        ]
    ),
    "sync_tables_audit": " UNION ALL ".join(
        [
            *_steps("run-1", "customer", _CHECK, "FDP_CREATE/COMPLETED/Created FDP table"),
            *_steps("run-1", "supplier", _CHECK, "FDP_CREATE/COMPLETED/Created FDP table"),
            *_steps("run-1", "absent", "PROCESS/FAILED/Landing table landing.absent not found"),
            *_steps("run-2", "customer", _CHECK, "SCHEMA_COMPARE/COMPLETED/No schema change"),
            *_steps("run-2", "supplier", _CHECK, "SCHEMA_UPDATE/COMPLETED/Updated FDP schema from landing"),
        ]
    ),
    "sync_tables_schema": f"""
        SELECT tbl, CAST(1 AS BIGINT) AS version, pos, name, CASE type WHEN 'int' THEN 'bigint' ELSE type END AS type
        FROM ({types_sql('supplier', TABLES['supplier'])})
        UNION ALL SELECT 'supplier', 1, CAST(4 + i AS INTEGER), ({INGEST_COLUMNS})[i], 'string' FROM range(1, 5) AS r(i)
    """,
    "schema_report_run": """
        SELECT run, tbl, CASE WHEN run = 1 THEN 'CREATE_FDP' WHEN run = 3 AND tbl = 'part' THEN 'UPDATE_FDP' ELSE 'NO_OP' END AS action,
            CASE WHEN run = 1 OR (run = 3 AND tbl = 'part') THEN 'YES' ELSE 'NO' END AS schema_changed, CAST(3 AS BIGINT) AS reports
        FROM unnest([1, 2, 3]) AS r(run), unnest(['customer', 'supplier', 'part']) AS t(tbl)
    """,
    "stream_new_files": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "stream_batch_log": """
        SELECT 'batch-000000000' AS batch_id, 'customer' AS table_name, 'SUCCEEDED' AS status, count(*) > 0 AS has_files FROM customer
        UNION ALL SELECT 'batch-000000001', 'supplier', 'SUCCEEDED', count(*) > 0 FROM supplier
    """,
    "publish_then_sync_rows": "SELECT *, 'iceberg' AS table_format FROM part",
    "convert_json_texts_to_csv": "SELECT * REPLACE ('  \"' || text || '\"\\ ' || chr(10) || ' ' AS text) FROM documents",
    "ingest_then_stream": "SELECT * FROM customer",
    "stream_retry": "SELECT *, 0 AS tables_before FROM supplier",
    "ingest_type_change": """
        SELECT 'old' AS tbl, * REPLACE (CAST(s_nationkey AS VARCHAR) AS s_nationkey) FROM supplier
        UNION ALL SELECT 'new', * REPLACE ('n' || s_nationkey AS s_nationkey) FROM supplier
    """,
    "ingest_json_mixed": """
        SELECT * REPLACE (CAST(c_nationkey AS BIGINT) AS c_nationkey),
            CASE WHEN c_custkey % 3 <> 0 THEN 'x' END AS extra FROM customer
    """,
    "ingest_empty_and_long": """
        WITH void AS (SELECT 'void.csv' AS source_file, 'void' AS table_name, 'FAILED: CSV appears empty or unreadable.' AS status,
            CAST(NULL AS BIGINT) AS row_count, 'CSV appears empty or unreadable.' AS message)
        SELECT m AS long_lines, void.* FROM void, unnest(['fail', 'cut']) AS t(m)
        UNION ALL SELECT 'fail', 'supplier.csv', 'supplier', 'FAILED: a row is longer than the header', NULL, 'a row is longer than the header'
        UNION ALL SELECT 'cut', 'supplier.csv', 'supplier', 'SUCCEEDED', count(*),
            count(*) FILTER (s_suppkey % 3 = 0) || ' rows cut to the header' FROM supplier
    """,
    "sync_type_drift": """
        SELECT s[1] AS "table", s[2] AS step, s[3] AS status, (SELECT count(*) FROM orders) AS row_count FROM unnest([
            ['orders', 'PROCESS_START', 'STARTED'], ['orders', 'FDP_CHECK', 'STARTED'], ['orders', 'SCHEMA_UPDATE', 'COMPLETED'],
            ['orders', 'ICEBERG_CREATE', 'STARTED'], ['orders', 'ICEBERG_CREATE', 'COMPLETED'], ['orders', 'PROCESS_END', 'COMPLETED'],
            ['broken', 'PROCESS_START', 'STARTED'], ['broken', 'PROCESS', 'FAILED']]) AS t(s)
    """,
    "audit_append": f"""
        SELECT process_id, step, status, CAST(n AS BIGINT) AS n FROM unnest(['run-1', 'run-2']) AS r(process_id), (VALUES
            ('PROCESS_START', 'STARTED', {{n}} + 1), ('FDP_CHECK', 'STARTED', {{n}} + 1), ('FDP_CREATE', 'COMPLETED', 1),
            ('SCHEMA_COMPARE', 'COMPLETED', {{n}}), ('ICEBERG_CREATE', 'STARTED', {{n}} + 1),
            ('ICEBERG_CREATE', 'COMPLETED', {{n}} + 1), ('PROCESS_END', 'COMPLETED', {{n}} + 1)) AS s(step, status, n)
    """.replace("{n}", str(len(TABLES["lineitem"]))),
    "land_clean_publish": f"""
        SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment AS market_segment,
            {_STAMPS.format("'customer.csv' AS source_filename, ", 'land_clean_publish')}, 'SCHEMA_COMPARE' AS audit_step FROM customer
    """,
}
