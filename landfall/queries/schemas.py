"""Queries over schemas inferred from whole tables: diff, drift, decision, report."""

from pyspark.sql import functions as F

from landfall.operators.audit import audit_steps, without_errors
from landfall.operators.clean import INGEST_COLUMNS
from landfall.operators.infer import infer_groups, infer_many
from landfall.operators.schema import (
    INVENTORY, as_inventory, compare_zones, current_evolution, decide, diff, evolution, missing_columns, report, signatures,
    tolerant_match, versioned_targets,
)
from landfall.queries.common import RUN_TS, TABLES, inventory_sql, label_sql, load, load_all, rank_sql, types_sql
from landfall.workspace import written

PAIR = ["customer", "supplier"]
ZONE = ["customer", "orders", "part", "supplier", "nation", "events"]
WANTED = [*ZONE, "absent"]


def _unprefixed(spark, sf, name):
    df = load(spark, sf, name)
    return df.toDF(*[c.partition("_")[2] for c in df.columns])


def _pair(spark, sf):
    """Customer and supplier as two states of one table, prefixes removed."""
    left, right = (
        as_inventory(infer_many({"party": _unprefixed(spark, sf, n)}), db) for n, db in zip(PAIR, ("old", "new"), strict=True)
    )
    return left, right


def schema_signature(spark, sf):
    """One sorted column list per table."""
    inventory = as_inventory(infer_many(load_all(spark, sf, TABLES)), "landing")
    listed = F.transform("signature", lambda c: F.concat(c["name"], F.lit(":"), c["type"]))
    return signatures(inventory).select("db", "tbl", F.array_join(listed, ",").alias("signature"))


def schema_diff_strict(spark, sf):
    """C2/C4."""
    return diff(*_pair(spark, sf))


def schema_diff_tolerant(spark, sf):
    """Incoming columns the target lacks."""
    return missing_columns(*_pair(spark, sf))


def _weekly(spark, sf):
    """Events per week as schema versions: whole values in week 1, event_type from week 3 on."""
    week = (F.floor((F.dayofmonth("ts") - 1) / 7) + 1).cast("bigint")
    text = F.col("value").cast("bigint").cast("string")
    df = load(spark, sf, "events").select(
        week.alias("version"),
        "event_id",
        "user_id",
        F.when(week == 1, text).otherwise(F.col("value").cast("string")).alias("value"),
        "event_type",
    )
    columns = infer_groups(df, ["version"])
    kept = columns.filter((F.col("name") != "event_type") | (F.col("version") >= 3))
    return as_inventory(kept, "landing", "events", F.col("version"))


def schema_evolution(spark, sf):
    """Each version against the one before."""
    return evolution(_weekly(spark, sf))


def schema_evolution_newest(spark, sf):
    """C3 for the newest version only."""
    return current_evolution(_weekly(spark, sf))


def _zones(spark, sf):
    """Landing with two versions, and a curated zone that lags behind in places."""
    columns = written(spark, infer_many(load_all(spark, sf, ZONE)), "columns")
    name, tbl = F.col("name"), F.col("tbl")
    landing = as_inventory(columns, "landing", version=2)
    earlier = as_inventory(
        columns.filter((tbl != "nation") & ~((tbl == "supplier") & (name == "s_acctbal"))), "landing", version=1
    )
    curated = as_inventory(
        columns.filter(~tbl.isin("part", "nation") & ~((tbl == "orders") & (name == "o_orderpriority"))), "curated"
    )
    rows = [("curated", "events", 1, 99, c, "string") for c in INGEST_COLUMNS]
    stamps = spark.createDataFrame(rows, INVENTORY)
    return landing, earlier, curated.unionByName(stamps)


def _decisions(spark, sf, evolving=True):
    landing, earlier, curated = _zones(spark, sf)
    wanted = spark.createDataFrame([(t,) for t in WANTED], "tbl string")
    pairs = compare_zones(landing, curated, wanted, ignore=INGEST_COLUMNS)
    if not evolving:
        return landing, decide(pairs.withColumn("evolved", F.lit(False)))
    evolved = current_evolution(earlier.unionByName(landing)).select("tbl", "evolved")
    pairs = pairs.join(evolved, "tbl", "left").withColumn("evolved", F.coalesce("evolved", F.lit(False)))
    return landing, decide(pairs)


def sync_decision(spark, sf):
    """Every row of the decision table."""
    return _decisions(spark, sf)[1]


def schema_report(spark, sf):
    """The report rows."""
    landing, decisions = _decisions(spark, sf)
    return report(decisions, landing, "landing", RUN_TS)


def audit_step_rows(spark, sf):
    """The audit rows of a table sync."""
    decisions = _decisions(spark, sf, evolving=False)[1]
    return audit_steps(without_errors(decisions), "run-1", RUN_TS, "landing", "zone/curated")


def versioned_target(spark, sf):
    """A table whose columns do not fit goes to a versioned one."""
    landing, _, curated = _zones(spark, sf)
    return versioned_targets(tolerant_match(landing, curated), RUN_TS)


QUERIES = {
    f.__name__: f
    for f in (
        schema_signature, schema_diff_strict, schema_diff_tolerant, schema_evolution, schema_evolution_newest,
        sync_decision, schema_report, audit_step_rows, versioned_target,
    )
}

_LEFT, _RIGHT = (
    "SELECT substr(name, 3) AS name, type FROM (" + types_sql(t, TABLES[t]) + ")" for t in PAIR
)

_WEEKLY = f"""
    WITH e AS (SELECT CAST(floor((day(ts) - 1) / 7) AS BIGINT) + 1 AS version, * FROM events),
    v AS (SELECT version, 'event_id' AS name, CAST(event_id AS VARCHAR) AS v FROM e
        UNION ALL SELECT version, 'user_id', CAST(user_id AS VARCHAR) FROM e
        UNION ALL SELECT version, 'value', CASE WHEN version = 1 THEN CAST(CAST(trunc(value) AS BIGINT) AS VARCHAR)
            ELSE CAST(value AS VARCHAR) END FROM e
        UNION ALL SELECT version, 'event_type', event_type FROM e WHERE version >= 3),
    c AS (SELECT version, name, {label_sql('max(' + rank_sql('v') + ')')} AS type FROM v GROUP BY ALL),
    s AS (SELECT version, string_agg(name || ':' || type, ',' ORDER BY name) AS signature FROM c GROUP BY version),
    h AS (SELECT 'landing' AS db, 'events' AS tbl, version,
        signature IS DISTINCT FROM lag(signature) OVER (ORDER BY version) AS evolved FROM s)
"""

_ZONES = f"""
    WITH inv AS ({inventory_sql(ZONE)}),
    old AS (SELECT * FROM inv WHERE tbl <> 'nation' AND NOT (tbl = 'supplier' AND name = 's_acctbal')),
    cur AS (SELECT * FROM inv WHERE tbl NOT IN ('part', 'nation') AND NOT (tbl = 'orders' AND name = 'o_orderpriority')),
    l AS (SELECT tbl, string_agg(name || ':' || type, ',' ORDER BY name) AS s FROM inv GROUP BY tbl),
    o AS (SELECT tbl, string_agg(name || ':' || type, ',' ORDER BY name) AS s FROM old GROUP BY tbl),
    c AS (SELECT tbl, string_agg(name || ':' || type, ',' ORDER BY name) AS s FROM cur GROUP BY tbl),
    w AS (SELECT unnest({WANTED}) AS tbl),
    p AS (SELECT w.tbl, l.s IS NOT NULL AS landing_exists, c.s IS NOT NULL AS target_exists,
        c.s IS NOT NULL AND l.s IS DISTINCT FROM c.s AS mismatch,
        l.s IS NOT NULL AND l.s IS DISTINCT FROM o.s AS evolved
        FROM w LEFT JOIN l ON l.tbl = w.tbl LEFT JOIN o ON o.tbl = w.tbl LEFT JOIN c ON c.tbl = w.tbl),
    d AS (SELECT *, CASE WHEN NOT landing_exists THEN 'LANDING_MISSING'
            WHEN evolved AND target_exists THEN 'UPDATE_FDP' WHEN evolved THEN 'CREATE_FDP'
            WHEN NOT target_exists THEN 'CREATE_FDP' WHEN mismatch THEN 'SYNC_FDP_SCHEMA' ELSE 'NO_OP' END AS action,
        CASE WHEN landing_exists AND (evolved OR (target_exists AND mismatch)) THEN 'YES' ELSE 'NO' END AS schema_changed
        FROM p)
"""

ORACLE = {
    "schema_signature": f"""
        SELECT 'landing' AS db, tbl, string_agg(name || ':' || type, ',' ORDER BY name, type) AS signature
        FROM ({inventory_sql(TABLES)}) GROUP BY tbl
    """,
    "schema_diff_strict": f"""
        SELECT 'party' AS tbl, coalesce(l.name, r.name) AS name, l.type AS left_type, r.type AS right_type,
            CASE WHEN l.name IS NULL THEN 'ADDED' WHEN r.name IS NULL THEN 'REMOVED'
                WHEN l.type <> r.type THEN 'TYPE_CHANGED' ELSE 'SAME' END AS status
        FROM ({_LEFT}) l FULL JOIN ({_RIGHT}) r ON l.name = r.name
    """,
    "schema_diff_tolerant": f"""
        SELECT 'party' AS tbl, name FROM ({_LEFT}) l WHERE name NOT IN (SELECT name FROM ({_RIGHT}) r)
    """,
    "schema_evolution": f"{_WEEKLY} SELECT * FROM h",
    "schema_evolution_newest": f"{_WEEKLY} SELECT * FROM h ORDER BY version DESC LIMIT 1",
    "sync_decision": f"{_ZONES} SELECT * FROM d",
    "schema_report": f"""{_ZONES}, j AS (
        SELECT tbl, CAST(to_json(list(struct_pack("Name" := name, "Type" := type) ORDER BY pos)) AS VARCHAR) AS "Details" FROM inv GROUP BY tbl)
        SELECT d.tbl AS "Table", 'landing' AS "Database", schema_changed AS "SchemaChanged",
            '20250102_030405Z' AS "Timestamp", "Details"
        FROM d JOIN j ON d.tbl = j.tbl WHERE action <> 'LANDING_MISSING'
    """,
    "audit_step_rows": f"""{_ZONES},
        a AS (SELECT tbl, target_exists, CASE WHEN NOT landing_exists THEN 'GONE' WHEN NOT target_exists THEN 'CREATE'
            WHEN mismatch THEN 'UPDATE' ELSE 'SAME' END AS what FROM p),
        s AS (
            SELECT tbl, 1 AS seq, 'PROCESS_START' AS step, 'STARTED' AS status, '' AS message, '{{}}' AS meta FROM a
            UNION ALL SELECT tbl, 2, 'PROCESS', 'FAILED', 'Landing table landing.' || tbl || ' not found', '{{}}' FROM a WHERE what = 'GONE'
            UNION ALL SELECT tbl, 2, 'FDP_CHECK', 'STARTED', '', '{{"fdp_exists":' || target_exists || '}}' FROM a WHERE what <> 'GONE'
            UNION ALL SELECT tbl, 3, 'FDP_CREATE', 'COMPLETED', 'Created FDP table',
                '{{"fdp_location":"zone/curated/' || tbl || '/"}}' FROM a WHERE what = 'CREATE'
            UNION ALL SELECT tbl, 3, 'SCHEMA_UPDATE', 'COMPLETED', 'Updated FDP schema from landing', '{{}}' FROM a WHERE what = 'UPDATE'
            UNION ALL SELECT tbl, 3, 'SCHEMA_COMPARE', 'COMPLETED', 'No schema change', '{{}}' FROM a WHERE what = 'SAME'
            UNION ALL SELECT tbl, 4, 'ICEBERG_CREATE', 'STARTED', '', '{{}}' FROM a WHERE what <> 'GONE'
            UNION ALL SELECT tbl, 5, 'ICEBERG_CREATE', 'COMPLETED', 'Iceberg table created/updated', '{{}}' FROM a WHERE what <> 'GONE'
            UNION ALL SELECT tbl, 6, 'PROCESS_END', 'COMPLETED', '', '{{}}' FROM a WHERE what <> 'GONE')
        SELECT 'run-1' AS process_id, tbl AS "table", step, status, message, '2025-01-02T03:04:05+00:00' AS "timestamp", meta, seq FROM s
    """,
    "versioned_target": f"""{_ZONES}
        SELECT tbl, CASE WHEN EXISTS (SELECT 1 FROM inv i WHERE i.tbl = l.tbl
                AND NOT EXISTS (SELECT 1 FROM cur k WHERE k.tbl = i.tbl AND k.name = i.name))
            THEN tbl || '__v20250102_030405' ELSE tbl END AS target FROM l
    """,
}
