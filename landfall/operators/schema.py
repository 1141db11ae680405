"""Schemas as data: inventory, comparison, drift, decision and report.

An inventory has one row per column: ``db, tbl, version, pos, name, type``.
All operators work on many tables in one plan.
"""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from landfall.functions.names import failure_text, version_suffix
from landfall.operators.clean import INGEST_COLUMNS
from landfall.operators.tables import list_tables

INVENTORY = "db string, tbl string, version bigint, pos int, name string, type string"

# Column statuses, actions and flags as reports show them.
SAME, ADDED, REMOVED, TYPE_CHANGED = "SAME", "ADDED", "REMOVED", "TYPE_CHANGED"
UPDATE, CREATE, SYNC, NO_OP = "UPDATE_FDP", "CREATE_FDP", "SYNC_FDP_SCHEMA", "NO_OP"
MISSING = "LANDING_MISSING"
UNREADABLE = "UNREADABLE"


def tidy(value: str) -> Column:
    """Names and types compare trimmed and lower-cased, null as empty."""
    return F.lower(F.trim(F.coalesce(F.col(value), F.lit(""))))


def read_inventory(
    spark: SparkSession, db: str, prefix: str = "", version: int = 1, workers: int = 4
) -> tuple[DataFrame, dict[str, str]]:
    """Columns of every table of a database whose name starts with ``prefix``, with their exact types.

    Tables that cannot be read are left out and returned with the reason.
    """

    def one(table: str) -> tuple[str, list[tuple], str | None]:
        try:
            fields = spark.table(f"`{db}`.`{table}`").schema
        except Exception as error:  # one bad entry must not hide the others
            return table, [], failure_text(error)
        return table, [(db, table, version, i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(fields)], None

    with ThreadPoolExecutor(max_workers=workers) as pool:
        found = list(pool.map(one, list_tables(spark, db, prefix)))
    rows = [row for _, columns, _ in found for row in columns]
    return spark.createDataFrame(rows, INVENTORY), {t: reason for t, _, reason in found if reason is not None}


def catalog_inventory(spark: SparkSession, db: str, prefix: str = "", version: int = 1) -> DataFrame:
    """The readable part of ``read_inventory``."""
    return read_inventory(spark, db, prefix, version)[0]


def as_inventory(columns: DataFrame, db: str, tbl: str | Column | None = None, version: int | Column = 1) -> DataFrame:
    """Inventory of inferred columns; ``tbl`` defaults to their own tbl column."""
    table = F.col("tbl") if tbl is None else F.lit(tbl) if isinstance(tbl, str) else tbl
    number = F.lit(version) if isinstance(version, int) else version
    return columns.select(
        F.lit(db).alias("db"), table.alias("tbl"), number.cast("bigint").alias("version"), "pos", "name", "type"
    )


def without_columns(inventory: DataFrame, names: list[str] = INGEST_COLUMNS) -> DataFrame:
    return inventory.filter(~tidy("name").isin([n.lower() for n in names]))


def signatures(inventory: DataFrame, *by: str) -> DataFrame:
    """One sorted, tidied column list per table; equal lists mean equal schemas."""
    keys = by or ("db", "tbl", "version")
    column = F.struct(tidy("name").alias("name"), tidy("type").alias("type"))
    return inventory.groupBy(*keys).agg(F.sort_array(F.collect_list(column)).alias("signature"))


def diff(left: DataFrame, right: DataFrame, ignore: list[str] | None = None) -> DataFrame:
    """Column-level difference from ``left`` to ``right`` per table.

    ADDED exists only in ``right``, REMOVED only in ``left``. ``ignore`` leaves
    out columns, such as the ingest columns of curated tables.
    """

    def side(inventory: DataFrame, type_name: str) -> DataFrame:
        if ignore:
            inventory = without_columns(inventory, ignore)
        return inventory.select("tbl", tidy("name").alias("name"), tidy("type").alias(type_name))

    both = side(left, "left_type").join(side(right, "right_type"), ["tbl", "name"], "full_outer")
    status = (
        F.when(F.col("left_type").isNull(), ADDED)
        .when(F.col("right_type").isNull(), REMOVED)
        .when(F.col("left_type") != F.col("right_type"), TYPE_CHANGED)
        .otherwise(SAME)
    )
    return both.select("tbl", "name", "left_type", "right_type", status.alias("status"))


def missing_columns(incoming: DataFrame, target: DataFrame) -> DataFrame:
    """Tolerant comparison: incoming columns the target lacks; types and extras do not count."""
    have = target.select("tbl", tidy("name").alias("name"))
    return incoming.select("tbl", tidy("name").alias("name")).join(have, ["tbl", "name"], "left_anti")


def tolerant_match(incoming: DataFrame, target: DataFrame) -> DataFrame:
    """Per table: does every incoming column exist in the target?"""
    missing = missing_columns(incoming, target).groupBy("tbl").agg(F.count("*").alias("missing"))
    tables = incoming.groupBy("tbl").agg(F.count("*").alias("columns"))
    count = F.coalesce("missing", F.lit(0)).alias("missing")
    return tables.join(missing, "tbl", "left").select("tbl", count, (count == 0).alias("matches"))


def evolution(inventory: DataFrame) -> DataFrame:
    """Each version against the one before; a first version counts as evolved."""
    history = Window.partitionBy("db", "tbl").orderBy("version")
    previous = F.lag("signature").over(history)
    return signatures(inventory).select(
        "db", "tbl", "version", (~F.col("signature").eqNullSafe(previous)).alias("evolved")
    )


def current_evolution(inventory: DataFrame) -> DataFrame:
    """Evolution of the newest version of each table."""
    newest = inventory.groupBy("db", "tbl").agg(F.max("version").alias("version"))
    return evolution(inventory).join(newest, ["db", "tbl", "version"], "left_semi")


def compare_zones(
    landing: DataFrame, curated: DataFrame, tables: DataFrame | None = None, ignore: list[str] | None = None
) -> DataFrame:
    """Per table: is it in landing, is it curated, do the schemas differ?

    ``tables`` names wanted tables (``tbl``), so that one missing from landing
    still shows up.
    """
    if ignore:
        curated = without_columns(curated, ignore)
    left = signatures(landing, "tbl").withColumnRenamed("signature", "landing")
    right = signatures(curated, "tbl").withColumnRenamed("signature", "curated")
    pairs = left.join(right, "tbl", "left")
    if tables is not None:
        pairs = tables.select("tbl").distinct().join(left, "tbl", "left").join(right, "tbl", "left")
    exists = F.col("curated").isNotNull()
    return pairs.select(
        "tbl",
        F.col("landing").isNotNull().alias("landing_exists"),
        exists.alias("target_exists"),
        (exists & ~F.col("landing").eqNullSafe(F.col("curated"))).alias("mismatch"),
    )


def decide(pairs: DataFrame) -> DataFrame:
    """Sync action and change flag from landing_exists, evolved, target_exists, mismatch."""
    action = (
        F.when(~F.col("landing_exists"), MISSING)
        .when(~F.col("target_exists"), CREATE)
        .when(F.col("evolved"), UPDATE)
        .when(F.col("mismatch"), SYNC)
        .otherwise(NO_OP)
    )
    changed = F.col("landing_exists") & (F.col("evolved") | (F.col("target_exists") & F.col("mismatch")))
    return pairs.select("*", action.alias("action"), F.when(changed, "YES").otherwise("NO").alias("schema_changed"))


def compact_ts(run_ts: dt.datetime) -> str:
    return run_ts.strftime("%Y%m%d_%H%M%SZ")


def report(decisions: DataFrame, landing: DataFrame, db: str, run_ts: dt.datetime) -> DataFrame:
    """Report rows: Table, Database, SchemaChanged, Timestamp, Details (JSON column list)."""
    column = F.struct("pos", F.col("name").alias("Name"), F.col("type").alias("Type"))
    listed = F.transform(
        F.sort_array(F.collect_list(column)), lambda c: F.struct(c["Name"].alias("Name"), c["Type"].alias("Type"))
    )
    details = landing.groupBy("tbl").agg(F.to_json(listed).alias("Details"))
    return (
        decisions.filter(~F.col("action").isin(MISSING, UNREADABLE))
        .join(details, "tbl")
        .select(
            F.col("tbl").alias("Table"),
            F.lit(db).alias("Database"),
            F.col("schema_changed").alias("SchemaChanged"),
            F.lit(compact_ts(run_ts)).alias("Timestamp"),
            "Details",
        )
    )


def versioned_targets(matches: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Target name per table: its own where the schema fits, else a versioned one."""
    name = F.concat("tbl", F.lit(version_suffix(run_ts)))
    return matches.select("tbl", F.when(F.col("matches"), F.col("tbl")).otherwise(name).alias("target"))
