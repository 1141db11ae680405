"""Sinks: files and tables. Row counts come from the write itself."""

import re
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from landfall.functions.names import join_location
from landfall.operators.tables import ensure_database, qualified, table_exists, table_source, upsert_table
from landfall.sources.readers import infer_xml_columns, read_landing, read_xml
from landfall.sources.records import xml_tags
from landfall.sources.xml_records import cut_xml

# One timestamp form that keeps microseconds through text.
TIMESTAMPS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
# Values keep their blanks, quotes and line breaks through a delimited file ...
EXACT = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
WRITE_OPTIONS = {
    "csv": {"header": True, **EXACT, **TIMESTAMPS},
    "tsv": {"header": True, "sep": "\t", **EXACT, **TIMESTAMPS},
    "json": {"ignoreNullFields": False, **TIMESTAMPS},
    "xml": {"rootTag": "records", "rowTag": "record", **TIMESTAMPS},
}

# ... if it is read with these. A quoted value may span lines, so a file is one task;
# the writers are parallel and keep files small.
# Null is a bare empty field and an empty text a quoted one; a null mark that no text equals keeps them apart.
READ_BACK = {"csv": {"header": "true", "escape": '"', "multiLine": "true", "nullValue": "\uffff"}}
READ_BACK["tsv"] = {"sep": "\t", **READ_BACK["csv"]}

# Names the folders of runs; readers of the table do not see it.
RUN_FOLDER = "run_folder"


def _observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation(f"rows-{uuid.uuid4().hex}")
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_files(
    df: DataFrame,
    path: str,
    fmt: str = "csv",
    mode: str = "overwrite",
    max_files: int | None = None,
    partition_by: list[str] | None = None,
    max_records_per_file: int | None = None,
    balanced: bool = False,
    **options,
) -> int:
    """Write files in csv, tsv, json, text, xml or parquet and return the row count.

    Writers stay parallel unless ``max_files`` asks for that many tasks at the
    end; what comes before them stays parallel. ``max_records_per_file`` makes
    a task start another file after so many rows. ``balanced`` deals the rows
    out so that each file gets about spark.sql.adaptive.advisoryPartitionSizeInBytes
    of them, as measured in the shuffle: small tasks share a file, large ones
    become several, and the number of files follows the data.
    """
    if balanced and max_files is not None:
        raise ValueError("files are either balanced by size or so many at most")
    if balanced:
        df = df.hint("rebalance")
    if max_files is not None:
        df = df.repartition(max_files)
    if max_records_per_file is not None:
        options = {**options, "maxRecordsPerFile": max_records_per_file}
    df, seen = _observed(df)
    source = "csv" if fmt == "tsv" else fmt
    settings = {**WRITE_OPTIONS.get(fmt, {}), **options}
    writer = df.write.mode(mode).format(source).options(**settings)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)
    return seen.get["rows"]


def replace_table(
    spark: SparkSession,
    df: DataFrame,
    db: str,
    table: str,
    location: str,
    fmt: str = "parquet",
    run_id: str | None = None,
    catalog: str | None = None,
) -> int:
    """Create or replace a table.

    Data goes to a new folder below ``location`` and the catalog entry moves
    there once the write is complete, so readers never see half a table and a
    table may be rebuilt from itself. With a configured v2 ``catalog`` the
    catalog's own create-or-replace is used.
    """
    if catalog:
        df, seen = _observed(df)
        writer = df.writeTo(f"`{catalog}`.{qualified(db, table)}").tableProperty("format-version", "2")
        writer.tableProperty("write.format.default", "parquet").createOrReplace()
        return seen.get["rows"]
    ensure_database(spark, db)
    folder = join_location(location, run_id or uuid.uuid4().hex)
    rows = write_files(df, folder, fmt)
    upsert_table(spark, db, table, folder, df.schema, fmt)
    spark.catalog.refreshTable(qualified(db, table))
    return rows


def append_table(spark: SparkSession, df: DataFrame, db: str, table: str, location: str, fmt: str = "parquet") -> int:
    """Append by column name, creating the table if missing."""
    if not table_exists(spark, db, table):
        return replace_table(spark, df, db, table, location, fmt)
    columns = spark.table(qualified(db, table)).columns
    df, seen = _observed(df.select(*[f"`{c}`" for c in columns]))
    df.write.insertInto(qualified(db, table))
    return seen.get["rows"]


def put_runs(spark: SparkSession, df: DataFrame, db: str, table: str, location: str, run_column: str) -> int:
    """Add the rows of runs to a table; what an earlier try of the same runs left gives way to them.

    Every run (a value of ``run_column``) has a folder below the table's location
    that is replaced as a whole, other runs stay. The run stays a column of the
    files, so the table keeps its columns and their order. Rows of a table made
    by plain appends stay too.
    """
    ensure_database(spark, db)
    if table_exists(spark, db, table):
        df = df.select(*[f"`{c}`" for c in spark.table(qualified(db, table)).columns])
        source, location = table_source(spark, db, table)
        if source != "parquet":
            raise ValueError(f"{db}.{table} holds {source}, runs are kept in parquet")
    runs = df.withColumn(RUN_FOLDER, F.col(run_column))
    rows = write_files(runs, location, "parquet", partition_by=[RUN_FOLDER], partitionOverwriteMode="dynamic")
    upsert_table(spark, db, table, location, df.schema, "parquet", recursiveFileLookup="true")
    spark.catalog.refreshTable(qualified(db, table))
    return rows


def write_catalog_files(
    spark: SparkSession, df: DataFrame, db: str, table: str, location: str, fmt: str = "csv", mode: str = "append"
) -> int:
    """Write files and create or update the catalog table over them.

    Columns are matched by name: an append takes the order of the table and is
    refused if the columns are not the same. An overwrite goes to a folder of
    its own, to which the table moves once it is complete.
    """
    ensure_database(spark, db)
    if mode == "append" and table_exists(spark, db, table):
        have = spark.table(qualified(db, table)).columns
        if sorted(c.lower() for c in have) != sorted(c.lower() for c in df.columns):
            raise ValueError(f"{db}.{table} has columns {have}, not {df.columns}")
        df = df.select(*[f"`{c}`" for c in have])
        location = table_source(spark, db, table)[1]
    elif mode == "overwrite":
        location = join_location(location, f"run-{uuid.uuid4().hex}")
    rows = write_files(df, location, fmt, mode)
    upsert_table(spark, db, table, location, df.schema, "csv" if fmt == "tsv" else fmt, **READ_BACK.get(fmt, {}))
    spark.catalog.refreshTable(qualified(db, table))
    return rows


def copy_files(spark: SparkSession, source: str, target: str, fmt: str, **options) -> int:
    """Publish files again in the format they came in, values unchanged.

    JSON comes out as lines and XML under its own root and record tags.
    """
    if fmt != "xml":
        exact = {k: v for k, v in READ_BACK.get(fmt, {}).items() if k not in ("header", "sep")}
        return write_files(read_landing(spark, source, fmt, **{**exact, **options}), target, fmt)
    root, tag = xml_tags(spark, source, **options)
    if tag is None:
        raise ValueError("XML has no records.")
    records = cut_xml(spark, source, tag, **options)
    shape = infer_xml_columns(spark, source, tag, records, **options)
    df = read_xml(spark, source, tag, shape, split=None if records is not None else False, records=records, **options)
    return write_files(df, target, fmt, rootTag=root, rowTag=tag)


def unused_folders(spark: SparkSession, db: str, table: str, location: str) -> list[str]:
    """Run folders below ``location`` that hold files but are not where the table lies; for a clean-up by the caller."""
    live = table_source(spark, db, table)[1].rstrip("/")
    base = location.rstrip("/") + "/"
    paths = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(location).select("path")
    below = F.regexp_extract(F.regexp_replace("path", "^file:/+", "/"), "^" + re.escape(re.sub("^file:/+", "/", base)) + "([^/]+)/", 1)
    runs = paths.select(below.alias("run")).filter("run != ''").distinct().orderBy("run").collect()
    return [join_location(location, r["run"]) for r in runs if not live.endswith("/" + r["run"])]
