"""Publish, copy and register single tables."""

from pyspark.sql import SparkSession, functions as F, types as T

from landfall.functions.names import catalog_name, join_location, table_name, unit_path
from landfall.operators.clean import drop_repeated_header, normalize_names
from landfall.operators.audit import guard_status
from landfall.operators.infer import ColumnSpec, infer_spark_types, opaque_schema
from landfall.operators.publish import append_table, copy_files, replace_table, write_catalog_files
from landfall.operators.tables import ensure_database, ensure_table, qualified, upsert_table
from landfall.sources.files import latest_file, list_keys
from landfall.sources.readers import read_csv, read_table


def publish_table(
    spark: SparkSession,
    source_db: str,
    source_table: str,
    target_db: str,
    target_table: str,
    location: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    catalog: str | None = None,
) -> tuple[str, int]:
    """Copy a catalog table under clean column names.

    ``overwrite`` creates or replaces the target, ``append`` adds to it. An
    empty source writes nothing and gives EMPTY.
    """
    df = read_table(spark, source_db, source_table)
    if guard_status(df) == "EMPTY":
        return "EMPTY", 0
    df = normalize_names(df)
    if mode == "append":
        return "SUCCEEDED", append_table(spark, df, target_db, target_table, location, fmt)
    if mode != "overwrite":
        raise ValueError(f"unknown mode {mode}")
    return "SUCCEEDED", replace_table(spark, df, target_db, target_table, location, fmt, catalog=catalog)


def copy_table(
    spark: SparkSession,
    source_db: str,
    source_table: str,
    target_db: str,
    target_table: str,
    location: str,
    mode: str = "append",
    first_column_only: bool = False,
) -> tuple[str, int]:
    """Copy a catalog table to CSV without repeated header rows and update the catalog."""
    df = read_table(spark, source_db, source_table)
    if guard_status(df) == "EMPTY":
        return "EMPTY", 0
    df = drop_repeated_header(df, first_column_only)
    return "SUCCEEDED", write_catalog_files(spark, df, target_db, target_table, location, "csv", mode)


def copy_latest(spark: SparkSession, source: str, target: str, db: str, prefix: str = "fdp_") -> tuple[str, int] | None:
    """Copy the CSV file with the greatest base name unchanged and register it.

    The table has one column of whole lines. None if there is no CSV file.
    """
    unit = unit_path(F.col("path"))
    units = list_keys(spark, source).select(unit.alias("path"))
    row = latest_file(units).select("path", "file_name", table_name(F.col("path"), prefix=prefix).alias("t")).first()
    if row["path"] is None:
        return None
    table, place = catalog_name(row["t"]), join_location(target, row["file_name"])
    ensure_database(spark, db)
    rows = copy_files(spark, row["path"], place, "text")
    ensure_table(spark, db, table, place, opaque_schema(), "text")
    spark.catalog.refreshTable(qualified(db, table))
    return table, rows


def register_path(
    spark: SparkSession, path: str, db: str, table: str, legacy: bool = False
) -> tuple[str, list[ColumnSpec]]:
    """Register or update a CSV table with the schema Spark infers from its files.

    A file path registers its folder restricted to that file.
    """
    df = read_csv(spark, path, infer=True)
    columns = infer_spark_types(df, legacy)
    fields = [f.dataType if c.type != "string" else T.StringType() for f, c in zip(df.schema, columns, strict=True)]
    schema = T.StructType([T.StructField(c.name, t) for c, t in zip(columns, fields, strict=True)])
    folder, _, name = path.rpartition("/")
    is_file = bool(name) and not list_keys(spark, path, suffix=f"/{name}").isEmpty()
    ensure_database(spark, db)
    options = {"pathGlobFilter": name} if is_file else {}
    location = join_location(folder) + "/" if is_file else path
    state = upsert_table(spark, db, table, location, schema, "csv", classification="csv", **options)
    return state, columns
