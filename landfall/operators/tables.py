"""Catalog work: databases and external tables. All of it is metadata."""

from pyspark.sql import DataFrame, SparkSession, types as T

# Own property, since the catalog reserves its own format key.
FORMAT_PROPERTY = "sync.table_format"

# Read options are noted under this prefix, so that a replaced entry keeps them.
OPTION_PREFIX = "sync.option."


def _text(value: str) -> str:
    """A SQL string literal."""
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def qualified(db: str, table: str) -> str:
    return f"`{db}`.`{table}`"


def ensure_database(spark: SparkSession, db: str, location: str | None = None) -> None:
    where = f" LOCATION {_text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`{where}")


def list_tables(spark: SparkSession, db: str, prefix: str = "") -> list[str]:
    """Table names with a prefix; an empty prefix keeps all."""
    names = [t.name for t in spark.catalog.listTables(db) if not t.isTemporary]
    return sorted(n for n in names if n.startswith(prefix))


def lookup(spark: SparkSession, db: str, table: str) -> DataFrame | None:
    """The table, or None if there is none."""
    return spark.table(qualified(db, table)) if table_exists(spark, db, table) else None


def table_exists(spark: SparkSession, db: str, table: str) -> bool:
    return spark.catalog.tableExists(qualified(db, table))


def _create(spark, db, table, location, schema, source, options) -> None:
    defaults = {"header": "true"} if source == "csv" else {}
    spark.catalog.createTable(qualified(db, table), path=location, source=source, schema=schema, **{**defaults, **options})
    set_properties(spark, db, table, {OPTION_PREFIX + k: v for k, v in options.items()})


def ensure_table(
    spark: SparkSession, db: str, table: str, location: str, schema: T.StructType | None, source: str = "csv", **options
) -> bool:
    """Create an external table if missing; an existing one is left alone. True if created."""
    if table_exists(spark, db, table):
        return False
    _create(spark, db, table, location, schema, source, options)
    return True


def upsert_table(
    spark: SparkSession, db: str, table: str, location: str, schema: T.StructType, source: str = "csv", **options
) -> str:
    """Create the entry, or bring an existing one to this schema and location.

    Trailing additions are ALTERs; anything else replaces the external entry
    and keeps its properties and, for the same source, its read options. Files
    are never touched.
    """
    if ensure_table(spark, db, table, location, schema, source, **options):
        return "CREATED"
    old = spark.table(qualified(db, table)).schema
    kind, where = table_source(spark, db, table)
    noted = table_properties(spark, db, table)
    same_options = all(noted.get(OPTION_PREFIX + k) == str(v) for k, v in options.items())
    same_place = kind == source and same_location(where, location) and same_options
    if same_place and _types(old) == _types(schema):
        return "UNCHANGED"
    if same_place and _types(schema)[: len(old)] == _types(old):
        added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema[len(old):])
        spark.sql(f"ALTER TABLE {qualified(db, table)} ADD COLUMNS ({added})")
        return "EXTENDED"
    properties = {k: v for k, v in noted.items() if not k.startswith(OPTION_PREFIX)}
    if kind == source:
        old_options = {k.removeprefix(OPTION_PREFIX): v for k, v in noted.items() if k not in properties}
        options = {**old_options, **options}
    spark.sql(f"DROP TABLE {qualified(db, table)}")
    _create(spark, db, table, location, schema, source, options)
    set_properties(spark, db, table, properties)
    return "REPLACED"


def _types(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name.lower(), f.dataType.simpleString()) for f in schema]


def _details(spark: SparkSession, db: str, table: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {qualified(db, table)}").collect()
    return {r["col_name"]: r["data_type"] for r in rows}


def table_source(spark: SparkSession, db: str, table: str) -> tuple[str, str]:
    """Source format and location."""
    details = _details(spark, db, table)
    return details.get("Provider", "").lower(), details.get("Location", "")


def same_location(left: str, right: str) -> bool:
    return _plain(left) == _plain(right)


def _plain(location: str) -> str:
    if location.startswith("file:"):
        location = "/" + location[len("file:"):].lstrip("/")
    return location.rstrip("/")


def table_properties(spark: SparkSession, db: str, table: str) -> dict[str, str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {qualified(db, table)}").collect()
    return {r["key"]: r["value"] for r in rows if not r["key"].startswith(("transient_", "spark.sql."))}


def set_properties(spark: SparkSession, db: str, table: str, properties: dict[str, str]) -> None:
    """Add properties; those already there stay."""
    if properties:
        pairs = ", ".join(f"{_text(k)} = {_text(v)}" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {qualified(db, table)} SET TBLPROPERTIES ({pairs})")


def set_location(spark: SparkSession, db: str, table: str, location: str) -> None:
    spark.sql(f"ALTER TABLE {qualified(db, table)} SET LOCATION {_text(location)}")


def mark_table_format(
    spark: SparkSession,
    db: str,
    table: str,
    location: str,
    table_format: str = "iceberg",
    properties: dict[str, str] | None = None,
    source: str = "parquet",
    move: bool = False,
) -> bool:
    """Note a table format on an entry, adding to its properties. True if anything was to do.

    An entry stays where its data lies; ``move`` points it to ``location``. A
    missing entry is created over the files at the location, with their columns.
    """
    changed = ensure_table(spark, db, table, location, None, source)
    if move and not same_location(table_source(spark, db, table)[1], location):
        set_location(spark, db, table, location)
        changed = True
    wanted = {FORMAT_PROPERTY: table_format, **(properties or {})}
    have = table_properties(spark, db, table)
    if any(have.get(k) != str(v) for k, v in wanted.items()):
        set_properties(spark, db, table, wanted)
        changed = True
    return changed
