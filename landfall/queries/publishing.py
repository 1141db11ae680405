"""Queries over sinks and catalog tables, judged by reading the result back."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.operators.audit import guard_status, row_counts
from landfall.operators.publish import (
    READ_BACK, append_table, copy_files, replace_table, write_catalog_files, write_files,
)
from landfall.operators.tables import (
    FORMAT_PROPERTY, ensure_table, list_tables, lookup, mark_table_format, set_location, table_properties, upsert_table,
)
from landfall.plans.publish import copy_latest, copy_table, publish_table, register_path
from landfall.queries.cleaning import CAST_CUSTOMER
from landfall.queries.common import TABLES, as_text, land, load, load_all, new_db
from landfall.sources.readers import read_csv, read_json, read_landing, read_table, read_xml
from landfall.workspace import fresh_folder


def publish_overwrite(spark, sf):
    """K1/K9: a second write replaces the first."""
    df = load(spark, sf, "part")
    path = fresh_folder(spark, "part")
    write_files(df, path)
    write_files(df, path)
    return read_csv(spark, path, schema=df.schema)


def publish_append(spark, sf):
    """K9: a second write adds to the first."""
    df = load(spark, sf, "part")
    path = fresh_folder(spark, "part")
    write_files(df, path, mode="append")
    write_files(df, path, mode="append")
    return read_csv(spark, path, schema=df.schema)


def publish_few_files(spark, sf):
    """K2: few files for few rows; the row count of the write is part of the result."""
    df = load(spark, sf, "customer")
    path = fresh_folder(spark, "customer")
    written = write_files(df, path, max_files=1)
    return read_csv(spark, path, schema=df.schema).withColumn("written", F.lit(written).cast("bigint"))


def publish_balanced_files(spark, sf):
    """K2: files by size, from tasks of which one holds most rows; quoted values span lines."""
    df = load(spark, sf, "documents")
    skewed = df.repartition(8, F.when(F.col("doc_id") % 10 > 0, 0).otherwise(F.col("doc_id")))
    path = fresh_folder(spark, "documents")
    written = write_files(skewed, path, balanced=True)
    return read_csv(spark, path, schema=df.schema, **READ_BACK["csv"]).withColumn("written", F.lit(written).cast("bigint"))


def publish_formats(spark, sf):
    """K9: the same rows through every target format."""
    df = load(spark, sf, "nation")
    result = None
    for fmt in ("csv", "tsv", "json", "xml", "parquet"):
        path = fresh_folder(spark, "nation")
        write_files(df, path, fmt)
        back = spark.read.parquet(path) if fmt == "parquet" else read_landing(spark, path, fmt, schema=df.schema)
        back = back.select(F.lit(fmt).alias("fmt"), "*")
        result = back if result is None else result.unionByName(back)
    return result


def publish_replace_table(spark, sf):
    """K4: a table replaced by one of another shape, built from itself."""
    db, place = new_db(spark, "replace"), fresh_folder(spark, "supplier")
    replace_table(spark, load(spark, sf, "supplier"), db, "supplier", place)
    again = read_table(spark, db, "supplier").withColumn("s_acctbal", F.col("s_acctbal") * 2).drop("s_name")
    replace_table(spark, again, db, "supplier", place)
    return read_table(spark, db, "supplier")


def publish_append_table(spark, sf):
    """K9: rows appended to a table by column name."""
    db, place = new_db(spark, "append"), fresh_folder(spark, "supplier")
    df = load(spark, sf, "supplier")
    append_table(spark, df, db, "supplier", place)
    append_table(spark, df.select(*reversed(df.columns)), db, "supplier", place)
    return read_table(spark, db, "supplier")


def publish_table_clean_names(spark, sf):
    """A landing table published under clean column names."""
    db = new_db(spark, "publish")
    df = load(spark, sf, "customer").toDF("Cust Key", " c_name", "c_nationkey", "C_AcctBal ", "Mkt Segment")
    ensure_table(spark, db, "landing", land(spark, df, "customer.csv"), df.schema)
    publish_table(spark, db, "landing", db, "curated", fresh_folder(spark, "customer"))
    return read_table(spark, db, "curated")


def publish_catalog_files(spark, sf):
    """K5: files written and the table over them created, then updated."""
    db, place = new_db(spark, "catalogfiles"), fresh_folder(spark, "orders")
    df = load(spark, sf, "orders")
    write_catalog_files(spark, df, db, "orders", place, mode="overwrite")
    write_catalog_files(spark, df.withColumn("is_open", F.col("o_orderstatus") == "O"), db, "orders", place, mode="overwrite")
    return read_table(spark, db, "orders")


def append_by_name(spark, sf):
    """K5/K9: rows appended to catalog files in another column order."""
    db, place = new_db(spark, "byname"), fresh_folder(spark, "supplier")
    df = load(spark, sf, "supplier")
    write_catalog_files(spark, df, db, "supplier", place)
    write_catalog_files(spark, df.select(*reversed(df.columns)), db, "supplier", place)
    return read_table(spark, db, "supplier")


def copy_files_unchanged(spark, sf):
    """K6: files published again as they came."""
    path = land(spark, load(spark, sf, "nation"), "nation.csv")
    target = fresh_folder(spark, "nation")
    copy_files(spark, path, target, "csv")
    return read_csv(spark, target)


def convert_json_to_csv(spark, sf):
    """JSON to CSV in key order."""
    df = load(spark, sf, "part")
    json_path, csv_path = land(spark, df, "part.json"), fresh_folder(spark, "part")
    write_files(read_json(spark, json_path).select(*df.columns), csv_path)
    return read_csv(spark, csv_path, schema=df.schema)


def convert_xml_to_csv(spark, sf):
    """XML to CSV in tag order."""
    df = load(spark, sf, "supplier")
    xml_path, csv_path = land(spark, df, "supplier.xml", rootTag="all", rowTag="supplier"), fresh_folder(spark, "supplier")
    write_files(read_xml(spark, xml_path, schema=df.schema), csv_path)
    return read_csv(spark, csv_path, schema=df.schema)


def copy_table_clean(spark, sf):
    """A landing table with repeated header rows copied without them."""
    db = new_db(spark, "copy")
    df = as_text(load(spark, sf, "customer"))
    dirty = df.unionByName(df.select(*[F.lit(c).alias(c) for c in df.columns]))
    ensure_table(spark, db, "landing", land(spark, dirty, "customer.csv"), df.schema)
    copy_table(spark, db, "landing", db, "curated", fresh_folder(spark, "customer"))
    return read_table(spark, db, "curated")


def copy_latest_file(spark, sf):
    """Of several deliveries the last by name, copied and registered line by line."""
    db, zone = new_db(spark, "latest"), fresh_folder(spark, "zone")
    for name in ("customer", "orders", "part"):
        land(spark, load(spark, sf, name), f"{name}.csv", zone)
    table, _ = copy_latest(spark, zone, fresh_folder(spark, "curated"), db)
    header = ",".join(TABLES["part"])
    copied = read_table(spark, db, table).filter(F.col("data") != header)
    return copied.select(F.lit(table).alias("tbl"), "data")


def register_path_table(spark, sf):
    """A path registered with the schema Spark infers."""
    db = new_db(spark, "register")
    register_path(spark, land(spark, load(spark, sf, "supplier"), "supplier.csv"), db, "supplier")
    return read_table(spark, db, "supplier")


def ensure_table_once(spark, sf):
    """The first registration stands."""
    db = new_db(spark, "ensure")
    df = load(spark, sf, "nation")
    path = land(spark, df, "nation.csv")
    ensure_table(spark, db, "nation", path, df.schema)
    ensure_table(spark, db, "nation", path, T.StructType([T.StructField("other", T.StringType())]))
    return lookup(spark, db, "nation")


def upsert_table_schema(spark, sf):
    """A curated schema extended, then changed; the files stay."""
    db = new_db(spark, "upsert")
    df = load(spark, sf, "supplier")
    path = land(spark, df, "supplier.csv")
    upsert_table(spark, db, "supplier", path, df.schema)
    upsert_table(spark, db, "supplier", path, T.StructType([*df.schema, T.StructField("record_status", T.StringType())]))
    extended = read_table(spark, db, "supplier").agg(F.count("*").alias("n"), F.count("record_status").alias("stamped"))
    counts = [F.lit(v).cast("bigint") for v in extended.first()]
    changed = T.StructType([T.StructField(f.name, T.StringType() if f.name == "s_suppkey" else f.dataType) for f in df.schema])
    upsert_table(spark, db, "supplier", path, changed)
    return read_table(spark, db, "supplier").select(
        "*", counts[0].alias("rows_before"), counts[1].alias("stamped_before")
    )


def mark_table_format_kept(spark, sf):
    """Marking a table's format keeps its columns, rows and properties."""
    db = new_db(spark, "mark")
    df = load(spark, sf, "nation")
    path = land(spark, df, "nation.csv")
    ensure_table(spark, db, "nation", path, df.schema)
    mark_table_format(spark, db, "nation", path, properties={"owner_note": "zone"})
    properties = table_properties(spark, db, "nation")
    return read_table(spark, db, "nation").select(
        "*", F.lit(properties[FORMAT_PROPERTY]).alias("table_format"), F.lit(properties["owner_note"]).alias("owner_note")
    )


def repoint_table(spark, sf):
    """A table moved to other files."""
    db = new_db(spark, "repoint")
    df = load(spark, sf, "supplier")
    ensure_table(spark, db, "supplier", land(spark, df.withColumn("s_name", F.lit("old")), "supplier.csv"), df.schema)
    set_location(spark, db, "supplier", land(spark, df, "supplier.csv"))
    spark.catalog.refreshTable(f"`{db}`.`supplier`")
    return read_table(spark, db, "supplier")


def table_prefix_filter(spark, sf):
    """Tables by name prefix, with their row counts."""
    db = new_db(spark, "prefix")
    for name, df in load_all(spark, sf, TABLES).items():
        ensure_table(spark, db, name, f"{sf}/{name}.parquet", df.schema, "parquet")
    return row_counts({t: read_table(spark, db, t) for t in list_tables(spark, db, "p")}).drop("status")


def row_counts_guard(spark, sf):
    """A1/A2: row counts of all tables and of one without rows."""
    tables = load_all(spark, sf, TABLES)
    tables["no_rows"] = tables["orders"].filter("o_orderkey < 0")
    return row_counts(tables)


def empty_guard(spark, sf):
    """A2: an empty source is reported and nothing is written."""
    db = new_db(spark, "guard")
    df = load(spark, sf, "orders")
    result = []
    for name, part in (("all", df), ("none", df.filter("o_orderkey < 0"))):
        ensure_table(spark, db, name, land(spark, part, f"{name}.csv"), df.schema)
        status, rows = publish_table(spark, db, name, db, f"{name}_out", fresh_folder(spark, name))
        result.append((name, guard_status(part), status, rows, lookup(spark, db, f"{name}_out") is not None))
    return spark.createDataFrame(result, "tbl string, guard string, status string, row_count bigint, written boolean")


QUERIES = {
    f.__name__: f
    for f in (
        publish_overwrite, publish_append, publish_few_files, publish_balanced_files, publish_formats, publish_replace_table,
        publish_append_table, publish_table_clean_names, publish_catalog_files, append_by_name, copy_files_unchanged,
        convert_json_to_csv, convert_xml_to_csv, copy_table_clean, copy_latest_file, register_path_table, ensure_table_once,
        upsert_table_schema, mark_table_format_kept, repoint_table, table_prefix_filter, row_counts_guard, empty_guard,
    )
}

ORACLE = {
    "publish_overwrite": "SELECT * FROM part",
    "publish_append": "SELECT * FROM part UNION ALL SELECT * FROM part",
    "publish_few_files": "SELECT *, (SELECT count(*) FROM customer) AS written FROM customer",
    "publish_balanced_files": "SELECT *, (SELECT count(*) FROM documents) AS written FROM documents",
    "publish_formats": "SELECT fmt, nation.* FROM nation, unnest(['csv', 'tsv', 'json', 'xml', 'parquet']) AS f(fmt)",
    "publish_replace_table": "SELECT s_suppkey, s_nationkey, s_acctbal * 2 AS s_acctbal FROM supplier",
    "publish_append_table": "SELECT * FROM supplier UNION ALL SELECT * FROM supplier",
    "publish_table_clean_names": """
        SELECT c_custkey AS cust_key, c_name, c_nationkey, c_acctbal, c_mktsegment AS mkt_segment FROM customer
    """,
    "publish_catalog_files": """
        SELECT *, o_orderstatus = 'O' AS is_open FROM orders
    """,
    "append_by_name": "SELECT * FROM supplier UNION ALL SELECT * FROM supplier",
    "copy_files_unchanged": """
        SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey FROM nation
    """,
    "convert_json_to_csv": "SELECT * FROM part",
    "convert_xml_to_csv": "SELECT * FROM supplier",
    "copy_table_clean": f"SELECT {CAST_CUSTOMER} FROM customer",
    "copy_latest_file": """
        SELECT 'fdp_part' AS tbl, concat_ws(',', p_partkey, p_name, p_brand, p_type, p_size, p_retailprice) AS data FROM part
    """,
    "register_path_table": "SELECT * REPLACE (CAST(s_suppkey AS INTEGER) AS s_suppkey) FROM supplier",
    "ensure_table_once": "SELECT * FROM nation",
    "upsert_table_schema": """
        SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, s_nationkey, s_acctbal,
            (SELECT count(*) FROM supplier) AS rows_before, CAST(0 AS BIGINT) AS stamped_before FROM supplier
    """,
    "mark_table_format_kept": "SELECT *, 'iceberg' AS table_format, 'zone' AS owner_note FROM nation",
    "repoint_table": "SELECT * FROM supplier",
    "table_prefix_filter": " UNION ALL ".join(
        f"SELECT '{t}' AS tbl, count(*) AS row_count FROM {t}" for t in TABLES if t.startswith("p")
    ),
    "row_counts_guard": " UNION ALL ".join(
        f"SELECT '{n}' AS tbl, count(*) AS row_count, CASE WHEN count(*) = 0 THEN 'EMPTY' ELSE 'READY' END AS status FROM {r}"
        for n, r in [*[(t, t) for t in TABLES], ("no_rows", "orders WHERE o_orderkey < 0")]
    ),
    "empty_guard": """
        SELECT 'all' AS tbl, 'READY' AS guard, 'SUCCEEDED' AS status, count(*) AS row_count, TRUE AS written FROM orders
        UNION ALL SELECT 'none', 'EMPTY', 'EMPTY', 0, FALSE
    """,
}
