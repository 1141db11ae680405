"""Queries over cleaning: column names, repeated headers, ingest columns."""

from pyspark.sql import functions as F

from landfall.operators.clean import (
    add_ingest_columns, drop_repeated_header, fill_blank_names, normalize_names,
)
from landfall.operators.infer import collect_columns, infer_table, storage_values
from landfall.queries.common import RUN_TS, TABLES, as_text, land, load
from landfall.sources.readers import read_csv, read_text

CAST_CUSTOMER = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in TABLES["customer"])


def normalize_column_names(spark, sf):
    """P1."""
    df = load(spark, sf, "customer")
    return normalize_names(df.toDF(" C_CustKey", "C Name ", "C Nation Key", "c_acctbal", "Market Segment "))


def rename_text_column(spark, sf):
    """The text column is called line."""
    urls = load(spark, sf, "pages").select("url")
    return read_text(spark, land(spark, urls, "urls.txt"))


def blank_header_names(spark, sf):
    """Blank header cells are numbered from one."""
    df = load(spark, sf, "nation").toDF("n_nationkey", "", "")
    return fill_blank_names(read_csv(spark, land(spark, df, "nation.csv")))


def _with_headers(spark, sf, name):
    """A table as text with one repeated header row per row of a small column set."""
    df = as_text(load(spark, sf, name))
    header = df.select(*[F.lit(c).alias(c) for c in df.columns])
    return df.unionByName(header)


def drop_repeated_header_rows(spark, sf):
    """Rows equal to the header go, wherever they are."""
    return drop_repeated_header(_with_headers(spark, sf, "customer"))


def drop_repeated_header_keeps_nulls(spark, sf):
    """The first-column form keeps rows whose first column is null."""
    df = _with_headers(spark, sf, "supplier")
    key = F.when((F.col("s_nationkey") != "7") | (F.col("s_suppkey") == "s_suppkey"), F.col("s_suppkey"))
    return drop_repeated_header(df.withColumn("s_suppkey", key), first_column_only=True)


def add_ingest_columns_orders(spark, sf):
    """P9 with a given source name."""
    return add_ingest_columns(load(spark, sf, "orders"), RUN_TS, "nightly", source="orders.csv")


def add_ingest_columns_from_files(spark, sf):
    """The source file comes from the file each row was read from."""
    df = read_csv(spark, land(spark, load(spark, sf, "supplier"), "supplier.csv"), infer=True)
    stamped = add_ingest_columns(df, RUN_TS, "nightly")
    is_part = F.col("source_filename").rlike(r"^part-.*\.csv$")
    return stamped.withColumn("source_filename", F.when(is_part, F.lit("part file")).otherwise(F.col("source_filename")))


def parse_inferred_values(spark, sf):
    """T1 and storage types: numbers in many spellings become plain values; a null says nothing about its column."""
    quantity = F.col("l_quantity").cast("string")
    # A sign and an exponent for those without; a very large or small double is written with one.
    sign = F.when(quantity.startswith("-"), "").otherwise("+")
    exponent = F.when(quantity.rlike("[EIN]"), "").otherwise("e0")
    df = load(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.concat(F.lit(" "), "l_partkey", F.lit("\t")).alias("padded"),
        F.concat(sign, quantity, exponent).alias("signed"),
        F.when(F.col("l_returnflag") == "A", "-inf").otherwise(F.lit("1_0.5")).alias("spelled"),
    )
    columns = collect_columns(infer_table(df, empty_as="ignore"))
    return df.select(*storage_values(df, columns))


QUERIES = {
    f.__name__: f
    for f in (
        normalize_column_names, rename_text_column, blank_header_names, drop_repeated_header_rows,
        drop_repeated_header_keeps_nulls, add_ingest_columns_orders, add_ingest_columns_from_files, parse_inferred_values,
    )
}

_STAMPS = (
    "'2025-01-02T03:04:05' AS ingestion_timestamp, '{}' AS source_filename, 'nightly' AS job_name,"
    " 'ACTIVE' AS record_status"
)

ORACLE = {
    "normalize_column_names": """
        SELECT c_custkey, c_name, c_nationkey AS c_nation_key, c_acctbal, c_mktsegment AS market_segment FROM customer
    """,
    "rename_text_column": "SELECT url AS line FROM pages",
    "blank_header_names": """
        SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name AS col_2, CAST(n_regionkey AS VARCHAR) AS col_3 FROM nation
    """,
    "drop_repeated_header_rows": f"SELECT {CAST_CUSTOMER} FROM customer",
    "drop_repeated_header_keeps_nulls": """
        SELECT CASE WHEN s_nationkey <> 7 THEN CAST(s_suppkey AS VARCHAR) END AS s_suppkey, s_name,
            CAST(s_nationkey AS VARCHAR) AS s_nationkey, CAST(s_acctbal AS VARCHAR) AS s_acctbal FROM supplier
    """,
    "add_ingest_columns_orders": f"SELECT *, {_STAMPS.format('orders.csv')} FROM orders",
    "add_ingest_columns_from_files": f"""
        SELECT * REPLACE (CAST(s_suppkey AS INTEGER) AS s_suppkey), {_STAMPS.format('part file')} FROM supplier
    """,
    "parse_inferred_values": """
        SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey AS padded, l_quantity AS signed,
            CASE WHEN l_returnflag = 'A' THEN CAST('-Infinity' AS DOUBLE) ELSE 10.5 END AS spelled FROM lineitem
    """,
}
