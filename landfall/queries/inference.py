"""Queries over type and schema inference."""

from pyspark.sql import functions as F

from landfall.functions.names import join_location
from landfall.functions.types import infer_type
from landfall.operators.infer import (
    infer_frame_types, infer_groups, infer_json, infer_many, infer_spark_types, infer_table,
)
from landfall.operators.ranks import infer_new_files
from landfall.operators.schema import as_inventory, tidy
from landfall.queries.common import (
    TABLES, as_text, inventory_sql, label_sql, land, land_in_order, land_json_arrays, load, load_all, rank_sql, types_sql,
)
from landfall.sources.files import list_files
from landfall.sources.heads import head_files
from landfall.sources.readers import header_schema, infer_xml, read_csv, read_text, read_tsv
from landfall.sources.records import json_records, xml_tags
from landfall.workspace import fresh_folder

TABULAR = ["customer", "orders", "events", "part", "lineitem"]
HEAD_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "late", "early"]
SMALL = ["region", "nation", "customer", "supplier", "part"]


def infer_types_tabular(spark, sf):
    """T1-T3 on tables as they are."""
    return infer_many(load_all(spark, sf, TABULAR)).drop("storage")


def infer_types_landed_csv(spark, sf):
    """T3 with type detection on landed CSV text."""
    paths = {t: land(spark, df, f"{t}.csv") for t, df in load_all(spark, sf, ["orders", "lineitem"]).items()}
    return infer_many({t: read_csv(spark, p) for t, p in paths.items()}).drop("storage")


def infer_types_compat_csv(spark, sf):
    """Files with a header are all strings unless detection is asked for."""
    df = load(spark, sf, "supplier")
    tables = {
        "csv": read_csv(spark, land(spark, df, "supplier.csv")),
        "tsv": read_tsv(spark, land(spark, df, "supplier.tsv")),
    }
    return infer_many(tables, detect_types=False).drop("storage")


def infer_types_sampled(spark, sf):
    """The first 49 rows by key."""
    return infer_table(load(spark, sf, "orders"), sample_rows=49, order_by=["o_orderkey"]).drop("storage")


def infer_types_head_bytes(spark, sf):
    """The first 20 KB of a file in whole lines; what comes after them says nothing."""
    df = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    last = df.agg(F.max("o_orderkey")).first()[0]
    key = F.col("o_orderkey").cast("string")
    rows = df.select(
        "*",
        F.when(F.col("o_orderkey") > last * 0.8, "late").otherwise(key).alias("late"),
        F.when(F.col("o_orderkey") % 50 == 7, "1.5").otherwise(key).alias("early"),
    )
    # One file in key order, as its head depends on the order.
    path = land_in_order(spark, rows, "orders.csv", "o_orderkey")
    heads = head_files(spark, path, kb=16, more_kb=4, whole_lines=True)
    return infer_table(read_csv(spark, heads, recursiveFileLookup="true")).drop("storage")


def infer_types_incremental(spark, sf):
    """T3 on deliveries that come one after the other: each run reads the new files only."""
    df = load(spark, sf, "orders").withColumn(
        "total_or_key", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_totalprice").cast("string")).otherwise(F.col("o_orderkey").cast("string"))
    ).withColumn("open_or_key", F.when(F.col("o_orderkey") % 3 == 1, F.col("o_orderstatus")).otherwise(F.col("o_custkey").cast("string")))
    zone, notes = fresh_folder(spark, "zone"), join_location(fresh_folder(spark, "notes"), "orders")
    for turn in (2, 0, 1):
        land(spark, df.filter(F.col("o_orderkey") % 3 == turn), f"orders-{turn}.csv", zone)
        files = list_files(spark, zone, ["csv"])
        types = infer_new_files(files, lambda paths: read_csv(spark, paths), notes)
    return types.drop("storage")


def infer_types_widened(spark, sf):
    """T3 with integer widths: keys scaled past 32 bits, 64 bits and 38 digits."""
    df = load(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("plain"),
        F.concat("o_orderkey", F.lit("0" * 10)).alias("past_int"),
        F.concat("o_orderkey", F.lit("0" * 20)).alias("past_bigint"),
        F.concat("o_orderkey", F.lit("0" * 40)).alias("past_decimal"),
    )
    return infer_table(df, widen=True).drop("storage")


def infer_types_empty_ignored(spark, sf):
    """T1 option: null and blank values do not make a column a string."""
    df = load(spark, sf, "lineitem").select(
        F.when(F.col("l_returnflag") == "N", " ").otherwise(F.col("l_orderkey").cast("string")).alias("blank_or_key"),
        F.when(F.col("l_returnflag") != "N", F.col("l_tax")).alias("null_or_tax"),
        "l_returnflag",
    )
    return infer_table(df, empty_as="ignore").drop("storage")


def infer_types_by_group(spark, sf):
    """Values of each event type merged on their own."""
    mixed = F.when(F.col("event_type") == "view", F.col("user_id").cast("string")).when(
        F.col("event_type") == "click", F.col("value").cast("string")
    ).otherwise(F.col("event_type"))
    df = load(spark, sf, "events").select("event_type", mixed.alias("mixed"), "user_id")
    return infer_groups(df, ["event_type"]).drop("storage")


def value_type_counts(spark, sf):
    """T1 per value: labels of every value of every column."""
    df = as_text(load(spark, sf, "lineitem"))
    pairs = F.stack(F.lit(len(df.columns)), *[x for c in df.columns for x in (F.lit(c), F.col(c))])
    values = df.select(pairs.alias("name", "value"))
    return values.groupBy("name", infer_type(F.col("value")).alias("type")).agg(F.count("*").alias("n"))


def infer_json_keys(spark, sf):
    """T5 on stored JSON objects."""
    return infer_json(load(spark, sf, "events").select(F.col("props").alias("value"))).drop("storage")


def infer_json_lines(spark, sf):
    """T5 on landed JSON lines with a null, a missing key, quoted digits and a nested object."""
    df = load(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_custkey").cast("string").alias("quoted"),
        "o_totalprice",
        F.struct("o_orderstatus").alias("nested"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderkey")).alias("with_null"),
    )
    path = land(spark, df, "orders.json")
    return infer_json(json_records(spark, path)).drop("storage")


def infer_json_missing_keys(spark, sf):
    """T5: a key that is missing, not null, in some objects keeps its type."""
    df = load(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", F.when(F.col("o_orderstatus") != "F", F.col("o_custkey")).alias("sometimes")
    )
    return infer_json(df.select(F.to_json(F.struct(*df.columns)).alias("value"))).drop("storage")


def infer_json_array(spark, sf):
    """T5 on JSON arrays, cut into objects in parallel."""
    path = land_json_arrays(spark, load(spark, sf, "customer"), "customer.json", "c_custkey")
    return infer_json(json_records(spark, path, recursiveFileLookup=True)).drop("storage")


def infer_xml_tags(spark, sf):
    """T6 on landed XML; the record tag comes from the file."""
    path = land(spark, load(spark, sf, "customer"), "customer.xml", rootTag="customers", rowTag="customer")
    return infer_xml(spark, path, xml_tags(spark, path)[1]).drop("storage")


def infer_text_column(spark, sf):
    """Any other file is one column of lines, counted here."""
    lines = load(spark, sf, "documents").select(F.explode(F.split("text", "\n")).alias("value"))
    df = read_text(spark, land(spark, lines, "documents.txt", lineSep="\n"), lineSep="\n")
    rows = df.agg(F.count("*").alias("line_count"))
    return rows.select(F.lit(df.columns[0]).alias("name"), F.lit(df.dtypes[0][1]).alias("type"), "line_count")


def spark_type_catalog_map(spark, sf):
    """Spark's own inference on CSV, by exact type and by the letters of its name."""
    tables = {t: read_csv(spark, land(spark, df, f"{t}.csv"), infer=True) for t, df in load_all(spark, sf, SMALL).items()}
    parts = []
    for t, df in tables.items():
        exact, legacy = infer_spark_types(df), infer_spark_types(df, legacy=True)
        counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
        rows = [
            F.struct(
                F.lit(t).alias("tbl"), F.lit(i + 1).alias("pos"), F.lit(c.name).alias("name"),
                F.lit(c.type).alias("type"), F.lit(old.type).alias("legacy_type"), F.col(c.name).alias("non_null"),
            )
            for i, (c, old) in enumerate(zip(exact, legacy, strict=True))
        ]
        parts.append(counts.select(F.inline(F.array(*rows))))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def frame_type_map(spark, sf):
    """The dataframe-dtype rule; an integer column with gaps is double."""
    df = load(spark, sf, "supplier").select(
        "*", F.when(F.col("s_acctbal") > 0, F.col("s_suppkey")).alias("gaps")
    )
    return infer_frame_types(read_csv(spark, land(spark, df, "supplier.csv"), infer=True)).drop("storage")


def header_only_schema(spark, sf):
    """Names from the header line, trimmed, blanks numbered, all strings."""
    df = load(spark, sf, "customer").toDF(" c_custkey ", "c_name", "c_nationkey", "", "c_mktsegment")
    path = land(spark, df, "customer.csv", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    schema = header_schema(spark, path)
    counts = read_csv(spark, path).toDF(*schema.names).agg(*[F.count(F.col(f"`{n}`")).alias(n) for n in schema.names])
    rows = [
        F.struct(
            F.lit(i + 1).alias("pos"), F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"),
            F.col(f"`{f.name}`").alias("non_null"),
        )
        for i, f in enumerate(schema)
    ]
    return counts.select(F.inline(F.array(*rows)))


def column_inventory(spark, sf):
    """The columns of every table, names and types tidied."""
    columns = infer_many(load_all(spark, sf, TABLES))
    tidied = [tidy(c).alias(c) for c in ("name", "type")]
    return as_inventory(columns, "landing").select("db", "tbl", "version", "pos", *tidied)


QUERIES = {
    f.__name__: f
    for f in (
        infer_types_tabular, infer_types_landed_csv, infer_types_compat_csv, infer_types_sampled, infer_types_head_bytes,
        infer_types_incremental, infer_types_widened,
        infer_types_empty_ignored, infer_types_by_group, value_type_counts, infer_json_keys, infer_json_lines,
        infer_json_missing_keys, infer_json_array, infer_xml_tags, infer_text_column, spark_type_catalog_map,
        frame_type_map, header_only_schema, column_inventory,
    )
}


def _untabled(sql: str) -> str:
    return f"SELECT pos, name, type FROM ({sql})"


def _wide(table: str, column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    digits = f"regexp_matches({text}, '^-?[0-9]+$')"
    whole = f"bool_and({digits} AND TRY_CAST({text} AS INTEGER) IS NOT NULL)"
    big = f"bool_and({digits} AND TRY_CAST({text} AS BIGINT) IS NOT NULL)"
    double = f"bool_and(TRY_CAST({text} AS DOUBLE) IS NOT NULL)"
    return (
        f"CASE WHEN {whole} THEN 'int' WHEN {big} THEN 'bigint' WHEN {double} THEN 'double' ELSE 'string' END,"
        f" CASE WHEN {whole} OR {big} THEN 'int' WHEN {double} THEN 'double' ELSE 'string' END,"
        f" count({column}) FROM {table}"
    )


_EMPTY = "CASE WHEN v IS NULL OR trim(v) = '' THEN NULL ELSE {} END"

ORACLE = {
    "infer_types_tabular": inventory_sql(TABULAR),
    "infer_types_landed_csv": inventory_sql(["orders", "lineitem"]),
    "infer_types_compat_csv": " UNION ALL ".join(
        f"SELECT DISTINCT '{fmt}' AS tbl, {i + 1} AS pos, '{c}' AS name, 'string' AS type FROM supplier"
        for fmt in ("csv", "tsv")
        for i, c in enumerate(TABLES["supplier"])
    ),
    "infer_types_sampled": _untabled(
        types_sql("orders", TABLES["orders"], relation="(SELECT * FROM orders ORDER BY o_orderkey LIMIT 49)")
    ),
    "infer_types_head_bytes": _untabled(
        types_sql("orders", HEAD_COLUMNS, relation=f"""(
            SELECT * FROM (
                SELECT *, sum(strlen(concat_ws(',', {', '.join(HEAD_COLUMNS)})) + 1) OVER (ORDER BY o_orderkey) - 1 AS ends FROM (
                    SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
                        CASE WHEN o_orderkey > (SELECT max(o_orderkey) FROM orders) * 0.8 THEN 'late'
                            ELSE CAST(o_orderkey AS VARCHAR) END AS late,
                        CASE WHEN o_orderkey % 50 = 7 THEN '1.5' ELSE CAST(o_orderkey AS VARCHAR) END AS early FROM orders))
            WHERE ends + {len(','.join(HEAD_COLUMNS)) + 1} <= 20480)""")
    ),
    "infer_types_incremental": _untabled(
        types_sql("orders", [*TABLES["orders"], "total_or_key", "open_or_key"], relation="""(
            SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_totalprice AS VARCHAR) ELSE CAST(o_orderkey AS VARCHAR) END AS total_or_key,
                CASE WHEN o_orderkey % 3 = 1 THEN o_orderstatus ELSE CAST(o_custkey AS VARCHAR) END AS open_or_key FROM orders)""")
    ),
    "infer_types_widened": """
        WITH w AS (SELECT max(length(CAST(o_orderkey AS VARCHAR))) AS n, max(o_orderkey) AS k FROM orders)
        SELECT pos, name, CASE WHEN digits <= 9 OR (pos = 1 AND k <= 2147483647) THEN 'int'
            WHEN digits <= 18 THEN 'bigint' WHEN digits <= 38 THEN 'decimal(38,0)' ELSE 'string' END AS type
        FROM (SELECT 1 AS pos, 'plain' AS name, n AS digits, k FROM w
            UNION ALL SELECT 2, 'past_int', n + 10, k FROM w
            UNION ALL SELECT 3, 'past_bigint', n + 20, k FROM w
            UNION ALL SELECT 4, 'past_decimal', n + 40, k FROM w)
    """,
    "infer_types_empty_ignored": f"""
        WITH t AS (SELECT CASE WHEN l_returnflag = 'N' THEN ' ' ELSE CAST(l_orderkey AS VARCHAR) END AS a,
            CASE WHEN l_returnflag <> 'N' THEN CAST(l_tax AS VARCHAR) END AS b, l_returnflag AS c FROM lineitem),
        u AS (SELECT 1 AS pos, 'blank_or_key' AS name, a AS v FROM t UNION ALL SELECT 2, 'null_or_tax', b FROM t
            UNION ALL SELECT 3, 'l_returnflag', c FROM t)
        SELECT pos, name, {label_sql('max(' + _EMPTY.format(rank_sql('v')) + ')')} AS type FROM u GROUP BY pos, name
    """,
    "infer_types_by_group": f"""
        WITH t AS (SELECT event_type, CASE event_type WHEN 'view' THEN CAST(user_id AS VARCHAR)
            WHEN 'click' THEN CAST(value AS VARCHAR) ELSE event_type END AS m, CAST(user_id AS VARCHAR) AS u FROM events)
        SELECT event_type, 1 AS pos, 'mixed' AS name, {label_sql('max(' + rank_sql('m') + ')')} AS type FROM t GROUP BY 1
        UNION ALL
        SELECT event_type, 2, 'user_id', {label_sql('max(' + rank_sql('u') + ')')} FROM t GROUP BY 1
    """,
    "value_type_counts": f"""
        SELECT name, {label_sql(rank_sql('v'))} AS type, count(*) AS n FROM ({
            ' UNION ALL '.join(f"SELECT '{c}' AS name, CAST({c} AS VARCHAR) AS v FROM lineitem" for c in TABLES['lineitem'])
        }) GROUP BY ALL
    """,
    "infer_json_keys": f"""
        WITH kv AS (SELECT unnest(json_keys(props)) AS name, props FROM events)
        SELECT CAST(row_number() OVER (ORDER BY name) AS INTEGER) AS pos, name, type FROM (
            SELECT name, {label_sql('max(' + rank_sql("json_extract_string(props, '$.' || name)") + ')')} AS type
            FROM kv GROUP BY name)
    """,
    "infer_json_lines": _untabled(
        types_sql(
            "orders", ["o_orderkey", "quoted", "o_totalprice", "nested", "with_null"],
            relation="""(SELECT o_orderkey, o_custkey AS quoted, o_totalprice, '{"o_orderstatus":' AS nested,
                CASE WHEN o_orderstatus <> 'F' THEN o_orderkey END AS with_null FROM orders)""",
        )
    ),
    "infer_json_missing_keys": f"""
        SELECT 1 AS pos, 'o_orderkey' AS name, {label_sql('max(' + rank_sql('CAST(o_orderkey AS VARCHAR)') + ')')} AS type FROM orders
        UNION ALL
        SELECT 2, 'o_totalprice', {label_sql('max(' + rank_sql('CAST(o_totalprice AS VARCHAR)') + ')')} FROM orders
        UNION ALL
        SELECT 3, 'sometimes', {label_sql('max(' + rank_sql('CAST(o_custkey AS VARCHAR)') + ')')} FROM orders WHERE o_orderstatus <> 'F'
    """,
    "infer_json_array": _untabled(types_sql("customer", TABLES["customer"])),
    "infer_xml_tags": _untabled(types_sql("customer", TABLES["customer"])),
    "infer_text_column": """
        SELECT 'line' AS name, 'string' AS type, CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS line_count FROM documents
    """,
    "spark_type_catalog_map": " UNION ALL ".join(
        f"SELECT '{t}' AS tbl, {i + 1} AS pos, '{c}' AS name, type, legacy_type, non_null"
        f" FROM (SELECT {_wide(t, c)}) AS x(type, legacy_type, non_null)"
        for t in SMALL
        for i, c in enumerate(TABLES[t])
    ),
    "frame_type_map": """
        SELECT 1 AS pos, 's_suppkey' AS name, 'int' AS type FROM (SELECT count(s_suppkey) FROM supplier)
        UNION ALL SELECT 2, 's_name', 'string'
        UNION ALL SELECT 3, 's_nationkey', 'int'
        UNION ALL SELECT 4, 's_acctbal', 'double'
        UNION ALL SELECT 5, 'gaps', CASE WHEN bool_and(s_acctbal > 0) THEN 'int' ELSE 'double' END FROM supplier
    """,
    "header_only_schema": " UNION ALL ".join(
        f"SELECT {i + 1} AS pos, '{n}' AS name, 'string' AS type, count({c}) AS non_null FROM customer"
        for i, (n, c) in enumerate(
            zip(["c_custkey", "c_name", "c_nationkey", "col_4", "c_mktsegment"], TABLES["customer"], strict=True)
        )
    ),
    "column_inventory": f"SELECT 'landing' AS db, tbl, CAST(1 AS BIGINT) AS version, pos, name, type FROM ({inventory_sql(TABLES)})",
}
