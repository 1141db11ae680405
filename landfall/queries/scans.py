"""Queries over sources: every format landed and read back, file listings."""

from pyspark.sql import functions as F

from landfall.functions.names import (
    extension, key_matches, parent_location, table_name, target_location,
)
from landfall.operators.infer import collect_columns, opaque_schema, storage_schema
from landfall.operators.publish import TIMESTAMPS, write_files
from landfall.operators.tables import ensure_table
from landfall.plans.ingest import land_files
from landfall.queries.common import TABLES, land, land_json_arrays, landing, load, new_db
from landfall.sources.files import latest_file, list_files, list_keys
from landfall.sources.readers import (
    infer_xml, long_rows, read_csv, read_first_csv, read_json, read_landing, read_table, read_text, read_tsv, read_xml,
)
from landfall.sources.xml_records import cut_xml
from landfall.workspace import fresh_folder

# Bytes of a landed file of pages, two splits as Spark sets them. A file is written by one task, so files grow in number.
XML_FILE_BYTES = 256 << 20


def scan_csv(spark, sf):
    """A CSV with its registered schema."""
    df = load(spark, sf, "orders")
    return read_csv(spark, land(spark, df, "orders.csv"), schema=df.schema, **TIMESTAMPS)


def scan_csv_inferred(spark, sf):
    """A CSV with Spark's type inference."""
    return read_csv(spark, land(spark, load(spark, sf, "supplier"), "supplier.csv"), infer=True)


def scan_first_csv(spark, sf):
    """S3: of several files the first in path order, types by the whole file."""
    zone = fresh_folder(spark, "zone")
    for name in ("part", "customer", "supplier"):
        land(spark, load(spark, sf, name), f"{name}.csv", zone)
    return read_first_csv(spark, zone)[0]


def scan_tsv(spark, sf):
    """S4."""
    df = load(spark, sf, "lineitem")
    return read_tsv(spark, land(spark, df, "lineitem.tsv"), schema=df.schema, **TIMESTAMPS)


def scan_json_lines(spark, sf):
    """S5."""
    return read_json(spark, land(spark, load(spark, sf, "part"), "part.json"))


def scan_json_array(spark, sf):
    """JSON arrays cut into objects in parallel, columns in key order."""
    path = land_json_arrays(spark, load(spark, sf, "customer"), "customer.json", "c_custkey")
    return read_json(spark, path, recursiveFileLookup=True)


def scan_json_texts(spark, sf):
    """S5b on long free text: arrays whose strings hold quotes, braces and newlines."""
    df = load(spark, sf, "pages")
    path = land_json_arrays(spark, df, "pages.json", "page_id")
    return read_json(spark, path, schema=df.schema, document=True, recursiveFileLookup=True)


def scan_text_lines(spark, sf):
    """S6/K3/T7."""
    lines = load(spark, sf, "documents").select(F.explode(F.split("text", "\n")).alias("value"))
    return read_text(spark, land(spark, lines, "documents.txt", lineSep="\n"), lineSep="\n")


def scan_opaque(spark, sf):
    """A file taken as lines of one column called data."""
    path = land(spark, load(spark, sf, "nation"), "nation.csv", max_files=1)
    return spark.read.text(path).toDF(*opaque_schema().names)


def scan_xml(spark, sf):
    """Records found by the first child of the root."""
    df = load(spark, sf, "customer")
    path = land(spark, df, "customer.xml", rootTag="customers", rowTag="customer")
    return read_xml(spark, path, schema=df.schema)


def scan_xml_split(spark, sf):
    """S7 with inferred types over many files, columns in tag order."""
    df = load(spark, sf, "part")
    path = land(spark, df, "part.xml", rootTag="parts", rowTag="part")
    columns = collect_columns(infer_xml(spark, path, "part"))
    return read_xml(spark, path, "part", storage_schema(columns))


def scan_xml_marks(spark, sf):
    """Records with CDATA that holds tags, inside a file with a long prolog and records in comments."""
    text = F.format_string(
        "<page><page_id>%d</page_id><html><![CDATA[%s</page><page>]]></html></page><!-- <page><page_id>0</page_id></page> -->",
        "page_id", F.replace("html", F.lit("]]>"), F.lit("")),
    )
    prolog = f"<!-- {'> ' * 100} --><pages>"
    doc = F.concat(F.lit(prolog), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("page_id", text.alias("x")))), lambda r: r["x"]), ""), F.lit("</pages>"))
    pages = load(spark, sf, "pages").groupBy(F.pmod("page_id", F.lit(40)).alias("n")).agg(doc.alias("value"))
    path = f"{fresh_folder(spark, 'zone')}/pages.xml"
    pages.write.partitionBy("n").text(path)
    options = {"ignoreSurroundingSpaces": False, "recursiveFileLookup": True}
    return read_xml(spark, path, schema="page_id bigint, html string", **options)


def scan_xml_large(spark, sf):
    """All pages in files of some splits each, cut over many tasks, marks as above and one record in five inside another; types inferred."""
    html = F.replace("html", F.lit("]]>"), F.lit(""))
    record = F.format_string("<page><page_id>%d</page_id><html><![CDATA[%s</page><page>]]></html>", "page_id", html)
    inner = F.when(F.col("page_id") % 5 == 0, F.lit("<seen><page><page_id>0</page_id></page></seen>")).otherwise("")
    text = F.concat(record, inner, F.lit("</page><!-- <page><page_id>0</page_id></page> -->"))
    prolog = f"<?xml version='1.0'?><!-- {'> ' * 100} </page> --><pages>"
    pages = load(spark, sf, "pages").select(F.lit(1).alias("part"), F.col("page_id").cast("bigint"), text.alias("value"))
    with landing():
        files = (pages.agg(F.sum(F.octet_length("value"))).first()[0] or 0) // XML_FILE_BYTES + 1
    marks = F.array(*[F.struct(F.lit(n).alias("part"), F.lit(mark).alias("value")) for n, mark in ((0, prolog), (2, "</pages>"))])
    ends = spark.range(files).select(F.col("id").alias("file"), F.inline(marks))
    path = f"{fresh_folder(spark, 'zone')}/pages.xml"
    with landing():
        rows = pages.withColumn("file", F.pmod(F.xxhash64("page_id"), F.lit(files))).unionByName(ends, allowMissingColumns=True)
        rows = rows.repartitionByRange(files, "file").sortWithinPartitions("file", "part", "page_id")
        rows.select("file", "value").write.partitionBy("file").text(path)
    records = cut_xml(spark, path, "page", split=True, recursiveFileLookup=True)
    columns = collect_columns(infer_xml(spark, path, "page", records=records, recursiveFileLookup=True))
    kinds = F.lit(",".join(f"{c.name}:{c.type}" for c in columns))
    read = read_xml(spark, path, "page", "page_id bigint, html string", records=records, ignoreSurroundingSpaces=False)
    return read.withColumn("columns", kinds)


def scan_catalog_table(spark, sf):
    """A registered table."""
    db = new_db(spark, "scan")
    df = load(spark, sf, "part")
    ensure_table(spark, db, "part", land(spark, df, "part.csv"), df.schema)
    return read_table(spark, db, "part")


def scan_unknown_extension(spark, sf):
    """An unknown extension is read as CSV with a header."""
    path = f"{fresh_folder(spark, 'zone')}/nation.dat"
    write_files(load(spark, sf, "nation"), path, "csv")
    return read_landing(spark, path, ".dat")


def pad_short_rows(spark, sf):
    """Short rows are padded, long rows cut to the header."""
    text = F.concat_ws(
        ",",
        F.col("o_orderkey"),
        F.col("o_custkey"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")),
        F.when(F.col("o_orderstatus") == "O", F.lit("extra")),
    )
    header = "o_orderkey,o_custkey,o_orderstatus"
    path = land(spark, load(spark, sf, "orders").select(text.alias(header)), "orders.csv", sep="\t")
    landed = land_files(spark, path, "csv", long_lines="cut")
    return landed.data.select(F.col("o_orderkey").cast("bigint"), F.col("o_custkey").cast("bigint"), "o_orderstatus").withColumn(
        "note", F.lit(landed.note)
    )


def long_row_report(spark, sf):
    """Rows with more fields than the header."""
    columns = TABLES["supplier"]
    line = F.concat_ws(",", *columns, F.when(F.col("s_acctbal") < 0, F.lit("over")))
    df = load(spark, sf, "supplier").select(line.alias(",".join(columns)))
    return long_rows(spark, land(spark, df, "supplier.csv", sep="\t"))


def file_inventory(spark, sf):
    """Supported files of a mixed zone, per format."""
    zone = fresh_folder(spark, "zone")
    for name, ext in (("customer", "csv"), ("supplier", "TSV"), ("part", "json"), ("nation", "xml"), ("region", "orc")):
        write_files(load(spark, sf, name), f"{zone}/{name}.{ext}", {"orc": "orc"}.get(ext, ext.lower()))
    listed = list_files(spark, zone)
    return listed.groupBy("table_name", "format").agg((F.sum("length") > 0).alias("has_bytes"))


def file_keys(spark, sf):
    """Keys by prefix and suffix, case-sensitive."""
    zone = fresh_folder(spark, "zone")
    for name in ("customer", "supplier"):
        land(spark, load(spark, sf, name), f"{name}.csv", zone)
    land(spark, load(spark, sf, "part"), "part.json", zone)
    keys = list_keys(spark, zone, suffix=".csv")
    folder = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)
    return keys.groupBy(folder.alias("folder")).agg((F.sum("length") > 0).alias("has_bytes"))


def _clean_url():
    return F.regexp_replace("url", r"[?#].*$", "")


def latest_file_per_group(spark, sf):
    """The greatest base name per host."""
    pages = load(spark, sf, "pages").select(
        F.regexp_extract("url", "^[a-z]+://([^/]+)", 1).alias("host"), _clean_url().alias("path")
    )
    return latest_file(pages, "host")


def table_name_from_path(spark, sf):
    """P6-P8 on page addresses as paths."""
    path = F.col("path")
    pages = load(spark, sf, "pages").select("page_id", _clean_url().alias("path"))
    return pages.select(
        "page_id",
        table_name(path).alias("table_name"),
        table_name(path, lower=True, prefix="fdp_").alias("prefixed"),
        extension(path).alias("extension"),
        target_location(F.lit("zone/curated//"), table_name(path)).alias("target"),
        parent_location(path).alias("parent"),
        key_matches(path, "https://", ".html").alias("matches"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        scan_csv, scan_csv_inferred, scan_first_csv, scan_tsv, scan_json_lines, scan_json_array, scan_json_texts,
        scan_text_lines, scan_opaque, scan_xml, scan_xml_split, scan_xml_marks, scan_xml_large, scan_catalog_table, scan_unknown_extension,
        pad_short_rows, long_row_report, file_inventory, file_keys, latest_file_per_group, table_name_from_path,
    )
}

_URL = "regexp_replace(url, '[?#].*$', '')"
_BASE = f"regexp_extract({_URL}, '([^/]*)$', 1)"
_NAME = f"CASE WHEN {_BASE} LIKE '_%.%' THEN regexp_replace({_BASE}, '\\.[^.]*$', '') ELSE {_BASE} END"

ORACLE = {
    "scan_csv": "SELECT * FROM orders",
    "scan_csv_inferred": "SELECT * REPLACE (CAST(s_suppkey AS INTEGER) AS s_suppkey) FROM supplier",
    "scan_first_csv": "SELECT * REPLACE (CAST(c_custkey AS INTEGER) AS c_custkey) FROM customer",
    "scan_tsv": "SELECT * FROM lineitem",
    "scan_json_lines": "SELECT * REPLACE (CAST(p_size AS BIGINT) AS p_size) FROM part",
    "scan_json_array": "SELECT * REPLACE (CAST(c_nationkey AS BIGINT) AS c_nationkey) FROM customer",
    "scan_json_texts": "SELECT * FROM pages",
    "scan_text_lines": "SELECT unnest(string_split(text, chr(10))) AS line FROM documents",
    "scan_opaque": """
        SELECT 'n_nationkey,n_name,n_regionkey' AS data
        UNION ALL SELECT concat_ws(',', n_nationkey, n_name, n_regionkey) FROM nation
    """,
    "scan_xml": "SELECT * FROM customer",
    "scan_xml_split": "SELECT * REPLACE (CAST(p_size AS BIGINT) AS p_size) FROM part",
    "scan_xml_marks": "SELECT page_id, replace(html, ']]>', '') || '</page><page>' AS html FROM pages",
    "scan_xml_large": """
        SELECT page_id, replace(html, ']]>', '') || '</page><page>' AS html, 'page_id:int,html:string,seen:string' AS columns FROM pages
    """,
    "scan_catalog_table": "SELECT * FROM part",
    "scan_unknown_extension": """
        SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey FROM nation
    """,
    "pad_short_rows": """
        SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END AS o_orderstatus,
            (SELECT count(*) FROM orders WHERE o_orderstatus = 'O') || ' rows cut to the header' AS note FROM orders
    """,
    "long_row_report": """
        SELECT concat_ws(',', s_suppkey, s_name, s_nationkey, s_acctbal, 'over') AS line FROM supplier WHERE s_acctbal < 0
    """,
    "file_inventory": """
        SELECT 'customer' AS table_name, 'csv' AS format, count(*) > 0 AS has_bytes FROM customer
        UNION ALL SELECT 'supplier', 'tsv', count(*) > 0 FROM supplier
        UNION ALL SELECT 'part', 'json', count(*) > 0 FROM part
        UNION ALL SELECT 'nation', 'xml', count(*) > 0 FROM nation
    """,
    "file_keys": """
        SELECT 'customer.csv' AS folder, count(*) > 0 AS has_bytes FROM customer
        UNION ALL SELECT 'supplier.csv', count(*) > 0 FROM supplier
    """,
    "latest_file_per_group": f"""
        WITH p AS (SELECT regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host, {_URL} AS path, {_BASE} AS file_name FROM pages)
        SELECT host, file_name, path FROM (
            SELECT *, row_number() OVER (PARTITION BY host ORDER BY file_name DESC, path DESC) AS n FROM p)
        WHERE n = 1
    """,
    "table_name_from_path": f"""
        SELECT page_id, {_NAME} AS table_name, 'fdp_' || lower({_NAME}) AS prefixed,
            lower(regexp_extract({_BASE}, '^.+\\.([^.]*)$', 1)) AS extension,
            'zone/curated/' || {_NAME} || '/' AS target,
            regexp_replace({_URL}, '[^/]+$', '') AS parent,
            {_URL} LIKE 'https://%.html' AS matches
        FROM pages
    """,
}
