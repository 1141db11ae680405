"""Shared by the registered queries: loading, landing and SQL building blocks."""

import datetime as dt
import time
import uuid
from contextlib import contextmanager
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from landfall.functions.names import join_location, literal_path
from landfall.operators.publish import write_files
from landfall.operators.tables import ensure_database
from landfall.workspace import fresh_folder, written

RUN_TS = dt.datetime(2025, 1, 2, 3, 4, 5)

# The given tables and their columns.
TABLES = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "lineitem": [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    ],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "embeddings": ["vec_id", "embedding", "label"],
    "pages": ["page_id", "url", "html"],
    "benchmark": ["item_id", "text"],
    "labels": ["doc_id", "quality", "toxic"],
    "conversations": ["conv_id", "turn", "role", "text"],
}


# Seconds spent on landing inputs so far; no work of the operators.
LANDING = {"seconds": 0.0}


@contextmanager
def landing():
    """Counts the time of what happens inside as landing."""
    start = time.perf_counter()
    try:
        yield
    finally:
        LANDING["seconds"] += time.perf_counter() - start


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load_all(spark: SparkSession, sf_dir: str, names) -> dict[str, DataFrame]:
    return {n: load(spark, sf_dir, n) for n in names}


def as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def land(spark: SparkSession, df: DataFrame, file_name: str, zone: str | None = None, **options) -> str:
    """Write a landing "file" (a folder of part files named like one) and return its path."""
    path = join_location(zone or fresh_folder(spark, "zone"), file_name)
    ext = file_name.rpartition(".")[2]
    with landing():
        write_files(df, path, {"txt": "text"}.get(ext, ext), **options)
    return path


def land_in_order(spark: SparkSession, df: DataFrame, file_name: str, *by: str) -> str:
    """Land rows as one file in the order of some columns.

    They are sorted by many tasks and written once. The task that makes the file
    takes those parts one after the other, so it neither sorts nor keeps rows.
    """
    with landing():
        parts = sorted(written(spark, df.orderBy(*by), "ordered").inputFiles())
    ordered = [spark.read.schema(df.schema).parquet(literal_path(unquote(p))) for p in parts]
    return land(spark, reduce(DataFrame.unionByName, ordered).coalesce(1), file_name)


def land_loose(spark: SparkSession, df: DataFrame, zone: str, file_name: str, key: str, files: int) -> None:
    """Land rows as ``files`` CSV files of one name, each in a folder of its own."""
    parts = fresh_folder(spark, "parts")
    with landing():
        dealt = df.withColumn("_deal", F.pmod(F.xxhash64(key), F.lit(files))).repartition(8, "_deal")
        dealt.write.partitionBy("_deal").option("header", True).csv(parts)
        path = spark._jvm.org.apache.hadoop.fs.Path
        system = path(parts).getFileSystem(spark._jsc.hadoopConfiguration())
        for found in system.globStatus(path(f"{parts}/_deal=*/part-*.csv")):
            place = path(zone, f"{found.getPath().getParent().getName().replace('_deal=', 'from-')}/{file_name}")
            system.mkdirs(place.getParent())
            system.rename(found.getPath(), place)


def land_json_arrays(
    spark: SparkSession, df: DataFrame, file_name: str, key: str, rows_per_file: int = 50_000, zone: str | None = None
) -> str:
    """Land JSON files that each hold one array of bounded size."""
    path = join_location(zone or fresh_folder(spark, "zone"), file_name)
    with landing():
        files = df.count() // rows_per_file + 1
    numbered = df.select(
        F.pmod(F.xxhash64(key), F.lit(files)).alias("doc"), F.to_json(F.struct(*df.columns)).alias("text"), F.col(key).alias("k")
    )
    first = F.row_number().over(Window.partitionBy("doc").orderBy("k")) == 1
    lines = numbered.select("doc", "k", F.lit(1).alias("part"), F.concat(F.when(first, "[").otherwise(","), "text").alias("line"))
    ends = numbered.select("doc").distinct().select(
        "doc", F.lit(None).alias("k"), F.lit(2).alias("part"), F.lit("]").alias("line")
    )
    with landing():
        (
            lines.unionByName(ends)
            .repartition("doc")
            .sortWithinPartitions("doc", "part", "k")
            .select("doc", "line")
            .write.partitionBy("doc")
            .text(path)
        )
    return path


def new_db(spark: SparkSession, name: str) -> str:
    """A database of its own for one call."""
    db = f"landfall_{name}_{uuid.uuid4().hex[:8]}"
    ensure_database(spark, db, fresh_folder(spark, db))
    return db


def rank_sql(value: str) -> str:
    """The rule in SQL's own terms: digits are whole numbers, what casts to a double is one, the rest is text."""
    text = f"trim({value})"
    return f"CASE WHEN regexp_full_match({text}, '-?[0-9]+') THEN 0 WHEN TRY_CAST({text} AS DOUBLE) IS NOT NULL THEN 1 ELSE 2 END"


def label_sql(rank: str) -> str:
    return f"CASE {rank} WHEN 0 THEN 'int' WHEN 1 THEN 'double' ELSE 'string' END"


def types_sql(table: str, columns: list[str], tbl: str | None = None, relation: str | None = None) -> str:
    """One row per column: tbl, pos, name, type by the regular expressions."""
    parts = [
        f"SELECT '{tbl or table}' AS tbl, {i + 1} AS pos, '{c}' AS name,"
        f" {label_sql('max(' + rank_sql(f'CAST({c} AS VARCHAR)') + ')')} AS type FROM {relation or table}"
        for i, c in enumerate(columns)
    ]
    return " UNION ALL ".join(parts)


def inventory_sql(tables) -> str:
    return " UNION ALL ".join(types_sql(t, TABLES[t]) for t in tables)
