"""Type and schema inference over whole data sets.

Results are DataFrames with one row per column: ``pos, name, type, storage``.
``type`` is the catalog label, ``storage`` the Spark type that loses no value.
"""

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from landfall.functions.types import (
    STRING, catalog_type, frame_type, parse_value, rank_label, rank_storage, text_rank, value_rank,
)
from landfall.sources.records import is_json_value, line_object
from landfall.workspace import written


class ColumnSpec(NamedTuple):
    name: str
    type: str
    storage: str = "string"


COLUMN_ROWS = "pos int, name string, type string, storage string"


def _column_rows(names: list[str], ranks: list[Column], widen: bool) -> Column:
    """One array element per column, ready for ``inline``."""
    return F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("pos"),
                F.lit(name).alias("name"),
                rank_label(rank, widen).alias("type"),
                rank_storage(rank).alias("storage"),
            )
            for i, (name, rank) in enumerate(zip(names, ranks, strict=True))
        ]
    )


def head_sample(df: DataFrame, n: int, order_by: list[str] | None = None) -> DataFrame:
    """First ``n`` rows, by an ordering if given."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def infer_groups(
    df: DataFrame, by: list[str], empty_as: str = "string", widen: bool = False
) -> DataFrame:
    """Column types per group: one pass, one partial aggregate, no row blow-up."""
    fields = [f for f in df.schema if f.name not in by]
    maxima = [
        F.max(value_rank(F.col(f"`{f.name}`"), f.dataType, empty_as)).alias(f"_r{i}")
        for i, f in enumerate(fields)
    ]
    rows = _column_rows([f.name for f in fields], [F.col(f"_r{i}") for i in range(len(fields))], widen)
    return df.groupBy(*by).agg(*maxima).select(*by, F.inline(rows))


def infer_table(
    df: DataFrame,
    detect_types: bool = True,
    empty_as: str = "string",
    widen: bool = False,
    sample_rows: int | None = None,
    order_by: list[str] | None = None,
) -> DataFrame:
    """Column types of a table.

    Without ``detect_types`` every column is a string, the rule for files with
    a header. ``sample_rows`` looks at the first rows only.
    """
    if not detect_types:
        ranks = [F.lit(STRING)] * len(df.columns)
        return df.sparkSession.range(1).select(F.inline(_column_rows(df.columns, ranks, widen)))
    if sample_rows is not None:
        df = head_sample(df, sample_rows, order_by)
    return infer_groups(df, [], empty_as, widen)


def infer_many(tables: Mapping[str, DataFrame], **options) -> DataFrame:
    """Column types of several tables in one job, with a leading ``tbl`` column."""
    parts = [infer_table(df, **options).select(F.lit(t).alias("tbl"), "*") for t, df in tables.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _fold_pairs(pairs: DataFrame) -> DataFrame:
    """Fold (file, block, seq, idx, key, rank, bad) rows into one row per key: key, rank, first, bad.

    The first fold is keyed by key and split, with plain integer buffers, so it
    hash-aggregates on the map side; what remains has one row per key and split.
    """
    # 33 bits of row number, made signed, and 31 of position fill one integer.
    row = F.col("seq").bitwiseAND(F.lit((1 << 33) - 1)) - F.lit(1 << 32)
    place = F.shiftleft(row, 31) + F.col("idx")
    by_split = pairs.groupBy("key", "file", "block").agg(
        F.max("rank").alias("rank"), F.min(place).alias("place"), F.sum("bad").alias("bad")
    )
    return by_split.groupBy("key").agg(
        F.max("rank").alias("rank"),
        F.min(F.struct("file", "block", "place")).alias("first"),
        F.sum("bad").alias("bad"),
    )


def number_keys(keys: DataFrame, unreadable: str | None = None) -> DataFrame:
    """Keys (key, rank, first, bad) with their position (``pos``) by ``first``, from 1.

    Keys are sorted in ranges, each range is numbered by itself and moved by the
    sizes of those before it, so no task holds all keys. The sorted keys are
    written once, since positions hold for one cut into ranges only. With
    ``unreadable`` a bad text, or no key at all, fails with that message.
    """
    # The row of texts without a key goes behind all keys, where it shifts none.
    order = F.when(F.col("key").isNotNull(), F.col("first")).asc_nulls_last()
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranges = keys.repartitionByRange(order).sortWithinPartitions(order)
    ranges = ranges.select("key", "rank", "bad", F.spark_partition_id().alias("part"), place.alias("place"))
    kept = written(keys.sparkSession, ranges, "keys")
    if unreadable:
        failed = (F.coalesce(F.sum("bad"), F.lit(0)) > 0) | (F.count("key") == 0)
        kept.agg(F.when(failed, F.raise_error(F.lit(unreadable))).alias("failed")).collect()
    found = kept.filter(F.col("key").isNotNull())
    # One row per range: as many as there are shuffle partitions, whatever the number of keys.
    before = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = found.groupBy("part").agg(F.count("*").alias("size")).select("part", F.coalesce(before, F.lit(0)).alias("start"))
    pos = (F.col("start") + F.col("place") + 1).cast("int")
    return found.join(F.broadcast(starts), "part").select(pos.alias("pos"), "key", "rank")


def json_value_rank(value: Column, empty_as: str = "string") -> Column:
    """Rank of a JSON value's text; bare NaN and infinities arrive quoted."""
    text = F.when(value.rlike('^"(NaN|-?Infinity)"$'), F.replace(value, F.lit('"'), F.lit(""))).otherwise(value)
    return text_rank(text, empty_as)


def json_keys(records: DataFrame, empty_as: str = "string") -> DataFrame:
    """Keys of JSON object texts: key, rank, the place where it first stands, and texts that are no JSON (``bad``)."""
    if "seq" not in records.columns:
        records = records.select(
            "value", F.lit("").alias("file"), F.spark_partition_id().cast("long").alias("block"),
            F.monotonically_increasing_id().alias("seq"),
        )
    parsed = records.withColumn("object", line_object(F.col("value")))
    bad = F.col("object").isNull() & ~is_json_value(F.col("value"))
    pairs = parsed.select(
        "file", "block", "seq", bad.cast("int").alias("bad"),
        F.posexplode_outer("object").alias("idx", "key", "text"),
    ).select(
        "file", "block", "seq", "bad", "idx", "key", json_value_rank(F.col("text"), empty_as).alias("rank")
    )
    return _fold_pairs(pairs)


def infer_json(
    records: DataFrame, bad_lines: str = "fail", empty_as: str = "string", widen: bool = False
) -> DataFrame:
    """Columns of JSON object texts in order of first appearance.

    Only keys present in an object count for it; an explicit null is a string.
    A text that is no JSON fails the whole set unless ``bad_lines="skip"``;
    JSON that is no object is passed over. ``records`` has a ``value`` column
    and, when read from files, file, block and seq. The texts are read here;
    the result is what they were found to hold.
    """
    unreadable = "JSON appears empty or unreadable." if bad_lines == "fail" else None
    rank = F.col("rank")
    return number_keys(json_keys(records, empty_as), unreadable).select(
        "pos", F.col("key").alias("name"), rank_label(rank, widen).alias("type"), rank_storage(rank).alias("storage")
    )


def infer_present(df: DataFrame, empty_as: str = "string", widen: bool = False) -> DataFrame:
    """Column types of text columns by their non-null values; a column without any is a string."""
    ranks = [F.max(F.when(F.col(f"`{c}`").isNotNull(), text_rank(F.col(f"`{c}`"), empty_as))).alias(f"_r{i}") for i, c in enumerate(df.columns)]
    rows = _column_rows(df.columns, [F.col(f"_r{i}") for i in range(len(df.columns))], widen)
    return df.agg(*ranks).select(F.inline(rows)) if df.columns else df.sparkSession.createDataFrame([], COLUMN_ROWS)


def infer_spark_types(df: DataFrame, legacy: bool = False) -> list[ColumnSpec]:
    """Columns by Spark type."""
    return [ColumnSpec(f.name, catalog_type(f.dataType, legacy), f.dataType.simpleString()) for f in df.schema]


def infer_frame_types(df: DataFrame) -> DataFrame:
    """Columns by the dataframe-dtype rule, where an integer column with gaps is double."""
    gaps = [(F.count("*") > F.count(F.col(f"`{c}`"))).alias(f"_g{i}") for i, c in enumerate(df.columns)]
    rows = [
        F.struct(
            F.lit(i + 1).alias("pos"),
            F.lit(f.name).alias("name"),
            F.when(F.col(f"_g{i}"), frame_type(f.dataType, True)).otherwise(frame_type(f.dataType)).alias("type"),
            F.lit(f.dataType.simpleString()).alias("storage"),
        )
        for i, f in enumerate(df.schema)
    ]
    return df.agg(*gaps).select(F.inline(F.array(*rows)))


def opaque_schema() -> T.StructType:
    """One text column for a file taken as it is."""
    return T.StructType([T.StructField("data", T.StringType())])


def collect_columns(columns: DataFrame) -> list[ColumnSpec]:
    """Bring an inferred schema to the driver; its size is the column count."""
    rows = columns.orderBy("pos").select("name", "type", "storage").collect()
    return [ColumnSpec(*r) for r in rows]


def storage_values(df: DataFrame, columns: list[ColumnSpec]) -> list[Column]:
    """Inferred columns in their order and storage types; only text needs parsing."""
    values = []
    for c in columns:
        value, is_text = F.col(f"`{c.name}`"), isinstance(df.schema[c.name].dataType, T.StringType)
        values.append((parse_value(value, c.storage) if is_text else value.cast(c.storage)).alias(c.name))
    return values


def storage_schema(columns: list[ColumnSpec]) -> T.StructType:
    """Spark schema of inferred columns, in their order."""
    return T.StructType([T.StructField(c.name, _data_type(c.storage)) for c in columns])


def text_schema(columns: list[ColumnSpec]) -> T.StructType:
    return T.StructType([T.StructField(c.name, T.StringType()) for c in columns])


def _data_type(name: str) -> T.DataType:
    return T.StructType.fromDDL(f"c {name}")[0].dataType
