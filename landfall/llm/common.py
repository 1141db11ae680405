"""Shared by the operators of this package."""

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# A row number of a split table is offset by the counts of this many parts, so no key's rows meet in one task.
PARTS = 64


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def map_batches(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    return df.mapInArrow(function, schema)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def map_rows(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """Whole rows through a function that keeps their columns; names may hold dots or other signs."""
    names = df.columns
    places = [f"c{i}" for i in range(len(names))]
    plain = df.toDF(*places)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in function(b.rename_columns(names) for b in batches):
            yield batch.rename_columns(places)

    return plain.mapInArrow(run, plain.schema).toDF(*names)


def table_batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def label_fold(doc_id: Column) -> Column:
    """Remainder that splits labelled rows; fold 2 is held out from learning."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4))


HELD_OUT_FOLD = 2


def held_out(doc_id: Column) -> Column:
    """Null ids are in no fold and never held out."""
    return F.coalesce(label_fold(doc_id) == HELD_OUT_FOLD, F.lit(False))


def sample_ids(labels: DataFrame, label: str, limit: int) -> DataFrame:
    """At most ``limit`` labelled ids outside the held-out fold, chosen by a hash of the id.

    Of an id labelled more than once the highest label counts; null ids and null labels are left out.
    """
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    one = usable.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
