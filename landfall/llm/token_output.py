"""Token ids in Parquet files that can be read in part (operator 7).

A row of the files is one document: ``doc_id``, ``n_tokens``, ``local_start`` (ids
before it in its file) and ``ids``, a list column. Ids are dictionary encoded and,
where a chunk outgrows its dictionary, delta encoded; row groups and pages are kept
small and carry indexes, so a reader of the metadata columns never touches the ids
and a filter on ``doc_id`` reads only the pages it needs. Files follow each other in
ascending doc_id order, null ids first; a manifest of one row per file gives the
position of each file's first id.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from landfall.functions.names import join_location
from landfall.llm.tokens import word_tokens
from landfall.llm.words import Words, slices

END_ID = 1
ROW_GROUP_BYTES = 16 << 20
PAGE_ROWS = 2_000
WRITE_OPTIONS = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "true",
    "parquet.block.size": str(ROW_GROUP_BYTES),
    "parquet.page.row.count.limit": str(PAGE_ROWS),
}


def _encoded(tokenizer: str, end_id: int, id_type: pa.DataType):
    schema = pa.schema([("doc_id", id_type), ("local_start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, before = word_tokens(tokenizer), 0
        for batch in batches:
            for part in slices(batch):
                ids, first = encoder.encode(Words(part.column("text")))
                count = np.diff(first) + 1
                ends = np.cumsum(count)
                flat = np.insert(ids.astype(np.int32), first[1:], end_id)
                lists = pa.ListArray.from_arrays(np.concatenate(([0], ends)).astype(np.int32), flat)
                arrays = [part.column("doc_id"), pa.array(before + ends - count), pa.array(count), lists]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)
                before += int(ends[-1])

    return encode


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, partitions: int | None = None) -> None:
    """Encode whole texts, append ``end_id`` to each and write them below ``path`` in doc_id order.

    ``docs`` needs doc_id and text; other columns are ignored. Null and empty
    texts hold the end id alone. Rows that share a doc_id stay next to each
    other in order of a hash of their text. An empty table gives empty files.
    """
    id_type = docs.schema["doc_id"].dataType
    spark = docs.sparkSession
    ranges = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
        .repartitionByRange(ranges, "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text")
    )
    schema = T.StructType([
        T.StructField("doc_id", id_type), T.StructField("local_start", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType())),
    ])
    arrow_id = pa.string() if isinstance(id_type, T.StringType) else pa.int32() if isinstance(id_type, T.IntegerType) else pa.int64()
    ordered.mapInArrow(_encoded(tokenizer, end_id, arrow_id), schema).write.options(**WRITE_OPTIONS).parquet(join_location(path, "tokens"))
    tokens = spark.read.schema(schema).parquet(join_location(path, "tokens"))
    # One row per file: file names carry the number of the partition.
    files = tokens.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")
    )
    number = F.regexp_extract("file", r"part-(\d+)", 1).cast("int")
    before = Window.orderBy(number).rowsBetween(Window.unboundedPreceding, -1)
    files.withColumn("file_start", F.coalesce(F.sum("tokens").over(before), F.lit(0))).coalesce(1).write.parquet(
        join_location(path, "manifest")
    )


def read_tokens(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """The documents with ``start``, the number of ids of all documents before them.

    Only the named columns of the files are read: the metadata columns cost nothing of the ids.
    """
    tokens = spark.read.parquet(join_location(path, "tokens"))
    manifest = spark.read.parquet(join_location(path, "manifest")).select("file", "file_start")
    named = tokens.select("*", F.col("_metadata.file_name").alias("file"))
    # As many rows as files, so as many as the writing had partitions.
    joined = named.join(F.broadcast(manifest), "file").withColumn("start", F.col("file_start") + F.col("local_start"))
    return joined.select(*(columns or ("doc_id", "start", "n_tokens", "ids")))


def token_digests(tokens: DataFrame, keep: list[str]) -> DataFrame:
    """Replace ``ids`` by the unsigned crc32 of its ids as little-endian 32-bit integers."""
    kept = tokens.select(*keep, "ids")
    schema = T.StructType([*[f for f in kept.schema.fields if f.name != "ids"], T.StructField("ids_crc32", T.LongType())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            flat = memoryview(lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)).cast("B")
            at = (lists.offsets.to_numpy() * 4).tolist()
            crc = pa.array([zlib.crc32(flat[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)], pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], crc], names=[*keep, "ids_crc32"])

    return kept.mapInArrow(digest, schema)
