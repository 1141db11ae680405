"""Heads of files bounded in bytes, for a look at files too large to read."""

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from landfall.sources.records import file_lines
from landfall.workspace import fresh_folder

# The size of a head, and what is added to it, in KB.
HEAD_KB, MORE_KB = 256, 64


def head_texts(
    spark: SparkSession,
    path: str | list[str],
    kb: int = HEAD_KB,
    more_kb: int = MORE_KB,
    whole_lines: bool = False,
    **options,
) -> DataFrame:
    """The first ``kb`` + ``more_kb`` KB of each file: file, text.

    A head ends before the first character that does not fit as a whole, or
    with ``whole_lines`` before the first line that does not. An empty file has
    no head. Only splits that begin inside the head are shuffled, and a task
    puts together no more than a head of each of its files.
    """
    limit = (kb + more_kb) * 1024
    lines = file_lines(spark, path, **options).filter(F.col("block") < limit)
    # A line longer than the head is cut before it moves; it still reaches beyond the head.
    lines = lines.withColumn("bytes", F.octet_length("value").cast("long")).withColumn("value", F.left("value", F.lit(limit)))
    # In its own split first, so that no more than a head of a split goes on.
    in_split = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    in_file = Window.partitionBy("file").orderBy("block", "seq").rowsBetween(Window.unboundedPreceding, -1)
    for window in (in_split, in_file):
        start = F.coalesce(F.sum(F.col("bytes") + 1).over(window), F.lit(0))
        lines = lines.withColumn("start", start).filter(F.col("start") < limit)
    # The line break before a line that begins a byte after the head's end is the last thing in it.
    room = F.lit(limit) - F.col("start")
    if whole_lines:
        lines = lines.filter(F.col("bytes") <= room)
    else:
        raw = F.encode("value", "UTF-8")
        cut = [F.substring(raw, F.lit(1), (room - less).cast("int")).cast("string") for less in range(4)]
        whole = F.coalesce(*[F.when(F.is_valid_utf8(c), c) for c in cut])
        lines = lines.withColumn("value", F.when(F.col("bytes") <= room, F.col("value")).otherwise(whole))
    ordered = F.array_sort(F.collect_list(F.struct("block", "seq", "value")))
    return lines.groupBy("file").agg(ordered.alias("l")).select("file", F.array_join("l.value", "\n").alias("text"))


def head_files(spark: SparkSession, path: str | list[str], **options) -> str:
    """Copy the head of each file to a folder of its own below a fresh one, for the readers of any format."""
    folder = fresh_folder(spark, "heads")
    heads = head_texts(spark, path, **options)
    named = heads.select(F.sha2("file", 256).alias("head"), "text")
    named.repartition("head").write.partitionBy("head").text(folder)
    return folder
