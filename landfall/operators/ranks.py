"""Column types of a growing set of files.

The type of a column is the largest rank of its values, so ranks can be kept
per file and merged later. They are noted for each version of a file (path,
modification time and length) and only files without a note are read.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from landfall.functions.names import decoded, literal_path
from landfall.functions.types import rank_label, rank_storage, value_rank
from landfall.workspace import written

VERSION = ["path", "modificationTime", "length"]
NOTES = "path string, modificationTime timestamp, length bigint, pos int, name string, rank int"


def _same_form(path: Column) -> Column:
    """A path in one form: listings and scans write the scheme of a local file differently."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def noted_ranks(spark: SparkSession, notes: str) -> DataFrame:
    """What earlier runs noted below the folder ``notes``; nothing if there is no folder yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(notes)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], NOTES)
    return spark.read.schema(NOTES).parquet(notes)


def file_ranks(rows: DataFrame, empty_as: str = "string") -> DataFrame:
    """Largest rank of each column in each file: path, pos, name, rank. One scan, one partial aggregate."""
    fields = rows.schema.fields
    maxima = [F.max(value_rank(F.col(f"`{f.name}`"), f.dataType, empty_as)).alias(f"_r{i}") for i, f in enumerate(fields)]
    columns = F.array(
        *[F.struct(F.lit(i + 1).alias("pos"), F.lit(f.name).alias("name"), F.col(f"_r{i}").alias("rank")) for i, f in enumerate(fields)]
    )
    source = _same_form(decoded(F.col("_metadata.file_path"))).alias("path")
    return rows.groupBy(source).agg(*maxima).select("path", F.inline(columns))


def note_ranks(
    files: DataFrame, read: Callable[[list[str]], DataFrame], notes: str, empty_as: str = "string"
) -> int:
    """Read the files that have no note yet, note their ranks and return how many were read.

    ``files`` is a listing (path, modificationTime, length), ``read`` gives the
    rows of some paths. The driver sees the paths of the new files only. A run
    that stops before its write has noted nothing and is made up by the next;
    two runs that note the same file do no harm, since ranks are merged by
    their maximum. A file without rows is noted without ranks.
    """
    spark = files.sparkSession
    known = noted_ranks(spark, notes).select(*VERSION).distinct()
    listed = files.select(_same_form(F.col("path")).alias("path"), F.col("path").alias("place"), "modificationTime", "length")
    # Fixed before reading: what is read and what is noted are the same versions.
    new = written(spark, listed.join(known, VERSION, "left_anti"), "new-files")
    paths = [literal_path(r["place"]) for r in new.select("place").collect()]
    if paths:
        found = file_ranks(read(paths), empty_as)
        new.drop("place").join(found, "path", "left").select(*VERSION, "pos", "name", "rank").write.mode("append").parquet(notes)
    return len(paths)


def merged_types(files: DataFrame, notes: str, widen: bool = False) -> DataFrame:
    """Column types of the listed files by the notes alone: pos, name, type, storage.

    Versions that are not listed any more say nothing. Columns come in the
    order of their first position; a column without any value is a string.
    """
    listed = files.select(_same_form(F.col("path")).alias("path"), "modificationTime", "length")
    noted = noted_ranks(files.sparkSession, notes).filter(F.col("name").isNotNull())
    merged = noted.join(listed, VERSION, "left_semi").groupBy("name").agg(F.max("rank").alias("rank"), F.min("pos").alias("first"))
    # One row per column here.
    pos = F.row_number().over(Window.orderBy("first", "name"))
    return merged.select(
        pos.alias("pos"), "name", rank_label(F.col("rank"), widen).alias("type"), rank_storage(F.col("rank")).alias("storage")
    )


def infer_new_files(
    files: DataFrame,
    read: Callable[[list[str]], DataFrame],
    notes: str,
    empty_as: str = "string",
    widen: bool = False,
) -> DataFrame:
    """Column types of all listed files, reading those only that no earlier run has noted."""
    note_ranks(files, read, notes, empty_as)
    return merged_types(files, notes, widen)
