"""File discovery: listings are DataFrames, file contents are never read."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from landfall.functions.names import FORMATS, base_name, decoded, file_format, inside_folder, key_matches, table_name, unit_path
from landfall.sources.listing import all_files

# Reader option of this package: leave out the files of delivered folders. Its value is a loose file, whose header counts.
LOOSE = "looseFiles"


def scan(df: DataFrame, options: dict[str, str]) -> DataFrame:
    """A fresh scan without the files of delivered folders, if its options say so; those files are not opened."""
    return df.filter(~inside_folder(F.col("_metadata.file_path"))) if LOOSE in options else df


def _listing(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "modificationTime", "length")
    )


def list_files(spark: SparkSession, path: str, formats: list[str] | None = None) -> DataFrame:
    """Supported files below ``path`` with their unit, format and table name.

    The unit is the file itself or the folder of part files it belongs to.
    Files without a single byte are not among them: see ``empty_files``.
    """
    wanted = formats or list(FORMATS.values())
    return (
        _listing(spark, path)
        .withColumn("unit", unit_path(F.col("path")))
        .withColumn("format", file_format(F.col("unit")))
        .filter(F.col("format").isin(wanted))
        .withColumn("table_name", table_name(F.col("unit")))
    )


def empty_files(spark: SparkSession, path: str, files: DataFrame, formats: list[str] | None = None) -> DataFrame:
    """Supported deliveries below ``path`` of which every file has no byte: table_name, format, unit.

    ``files`` is the listing of those that have some. Scans pass empty files
    over, so tasks list the folders; only what is empty leaves them.
    """
    wanted = formats or list(FORMATS.values())
    names = all_files(spark, path)
    if names is None:
        # No task can list there: the driver's reader does, which knows names but no sizes.
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
        listed = spark.createDataFrame([(p,) for p in reader.load(path).inputFiles()], "path string")
        names = listed.select(decoded(F.col("path")).alias("path"))
    else:
        names = names.filter("length = 0")
    units = names.select(unit_path(F.col("path")).alias("unit")).distinct()
    units = units.withColumn("format", file_format(F.col("unit"))).filter(F.col("format").isin(wanted))
    units = units.withColumn("table_name", table_name(F.col("unit")))
    return units.join(files.select("table_name", "format").distinct(), ["table_name", "format"], "left_anti")


def list_keys(spark: SparkSession, path: str, prefix: str = "", suffix: str = ".csv") -> DataFrame:
    """Files whose path starts with ``prefix`` and ends with ``suffix`` (case-sensitive)."""
    return _listing(spark, path).filter(key_matches(F.col("path"), prefix, suffix))


def latest_file(files: DataFrame, *by: str, path: str = "path") -> DataFrame:
    """Greatest base name per group; equal names fall back to the greatest path."""
    newest = F.max(F.struct(base_name(F.col(path)).alias("name"), F.col(path).alias("path")))
    return files.groupBy(*by).agg(newest.alias("newest")).select(
        *by, F.col("newest.name").alias("file_name"), F.col("newest.path").alias(path)
    )


def first_file(files: DataFrame, path: str = "path") -> DataFrame:
    """The first file in path order."""
    return files.orderBy(path).limit(1)
