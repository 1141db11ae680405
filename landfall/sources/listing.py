"""A listing of files as a data source: folders are listed by tasks side by side, files without a byte are rows too."""

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from landfall.workspace import show_package

LISTING = "path string, modificationTime timestamp, length bigint"
# Folders are dealt to at most so many tasks, and go to Spark in batches of so many files.
TASKS, BATCH = 1_000, 10_000
# Schemes whose paths begin with a bucket.
BUCKETS = ("s3", "s3a", "s3n", "gs")


def _opened(location: str) -> tuple[fs.FileSystem, str, str]:
    """File system of a location, the place in it, and what Spark writes before places."""
    scheme, _, rest = location.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/"), "file:"
    authority, _, place = rest.lstrip("/").partition("/")
    if scheme in BUCKETS:
        root = f"{'gs' if scheme == 'gs' else 's3'}://{authority}"
        return fs.FileSystem.from_uri(root)[0], f"{authority}/{place}", f"{scheme}://"
    return fs.FileSystem.from_uri(f"{scheme}://{authority}/")[0], f"/{place}", f"{scheme}://{authority}"


class FolderListing(DataSource):
    """Every file below ``path``, hidden ones too: path, modificationTime, length."""

    @classmethod
    def name(cls) -> str:
        return "folder_listing"

    def schema(self) -> str:
        return LISTING

    def reader(self, schema) -> DataSourceReader:
        return _FolderReader(self.options["path"])


class _FolderReader(DataSourceReader):
    def __init__(self, location: str):
        self.location = location

    def partitions(self) -> list[InputPartition]:
        """The folders right below, dealt to tasks, and the files that lie beside them."""
        system, place, _ = _opened(self.location)
        found = system.get_file_info(fs.FileSelector(place))
        folders = sorted(f.path for f in found if f.type == fs.FileType.Directory)
        dealt = [folders[i::TASKS] for i in range(min(TASKS, len(folders)))]
        return [InputPartition((False, [place])), *[InputPartition((True, part)) for part in dealt]]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        system, _, prefix = _opened(self.location)
        deep, folders = partition.value
        for folder in folders:
            found = system.get_file_info(fs.FileSelector(folder, recursive=deep))
            files = [f for f in found if f.type == fs.FileType.File]
            for i in range(0, len(files), BATCH):
                part = files[i : i + BATCH]
                # Whole milliseconds, as scans give them.
                times = pa.array([(f.mtime_ns or 0) // 1_000_000 * 1_000 for f in part], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([prefix + f.path for f in part], pa.string()),
                        times.cast(pa.timestamp("us", tz="UTC")),
                        pa.array([f.size for f in part], pa.int64()),
                    ],
                    names=["path", "modificationTime", "length"],
                )


def qualified_location(spark: SparkSession, path: str) -> str:
    """The path with scheme and authority, as the session's file systems complete it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


def all_files(spark: SparkSession, path: str) -> DataFrame | None:
    """Files below ``path`` that scans would see, those without a byte too; null where tasks cannot list its file system."""
    location = qualified_location(spark, path)
    try:
        _opened(location)
    except (pa.ArrowException, OSError, ImportError):
        return None
    show_package(spark)
    spark.dataSource.register(FolderListing)
    below = F.substring("path", F.lit(len(location.rstrip("/")) + 1), F.length("path"))
    # Fixed rule: names that begin with a dot, or with an underscore and hold no "=", and unfinished copies are hidden.
    hidden = below.rlike(r"/(?:\.|_[^/=]*(?:/|$))") | F.col("path").endswith("._COPYING_")
    return spark.read.format("folder_listing").load(location).filter(~hidden)
