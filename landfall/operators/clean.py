"""Cleaning: column names, repeated headers and ingest columns."""

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F

from landfall.functions.names import clean_name, decoded

# Default names of the ingest columns, all strings.
INGEST_COLUMNS = ["ingestion_timestamp", "source_filename", "job_name", "record_status"]


def normalize_names(df: DataFrame) -> DataFrame:
    """Trim, lower and put underscores for spaces in every column name."""
    return df.toDF(*[clean_name(c) for c in df.columns])


def fill_blank_names(df: DataFrame) -> DataFrame:
    """Trim header names; a blank header cell becomes ``col_<position>``."""
    names = []
    for i, name in enumerate(df.columns):
        blank = not name.strip() or name == f"_c{i}"
        names.append(f"col_{i + 1}" if blank else name.strip())
    return df.toDF(*names)


def drop_repeated_header(df: DataFrame, first_column_only: bool = False) -> DataFrame:
    """Drop rows that repeat the column names.

    A row goes when every column equals its own name, or only the first one if
    asked. Rows whose first column is null stay. No row order is assumed.
    """
    names = df.columns[:1] if first_column_only else df.columns
    repeated = F.lit(True)
    for name in names:
        repeated = repeated & df[f"`{name}`"].cast("string").eqNullSafe(F.lit(name))
    return df.filter(~repeated)


def source_name(df: DataFrame) -> Column:
    """File name each row was read from, empty when rows do not come from files."""
    try:
        df.select("_metadata.file_name")
    except AnalysisException:
        return F.lit("")
    return decoded(F.col("_metadata.file_name"))


def add_ingest_columns(
    df: DataFrame,
    run_ts: dt.datetime,
    job: str,
    status: str = "ACTIVE",
    source: str | Column | None = None,
    names: list[str] = INGEST_COLUMNS,
) -> DataFrame:
    """Stamp run time, source file, job and status on every row, as strings."""
    if source is None:
        source = source_name(df)
    elif isinstance(source, str):
        source = F.lit(source)
    values = [F.lit(run_ts.strftime("%Y-%m-%dT%H:%M:%S")), source, F.lit(job), F.lit(status)]
    return df.select("*", *[v.cast("string").alias(n) for v, n in zip(values, names, strict=True)])
