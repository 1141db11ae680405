"""Names: columns, tables, files and locations."""

import datetime as dt
import re

from pyspark.errors import PySparkException
from pyspark.sql import Column, functions as F

# File extension -> format.
FORMATS = {"csv": "csv", "tsv": "tsv", "json": "json", "txt": "text", "xml": "xml"}


def clean_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def base_name(path: Column) -> Column:
    """Last path segment."""
    return F.regexp_extract(path, r"([^/]*)$", 1)


def extension(path: Column) -> Column:
    """Lower-cased extension without the dot, empty when there is none."""
    return F.lower(F.regexp_extract(base_name(path), r"^.+\.([^.]*)$", 1))


def file_format(path: Column) -> Column:
    """Format decided by the extension, null when unsupported."""
    pairs = [F.lit(x) for pair in FORMATS.items() for x in pair]
    return F.create_map(*pairs)[extension(path)]


def unit_path(path: Column) -> Column:
    """What was delivered: the file, or the folder of part files named like a file.

    ``in/a.csv/part-0.csv`` belongs to ``in/a.csv``.
    """
    extensions = "|".join(FORMATS)
    return F.regexp_replace(path, rf"(?i)^(.*?\.(?:{extensions}))/.+$", "$1")


def inside_folder(path: Column) -> Column:
    """Does the file lie in a delivered folder?"""
    return path.rlike(rf"(?i)\.(?:{'|'.join(FORMATS)})/")


def table_name(path: Column, lower: bool = False, prefix: str = "") -> Column:
    """Table name of a file: base name without its extension."""
    base = F.regexp_replace(base_name(path), r"(?<=.)\.[^.]*$", "")
    return F.concat(F.lit(prefix), F.lower(base) if lower else base)


def catalog_name(name: str) -> str:
    """A table name the catalog accepts: letters, digits and underscores."""
    return re.sub(r"[^A-Za-z0-9_]", "_", name)


def decoded(path: Column) -> Column:
    """A path or file name as written on disk; Spark's file metadata is percent-encoded."""
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.when(path.contains("%"), plain).otherwise(path)


def key_matches(path: Column, prefix: str = "", suffix: str = ".csv") -> Column:
    return path.startswith(prefix) & path.endswith(suffix)


def target_location(base: Column, table: Column) -> Column:
    return F.concat(F.regexp_replace(base, "/+$", ""), F.lit("/"), table, F.lit("/"))


def parent_location(path: Column) -> Column:
    """The folder itself for a folder path, the parent folder for a file path."""
    return F.regexp_replace(path, "[^/]+$", "")


def version_suffix(run_ts: dt.datetime) -> str:
    """Ends the name of the side table that takes rows whose schema does not fit."""
    return f"__v{run_ts:%Y%m%d_%H%M%S}"


def join_location(base: str, *parts: str) -> str:
    return "/".join([base.rstrip("/"), *[p.strip("/") for p in parts]])


def _any_case(text: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.lower() != c.upper() else c for c in text)


def literal_path(path: str) -> str:
    """A path that readers take as it is and not as a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def glob_for(table: str, fmt: str, any_case: bool = False) -> str:
    """Glob that matches ``<table>.<ext>`` with the extension, or all of it, in any case."""
    ext = next(e for e, f in FORMATS.items() if f == fmt)
    stem = literal_path(table)
    return (_any_case(stem) if any_case else stem) + "." + _any_case(ext)


def failure_text(error: Exception) -> str:
    """One line saying what went wrong."""
    if isinstance(error, PySparkException):
        raised = (error.getMessageParameters() or {}).get("errorMessage")
        if raised:
            return raised
    return (str(error) or type(error).__name__).split("\n")[0]
