"""Ingest a zone of mixed files: discover, infer, register, publish, summarise."""

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from landfall.functions.names import (
    catalog_name, failure_text, file_format, glob_for, join_location, literal_path, table_name, version_suffix,
)
from landfall.operators.audit import batch_log, process_id
from landfall.operators.clean import INGEST_COLUMNS, add_ingest_columns, fill_blank_names
from landfall.operators.infer import (
    ColumnSpec, collect_columns, infer_json, infer_table, storage_schema, storage_values, text_schema,
)
from landfall.operators.publish import READ_BACK, put_runs, write_files
from landfall.operators.tables import ensure_database, ensure_table, qualified, table_exists, table_source, upsert_table
from landfall.sources.files import LOOSE, empty_files, list_files
from landfall.sources.readers import LONG, checked_rows, infer_xml, parse_json, read_csv, read_json, read_text, read_tsv, read_xml
from landfall.sources.records import json_forms, json_records, line_object, xml_tags
from landfall.sources.xml_records import cut_xml
from landfall.workspace import written

STATUS = "source_file string, table_name string, status string, row_count bigint, message string"
EMPTY = "{} appears empty or unreadable."

# Carries the name of the source file where rows are cut from record texts.
SOURCE_COLUMN = "_source_file"

# Groups of up to so many files are read by path, larger ones by a pattern that passes over delivered folders.
PATHS_READ = 100

# Marks a name delivered as several folders, or as folder and file.
AMBIGUOUS = "?"


class FileGroup(NamedTuple):
    """The files of a zone that share a base name and format; they form one table.

    ``folder`` is set when they are the part files of one delivered folder;
    otherwise ``files`` counts them and ``first`` is one of them. ``hidden``
    files of that name lie in delivered folders and belong to those.
    """

    base: str
    fmt: str
    table: str
    folder: str | None = None
    files: int = 1
    first: str | None = None
    hidden: int = 0


class Landed(NamedTuple):
    columns: list[ColumnSpec]
    data: DataFrame
    source: str
    options: dict[str, str]
    source_column: str | None = None
    note: str = ""
    registered: bool = True


def file_groups(files: DataFrame, suffix_format: bool = False) -> list[FileGroup]:
    """One entry per base name and format, each with a table of its own.

    The format is added to the table name where two formats share a base name,
    or always with ``suffix_format``. Names the catalog takes for the same get
    a number.
    """
    is_folder = F.col("unit") != F.col("path")
    groups = files.groupBy("table_name", "format").agg(
        F.min(F.when(is_folder, F.col("unit"))).alias("folder"),
        F.max(F.when(is_folder, F.col("unit"))).alias("last_folder"),
        F.count(F.when(~is_folder, 1)).alias("files"),
        F.min(F.when(~is_folder, F.col("path"))).alias("first"),
    )
    inner = files.filter(is_folder).select(table_name(F.col("path")).alias("table_name"), file_format(F.col("path")).alias("format"))
    groups = groups.join(inner.groupBy("table_name", "format").agg(F.count("*").alias("hidden")), ["table_name", "format"], "left")
    shared = groups.groupBy("table_name").agg(F.count("*").alias("formats"))
    rows = groups.join(shared, "table_name").orderBy("table_name", "format").collect()
    result, taken = [], set()
    for r in rows:
        suffix = suffix_format or r["formats"] > 1
        stem = catalog_name(f"{r['table_name']}_{r['format']}" if suffix else r["table_name"])
        name, n = stem, 1
        while name.lower() in taken:
            n += 1
            name = f"{stem}_{n}"
        taken.add(name.lower())
        folder = r["folder"]
        if folder and (folder != r["last_folder"] or r["files"]):
            folder = AMBIGUOUS
        result.append(FileGroup(r["table_name"], r["format"], name, folder, r["files"], r["first"], r["hidden"] or 0))
    return result


def _checked_columns(rows: DataFrame, detect_types: bool) -> tuple[list[ColumnSpec], int]:
    """Columns of checked rows and how many records are too long, in one scan."""
    values = [c for c in rows.columns if c != LONG]
    if not detect_types:
        return collect_columns(infer_table(rows.drop(LONG), False)), rows.filter(F.col(LONG).isNotNull()).count()
    seen = Observation()
    counted = rows.observe(seen, F.count(LONG).alias("long"))
    return collect_columns(infer_table(counted.select(*[F.col(f"`{c}`") for c in values]))), seen.get["long"]


def land_files(
    spark: SparkSession,
    path: str | list[str],
    fmt: str,
    detect_types: bool = False,
    row_tag: str | None = None,
    bad_lines: str = "fail",
    long_lines: str = "fail",
    **options,
) -> Landed:
    """Infer the columns of some files and read them in that column order.

    Values come back as text where the columns are text or the file is, so
    nothing is lost on the way to another text format. A delimited row with
    more fields than the header fails the files; ``long_lines="cut"`` drops the
    fields beyond it and notes the number of rows. All files of a table must
    share a header.
    """
    if fmt in ("csv", "tsv"):
        options = {"enforceSchema": "false", **options}
        df = fill_blank_names((read_tsv if fmt == "tsv" else read_csv)(spark, path, **options))
        if not df.columns:
            raise ValueError(EMPTY.format(fmt.upper()))
        columns, rows = _checked_columns(checked_rows(spark, path, fmt, **options), detect_types)
        if rows and long_lines != "cut":
            raise ValueError("a row is longer than the header")
        note = f"{rows} rows cut to the header" if rows else ""
        sep = {"sep": "\t"} if fmt == "tsv" else {}
        return Landed(columns, df, "csv", {"header": "true", "escape": '"', **sep}, note=note)
    if fmt == "json":
        forms = json_forms(spark, path, **options)
        document = any(forms.values())
        if not document:
            records = json_records(spark, path, False, **options)
        else:
            records = written(spark, json_records(spark, path, True if all(forms.values()) else None, **options), "json-objects")
        columns = collect_columns(infer_json(records, bad_lines))
        if not columns:
            raise ValueError(EMPTY.format("JSON"))
        shape, line_options = text_schema(columns), {"multiLine": str(document).lower()}
        if document:
            # No table entry reads lines and documents alike.
            alike = all(forms.values())
            if not alike and bad_lines == "skip":
                records = records.filter(line_object(F.col("value")).isNotNull())
            return Landed(
                columns, parse_json(records, shape, SOURCE_COLUMN), "json", line_options, SOURCE_COLUMN,
                "" if alike else "landing table not registered: some files hold lines, some documents", alike,
            )
        mode = {"mode": "DROPMALFORMED"} if bad_lines == "skip" else {}
        return Landed(columns, read_json(spark, path, shape, False, **options, **mode), "json", line_options)
    if fmt == "xml":
        root, tag = xml_tags(spark, path, **options)
        if root is None:
            fmt = "text"
        else:
            row_tag = row_tag or tag
            if row_tag is None:
                raise ValueError("XML has no records.")
            # Cut once for both, where the files are large.
            records = cut_xml(spark, path, row_tag, **options)
            split = None if records is not None else False
            columns = collect_columns(infer_xml(spark, path, row_tag, split=split, records=records, **options))
            if not columns:
                raise ValueError("XML has no records.")
            df = read_xml(
                spark, path, row_tag, text_schema(columns), SOURCE_COLUMN, split=split, records=records, **options
            )
            return Landed(columns, df, "xml", {"rowTag": row_tag}, SOURCE_COLUMN)
    if fmt == "text":
        return Landed([ColumnSpec("line", "string")], read_text(spark, path, **options), "text", {})
    raise ValueError(f"unsupported format {fmt}")


# Types a value of the other type can be stored as without loss.
WIDER = {
    ("bigint", "double"), ("bigint", "decimal(38,0)"), ("int", "bigint"), ("int", "double"), ("int", "decimal(38,0)"),
}


def _holds(have: str, storage: str) -> bool:
    return have == "string" or have == storage or (storage, have) in WIDER


def _target_table(
    spark: SparkSession,
    db: str,
    table: str,
    columns: list[ColumnSpec],
    source: str,
    on_mismatch: str,
    run_ts: dt.datetime,
) -> tuple[str, list[str] | None]:
    """Table to publish to and, if it exists and fits, its columns.

    An existing table fits when it has the same file format and every incoming
    column in a type that holds its values: the same, text, or a wider number.
    If it does not, a versioned table takes the rows, or the ingest of the file
    fails with ``on_mismatch="fail"``.
    """
    if not table_exists(spark, db, table):
        return table, None
    have = spark.table(qualified(db, table)).schema
    types = {f.name.strip().lower(): f.dataType.simpleString() for f in have}
    missing = {c.name.strip().lower() for c in columns} - types.keys()
    narrow = [] if missing else [c.name for c in columns if not _holds(types[c.name.strip().lower()], c.storage)]
    kind = table_source(spark, db, table)[0]
    if not missing and not narrow and kind == source:
        return table, have.names
    if on_mismatch == "fail":
        reason = f"{kind} files, not {source}"
        if missing or narrow:
            reason = f"columns missing: {sorted(missing)}" if missing else f"types too narrow: {sorted(narrow)}"
        raise ValueError(f"{db}.{table} does not fit: {reason}")
    return table + version_suffix(run_ts), None


def sync_group(
    spark: SparkSession,
    group: FileGroup,
    path: str | list[str],
    target: str,
    landing_db: str,
    curated_db: str,
    run_ts: dt.datetime,
    job: str,
    on_mismatch: str = "version",
    ingest_columns: bool = False,
    max_files: int | None = None,
    balanced: bool = False,
    target_part: str | None = None,
    read_options: dict[str, str] | None = None,
    landing_path: str | None = None,
    landing_options: dict[str, str] | None = None,
    **land_options,
) -> tuple[str, int, str]:
    """Register and publish one group of files. Returns the table used, its row count and a note.

    Each run writes to a folder of its own. Without ``target_part`` the table
    then moves there, so a failed write leaves it as it was; with it the rows
    are added in that folder below the place where the table lies.
    """
    options = read_options or {}
    landed = land_files(spark, path, group.fmt, **land_options, **options)
    if group.hidden and not group.folder:
        note = "landing table not registered: delivered folders hold files of that name"
        landed = landed._replace(registered=False, note="; ".join(filter(None, [landed.note, note])))
    if landed.registered:
        ensure_table(
            spark, landing_db, group.table, landing_path or path, storage_schema(landed.columns), landed.source,
            **(landing_options or options), **landed.options,
        )

    source = "text" if landed.source == "text" and not ingest_columns else "csv"
    table, existing = _target_table(spark, curated_db, group.table, landed.columns, source, on_mismatch, run_ts)
    df = landed.data
    if ingest_columns:
        origin = F.col(landed.source_column) if landed.source_column else None
        df = add_ingest_columns(df, run_ts, job, source=origin)
    stamps = [F.col(c) for c in INGEST_COLUMNS] if ingest_columns else []
    df = df.select(*storage_values(landed.data, landed.columns), *stamps)
    if existing:
        present = {c.strip().lower() for c in df.columns}
        df = df.select(
            *[F.col(f"`{c}`") if c.strip().lower() in present else F.lit(None).cast("string").alias(c) for c in existing]
        )
    base = join_location(target, table)
    if target_part:
        home = table_source(spark, curated_db, table)[1] if existing else base
        place = join_location(home, target_part)
    else:
        home = place = join_location(base, f"run-{run_ts:%Y%m%d_%H%M%S}-{uuid.uuid4().hex[:8]}")
    rows = write_files(df, place, source, max_files=max_files, balanced=balanced)
    schema = spark.table(qualified(curated_db, table)).schema if existing else df.schema
    upsert_table(spark, curated_db, table, home, schema, source, recursiveFileLookup="true", **READ_BACK.get(source, {}))
    if landed.registered:
        spark.catalog.refreshTable(qualified(landing_db, group.table))
    spark.catalog.refreshTable(qualified(curated_db, table))
    return table, rows, landed.note


def sync_files(
    spark: SparkSession,
    source: str,
    target: str,
    landing_db: str,
    curated_db: str,
    run_ts: dt.datetime | None = None,
    job: str = "sync_files",
    suffix_format: bool = False,
    formats: list[str] | None = None,
    workers: int = 4,
    log_db: str | None = None,
    log_table: str = "batch_log",
    batch_id: str | None = None,
    **options,
) -> DataFrame:
    """Ingest every supported file below ``source``.

    Files with the same base name and format are read together as one table; a
    folder of part files named like a file counts as that file. A group that
    fails, or has no byte, gets a FAILED status and does not stop the others.
    Returns source_file, table_name, status, row_count, message; with ``log_db``
    the same goes to the batch log table.

    Options: detect_types, row_tag, bad_lines, long_lines, on_mismatch,
    ingest_columns, max_files, balanced.
    """
    run_ts = run_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    ensure_database(spark, landing_db)
    ensure_database(spark, curated_db)
    # Listed once; a group of few files is read by their paths.
    listed = written(spark, list_files(spark, source, formats), "listing")
    groups = file_groups(listed, suffix_format)
    sizes = spark.createDataFrame(
        [(g.base, g.fmt) for g in groups if not g.folder and g.files <= PATHS_READ], "table_name string, format string"
    )
    loose = listed.filter(F.col("unit") == F.col("path")).join(F.broadcast(sizes), ["table_name", "format"])
    few = loose.groupBy("table_name", "format").agg(F.collect_list("path").alias("paths"))
    places = {(r["table_name"], r["format"]): r["paths"] for r in few.collect()}
    nothing = empty_files(spark, source, listed, formats).orderBy("unit").collect()

    def one(group: FileGroup) -> tuple:
        path, reading = source, {"recursiveFileLookup": "true"}
        landing = dict(reading)
        if group.folder:
            path = group.folder
        else:
            landing["pathGlobFilter"] = glob_for(group.base, group.fmt)
            paths = places.get((group.base, group.fmt))
            if paths:
                path = [literal_path(p) for p in paths]
            else:
                reading = {**landing, LOOSE: literal_path(group.first)}
        label = f"{group.base}.{'txt' if group.fmt == 'text' else group.fmt}"
        try:
            if group.folder == AMBIGUOUS:
                raise ValueError(f"{label} was delivered in several places")
            table, rows, note = sync_group(
                spark, group, path, target, landing_db, curated_db, run_ts, job,
                read_options=reading, landing_path=group.folder or source, landing_options=landing, **options,
            )
        except Exception as error:  # one bad file must not stop the others
            reason = failure_text(error)
            return label, group.table, f"FAILED: {reason}", None, reason
        return label, table, "SUCCEEDED", rows, note

    with ThreadPoolExecutor(max_workers=workers) as pool:
        rows = list(pool.map(one, groups))
    for r in nothing:
        reason = EMPTY.format(r["format"].upper())
        rows.append((f"{r['table_name']}.{r['unit'].rpartition('.')[2].lower()}", catalog_name(r["table_name"]), f"FAILED: {reason}", None, reason))
    statuses = spark.createDataFrame(rows, STATUS)
    if log_db:
        ensure_database(spark, log_db)
        finished = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        logged = batch_log(statuses, batch_id or process_id(run_ts), run_ts, finished)
        put_runs(spark, logged, log_db, log_table, join_location(target, log_table), "batch_id")
    return statuses
