import datetime as dt
import json

import pytest
from gauges import READING_COLUMNS, READINGS, readings
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall import workspace
from landfall.functions.names import (
    file_format, glob_for, key_matches, parent_location, table_name, target_location, version_suffix,
)
from landfall.operators import audit, clean, publish, schema, tables
from landfall.sources import files, readers

TS = dt.datetime(2031, 4, 5, 6, 7, 8)


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def inventory(spark, rows):
    return spark.createDataFrame([(*r[:3], i + 1, *r[3:]) for i, r in enumerate(rows)], schema.INVENTORY)


# --- names and files


def test_names(spark):
    lit = F.lit
    assert one(spark, table_name(lit("/a/b/Sales.2025.csv"))) == "Sales.2025"
    assert one(spark, table_name(lit("/a/b/Sales.CSV"), lower=True, prefix="fdp_")) == "fdp_sales"
    assert one(spark, table_name(lit("plain"))) == "plain"
    assert one(spark, file_format(lit("a/X.TSV"))) == "tsv"
    assert one(spark, file_format(lit("a/x.parquet"))) is None
    assert one(spark, target_location(lit("s/base//"), lit("t"))) == "s/base/t/"
    assert one(spark, parent_location(lit("s/base/f.csv"))) == "s/base/"
    assert one(spark, parent_location(lit("s/base/"))) == "s/base/"
    assert version_suffix(TS) == "__v20310405_060708"
    assert one(spark, key_matches(lit("in/x.csv"), "in/", ".csv")) is True
    assert one(spark, key_matches(lit("in/x.CSV"), "in/", ".csv")) is False
    assert glob_for("a[1]", "csv") == r"a\[1\].[cC][sS][vV]"


def test_file_listing(spark, zone):
    for name in ("a.csv", "b.JSON", "c.parquet", "sub/d.txt", "e.xml", "f.tsv"):
        zone(name, "x")
    found = {(r["table_name"], r["format"]) for r in files.list_files(spark, zone.path).collect()}
    assert found == {("a", "csv"), ("b", "json"), ("d", "text"), ("e", "xml"), ("f", "tsv")}
    assert files.list_files(spark, zone.path, ["tsv"]).count() == 1
    assert files.list_keys(spark, zone.path).count() == 1


def test_listing_reads_no_content(spark, zone):
    zone("a.csv", "x")
    plan = files.list_files(spark, zone.path)._jdf.queryExecution().executedPlan().toString()
    read = plan[plan.index("ReadSchema"):]
    assert "path" in read and "content" not in read, plan


def test_latest_and_first(spark, zone):
    for name in ("b/1.csv", "a/3.csv", "c/2.csv"):
        zone(name, "v\n" + name[0])
    listed = files.list_keys(spark, zone.path)
    assert files.latest_file(listed).first()["file_name"] == "3.csv"
    df, path = readers.read_first_csv(spark, zone.path)
    assert path.endswith("a/3.csv") and df.first()["v"] == "a"
    with pytest.raises(FileNotFoundError):
        readers.read_first_csv(spark, zone("empty/x.txt", "").rpartition("/")[0])


def test_latest_per_group(spark):
    df = spark.createDataFrame([("a", "z/1"), ("a", "b/2"), ("a", "c/2"), ("b", "q/9")], "g string, path string")
    got = {(r["g"], r["path"]) for r in files.latest_file(df, "g").collect()}
    assert got == {("a", "c/2"), ("b", "q/9")}


# --- readers


@pytest.mark.parametrize("fmt", ["csv", "tsv", "json", "ndjson", "xml", "txt"])
def test_readers(spark, zone, fmt):
    ext = "json" if fmt == "ndjson" else fmt
    df = readers.read_landing(spark, zone(f"c.{ext}", readings(fmt)), ext)
    assert df.count() == 3
    if fmt == "txt":
        assert df.columns == ["line"]
    else:
        assert set(df.columns) == set(READING_COLUMNS)
        assert {r["gauge"] for r in df.collect()} == {r[0] for r in READINGS}


def test_unknown_extension_is_csv(spark, zone):
    assert readers.read_landing(spark, zone("c.dat", "a,b\n1,2"), ".dat").columns == ["a", "b"]


def test_xml_other_row_tag(spark, zone):
    path = zone("o.xml", "<records><record><a>1</a></record><record><a>2</a></record></records>")
    assert readers.read_xml(spark, path, "record").count() == 2
    with pytest.raises(ValueError, match="no records"):
        readers.read_xml(spark, zone("none.xml", "<records></records>"))


def test_long_rows(spark, zone):
    path = zone("l.csv", 'a,b\n1,2\n1\n1,2,3\n"x,y",2\n')
    assert [r["line"] for r in readers.long_rows(spark, path).collect()] == ["1,2,3"]


# --- cleaning


def test_normalize_names(spark):
    assert clean.normalize_names(spark.sql("select 1 ` First Name `, 2 `B`")).columns == ["first_name", "b"]


def test_repeated_header(spark):
    rows = [("a", "b"), ("1", "2"), (None, "b"), ("a", "x"), (None, None), ("a", "b")]
    df = spark.createDataFrame(rows, "a string, b string")
    assert sorted(map(tuple, clean.drop_repeated_header(df).collect()), key=str) == sorted(
        [("1", "2"), (None, "b"), ("a", "x"), (None, None)], key=str
    )
    assert clean.drop_repeated_header(df, first_column_only=True).count() == 3


def test_ingest_columns(spark, zone):
    df = readers.read_csv(spark, zone("in.csv", "a\n1"))
    row = clean.add_ingest_columns(df, TS, "job").first()
    assert row.asDict() == {
        "a": "1", "ingestion_timestamp": "2031-04-05T06:07:08", "source_filename": "in.csv",
        "job_name": "job", "record_status": "ACTIVE",
    }
    assert clean.add_ingest_columns(spark.range(1), TS, "job", names=["w", "x", "y", "z"]).columns == ["id", "w", "x", "y", "z"]


# --- schemas

DRIFT = {
    "2025": [("col1", "string"), ("col2", "int"), ("col3", "string"), ("col4", "double"), ("col5", "string")],
    "2026": [("col1", "string"), ("col2", "string"), ("col3", "int"), ("col4", "double"), ("col5", "string"),
             ("col6", "string"), ("col7", "string")],
}


def test_diff(spark):
    left = inventory(spark, [("l", "t", 1, *c) for c in DRIFT["2025"]])
    right = inventory(spark, [("r", "t", 1, *c) for c in DRIFT["2026"]])
    got = {r["name"]: r["status"] for r in schema.diff(left, right).collect()}
    assert got == {
        "col1": "SAME", "col2": "TYPE_CHANGED", "col3": "TYPE_CHANGED", "col4": "SAME", "col5": "SAME",
        "col6": "ADDED", "col7": "ADDED",
    }
    back = {r["name"]: r["status"] for r in schema.diff(right, left).collect()}
    assert back["col6"] == "REMOVED"
    assert schema.missing_columns(left, right).count() == 0
    assert sorted(r["name"] for r in schema.missing_columns(right, left).collect()) == ["col6", "col7"]
    assert schema.tolerant_match(left, right).first()["matches"] is True
    assert schema.tolerant_match(right, left).first()["matches"] is False


def test_equal_modulo_order_case_and_ingest_columns(spark):
    landing = inventory(spark, [("l", "t", 1, "A ", "INT"), ("l", "t", 1, "b", "string")])
    curated = inventory(spark, [("c", "t", 1, "b", "String"), ("c", "t", 1, "a", "int"), ("c", "t", 1, "job_name", "string")])
    assert schema.compare_zones(landing, curated, ignore=["job_name"]).first()["mismatch"] is False
    assert schema.compare_zones(landing, curated).first()["mismatch"] is True


def test_evolution(spark):
    rows = [("l", "t", 1, "a", "int"), ("l", "t", 2, "A", "int"), ("l", "t", 3, "a", "double"), ("l", "u", 1, "a", "int")]
    versions = inventory(spark, rows)
    got = {(r["tbl"], r["version"]): r["evolved"] for r in schema.evolution(versions).collect()}
    assert got == {("t", 1): True, ("t", 2): False, ("t", 3): True, ("u", 1): True}
    newest = {r["tbl"]: r["version"] for r in schema.current_evolution(versions).collect()}
    assert newest == {"t": 3, "u": 1}


@pytest.mark.parametrize(
    "landing, evolved, target, mismatch, action, changed",
    [
        (True, True, True, True, "UPDATE_FDP", "YES"),
        (True, True, True, False, "UPDATE_FDP", "YES"),
        (True, True, False, False, "CREATE_FDP", "YES"),
        (True, False, True, True, "SYNC_FDP_SCHEMA", "YES"),
        (True, False, True, False, "NO_OP", "NO"),
        (True, False, False, False, "CREATE_FDP", "NO"),
        (False, False, True, False, "LANDING_MISSING", "NO"),
    ],
)
def test_decision_table(spark, landing, evolved, target, mismatch, action, changed):
    df = spark.createDataFrame(
        [("t", landing, evolved, target, mismatch)],
        "tbl string, landing_exists boolean, evolved boolean, target_exists boolean, mismatch boolean",
    )
    row = schema.decide(df).first()
    assert (row["action"], row["schema_changed"]) == (action, changed)


def test_report(spark):
    landing = inventory(spark, [("l", "t", 1, "z", "int"), ("l", "t", 1, "a", "string")])
    decisions = spark.createDataFrame([("t", "NO_OP", "NO"), ("gone", "LANDING_MISSING", "NO")], "tbl string, action string, schema_changed string")
    rows = schema.report(decisions, landing, "l", TS).collect()
    assert len(rows) == 1
    assert (rows[0]["Table"], rows[0]["Database"], rows[0]["SchemaChanged"], rows[0]["Timestamp"]) == ("t", "l", "NO", "20310405_060708Z")
    assert json.loads(rows[0]["Details"]) == [{"Name": "z", "Type": "int"}, {"Name": "a", "Type": "string"}]


def test_versioned_targets(spark):
    matches = spark.createDataFrame([("a", True), ("b", False)], "tbl string, matches boolean")
    got = {r["tbl"]: r["target"] for r in schema.versioned_targets(matches, TS).collect()}
    assert got == {"a": "a", "b": "b__v20310405_060708"}


# --- sinks


@pytest.mark.parametrize("fmt", ["csv", "tsv", "json", "xml", "parquet"])
def test_write_and_read_back(spark, tmp_path, fmt):
    df = spark.createDataFrame([(1, "a,b", 1.5), (2, "x\ty", None)], "i int, s string, d double")
    path = str(tmp_path / fmt)
    assert publish.write_files(df, path, fmt) == 2
    back = spark.read.parquet(path) if fmt == "parquet" else readers.read_landing(
        spark, path, fmt, schema=df.schema, **({"row_tag": "record"} if fmt == "xml" else {}))
    assert sorted(map(tuple, back.collect())) == [(1, "a,b", 1.5), (2, "x\ty", None)]


def test_few_files(spark, tmp_path):
    path = tmp_path / "few"
    df = spark.range(0, 100, 1, 8)
    publish.write_files(df, str(path), max_files=1)
    assert len(list(path.glob("part-*"))) == 1
    publish.write_files(df, str(path), max_files=1, max_records_per_file=30)
    assert len(list(path.glob("part-*"))) == 4
    assert readers.read_csv(spark, str(path)).count() == 100


ODD_TEXTS = ["  pad  ", "x\ny", 'q"u"o', "a,b", "tab\tbed", "back\\slash", "\\", '"', "\r\n", "", "é"]


@pytest.mark.parametrize("fmt", ["csv", "tsv"])
def test_delimited_files_keep_every_value(spark, db, tmp_path, fmt):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ODD_TEXTS)], "i int, s string")
    publish.write_catalog_files(spark, df, db[1], "odd", str(tmp_path / "odd"), fmt, "overwrite")
    assert [r["s"] for r in spark.table(f"{db[1]}.odd").orderBy("i").collect()] == ODD_TEXTS


def test_catalog_append_matches_names(spark, db, tmp_path):
    place = str(tmp_path / "t")
    df = spark.createDataFrame([("A", "B")], "a string, b string")
    for part in (df, df.select("b", "a")):
        publish.write_catalog_files(spark, part, db[1], "t", place)
    assert [tuple(r) for r in spark.table(f"{db[1]}.t").collect()] == [("A", "B")] * 2
    with pytest.raises(ValueError, match="has columns"):
        publish.write_catalog_files(spark, df.withColumn("c", F.lit(1)), db[1], "t", place)


def test_unused_folders(spark, db, tmp_path):
    place = str(tmp_path / "t")
    for run in ("one", "two"):
        publish.replace_table(spark, spark.range(3), db[1], "t", place, run_id=run)
    assert publish.unused_folders(spark, db[1], "t", place) == [f"{place}/one"]


def test_write_modes(spark, tmp_path):
    path = str(tmp_path / "m")
    for mode, rows in (("overwrite", 3), ("append", 6), ("overwrite", 3)):
        publish.write_files(spark.range(3), path, "csv", mode)
        assert readers.read_csv(spark, path).count() == rows


def test_replace_and_append_table(spark, db, tmp_path):
    _, curated = db
    place = str(tmp_path / "t")
    assert publish.replace_table(spark, spark.range(3), curated, "t", place) == 3
    assert publish.append_table(spark, spark.range(2), curated, "t", place) == 2
    assert spark.table(f"{curated}.t").count() == 5
    again = spark.table(f"{curated}.t").select(F.col("id").cast("string").alias("id"), F.lit(1).alias("n"))
    assert publish.replace_table(spark, again, curated, "t", place) == 5
    assert spark.table(f"{curated}.t").dtypes == [("id", "string"), ("n", "int")]
    assert spark.table(f"{curated}.t").count() == 5


@pytest.mark.parametrize("fmt", ["json", "xml"])
def test_copy_records(spark, zone, tmp_path, fmt):
    target = str(tmp_path / "copy")
    assert publish.copy_files(spark, zone(f"c.{fmt}", readings(fmt)), target, fmt) == 3
    back = readers.read_landing(spark, target, fmt)
    assert set(back.columns) == set(READING_COLUMNS) and back.filter("flow = 77051").count() == 1


def test_copy_files(spark, zone, tmp_path):
    target = str(tmp_path / "copy")
    assert publish.copy_files(spark, zone("c.csv", readings("csv")), target, "csv") == 3
    assert readers.read_csv(spark, target).columns == READING_COLUMNS


# --- catalog


def test_ensure_table_once(spark, db, zone):
    landing, _ = db
    path = zone("c.csv", "a,b\n1,x")
    shape = T.StructType.fromDDL("a bigint, b string")
    assert tables.ensure_table(spark, landing, "c", path, shape) is True
    assert tables.ensure_table(spark, landing, "c", path, T.StructType.fromDDL("z int")) is False
    assert [tuple(r) for r in tables.lookup(spark, landing, "c").collect()] == [(1, "x")]
    assert tables.lookup(spark, landing, "nothing") is None


def test_prefix_listing(spark, db, zone):
    landing, _ = db
    path = zone("c.csv", "a\n1")
    for name in ("in_a", "in_b", "out_a", "inx"):
        tables.ensure_table(spark, landing, name, path, T.StructType.fromDDL("a string"))
    assert tables.list_tables(spark, landing, "in_") == ["in_a", "in_b"]
    assert len(tables.list_tables(spark, landing)) == 4


def test_upsert(spark, db, tmp_path):
    _, curated = db
    place = str(tmp_path / "u")
    publish.write_files(spark.range(4).select("id"), place)
    ddl = T.StructType.fromDDL
    assert tables.upsert_table(spark, curated, "u", place, ddl("id bigint")) == "CREATED"
    assert tables.upsert_table(spark, curated, "u", place, ddl("id bigint")) == "UNCHANGED"
    tables.set_properties(spark, curated, "u", {"owner_note": "it's"})
    assert tables.upsert_table(spark, curated, "u", place, ddl("id bigint, n string")) == "EXTENDED"
    assert spark.table(f"{curated}.u").columns == ["id", "n"]
    assert tables.upsert_table(spark, curated, "u", place, ddl("id string")) == "REPLACED"
    assert tables.table_properties(spark, curated, "u")["owner_note"] == "it's"
    assert spark.table(f"{curated}.u").count() == 4


def test_table_format_mark(spark, db, tmp_path):
    _, curated = db
    place = str(tmp_path / "m")
    publish.write_files(spark.range(4), place)
    tables.ensure_table(spark, curated, "m", place, T.StructType.fromDDL("id bigint"))
    tables.set_properties(spark, curated, "m", {"keep": "1"})
    assert tables.mark_table_format(spark, curated, "m", place, properties={"extra": "2"})
    assert not tables.mark_table_format(spark, curated, "m", str(tmp_path / "elsewhere"), properties={"extra": "2"})
    properties = tables.table_properties(spark, curated, "m")
    assert (properties["keep"], properties["extra"], properties[tables.FORMAT_PROPERTY]) == ("1", "2", "iceberg")
    assert spark.table(f"{curated}.m").count() == 4
    publish.write_files(spark.range(2), str(tmp_path / "new"), "parquet")
    tables.mark_table_format(spark, curated, "new", str(tmp_path / "new"))
    assert spark.table(f"{curated}.new").count() == 2
    publish.write_files(spark.range(7), str(tmp_path / "m7"))
    assert tables.mark_table_format(spark, curated, "m", str(tmp_path / "m7"), move=True)
    spark.catalog.refreshTable(f"{curated}.m")
    assert spark.table(f"{curated}.m").count() == 7
    assert tables.table_properties(spark, curated, "new")[tables.FORMAT_PROPERTY] == "iceberg"


def test_relocation(spark, db, tmp_path):
    _, curated = db
    publish.write_files(spark.range(4), str(tmp_path / "a"))
    publish.write_files(spark.range(6), str(tmp_path / "b"))
    tables.ensure_table(spark, curated, "r", str(tmp_path / "a"), T.StructType.fromDDL("id bigint"))
    tables.set_location(spark, curated, "r", str(tmp_path / "b"))
    assert spark.table(f"{curated}.r").count() == 6


# --- audit


def test_row_counts(spark):
    got = {r["tbl"]: (r["row_count"], r["status"]) for r in audit.row_counts({"a": spark.range(3), "b": spark.range(0)}).collect()}
    assert got == {"a": (3, "READY"), "b": (0, "EMPTY")}


def test_run_summary(spark):
    df = spark.createDataFrame([("SUCCEEDED",), ("FAILED: x: y",), ("FAILED: z",)], "status string")
    assert {r["status"]: r["items"] for r in audit.run_summary(df).collect()} == {"SUCCEEDED": 1, "FAILED": 2}


def test_audit_steps(spark, db, tmp_path):
    outcomes = [
        ("gone", "LANDING_MISSING", False, None, None), ("new", "CREATE_FDP", False, None, None),
        ("same", "NO_OP", True, None, None), ("drift", "SYNC_FDP_SCHEMA", True, None, None),
        ("broken", "SYNC_FDP_SCHEMA", True, "boom", None), ("odd", "NO_OP", True, None, "no"),
    ]
    df = spark.createDataFrame(outcomes, "tbl string, action string, target_exists boolean, sync_error string, format_error string")
    rows = audit.audit_steps(df, "proc", TS, "land", "base/").orderBy("table", "seq").collect()
    steps = {}
    for r in rows:
        steps.setdefault(r["table"], []).append(f"{r['step']}/{r['status']}")
    mark = ["ICEBERG_CREATE/STARTED", "ICEBERG_CREATE/COMPLETED", "PROCESS_END/COMPLETED"]
    head = ["PROCESS_START/STARTED", "FDP_CHECK/STARTED"]
    assert steps == {
        "gone": ["PROCESS_START/STARTED", "PROCESS/FAILED"],
        "new": [*head, "FDP_CREATE/COMPLETED", *mark],
        "same": [*head, "SCHEMA_COMPARE/COMPLETED", *mark],
        "drift": [*head, "SCHEMA_UPDATE/COMPLETED", *mark],
        "broken": [*head, "FDP_SYNC/FAILED"],
        "odd": [*head, "SCHEMA_COMPARE/COMPLETED", "ICEBERG_CREATE/STARTED", "ICEBERG_CREATE/FAILED"],
    }
    by_step = {(r["table"], r["step"], r["status"]): r for r in rows}
    assert json.loads(by_step["new", "FDP_CHECK", "STARTED"]["meta"]) == {"fdp_exists": False}
    assert json.loads(by_step["new", "FDP_CREATE", "COMPLETED"]["meta"]) == {"fdp_location": "base/new/"}
    assert by_step["gone", "PROCESS", "FAILED"]["message"] == "Landing table land.gone not found"
    assert by_step["broken", "FDP_SYNC", "FAILED"]["message"] == "boom"

    curated = db[1]
    steps = {p: audit.audit_steps(df, p, TS, "land", "base/") for p in ("proc", "other / id=2")}
    for run, n in (("proc", 1), ("other / id=2", 2), ("proc", 2)):
        assert audit.append_audit(spark, steps[run], curated, "audit", str(tmp_path / "audit"))
        assert spark.table(f"{curated}.audit").count() == n * len(rows)
    df = steps["proc"]
    assert {r["process_id"] for r in spark.table(f"{curated}.audit").collect()} == set(steps)
    assert spark.table(f"{curated}.audit").columns == audit.AUDIT_COLUMNS
    assert audit.append_audit(spark, df.drop("step"), curated, "audit", "x") is False


def test_runs_join_a_table_of_plain_appends(spark, db, tmp_path):
    def rows(run, *values):
        return spark.createDataFrame([(v, run) for v in values], "v int, run string")

    curated, place = db[1], str(tmp_path / "log")
    publish.append_table(spark, rows("old", 1, 2), curated, "log", place)
    publish.put_runs(spark, rows("a", 3), curated, "log", place, "run")
    publish.put_runs(spark, rows("a", 4, 5).union(rows(None, 6)), curated, "log", place, "run")
    publish.put_runs(spark, rows(None, 7), curated, "log", place, "run")
    got = sorted((r["v"], r["run"]) for r in spark.table(f"{curated}.log").collect())
    assert got == [(1, "old"), (2, "old"), (4, "a"), (5, "a"), (7, None)]
    assert spark.table(f"{curated}.log").columns == ["v", "run"]


def test_batch_log(spark):
    status = spark.createDataFrame([("a.csv", "a", "SUCCEEDED", 3, "")], "source_file string, table_name string, status string, row_count int, message string")
    df = audit.batch_log(status, "b1", TS, TS + dt.timedelta(seconds=5))
    assert df.columns == audit.BATCH_LOG_COLUMNS
    assert {t for _, t in df.dtypes} == {"string"}
    assert df.first()["finished_at"] == "2031-04-05T06:07:13"


def test_workspace(spark):
    folder = workspace.fresh_folder(spark, "x")
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert folder != workspace.fresh_folder(spark, "x")
