import datetime as dt
import json

import pytest
from gauges import READING_COLUMNS, readings
from pyspark.sql import functions as F
from pyspark.sql import types as T

import landfall
from landfall.operators import publish, tables
from landfall.plans import ingest
from landfall.streaming import arrival
from landfall.sources.readers import read_csv

TS = dt.datetime(2031, 4, 5, 6, 7, 8)


def statuses(df):
    return {r["source_file"]: (r["table_name"], r["status"].split(":")[0], r["row_count"]) for r in df.collect()}


# --- ingest


def test_ingest_of_all_formats(spark, db, zone, tmp_path):
    landing, curated = db
    zone("people.csv", readings("csv"))
    zone("team.TSV", readings("tsv"))
    zone("staff.json", readings("json"))
    zone("lines.json", readings("ndjson"))
    zone("clients.xml", readings("xml"))
    zone("notes.txt", readings("txt"))
    zone("ignored.parquet", "x")
    zone("void.csv", "\n")
    zone("nothing.tsv", "")
    zone("norows.csv", "a,b\n")
    zone("void2.json", " \n")
    zone("void3.xml", "<r></r>")
    target = str(tmp_path / "curated")
    result = landfall.sync_files(spark, zone.path, target, landing, curated, run_ts=TS)
    assert statuses(result) == {
        "people.csv": ("people", "SUCCEEDED", 3), "team.tsv": ("team", "SUCCEEDED", 3),
        "staff.json": ("staff", "SUCCEEDED", 3), "lines.json": ("lines", "SUCCEEDED", 3),
        "clients.xml": ("clients", "SUCCEEDED", 3), "notes.txt": ("notes", "SUCCEEDED", 3),
        "norows.csv": ("norows", "SUCCEEDED", 0), "void.csv": ("void", "FAILED", None),
        "void2.json": ("void2", "FAILED", None), "void3.xml": ("void3", "FAILED", None), "nothing.tsv": ("nothing", "FAILED", None),
    }
    messages = {r["source_file"]: r["message"] for r in result.collect()}
    assert messages["void.csv"] == "CSV appears empty or unreadable."
    assert messages["nothing.tsv"] == "TSV appears empty or unreadable."
    assert "JSON appears empty or unreadable." in messages["void2.json"]
    assert messages["void3.xml"] == "XML has no records."

    text = [("gauge/12", "mill race", "9", "18.125", "true", "clear")]
    typed = [("gauge/12", "mill race", 9, 18.125, "true", "clear")]
    for name in ("people", "team", "staff", "lines", "clients"):
        table = spark.table(f"{curated}.{name}")
        assert table.columns == READING_COLUMNS
        rows = [tuple(r) for r in table.filter("gauge = 'gauge/12'").collect()]
        assert rows == (text if name in ("people", "team") else typed), name
        landed = spark.table(f"{landing}.{name}")
        assert landed.schema == table.schema and landed.count() == 3, name
    assert spark.table(f"{curated}.notes").columns == ["line"]
    assert spark.table(f"{curated}.notes").count() == spark.table(f"{landing}.notes").count() == 3


def test_ingest_reads_only_its_own_files(spark, db, zone, tmp_path):
    landing, curated = db
    zone("a.csv", "x,y\n1,2")
    zone("b.csv", "p\n9")
    zone("sub/a.csv", "x,y\n3,4")
    landfall.sync_files(spark, zone.path, str(tmp_path / "c"), landing, curated)
    assert sorted(map(tuple, spark.table(f"{curated}.a").collect())) == [("1", "2"), ("3", "4")]
    assert sorted(map(tuple, spark.table(f"{landing}.a").collect())) == [("1", "2"), ("3", "4")]
    assert [tuple(r) for r in spark.table(f"{curated}.b").collect()] == [("9",)]


def test_ingest_with_detection_stamps_and_one_file(spark, db, zone, tmp_path):
    landing, curated = db
    zone("n.csv", "i,d,s\n 7 ,1_000.5,x\n8,nan,y")
    target = tmp_path / "c"
    result = landfall.sync_files(
        spark, zone.path, str(target), landing, curated, run_ts=TS, job="nightly",
        detect_types=True, ingest_columns=True, max_files=1,
    )
    assert statuses(result)["n.csv"] == ("n", "SUCCEEDED", 2)
    zone("j.json", '{"w": NaN, "x": 1}\n{"w": 2.5, "x": 1e3}')
    landfall.sync_files(spark, zone.path, str(target), landing, curated, run_ts=TS, formats=["json"])
    values = sorted(r["w"] for r in spark.table(f"{curated}.j").collect() if r["w"] == r["w"])
    assert values == [2.5] and spark.table(f"{curated}.j").filter("isnan(w)").count() == 1
    rows = spark.table(f"{curated}.n").orderBy("i").collect()
    assert [r["i"] for r in rows] == [7, 8] and rows[0]["d"] == 1000.5 and rows[1]["d"] != rows[1]["d"]
    assert (rows[0]["source_filename"], rows[0]["job_name"], rows[0]["record_status"]) == ("n.csv", "nightly", "ACTIVE")
    assert len(list((target / "n").glob("run-*/part-*"))) == 1


def test_ingest_again_versions_a_table_that_does_not_fit(spark, db, zone, tmp_path):
    landing, curated = db
    target = str(tmp_path / "c")
    zone("a.csv", "x,y\n1,2")
    landfall.sync_files(spark, zone.path, target, landing, curated, run_ts=TS)
    zone("a.csv", "y\n5")
    landfall.sync_files(spark, zone.path, target, landing, curated, run_ts=TS)
    assert [tuple(r) for r in spark.table(f"{curated}.a").collect()] == [(None, "5")]
    zone("a.csv", "y,new\n5,6")
    failed = landfall.sync_files(spark, zone.path, target, landing, curated, run_ts=TS, on_mismatch="fail")
    assert statuses(failed)["a.csv"][1] == "FAILED"
    done = landfall.sync_files(spark, zone.path, target, landing, curated, run_ts=TS)
    assert statuses(done)["a.csv"] == ("a__v20310405_060708", "SUCCEEDED", 1)
    assert [tuple(r) for r in spark.table(f"{curated}.a__v20310405_060708").collect()] == [("5", "6")]
    assert [tuple(r) for r in spark.table(f"{curated}.a").collect()] == [(None, "5")]


def test_ingest_keeps_file_formats_apart(spark, db, zone, tmp_path):
    landing, curated = db
    zone("a.csv", "line\nx")
    landfall.sync_files(spark, zone.path, str(tmp_path / "c"), landing, curated, run_ts=TS)
    zone("b/a.txt", "y")
    got = statuses(landfall.sync_files(spark, zone.path + "/b", str(tmp_path / "c"), landing, curated, run_ts=TS))
    assert got["a.txt"] == ("a__v20310405_060708", "SUCCEEDED", 1)
    assert [r["line"] for r in spark.table(f"{curated}.a").collect()] == ["x"]


def test_ingest_table_names(spark, db, zone, tmp_path):
    landing, curated = db
    zone("s.csv", "a\n1")
    zone("s.txt", "b")
    got = statuses(landfall.sync_files(spark, zone.path, str(tmp_path / "c"), landing, curated))
    assert {v[0] for v in got.values()} == {"s_csv", "s_text"}
    got = statuses(landfall.sync_files(spark, zone.path, str(tmp_path / "d"), landing, curated, suffix_format=True, formats=["csv"]))
    assert got == {"s.csv": ("s_csv", "SUCCEEDED", 1)}


def test_ingest_of_delivered_folders(spark, db, zone, tmp_path):
    landing, curated = db
    publish.write_files(spark.range(0, 50, 1, 3), zone.path + "/ids.csv")
    publish.write_files(spark.range(0, 40, 1, 3), zone.path + "/nums.tsv", "tsv")
    publish.write_files(spark.range(0, 30, 1, 3), zone.path + "/two.csv")
    publish.write_files(spark.range(0, 30, 1, 3), zone.path + "/sub/two.csv")
    got = statuses(landfall.sync_files(spark, zone.path, str(tmp_path / "c"), landing, curated))
    assert got == {"ids.csv": ("ids", "SUCCEEDED", 50), "nums.tsv": ("nums", "SUCCEEDED", 40), "two.csv": ("two", "FAILED", None)}
    assert spark.table(f"{landing}.ids").count() == spark.table(f"{curated}.ids").count() == 50


def test_files_of_one_table_must_share_a_header(spark, db, zone, tmp_path):
    zone("x/a.csv", "p,q\n1,2")
    zone("y/a.csv", "q,p\n1,2")
    got = statuses(landfall.sync_files(spark, zone.path, str(tmp_path / "c"), *db))
    assert got["a.csv"][1] == "FAILED"


def test_ingest_names_the_source_file(spark, db, zone, tmp_path):
    landing, curated = db
    for name, fmt in (("a b+c%.csv", "csv"), ("d e.json", "json"), ("f.json", "ndjson"), ("g h.xml", "xml")):
        zone(name, readings(fmt))
    got = statuses(landfall.sync_files(spark, zone.path, str(tmp_path / "c"), landing, curated, ingest_columns=True))
    assert got == {
        "a b+c%.csv": ("a_b_c_", "SUCCEEDED", 3), "d e.json": ("d_e", "SUCCEEDED", 3),
        "f.json": ("f", "SUCCEEDED", 3), "g h.xml": ("g_h", "SUCCEEDED", 3),
    }
    for file, (table, _, _) in got.items():
        assert {r["source_filename"] for r in spark.table(f"{curated}.{table}").collect()} == {file}
        assert spark.table(f"{landing}.{table}").count() == 3


def test_table_names_never_clash(spark, db, zone, tmp_path):
    for name in ("a-b.csv", "a_b.csv", "A_B.csv", "s.csv"):
        zone(name, f"v\n{name}")
    landing, curated = db
    got = statuses(landfall.sync_files(spark, zone.path, str(tmp_path / "c"), landing, curated))
    assert len({t.lower() for t, _, _ in got.values()}) == 4
    for file, (table, _, _) in got.items():
        assert [r["v"] for r in spark.table(f"{curated}.{table}").collect()] == [file]
        assert [r["v"] for r in spark.table(f"{landing}.{table}").collect()] == [file]


def test_bad_json_lines_can_be_skipped(spark, db, zone, tmp_path):
    zone("a.json", '{"x": 1}\n{"x": \n{"x": 2}')
    landing, curated = db
    assert statuses(landfall.sync_files(spark, zone.path, str(tmp_path / "c"), landing, curated))["a.json"][1] == "FAILED"
    got = statuses(landfall.sync_files(spark, zone.path, str(tmp_path / "c"), landing, curated, bad_lines="skip"))
    assert got["a.json"] == ("a", "SUCCEEDED", 2)
    assert sorted(r["x"] for r in spark.table(f"{curated}.a").collect()) == [1, 2]
    zone("first.json", '{"x": \n{"x": 1}\n{"x": 2}')
    got = statuses(landfall.sync_files(spark, zone.path, str(tmp_path / "c"), landing, curated, bad_lines="skip"))
    assert got["first.json"] == ("first", "SUCCEEDED", 2)


def test_long_rows_fail_unless_they_may_be_cut(spark, db, zone, tmp_path):
    landing, curated = db
    zone("l.csv", "a,b\n1,2,3\n4,5")
    got = landfall.sync_files(spark, zone.path, str(tmp_path / "c"), landing, curated)
    assert statuses(got)["l.csv"][1] == "FAILED"
    row = landfall.sync_files(spark, zone.path, str(tmp_path / "c"), landing, curated, long_lines="cut").first()
    assert (row["status"], row["row_count"], row["message"]) == ("SUCCEEDED", 2, "1 rows cut to the header")


def test_parts_of_a_delivered_folder_must_share_a_header(spark, db, zone, tmp_path):
    zone("orders.csv/part-0", "a,b\n1,2")
    zone("orders.csv/part-1", "b,a\nx,y")
    assert statuses(landfall.sync_files(spark, zone.path, str(tmp_path / "c"), *db))["orders.csv"][1] == "FAILED"


def test_types_that_do_not_hold_the_values_make_a_version(spark, db, zone, tmp_path):
    target = str(tmp_path / "c")
    run = lambda: statuses(landfall.sync_files(spark, zone.path, target, *db, run_ts=TS, detect_types=True))["p.csv"]
    zone("p.csv", "n,d\n1,1.5")
    assert run() == ("p", "SUCCEEDED", 1)
    zone("p.csv", "n,d\n2,7")
    assert run() == ("p", "SUCCEEDED", 1)
    assert [tuple(r) for r in spark.table(f"{db[1]}.p").collect()] == [(2, 7.0)]
    zone("p.csv", "n,d\nn/a,7\nunknown,8")
    assert run() == ("p__v20310405_060708", "SUCCEEDED", 2)
    assert [tuple(r) for r in spark.table(f"{db[1]}.p").collect()] == [(2, 7.0)]


def test_a_failed_write_leaves_the_table(spark, db, zone, tmp_path, monkeypatch):
    import landfall.plans.ingest as module

    target = str(tmp_path / "c")
    zone("a.csv", "x\n1")
    landfall.sync_files(spark, zone.path, target, *db)

    def broken(*_, **__):
        raise OSError("disk full")

    monkeypatch.setattr(module, "write_files", broken)
    assert statuses(landfall.sync_files(spark, zone.path, target, *db))["a.csv"][1] == "FAILED"
    assert [r["x"] for r in spark.table(f"{db[1]}.a").collect()] == ["1"]


def test_empty_zone(spark, db, tmp_path):
    (tmp_path / "none").mkdir()
    assert landfall.sync_files(spark, str(tmp_path / "none"), str(tmp_path / "c"), *db).count() == 0


# --- tables


def land(spark, db, name, df, folder):
    publish.write_files(df, folder)
    tables.ensure_table(spark, db, name, folder, df.schema)


def test_publish_table(spark, db, tmp_path):
    landing, curated = db
    df = spark.createDataFrame([(1, "x"), (2, "y")], "`Cust Id` long, `NAME ` string")
    land(spark, landing, "src", df, str(tmp_path / "src"))
    place = str(tmp_path / "out")
    for mode, rows in (("overwrite", 2), ("append", 4), ("overwrite", 2)):
        assert landfall.publish_table(spark, landing, "src", curated, "dst", place, mode) == ("SUCCEEDED", 2)
        assert spark.table(f"{curated}.dst").count() == rows
    assert spark.table(f"{curated}.dst").columns == ["cust_id", "name"]
    tables.ensure_table(spark, landing, "none", str(tmp_path / "none"), df.schema)
    (tmp_path / "none").mkdir()
    assert landfall.publish_table(spark, landing, "none", curated, "none", place) == ("EMPTY", 0)
    assert not tables.table_exists(spark, curated, "none")
    with pytest.raises(ValueError):
        landfall.publish_table(spark, landing, "src", curated, "dst", place, "sideways")


def test_copy_table(spark, db, zone, tmp_path):
    landing, curated = db
    path = zone("r.csv", "a,b\na,b\n1,2\n,3\na,b")
    tables.ensure_table(spark, landing, "r", path, T.StructType.fromDDL("a string, b string"))
    place = str(tmp_path / "out")
    assert landfall.copy_table(spark, landing, "r", curated, "r", place) == ("SUCCEEDED", 2)
    assert sorted(map(tuple, spark.table(f"{curated}.r").collect()), key=str) == [("1", "2"), (None, "3")]
    landfall.copy_table(spark, landing, "r", curated, "r", place)
    assert spark.table(f"{curated}.r").count() == 4
    landfall.copy_table(spark, landing, "r", curated, "r", place, mode="overwrite")
    assert spark.table(f"{curated}.r").count() == 2


def test_copy_latest(spark, db, zone, tmp_path):
    _, curated = db
    zone("x/b.csv", "h\n1")
    zone("y/a.csv", "h\n2")
    assert landfall.copy_latest(spark, zone.path, str(tmp_path / "out"), curated) == ("fdp_b", 2)
    assert sorted(r["data"] for r in spark.table(f"{curated}.fdp_b").collect()) == ["1", "h"]
    (tmp_path / "none").mkdir()
    assert landfall.copy_latest(spark, str(tmp_path / "none"), str(tmp_path / "out"), curated) is None


def test_batch_log_table(spark, db, zone, tmp_path):
    landing, curated = db
    zone("a.csv", "x\n1")
    for batch in ("b1", "b2"):
        landfall.sync_files(spark, zone.path, str(tmp_path / "c"), landing, curated, run_ts=TS, log_db=curated, batch_id=batch)
    rows = spark.table(f"{curated}.batch_log").select("batch_id", "source_file", "table_name", "status", "started_at").collect()
    assert sorted(map(tuple, rows)) == [(b, "a.csv", "a", "SUCCEEDED", "2031-04-05T06:07:08") for b in ("b1", "b2")]


def test_register_path(spark, db, zone):
    landing, _ = db
    path = zone("reg.csv", "a,b,c,d,e\n1,2.5,true,x,2024-01-01\n5000000000,1,false,y,2024-01-02")
    zone("other.csv", "zzz\n1")
    state, columns = landfall.register_path(spark, path, landing, "reg")
    assert state == "CREATED"
    assert [(c.name, c.type) for c in columns] == [("a", "bigint"), ("b", "double"), ("c", "boolean"), ("d", "string"), ("e", "string")]
    assert spark.table(f"{landing}.reg").count() == 2
    assert spark.table(f"{landing}.reg").filter("a = 5000000000 and e = '2024-01-02'").count() == 1
    zone("reg.csv", "a,b\n1,x")
    assert landfall.register_path(spark, path, landing, "reg")[0] == "REPLACED"
    assert spark.table(f"{landing}.reg").columns == ["a", "b"]
    assert [c.type for c in landfall.register_path(spark, zone("w.csv", "a\n5000000000"), landing, "w", legacy=True)[1]] == ["int"]


def test_sync_tables(spark, db, tmp_path):
    landing, curated = db
    land(spark, landing, "in_new", spark.range(2), str(tmp_path / "l1"))
    land(spark, landing, "in_old", spark.range(2).select("id", F.lit("x").alias("extra")), str(tmp_path / "l2"))
    land(spark, landing, "skip", spark.range(2), str(tmp_path / "l3"))
    land(spark, curated, "in_old", spark.range(2), str(tmp_path / "c" / "in_old"))
    args = dict(prefix="in_", audit_db=curated, run_ts=TS, properties={"k": "v"})
    target = str(tmp_path / "c")

    def steps(**more):
        rows = landfall.sync_tables(spark, landing, curated, target, **args, **more).orderBy("table", "seq").collect()
        return [(r["table"], r["step"]) for r in rows if r["step"] in ("FDP_CREATE", "SCHEMA_UPDATE", "SCHEMA_COMPARE", "PROCESS", "FDP_SYNC")]

    assert steps() == [("in_new", "FDP_CREATE"), ("in_old", "SCHEMA_UPDATE")]
    assert spark.table(f"{curated}.in_new").columns == ["id", "ingestion_timestamp", "source_filename", "job_name", "record_status"]
    assert spark.table(f"{curated}.in_old").columns == ["id", "extra"]
    assert spark.table(f"{curated}.in_old").count() == 2
    assert tables.table_properties(spark, curated, "in_old")["k"] == "v"
    # The ingest columns of the new table are no drift on the next run ...
    assert steps() == [("in_new", "SCHEMA_COMPARE"), ("in_old", "SCHEMA_COMPARE")]
    # ... unless asked, and then they go.
    assert steps(strict=True) == [("in_new", "SCHEMA_UPDATE"), ("in_old", "SCHEMA_COMPARE")]
    assert spark.table(f"{curated}.in_new").columns == ["id"]
    assert steps(tables=["in_old", "in_gone"]) == [("in_gone", "PROCESS"), ("in_old", "SCHEMA_COMPARE")]
    ids = spark.table(f"{curated}.audit").select("process_id").distinct().count()
    assert ids == 4


def test_schema_report(spark, db, tmp_path):
    landing, curated = db
    target, history = str(tmp_path / "c"), str(tmp_path / "history")
    land(spark, landing, "a", spark.range(2), str(tmp_path / "a"))
    land(spark, landing, "b", spark.range(2), str(tmp_path / "b"))
    land(spark, curated, "b", spark.range(2), str(tmp_path / "c" / "b"))

    def run(hours, **more):
        at = TS + dt.timedelta(hours=hours)
        rows, decisions = landfall.schema_report(spark, landing, curated, target, history, run_ts=at, **more)
        return {r["tbl"]: (r["action"], r["schema_changed"]) for r in decisions.collect()}, rows

    # First sight counts as evolved.
    assert run(0)[0] == {"a": ("CREATE_FDP", "YES"), "b": ("UPDATE_FDP", "YES")}
    assert run(1)[0] == {"a": ("NO_OP", "NO"), "b": ("NO_OP", "NO")}
    tables.upsert_table(spark, landing, "a", str(tmp_path / "a"), T.StructType.fromDDL("id bigint, n string"))
    spark.sql(f"DROP TABLE {curated}.b")
    actions, rows = run(2, report_path=str(tmp_path / "report"), tables=["a", "b", "gone"])
    assert actions == {"a": ("UPDATE_FDP", "YES"), "b": ("CREATE_FDP", "NO"), "gone": ("LANDING_MISSING", "NO")}
    assert spark.table(f"{curated}.a").columns == ["id", "n"]
    spark.sql(f"DROP TABLE {curated}.a")
    land(spark, curated, "a", spark.range(1), str(tmp_path / "elsewhere"))
    assert run(3, apply=False)[0]["a"] == ("SYNC_FDP_SCHEMA", "YES")
    # A repeated run sees what the first attempt saw.
    assert run(2, apply=False)[0]["a"] == ("SYNC_FDP_SCHEMA", "YES")
    history_rows = spark.read.option("recursiveFileLookup", True).parquet(history)
    assert history_rows.filter("tbl = 'a'").select("version").distinct().count() == 4
    written = list((tmp_path / "report").glob("report=schema_report_*_20310405_080708Z/part-*.csv"))
    assert len(written) == 2
    row = read_csv(spark, str(tmp_path / "report")).filter("`Table` = 'a'").first()
    assert json.loads(row["Details"]) == [{"Name": "id", "Type": "bigint"}, {"Name": "n", "Type": "string"}]


def test_sync_goes_on_past_an_unreadable_entry(spark, db, tmp_path):
    landing, curated = db
    land(spark, landing, "good", spark.range(2), str(tmp_path / "g"))
    land(spark, landing, "base", spark.range(2), str(tmp_path / "b"))
    spark.sql(f"CREATE VIEW {landing}.bad AS SELECT * FROM {landing}.base")
    spark.sql(f"DROP TABLE {landing}.base")
    rows = landfall.sync_tables(spark, landing, curated, str(tmp_path / "c"), run_ts=TS).collect()
    assert {(r["step"], r["status"]) for r in rows if r["table"] == "bad"} == {("PROCESS_START", "STARTED"), ("PROCESS", "FAILED")}
    assert ("FDP_CREATE", "COMPLETED") in {(r["step"], r["status"]) for r in rows if r["table"] == "good"}
    _, decisions = landfall.schema_report(spark, landing, curated, str(tmp_path / "c"), str(tmp_path / "h"), run_ts=TS)
    errors = {r["tbl"]: r["error"] for r in decisions.collect()}
    assert errors["good"] is None and errors["bad"]


# --- arrival


def test_arrival_sees_each_file_once(spark, db, zone, tmp_path):
    landing, curated = db
    target, checkpoint, log = (str(tmp_path / n) for n in ("c", "cp", "log"))

    def run():
        landfall.stream_files(spark, zone.path, target, landing, curated, checkpoint, log, run_ts=TS).awaitTermination()
        return sorted(
            (r["source_file"], r["status"])
            for r in spark.read.option("recursiveFileLookup", True).parquet(log).collect()
        )

    zone("One.csv", "a,b\n1,2")
    zone("two.csv", "z\n9")
    zone("no.txt", "x")
    assert run() == [("One.csv", "SUCCEEDED"), ("two.csv", "SUCCEEDED")]
    assert [tuple(r) for r in spark.table(f"{curated}.one").collect()] == [("1", "2")]
    zone("sub/one.csv", "a,b\n3,4")
    assert run() == [("One.csv", "SUCCEEDED"), ("one.csv", "SUCCEEDED"), ("two.csv", "SUCCEEDED")]
    assert sorted(map(tuple, spark.table(f"{curated}.one").collect())) == [("1", "2"), ("3", "4")]
    assert sorted(map(tuple, spark.table(f"{landing}.one").collect())) == [("1", "2"), ("3", "4")]
    assert spark.table(f"{landing}.one").dtypes == [("a", "string"), ("b", "string")]
    assert spark.table(f"{curated}.two").count() == 1
    assert len(run()) == 3


def test_a_repeated_batch_changes_nothing(spark, db, zone, tmp_path):
    zone("a.csv", "v\n1\n2")
    for _ in range(2):
        landfall.stream_files(spark, zone.path, str(tmp_path / "c"), *db, str(tmp_path / "one")).awaitTermination()
        assert spark.table(f"{db[1]}.a").count() == 2


def test_arrival_isolates_failures(spark, db, zone, tmp_path):
    landing, curated = db
    zone("bad.csv", "\n")
    zone("good.csv", "a\n1")
    log = str(tmp_path / "log")
    landfall.stream_files(spark, zone.path, str(tmp_path / "c"), landing, curated, str(tmp_path / "cp"), log).awaitTermination()
    rows = spark.read.option("recursiveFileLookup", True).parquet(log).collect()
    assert {r["source_file"]: r["status"].split(":")[0] for r in rows} == {"bad.csv": "FAILED", "good.csv": "SUCCEEDED"}


def test_failed_arrivals_are_tried_again(spark, db, zone, tmp_path):
    landing, curated = db
    args = (spark, zone.path, str(tmp_path / "c"), landing, curated, str(tmp_path / "cp"))
    zone("bad.csv", "a,b\n1,2,3")
    zone("good.csv", "a\n1")
    landfall.stream_files(*args).awaitTermination()
    assert not tables.table_exists(spark, curated, "bad")
    landfall.stream_files(*args, long_lines="cut").awaitTermination()
    assert [tuple(r) for r in spark.table(f"{curated}.bad").collect()] == [("1", "2")]
    landfall.stream_files(*args, long_lines="cut").awaitTermination()
    assert spark.table(f"{curated}.bad").count() == spark.table(f"{curated}.good").count() == 1


def test_streams_and_ingests_of_one_table(spark, db, zone, tmp_path):
    landing, curated = db
    target = str(tmp_path / "c")
    zone("one/a.csv", "v\n1")
    zone("two/a.csv", "v\n2")
    zone("three/a.csv", "v\n3")
    landfall.sync_files(spark, zone.path + "/one", target, landing, curated, run_ts=TS)
    for part in ("two", "three"):
        landfall.stream_files(spark, f"{zone.path}/{part}", target, landing, curated, str(tmp_path / f"cp-{part}")).awaitTermination()
    assert sorted(r["v"] for r in spark.table(f"{curated}.a").collect()) == ["1", "2", "3"]
    landfall.sync_files(spark, zone.path, target, landing, curated, run_ts=TS)
    assert sorted(r["v"] for r in spark.table(f"{curated}.a").collect()) == ["1", "2", "3"]


def test_values_over_lines_are_no_long_rows(spark, db, zone, tmp_path):
    landing, curated = db
    zone("good.csv", 'a,b\n1,"x\ny,z,w"\n2,q\n3\n')
    zone("bad.csv", 'a,b\n1,"x\ny"\n2,"q\nr",3\n')
    zone("odd.tsv", 'a\tb\n1\t"x\ny\tz\tw"\n')
    for detect in (False, True):
        got = statuses(landfall.sync_files(spark, zone.path, str(tmp_path / "c"), landing, curated, detect_types=detect, multiLine="true"))
        assert got["good.csv"][1:] == ("SUCCEEDED", 3) and got["odd.tsv"][1:] == ("SUCCEEDED", 1)
        assert got["bad.csv"][1] == "FAILED"
    rows = spark.table(f"{curated}.good").collect()
    assert sorted(tuple(r) for r in rows if r["a"] != "3") == [("1", "x\ny,z,w"), ("2", "q")]
    cut = landfall.sync_files(spark, zone.path, str(tmp_path / "d"), *db, long_lines="cut", multiLine="true", formats=["csv"])
    assert {r["source_file"]: r["message"] for r in cut.collect()}["bad.csv"] == "1 rows cut to the header"


BODIES = {
    "csv": ("k,v\n{0},a{0}\n", "other\nin a folder\n"), "tsv": ("k\tv\n{0}\ta{0}\n", "other\nx\n"),
    "json": ('{{"k": {0}, "v": "a{0}"}}\n', '[{"other": 1}, {"other": 2}]'),
    "xml": ("<r><e><k>{0}</k><v>a{0}</v></e></r>", "<r><e><other>1</other></e></r>"), "txt": ("{0}\n", "in a folder\n"),
}


@pytest.mark.parametrize("limit", [100, 5])
@pytest.mark.parametrize("ext", BODIES)
def test_files_of_a_delivered_folder_belong_to_it_whatever_their_names(spark, db, zone, tmp_path, monkeypatch, ext, limit):
    """The way a group is read, by paths or by a pattern, changes no row."""
    monkeypatch.setattr(ingest, "PATHS_READ", limit)
    body, inner = BODIES[ext]
    for i in range(7):
        zone(f"d{i}/part.{ext}", body.format(i))
    zone(f"a/big.{ext}/part.{ext}", inner)
    result = landfall.sync_files(spark, zone.path, str(tmp_path / "c"), *db)
    got, n = statuses(result), {"json": 2, "xml": 1, "txt": 1}.get(ext, 1)
    assert got == {f"part.{ext}": ("part", "SUCCEEDED", 7), f"big.{ext}": ("big", "SUCCEEDED", n)}
    messages = {r["source_file"]: r["message"] for r in result.collect()}
    assert "not registered" in messages[f"part.{ext}"] and not messages[f"big.{ext}"]
    part = spark.table(f"{db[1]}.part")
    assert sorted(str(r[0]) for r in part.collect()) == [str(i) for i in range(7)]
    assert part.columns == (["line"] if ext == "txt" else ["k", "v"])
    assert not spark.catalog.tableExists(f"{db[0]}.part") and spark.catalog.tableExists(f"{db[0]}.big")


@pytest.mark.parametrize("stop_before", ["rows", "ledger", "log"])
def test_a_stopped_retry_is_repeated_and_forgets_nothing(spark, db, zone, tmp_path, monkeypatch, stop_before):
    landing, curated = db
    zone("a.csv", "x,y\n1,2,3\n")
    zone("b.csv", "x,y\n7,8\n")
    args = spark, zone.path, str(tmp_path / "c"), landing, curated, str(tmp_path / "cp"), str(tmp_path / "log")
    landfall.stream_files(*args).awaitTermination()
    assert not spark.catalog.tableExists(f"{curated}.a") and spark.table(f"{curated}.b").count() == 1

    def stop(*_, **__):
        raise RuntimeError("stopped")

    with monkeypatch.context() as broken:
        if stop_before == "rows":
            broken.setattr(arrival, "sync_group", stop)
        elif stop_before == "ledger":
            create = spark.createDataFrame
            broken.setattr(spark, "createDataFrame", lambda rows, schema=None: stop() if rows and schema == arrival.RETRY else create(rows, schema))
        else:
            broken.setattr(arrival, "batch_log", stop)
        with pytest.raises(RuntimeError, match="stopped"):
            landfall.stream_files(*args, long_lines="cut").awaitTermination()
    for _ in range(2):  # the second run finds nothing left to do
        landfall.stream_files(*args, long_lines="cut").awaitTermination()
        assert [tuple(r) for r in spark.table(f"{curated}.a").collect()] == [("1", "2")]
    assert spark.table(f"{curated}.b").count() == 1
