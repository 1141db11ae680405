"""The listing that tasks make."""

import os

from pyspark.sql import functions as F

from landfall.plans.ingest import sync_files
from landfall.sources import listing
from landfall.sources.files import empty_files, list_files


def test_listing_has_what_scans_see_and_the_empty_files(spark, zone):
    for name in ("a.csv", "x/b.csv", "x/y z/c%20+.csv", "p=1/d.csv", "_q=1/e.csv", "part.csv/part-0.csv", "é/f[1].csv"):
        zone(name, "k\n1")
    for name in ("_SUCCESS", ".hidden.csv", "x/_tmp/g.csv", ".dir/h.csv", "x/i.csv._COPYING_"):
        zone(name, "k\n1")
    zone("none.csv", "")
    zone("x/none.json", "")
    scanned = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(zone.path)
    columns = ["path", "modificationTime", "length"]
    rows = {tuple(r) for r in listing.all_files(spark, zone.path).select(columns).collect()}
    assert {r for r in rows if r[2]} == {tuple(r) for r in scanned.select(columns).collect()}
    assert sorted(os.path.basename(r[0]) for r in rows if not r[2]) == ["none.csv", "none.json"]


def test_folders_are_listed_by_tasks_side_by_side(spark, zone, monkeypatch):
    for i in range(7):
        zone(f"f{i}/a.csv", "k\n1")
        zone(f"f{i}/deep/b.csv", "")
    monkeypatch.setattr(listing, "TASKS", 3)
    reader = listing.FolderListing({"path": f"file:{zone.path}"}).reader(None)
    parts = reader.partitions()
    assert len(parts) == 4
    assert sum(b.num_rows for p in parts for b in reader.read(p)) == 14


def test_empty_deliveries_without_a_list_of_names_in_the_driver(spark, zone, db, tmp_path, monkeypatch):
    zone("good.csv", "k\n1")
    zone("good/good.csv", "")
    zone("void.csv", "")
    zone("half.json/part-0.json", "")
    zone("half.json/part-1.json", '{"k": 1}')
    zone("odd.bin", "")
    files = list_files(spark, zone.path)
    found = empty_files(spark, zone.path, files)
    assert [(r["table_name"], r["format"]) for r in found.collect()] == [("void", "csv")]
    assert "LocalTableScan" not in found._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr("landfall.sources.files.all_files", lambda *_: None)
    assert empty_files(spark, zone.path, files).select("table_name", "format").collect() == [("void", "csv")]
    status = sync_files(spark, zone.path, str(tmp_path / "curated"), *db)
    by_table = {r["table_name"]: r["status"].partition(":")[0] for r in status.filter(F.col("status").isNotNull()).collect()}
    assert by_table == {"good": "SUCCEEDED", "half": "SUCCEEDED", "void": "FAILED"}


def test_no_files_and_no_folders(spark, zone):
    assert listing.all_files(spark, zone.path).count() == 0
