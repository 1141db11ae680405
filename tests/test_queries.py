"""Every registered query against its SQL on the given tables."""

import datetime as dt
import math
import pathlib

import duckdb
import pytest

from landfall.queries import ORACLE, QUERIES, scans

DATA = pathlib.Path("/root/testdata/sf0.001")
DUCK_TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def plain(value):
    if value is None:
        return "null"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    return value.isoformat() if isinstance(value, dt.datetime) else str(value)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.skipif(not DATA.exists(), reason="no test data")
@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, str(DATA))
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    result = duck.execute(ORACLE[name])
    names = [c[0] for c in result.description]
    types = {c[0]: str(c[1]) for c in result.description}
    assert sorted(names) == columns
    assert {c: DUCK_TYPES[t] for c, t in df.dtypes} == types
    want = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall())
    assert got == want


def test_values_parse_as_their_sql_says_for_any_number(spark, duck, tmp_path):
    """Negative, huge, tiny, endless and missing numbers; the given tables hold none of them."""
    odd = [-3.5, 12_500_000.0, 2.5e-7, float("inf"), float("-inf"), 0.0, None]
    rows = [(i, 1, None if i == 2 else i * 10, q, "NAR"[i % 3]) for i, q in enumerate(odd)]
    names = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_quantity double, l_returnflag string"
    spark.createDataFrame(rows, names).write.parquet(str(tmp_path / "lineitem.parquet"))
    df = QUERIES["parse_inferred_values"](spark, str(tmp_path))
    result = duck.execute(f"WITH lineitem AS (SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet') {ORACLE['parse_inferred_values']}")
    assert [DUCK_TYPES[t] for _, t in df.dtypes] == [str(c[1]) for c in result.description]
    assert sorted(tuple(map(plain, r)) for r in df.collect()) == sorted(tuple(map(plain, r)) for r in result.fetchall())


@pytest.mark.skipif(not DATA.exists(), reason="no test data")
def test_pages_land_in_files_of_bounded_size(spark, duck, monkeypatch):
    """No task writes all pages, and files of many splits, cut side by side, give the same rows."""
    def cut(spark, path, *args, **options):
        sizes.extend(r["length"] for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("length").collect())
        return cut_xml(spark, path, *args, **options)

    sizes, cut_xml = [], scans.cut_xml
    monkeypatch.setattr(scans, "cut_xml", cut)
    monkeypatch.setattr(scans, "XML_FILE_BYTES", 40_000, raising=False)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        df = scans.scan_xml_large(spark, str(DATA))
        got = sorted(tuple(map(plain, r)) for r in df.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(sizes) > 2 and max(sizes) < 80_000
    assert got == sorted(tuple(map(plain, r)) for r in duck.execute(ORACLE["scan_xml_large"]).fetchall())
