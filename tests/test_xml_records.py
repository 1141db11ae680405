"""XML records cut over many tasks give what the built-in source gives."""

import contextlib
import io
import random
import re

import pytest
from pyspark.sql import functions as F

from landfall.operators.infer import collect_columns
from landfall.plans.ingest import land_files
from landfall.sources.readers import infer_xml, read_xml
from landfall.sources.xml_records import _record_of_pieces, cut_xml, xml_pieces, xml_records

SHAPE = "k string, v string"
# Whatever may hold an end tag that ends nothing, and marks of other sections.
SECTIONS = [
    "x", "é", "&lt;r&gt;", "<![CDATA[a</r> <r> -->]]>", "<!-- </r><r><k>9</k></r> ]]> -->", "<?p </r> <r> ?>",
    "<![CDATA[<!--]]>", "<!-- <![CDATA[ -->", "<![CDATA[?>]]>", "<![CDATA[</r></r>]]>",
]
BETWEEN = ["", "\n", "<!-- <r><k>0</k></r> -->", "<rr>t</rr>", "<?x </r> ?>", "<!-- a -->" * 3]


def document(rnd, records):
    body = ""
    for i in range(records):
        text = "".join(rnd.choice(SECTIONS) for _ in range(rnd.randint(0, 3)))
        inner = f"<n><r><k>n{i}</k></r></n>" if rnd.random() < 0.2 else ""
        mark = rnd.choice(["", ' a="1&gt;2"', " a='q' b=\">\""])
        body += f"<r{mark}><k>{i}</k><v>{text}</v>{inner}</r>" + rnd.choice(BETWEEN)
    return f'<?xml version="1.0"?><!-- > </r> --><rs>{body}</rs>' + rnd.choice(["", "\n\n", "<!-- </r> -->"])


@pytest.fixture
def split_bytes(spark):
    name = "spark.sql.files.maxPartitionBytes"
    yield lambda n: spark.conf.set(name, str(n))
    spark.conf.unset(name)


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("seed,size", [(1, 40), (2, 150), (3, 1000)])
def test_tiny_splits_equal_the_built_in_source(spark, zone, split_bytes, seed, size):
    rnd = random.Random(seed)
    for f in range(3):
        zone(f"f{f}.xml", document(rnd, 25))
    zone("none.xml", "<rs></rs>")
    split_bytes(size)
    pieces = xml_pieces(spark, zone.path, "r")
    split_bytes(2**27)
    assert pieces.select("file", "block").distinct().count() > 3
    assert pieces.filter("other").isEmpty()
    read = xml_records(spark, pieces, "r").select(F.from_xml("value", SHAPE).alias("r")).select("r.*")
    expected = rows(spark.read.option("rowTag", "r").schema(SHAPE).xml(zone.path))
    assert len(expected) == 75 and rows(read) == expected


def test_files_larger_than_a_split_are_cut(spark, zone, split_bytes):
    path = zone("a.xml", document(random.Random(4), 60))
    whole = rows(read_xml(spark, path, "r", SHAPE, "origin"))
    types = collect_columns(infer_xml(spark, path, "r"))
    landed = land_files(spark, path, "xml", row_tag="r")
    assert cut_xml(spark, path, "r") is None
    split_bytes(2000)
    assert cut_xml(spark, path, "r") is not None
    assert rows(read_xml(spark, path, "r", SHAPE, "origin")) == whole
    assert collect_columns(infer_xml(spark, path, "r")) == types
    cut = land_files(spark, path, "xml", row_tag="r")
    assert cut.columns == landed.columns and rows(cut.data) == rows(landed.data)


def test_records_that_close_in_another_way_are_left_to_the_built_in_source(spark, zone):
    for i, form in enumerate(('<r a="1"/>', "<r><k>1</k></r >", "<r/>")):
        path = zone(f"form{i}.xml", f"<rs><r><k>0</k></r>{form}</rs>")
        assert cut_xml(spark, path, "r", split=True) is None
        assert rows(read_xml(spark, path, "r", SHAPE, split=True)) == rows(read_xml(spark, path, "r", SHAPE, split=False))


def test_records_without_end_or_file(spark, zone):
    path = zone("a.xml", "<rs><r><k>1</k></r><r><k>2</k>")
    assert [r["value"] for r in cut_xml(spark, path, "r", split=True).collect()] == ["<r><k>1</k></r>"]
    only = zone("b.xml", "<r><k>1</k></r>")
    assert cut_xml(spark, only, "r", split=True).count() == 1
    assert cut_xml(spark, zone("c.xml", "<rs></rs>"), "r", split=True).count() == 0


def test_no_text_goes_through_the_windows(spark, zone):
    pieces = xml_pieces(spark, zone("a.xml", document(random.Random(6), 5)), "r")
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        _record_of_pieces(pieces).explain("formatted")
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text.getvalue())
    assert schemas and not any("value:" in s for s in schemas)
