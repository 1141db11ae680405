"""Record texts of large XML files, cut without reading a file in one task.

Scans take plain text with the record's end tag as line separator, so one huge
file spreads over all its splits and a piece is about a record. An end tag may
stand in a comment, a CDATA section or an instruction and end nothing, so each
piece is a map from the state it begins in to the state it leaves. The maps are
one small number each; they are chained per split and the splits per file.
"""

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from landfall.sources.files import LOOSE, scan
from landfall.sources.records import _pieces
from landfall.workspace import show_package, written

# What opens and closes the states 1 (comment), 2 (CDATA), 3 (instruction); state 0 is plain markup.
OPENS = ("<!--", "<![CDATA[", "<?")
CLOSES = ("-->", "]]>", "?>")
_SECTION = "|".join(f"{re.escape(a)}.*?{re.escape(b)}" for a, b in zip(OPENS, CLOSES, strict=True))
_OPEN = "|".join(re.escape(a) for a in OPENS)

# The map that changes nothing: two bits for each state.
SAME = 0b11100100


def _image(code: Column, state: Column) -> Column:
    """The state that a map leaves a state in; maps have two bits a state, state 0 the lowest."""
    return F.call_function("shiftright", code, state * 2).bitwiseAND(3)


def _then(first: Column, second: Column) -> Column:
    """The map of two pieces after each other."""
    images = [_image(second, _image(first, F.lit(s))) * 4**s for s in range(4)]
    return images[0] + images[1] + images[2] + images[3]


def _running(table: pa.Table) -> pa.Table:
    """The map of everything before each row of one group, rows in their order."""
    table = table.sort_by("place")
    steps: dict[tuple[int, int], int] = {}
    now, before = SAME, []
    for code in table["code"].to_pylist():
        before.append(now)
        after = steps.get((now, code))
        if after is None:
            after = sum((code >> 2 * (now >> 2 * s & 3) & 3) << 2 * s for s in range(4))
            steps[now, code] = after
        now = after
    return table.append_column("before", pa.array(before, pa.int32()))


def _chained(maps: DataFrame, *by: str) -> DataFrame:
    """``maps`` (keys, place, code) with the map of all rows of the group that come before."""
    show_package(maps.sparkSession)
    schema = T.StructType([*maps.schema.fields, T.StructField("before", T.IntegerType())])
    return maps.groupBy(*by).applyInArrow(_running, schema)


def _measured(pieces: DataFrame, tag: str) -> DataFrame:
    """``pieces`` with the map (code) of each and the number of records that it opens, by the state it begins in.

    A step per column, so that no text is searched twice; most texts hold no marks and are only looked through for them.
    """
    rests = [F.col("value")]
    for s, close in enumerate(CLOSES, 1):
        at = F.instr("value", close)
        rests.append(F.when(at > 0, F.substring("value", at + len(close), F.length("value"))))
    df = pieces.withColumns({f"rest{s}": r for s, r in enumerate(rests)})

    def marked(name: str) -> Column:
        return F.contains(F.col(name), F.lit("<!")) | F.contains(F.col(name), F.lit("<?"))

    # Sections go from left to right, so a mark inside another section is none.
    bare = {
        f"bare{s}": F.when(marked(f"rest{s}"), F.regexp_replace(f"rest{s}", f"(?s){_SECTION}", " ")).otherwise(F.col(f"rest{s}"))
        for s in range(4)
    }
    marks = {f"mark{s}": F.when(marked(f"bare{s}"), F.regexp_extract(f"bare{s}", _OPEN, 0)).otherwise("") for s in range(4)}
    plain = {
        f"plain{s}": F.when(F.col(f"mark{s}") == "", F.col(f"bare{s}")).otherwise(
            F.call_function("substring_index", F.col(f"bare{s}"), F.col(f"mark{s}"), F.lit(1))
        )
        for s in range(4)
    }
    df = df.withColumns(bare).withColumns(marks).withColumns(plain)
    counts = {
        f"opened{s}": F.when(
            F.contains(F.col(f"plain{s}"), F.lit(f"<{tag}")), F.regexp_count(f"plain{s}", F.lit(rf"<{re.escape(tag)}[\s>]"))
        ).otherwise(0)
        for s in range(4)
    }
    state = F.create_map(*[F.lit(x) for pair in zip(OPENS, (1, 2, 3), strict=True) for x in pair])
    images = [
        F.when(F.col(f"rest{s}").isNull(), s).otherwise(F.coalesce(F.element_at(state, F.col(f"mark{s}")), F.lit(0))) * 4**s
        for s in range(4)
    ]
    return df.withColumns({**counts, "code": (images[0] + images[1] + images[2] + images[3]).cast("int")})


def xml_pieces(spark: SparkSession, path: str | list[str], tag: str, **options) -> DataFrame:
    """Texts between the end tags of records with what the chaining needs: the map and the records opened per state.

    ``other`` tells of pieces with records that close in another way (as an empty tag, or with
    blanks in the end tag). Written once, since seq and block must come from the same splits.
    """
    name = re.escape(tag)
    other = rf"</{name}\s+>|<{name}(?:\s(?:[^\"'>/]++|\"[^\"]*+\"|'[^']*+'|/(?!>))*+)?/>"
    pieces = _pieces(spark, path, f"</{tag}>", _size=True, **options)
    may_be = F.contains(F.col("value"), F.lit("/>")) | F.contains(F.col("value"), F.lit(f"</{tag}"))
    return written(
        spark,
        _measured(pieces, tag).select(
            "value", "file", "block", "seq", "size",
            (F.octet_length("value") + len(f"</{tag}>".encode())).alias("bytes"),
            "code",
            *[f"opened{s}" for s in range(4)],
            F.when(may_be, F.col("value").rlike(other)).otherwise(False).alias("other"),
        ),
        "xml-pieces",
    )


def _record_of_pieces(pieces: DataFrame) -> DataFrame:
    """Per piece (seq) the last piece of the record it belongs to (end_seq). Numbers only, no text is moved."""
    in_split = Window.partitionBy("file", "block")
    so_far = in_split.orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    from_here = in_split.orderBy(F.desc("seq")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    in_file = Window.partitionBy("file")
    before = in_file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # Later splits come first in this order, which keeps the frame a running one.
    after = in_file.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)

    maps = _chained(pieces.select("file", "block", F.col("seq").alias("place"), "code"), "file", "block")
    splits = maps.groupBy("file", "block").agg(F.max_by(_then(F.col("before"), F.col("code")), "place").alias("code"))
    splits = _chained(splits.select("file", F.col("block").alias("place"), "code"), "file")
    states = splits.select("file", F.col("place").alias("block"), F.col("before").bitwiseAND(3).alias("begins"))

    # Without a separator at its end, what is left of a file closes nothing.
    sizes = pieces.groupBy("file").agg(
        F.max_by("seq", F.struct("block", "seq")).alias("last"), (F.sum("bytes") > F.max("size")).alias("open_end")
    )
    tails = sizes.filter("open_end").select(F.col("last").alias("seq"), F.lit(True).alias("tail"))
    numbers = pieces.select("file", "block", "seq", *[f"opened{s}" for s in range(4)])
    known = (
        numbers.join(maps.select(F.col("place").alias("seq"), "before", "code"), "seq")
        .join(states, ["file", "block"])
        .join(tails, "seq", "left")
        .withColumn("state", _image(F.col("before"), F.col("begins")))
        .withColumn("closes", (_image(F.col("code"), F.col("state")) == 0) & F.col("tail").isNull())
        .withColumn("opened", F.array(*[F.col(f"opened{s}") for s in range(4)])[F.col("state")])
        .withColumn("depth", F.sum(F.col("opened") - F.col("closes").cast("int")).over(so_far))
    )
    levels = known.groupBy("file", "block").agg(F.max_by("depth", "seq").alias("total"))
    levels = levels.select("file", "block", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("level"))
    ends = (
        known.select("file", "block", "seq", "closes", "depth")
        .join(levels, ["file", "block"])
        .withColumn("end", F.when(F.col("closes") & (F.col("level") + F.col("depth") == 0), F.col("seq")))
        .withColumn("own", F.min("end").over(from_here))
    )
    following = ends.groupBy("file", "block").agg(F.min("end").alias("first"))
    following = following.select("file", "block", F.last("first", ignorenulls=True).over(after).alias("next"))
    return ends.join(following, ["file", "block"]).select("seq", F.coalesce("own", "next").alias("end_seq")).filter("end_seq is not null")


def xml_records(spark: SparkSession, pieces: DataFrame, tag: str) -> DataFrame:
    """Texts of the records in ``pieces``, one row each: value, file.

    A record may hold others of its own name and go over any number of splits.
    A record that never closes is left out. Most records are one piece and
    meet nothing; only those of several pieces are put together.
    """
    numbers = written(spark, _record_of_pieces(pieces), "xml-places")
    spread = numbers.groupBy("end_seq").agg(F.count("*").alias("n")).filter("n > 1").select("end_seq")
    texts = pieces.select("seq", "file", "block", "value")
    single = texts.join(numbers.filter("seq = end_seq").join(spread, "end_seq", "left_anti"), "seq").select("file", "value")
    several = texts.join(numbers.join(spread, "end_seq"), "seq").groupBy("end_seq", "file").agg(
        F.sort_array(F.collect_list(F.struct("block", "seq", "value"))).alias("parts")
    )
    joined = several.select("file", F.array_join(F.transform("parts", lambda p: p["value"]), f"</{tag}>").alias("value"))
    name = re.escape(tag)
    lead_in = rf"(?s)^(?:[^<]++|{_SECTION}|<(?!{name}[\s>]))*+"
    return single.unionByName(joined).select(
        F.concat(F.regexp_replace("value", lead_in, ""), F.lit(f"</{tag}>")).alias("value"), "file"
    )


# Options that choose files; the others say how a record is read.
FILE_OPTIONS = ("recursiveFileLookup", "pathGlobFilter", "modifiedBefore", "modifiedAfter", "ignoreMissingFiles", "ignoreCorruptFiles", LOOSE)
# Options about what only the reader of whole files does.
WHOLE_OPTIONS = ("mode", "columnNameOfCorruptRecord", "encoding", "charset", "samplingRatio", "rowValidationXSDPath", "compression")


def _split_bytes(spark: SparkSession) -> int:
    """Bytes of a split as the session sets them."""
    number, unit = re.match(r"(\d+)\s*([kmgtp]?)", spark.conf.get("spark.sql.files.maxPartitionBytes").lower()).groups()
    return int(number) * 1024 ** " kmgtp".index(unit or " ")


def record_options(options: dict[str, str]) -> dict[str, str]:
    """The options that say how a record is read, as texts."""
    plain = {k: v for k, v in options.items() if k not in FILE_OPTIONS}
    return {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in plain.items()}


def cut_xml(spark: SparkSession, path: str | list[str], row_tag: str, split: bool | None = None, **options) -> DataFrame | None:
    """Record texts of XML files, null where the built-in source should read the files.

    The built-in source reads a file in one task and files side by side, which
    is as good while no file is larger than a split; ``split`` decides otherwise.
    Files whose records close as empty tags, or with blanks in the end tag, are
    left to it too. Both ways give the same rows.
    """
    files = {k: v for k, v in options.items() if k in FILE_OPTIONS}
    if split is False or any(k in options for k in WHOLE_OPTIONS):
        return None
    if split is None:
        plain = scan(spark.read.format("binaryFile").options(**files).load(path), files).filter(F.lower("path").endswith(".xml"))
        if (plain.agg(F.max("length").alias("n")).first()["n"] or 0) <= _split_bytes(spark):
            return None
    pieces = xml_pieces(spark, path, row_tag, **files)
    if not pieces.filter("other").isEmpty():
        return None
    return written(spark, xml_records(spark, pieces, row_tag), "xml-records")
