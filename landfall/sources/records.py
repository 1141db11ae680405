"""Record texts of JSON files, cut without reading a file in one task, and what XML files begin with.

Scans take plain text with the record's closing mark as line separator, so one
huge file still spreads over all its splits. Each row carries the file,
the start of its split (``block``) and its order within the split (``seq``).
"""

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from landfall.functions.names import decoded, literal_path
from landfall.sources.files import LOOSE, scan
from landfall.workspace import written


def _pieces(
    spark: SparkSession, path: str | list[str], separator: str, _size: bool = False, **options
) -> DataFrame:
    columns = [
        F.col("value"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
    ]
    if _size:
        columns.append(F.col("_metadata.file_size").alias("size"))
    return scan(spark.read.option("lineSep", separator).options(**options).text(path), options).select(*columns)


def head_pieces(spark: SparkSession, path: str | list[str], separator: str, n: int, **options) -> list[str]:
    """First non-blank pieces of the first split, ``n`` at most."""
    rows = (
        _pieces(spark, path, separator, **options)
        .filter((F.col("block") == 0) & F.col("value").rlike(r"\S"))
        .limit(n)
        .collect()
    )
    return [r["value"] for r in rows]


def file_lines(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """Every line, with whatever stands before its line break."""
    return _pieces(spark, path, "\n", **options)


def json_lines(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """One row per non-blank line."""
    return _pieces(spark, path, "\n", **options).filter(F.col("value").rlike(r"\S"))


def json_forms(spark: SparkSession, path: str | list[str], **options) -> dict[str, bool]:
    """Per file: is it a document (an array, or an object spread over lines) and not one object per line?

    A file that begins with a bracket is a document. One that begins with an
    object is a document if none of its lines is an object by itself, or if its
    first line leaves something open and fewer than half of the lines are. Every
    line counts, so bad lines at the beginning do not change the form. One
    entry per file that is not blank.
    """
    place = F.struct("block", "seq")
    text = F.ltrim(F.regexp_replace("value", "^\ufeff", ""), F.lit(" \t\r\n"))
    pieces = _pieces(spark, path, "}", **options).select("file", "block", "seq", F.substring(text, 1, 1).alias("sign"))
    firsts = pieces.filter("sign != ''").groupBy("file").agg(F.min_by("sign", place).alias("sign")).collect()
    forms = {r["file"]: r["sign"] == "[" for r in firsts}
    unclear = [file for file, document in forms.items() if not document]
    if not unclear:
        return forms
    # Only the files that need it are read by lines: an array may be one long line.
    whole = len(unclear) == len(forms)
    places = path if whole else _paths(spark, unclear)
    lines = _pieces(spark, places, "\n", **(options if whole else {k: v for k, v in options.items() if k != LOOSE})).filter(F.col("value").rlike(r"\S"))
    tail = F.regexp_extract("value", r"(\S)\s*$", 1)
    found = lines.select("file", "block", "seq", tail.alias("tail"), line_object(F.col("value")).isNotNull().cast("int").alias("object"))
    judged = found.groupBy("file").agg(
        F.min_by("tail", place).alias("tail"), F.sum("object").alias("objects"), F.count("*").alias("lines")
    )
    for r in judged.collect():
        open_line = r["tail"] in ("{", "[", ",", ":")
        forms[r["file"]] = not r["objects"] or (open_line and 2 * r["objects"] < r["lines"])
    return forms


def _paths(spark: SparkSession, files: list[str]) -> list[str]:
    """File paths as readers take them."""
    rows = spark.createDataFrame([(f,) for f in files], "file string").select(decoded(F.col("file")).alias("path"))
    return [literal_path(r["path"]) for r in rows.collect()]


def _line_values(line: Column, value_type: str) -> Column:
    """The JSON values of a line, read as an array so trailing text is an error."""
    strict = {"allowSingleQuotes": "false"}
    return F.from_json(F.concat(F.lit("["), line, F.lit("]")), f"array<{value_type}>", strict)


def line_object(line: Column) -> Column:
    """The single object of a line as a map of texts in key order, null if there is none."""
    values = _line_values(line, "map<string,string>")
    return F.when(F.size(values) == 1, values[0])


def is_json_value(line: Column) -> Column:
    """True for a line holding one readable JSON value of any kind."""
    return F.coalesce(F.size(_line_values(line, "string")) == 1, F.lit(False))


def json_documents(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """Every top-level object of array or single-object JSON files, one row each.

    The text is cut at each "}". A piece alone does not tell whether it starts
    inside a string or how deep it is, so each split is summarised for both
    string states, the summaries (one row per split) are chained per file, and
    the pieces then learn which object they belong to. No window spans more
    than the pieces of one split or the split summaries of one file. An object
    that never closes comes out as an unreadable text.
    """
    in_split = Window.partitionBy("file", "block")
    so_far = in_split.orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def less(text: Column, char: str) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))

    def opened(text: Column) -> Column:
        return less(F.regexp_replace(text, '"[^"]*(?:"|$)', ""), "{")

    # All text work happens here. A piece is counted for both of its possible
    # beginnings. The pieces are written once: the split summaries and the pieces
    # must come from the same splits, and two scans might be split differently.
    # The summary then reads only the numbers.
    counted = (
        _pieces(spark, path, "}", _size=True, **options)
        .withColumn("bare", F.regexp_replace("value", r"(?s)\\.", ""))
        .select(
            "value", "file", "block", "seq", "size",
            (F.octet_length("value") + 1).alias("bytes"),
            less(F.col("bare"), '"').alias("quotes"),
            opened(F.col("bare")).alias("open_outside"),
            opened(F.regexp_replace("bare", '^[^"]*(?:"|$)', "")).alias("open_inside"),
        )
    )
    pieces = (
        written(spark, counted, "json-pieces")
        .withColumn("odd", (F.sum("quotes").over(so_far) - F.col("quotes")) % 2 == 1)
        .withColumn("last_piece", F.col("seq") == F.max("seq").over(in_split))
    )
    # State 0: the split starts outside a string; state 1: inside one.
    for state, in_string in ((0, F.col("odd")), (1, ~F.col("odd"))):
        pieces = (
            pieces.withColumn(f"opened{state}", F.when(in_string, F.col("open_inside")).otherwise(F.col("open_outside")))
            .withColumn(f"close{state}", (F.col("quotes") % 2 == 0) != in_string)
            .withColumn(
                f"depth{state}",
                F.sum(F.col(f"opened{state}") - F.col(f"close{state}").cast("int")).over(so_far),
            )
        )

    # Depth is never negative and is zero exactly where an object ends. The
    # last piece is kept apart: a file's tail has no "}" and closes nothing.
    summary = [F.sum("quotes").alias("quotes"), F.max("size").alias("size")]
    summary.append(F.sum("bytes").alias("bytes"))
    for s in (0, 1):
        inner = F.col(f"close{s}") & ~F.col("last_piece")
        summary += [
            F.min(F.when(inner, F.col(f"depth{s}"))).alias(f"least{s}"),
            F.max(F.when(F.col("last_piece"), F.col(f"depth{s}"))).alias(f"total{s}"),
            F.max(F.when(F.col("last_piece"), F.col(f"close{s}"))).alias(f"closed{s}"),
        ]
    in_file = Window.partitionBy("file")
    before = in_file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # Later splits come first in this order, which keeps the frame a running one.
    after = in_file.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)

    def chosen(name: str) -> Column:
        return F.when(F.col("state") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))

    splits = (
        pieces.groupBy("file", "block")
        .agg(*summary)
        .withColumn("state", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
        .withColumn("start", F.coalesce(F.sum(chosen("total")).over(before), F.lit(0)))
        .withColumn("last_split", F.col("block") == F.max("block").over(in_file))
        .withColumn("cut_off", F.sum("bytes").over(in_file) > F.col("size"))
        .withColumn("tail", F.col("last_split") & F.col("cut_off"))
        .withColumn(
            "has_end",
            (F.col("start") + F.coalesce(chosen("least"), F.lit(1)) == 0)
            | (chosen("closed") & (F.col("start") + chosen("total") == 0) & ~F.col("tail")),
        )
        .withColumn("next_block", F.min(F.when(F.col("has_end"), F.col("block"))).over(after))
        .select("file", "block", "state", "start", "tail", "next_block")
    )

    depth = F.col("start") + chosen("depth")
    is_end = chosen("close") & (depth == 0) & ~(F.col("tail") & F.col("last_piece"))
    starts = (chosen("opened") > 0) & (depth - chosen("opened") + chosen("close").cast("int") == 0)
    # A piece belongs to the next end: in its own split, numbered there, or
    # else the first end of the next split that has one.
    last_end = F.max(F.when(F.col("end") == 1, F.col("seq"))).over(in_split)
    placed = (
        pieces.join(splits, ["file", "block"])
        .withColumn("end", is_end.cast("int"))
        .withColumn("starts", starts)
        .withColumn("here", F.coalesce(F.col("seq") <= last_end, F.lit(False)))
        .withColumn("ended", F.sum("end").over(so_far) - F.col("end"))
        .withColumn("end_block", F.when(F.col("here"), F.col("block")).otherwise(F.col("next_block")))
        .filter(F.col("end_block").isNotNull() | F.col("starts"))
    )
    nth = F.when(F.col("here"), F.col("ended")).otherwise(F.lit(0)).alias("nth")
    objects = (
        placed.select("file", "end_block", nth, F.struct("block", "seq", "value").alias("piece"))
        .groupBy("file", "end_block", "nth")
        .agg(F.sort_array(F.collect_list("piece")).alias("pieces"))
    )
    joined = F.array_join(F.transform("pieces", lambda p: p["value"]), "}")
    lead_in = r'(?s)^[^{"]*+(?:"(?:[^"\\]++|\\.)*+"[^{"]*+)*+'
    closing = F.when(F.col("end_block").isNull(), "").otherwise("}")
    return objects.select(
        F.concat(F.regexp_replace(joined, lead_in, ""), closing).alias("value"),
        "file",
        F.coalesce("end_block", F.element_at("pieces", 1)["block"]).alias("block"),
        F.col("nth").alias("seq"),
    )


def json_records(spark: SparkSession, path: str | list[str], document: bool | None = None, **options) -> DataFrame:
    """Object texts of JSON files, each cut by its own form if none is given."""
    if document is not None:
        return (json_documents if document else json_lines)(spark, path, **options)
    forms = json_forms(spark, path, **options)
    documents, lines = ([f for f, d in forms.items() if d is wanted] for wanted in (True, False))
    if not documents or not lines:
        return (json_documents if documents else json_lines)(spark, path, **options)
    options = {k: v for k, v in options.items() if k not in ("pathGlobFilter", LOOSE)}
    objects = json_documents(spark, _paths(spark, documents), **options)
    return objects.unionByName(json_lines(spark, _paths(spark, lines), **options))


def xml_tags(spark: SparkSession, path: str | list[str], **options) -> tuple[str | None, str | None]:
    """Root tag and the tag of its first child, null where there is none.

    More of the file's beginning is taken until both are found or it ends, so
    a prolog may be of any length.
    """
    n, root, child = 64, None, None
    while True:
        head = head_pieces(spark, path, ">", n, **options)
        text = ">".join(head) + ">"
        blanked = F.regexp_replace(F.lit(text), r"(?s)<!--.*?(-->|$)|<\?.*?(\?>|$)|<!\[CDATA\[.*?(\]\]>|$)|<![^>]*>", "")
        tags = F.regexp_extract_all(blanked, F.lit(r"<(/?[^\s<>/]+)(?:\s[^>]*)?/?>"), 1)
        found = spark.range(1).select(tags.alias("tags")).first()["tags"]
        root = found[0] if found and not found[0].startswith("/") else None
        child = found[1] if len(found) > 1 and not found[1].startswith("/") else None
        if len(found) > 1 or len(head) < n:
            return root, child
        n *= 8


def tag_order(spark: SparkSession, path: str | list[str], row_tag: str, names: list[str], **options) -> list[str]:
    """The names in the order in which their tags first show in the text; those that never do come last.

    The text is only looked at for places, never taken apart. Of loose files
    only names that show are kept: the others come from delivered folders.
    """
    if not names or (len(names) < 2 and LOOSE not in options):
        return list(names)
    pieces = _pieces(spark, path, f"</{row_tag}>", **options)
    places = [F.regexp_instr("value", F.lit("<" + re.escape(n) + r"[\s/>]")).alias(f"p{i}") for i, n in enumerate(names)]
    firsts = [
        F.min(F.when(F.col(f"p{i}") > 0, F.struct("file", "block", "seq", F.col(f"p{i}").alias("at")))).alias(f"f{i}")
        for i in range(len(names))
    ]
    row = pieces.select("file", "block", "seq", *places).agg(*firsts).first()
    shown = {n: tuple(row[f"f{i}"]) if row[f"f{i}"] else None for i, n in enumerate(names)}
    if LOOSE in options:
        shown = {n: place for n, place in shown.items() if place is not None}
    return sorted(shown, key=lambda n: (shown[n] is None, shown[n] or (), n))
