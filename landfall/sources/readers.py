"""Readers of the landing formats. Each returns a plain DataFrame."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from landfall.functions.names import FORMATS, base_name, decoded, unit_path
from landfall.operators.clean import fill_blank_names, source_name
from landfall.operators.infer import collect_columns, infer_json, infer_present, storage_schema
from landfall.sources.files import LOOSE, first_file, list_keys, scan
from landfall.sources.records import json_records, json_forms, tag_order, xml_tags
from landfall.sources.xml_records import cut_xml, record_options
from landfall.workspace import written

# Attributes and a record's own text are no columns; their names here cannot clash with tags.
XML_NAMES = {"attributePrefix": "@", "valueTag": "@text"}


def read_csv(spark: SparkSession, path, sep: str = ",", infer: bool = False, schema=None, **options) -> DataFrame:
    """CSV with a header and doubled quotes; all strings unless a schema is given or inferred."""
    chosen = {"header": True, "sep": sep, "inferSchema": infer, "escape": '"', **options}
    if schema is None and LOOSE in options:
        alone = {k: v for k, v in chosen.items() if k != "pathGlobFilter"}
        schema = spark.read.options(**alone).csv(options[LOOSE]).schema
    reader = spark.read.options(**chosen)
    return scan((reader.schema(schema) if schema is not None else reader).csv(path), options)


def read_tsv(spark: SparkSession, path, **options) -> DataFrame:
    return read_csv(spark, path, sep="\t", **options)


def read_json(spark: SparkSession, path, schema=None, document: bool | None = None, **options) -> DataFrame:
    """JSON lines, JSON arrays or single objects, decided for each file if not told."""
    forms = {document} if document is not None else set(json_forms(spark, path, **options).values())
    if forms <= {False}:
        reader = spark.read.options(**options)
        return scan((reader.schema(schema) if schema is not None else reader).json(path), options)
    records = json_records(spark, path, document, **options)
    if schema is None:
        records = written(spark, records, "json-objects")
        schema = storage_schema(collect_columns(infer_json(records)))
    return parse_json(records, schema)


def parse_json(records: DataFrame, schema: T.StructType, source_column: str | None = None) -> DataFrame:
    """Rows of JSON object texts, with the name of the file each came from if asked."""
    return _parsed(records, F.from_json("value", schema), source_column)


def _parsed(records: DataFrame, record: Column, source_column: str | None) -> DataFrame:
    extra = [decoded(base_name(F.col("file"))).alias(source_column)] if source_column else []
    rows = records.select(record.alias("_record"), *extra)
    return rows.select("_record.*", *([source_column] if source_column else []))


def read_text(spark: SparkSession, path, column: str = "line", **options) -> DataFrame:
    return scan(spark.read.options(**options).text(path), options).withColumnRenamed("value", column)


def read_xml(
    spark: SparkSession,
    path,
    row_tag: str | None = None,
    schema=None,
    source_column: str | None = None,
    split: bool | None = None,
    records: DataFrame | None = None,
    **options,
) -> DataFrame:
    """XML records; ``row_tag`` defaults to the first child of the root.

    The built-in source reads them, one task a file. Files larger than a split,
    or all with ``split``, are cut into record texts over many tasks, and its
    parser then reads each of those. ``records`` gives texts that are cut already.
    """
    row_tag = row_tag or xml_tags(spark, path, **options)[1]
    if row_tag is None:
        raise ValueError("XML has no records.")
    if records is None:
        records = cut_xml(spark, path, row_tag, split, **options)
    if records is not None:
        shape = schema if schema is not None else _xml_of_texts(records, row_tag, **options).schema
        return _parsed(records, F.from_xml("value", shape, record_options(options)), source_column)
    reader = spark.read.option("rowTag", row_tag).options(**options)
    df = scan((reader.schema(schema) if schema is not None else reader).xml(path), options)
    return df.select("*", source_name(df).alias(source_column)) if source_column else df


def _xml_of_texts(records: DataFrame, row_tag: str, **options) -> DataFrame:
    """What the built-in source makes of record texts; it takes them as a typed data set of the JVM only."""
    reader = records.sparkSession.read.options(**{**record_options(options), "rowTag": row_tag})
    jvm = records.sparkSession._jvm
    texts = getattr(records.select("value")._jdf, "as")(jvm.org.apache.spark.sql.Encoders.STRING())
    return reader._df(reader._jreader.xml(texts))


def infer_xml_columns(
    spark: SparkSession, path, row_tag: str, records: DataFrame | None = None, **options
) -> T.StructType:
    """Text columns for the children of the records, in order of first appearance."""
    as_text = {"inferSchema": False, **XML_NAMES, **options}
    if records is not None:
        found = _xml_of_texts(records, row_tag, **as_text)
    else:
        found = spark.read.options(rowTag=row_tag, **as_text).xml(path)
    names = [n for n in found.schema.names if not n.startswith("@")]
    return T.StructType([T.StructField(n, T.StringType()) for n in tag_order(spark, path, row_tag, names, **options)])


def infer_xml(
    spark: SparkSession,
    path,
    row_tag: str,
    empty_as: str = "string",
    widen: bool = False,
    split: bool | None = None,
    records: DataFrame | None = None,
    **options,
) -> DataFrame:
    """Columns of XML records, typed by the text that reading them as text gives.

    Of a repeated child the last counts, as in reading. A child that is missing says nothing.
    """
    if records is None:
        records = cut_xml(spark, path, row_tag, split, **options)
    shape = infer_xml_columns(spark, path, row_tag, records, **options)
    split = None if records is not None else False
    return infer_present(read_xml(spark, path, row_tag, shape, split=split, records=records, **options), empty_as, widen)


def read_landing(spark: SparkSession, path, fmt: str, **options) -> DataFrame:
    """Dispatch by format or extension; anything unknown is CSV with a header."""
    fmt = FORMATS.get(fmt.lower().lstrip("."), fmt)
    readers = {"tsv": read_tsv, "json": read_json, "text": read_text, "xml": read_xml}
    return readers.get(fmt, read_csv)(spark, path, **options)


def read_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.table(f"`{database}`.`{table}`")


def read_first_csv(spark: SparkSession, path: str) -> tuple[DataFrame, str]:
    """The first CSV file (or delivered folder) in path order, types by all of it."""
    units = list_keys(spark, path).select(unit_path(F.col("path")).alias("path"))
    first = first_file(units).first()
    if first is None:
        raise FileNotFoundError(f"No CSV files found in {path}.")
    return read_csv(spark, first["path"], infer=True), first["path"]


def header_schema(spark: SparkSession, path, **options) -> T.StructType:
    """Schema of the header line alone: every column a string."""
    return fill_blank_names(read_csv(spark, path, **options)).schema



# Column of checked_rows, named so that no header cell is likely to be called so.
LONG = "_long_record"


def checked_rows(spark: SparkSession, path, fmt: str = "csv", **options) -> DataFrame:
    """CSV or TSV rows as text, and LONG: the text of a record that has more fields than the header.

    The reader's own verdict tells which records do not fit, so values that span
    lines are judged as the records they are, in the scan that reads them.
    """
    sep = options.pop("sep", "\t" if fmt == "tsv" else ",")
    header = read_csv(spark, path, sep=sep, **options)
    shape = T.StructType([*(T.StructField(n, T.StringType()) for n in header.columns), T.StructField(LONG, T.StringType())])
    # A record is judged by all of its fields, whichever of them a query needs.
    verdict = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": LONG, "columnPruning": "false"}
    rows = read_csv(spark, path, sep=sep, schema=shape, **{**options, **verdict})
    # A record that does not fit may also be too short.
    wide = ", ".join(f"c{i} string" for i in range(len(header.columns) + 1))
    marks = {k: v for k, v in options.items() if k in ("quote", "escape", "charToEscapeQuoteEscaping")}
    fields = F.from_csv(F.rtrim(LONG, F.lit("\r\n")), wide, {"sep": sep, "escape": '"', **marks})
    # The reader gives no verdict to a scan of the verdict alone; this always true look at a value keeps one in.
    read = F.coalesce(F.length(F.col(f"`{header.columns[0]}`")), F.lit(0)) >= 0
    over = F.when(read & fields[f"c{len(header.columns)}"].isNotNull(), F.rtrim(LONG, F.lit("\r\n")))
    names = fill_blank_names(header).columns
    return rows.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(header.columns, names, strict=True)], over.alias(LONG))


def long_rows(spark: SparkSession, path, fmt: str = "csv", **options) -> DataFrame:
    """Texts of CSV or TSV records with more fields than the header."""
    return checked_rows(spark, path, fmt, **options).filter(F.col(LONG).isNotNull()).select(F.col(LONG).alias("line"))
