import pytest

SF = "/root/testdata/sf0.001"
LONG = "word " * 40_000 + "x" * 70_000

EDGE_ROWS = [
    (1, None, "a", 1.0, None),
    (2, "", "a", 1.0, "k"),
    (3, " \n\t ", None, None, "k"),
    (4, "one", "b", 2.0, "k"),
    (5, "One two three four five six", "b", 2.0, "k"),
    (6, "one two three four five six", "b", 2.0, "k"),
    (6, "one two three four five six", "b", 2.0, "k"),
    (7, "ünï ß 漢字 <|endoftext|> it's x²", "b", 2.0, "k"),
    (8, LONG, "b", 2.0, "k"),
    (None, "a row without an id has a text of its own", "b", 2.0, "k"),
    (9, "z", "b", 2.0, "k"),
]
# Names that operators use inside.
EDGE_SCHEMA = "doc_id long, text string, lang string, score double, shard string"


@pytest.fixture(scope="session")
def edge_docs(spark):
    extra = spark.createDataFrame(EDGE_ROWS, EDGE_SCHEMA)
    for name in ("key", "node", "label", "gram", "part", "rank", "group", "found", "kept_id", "n_chars"):
        extra = extra.selectExpr("*", f"cast(null as string) as {name}")
    return extra


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


@pytest.fixture(scope="session")
def sf_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def sf_rows(sf_docs):
    return [(r["doc_id"], r["text"]) for r in sf_docs.select("doc_id", "text").collect()]
