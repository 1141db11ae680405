from pyspark.sql import functions as F

import corpus_pipeline
from landfall.workspace import written

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_do_what_their_operators_say(spark, sf_rows):
    from test_near_dedup import brute
    from test_packing import pieces

    docs, seen = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(spark, stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == COLUMNS
        seen.append({r["doc_id"]: r for r in docs.collect()})
    clean, unique, unleaked, masked = seen
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").filter("toxic = 1").collect()}
    assert len(toxic & set(clean)) <= 0.2 * len(toxic) and len(clean) >= len(sf_rows) - len(toxic) * 3
    rows = [(d, r["text"]) for d, r in sorted(clean.items())]
    assert set(unique) == {d for d, _, c, k in brute(rows, 5, 80) if k}
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert set(unleaked) == {d for d, r in unique.items() if not any(i in r["text"] for i in items)}
    assert set(masked) == set(unleaked)
    assert all(r["n_chars"] == len(r["text"]) and "@mail" not in r["text"] for r in masked.values())
    placed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    result = [tuple(r)[:5] for r in placed.select("doc_id", "piece", "start", "length", "ids_crc32").collect()]
    assert sorted(result, key=str) == pieces([(d, r["text"]) for d, r in masked.items()], 2048)


def test_run_is_the_stages_in_order(spark):
    first = corpus_pipeline.run(spark, SF).select("doc_id", "piece", "ids_crc32")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = written(spark, stage(spark, docs, SF), f"again-{name}")
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, docs.select("doc_id", "piece", "ids_crc32").collect()))


def test_columns_of_any_name(spark):
    """Names with dots, spaces, quotes or names that stages use inside stay as they are, with their values."""
    names = ["a.b", "c d", "back`tick", "kept_id", "label", "c0", "copies", "node", "bucket"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    for i, name in enumerate(names):
        docs = docs.withColumn(name, F.col("doc_id") * 10 + i)
    docs = written(spark, docs, "test-names")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(spark, stage(spark, docs, SF), f"test-names-{name}")
        assert docs.columns == COLUMNS + names
    rows = docs.collect()
    assert rows and all([r[n] for n in names] == [r["doc_id"] * 10 + i for i in range(len(names))] for r in rows)
