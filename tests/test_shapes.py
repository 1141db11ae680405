"""Shapes of the physical plans that matter at scale."""

import contextlib
import io
import json
import pathlib
import random
import re

import pytest
from pyspark.sql import functions as F

from landfall import workspace
from landfall.operators.infer import infer_groups, infer_json, infer_table, json_keys
from landfall.operators.publish import write_files
from landfall.operators.schema import INVENTORY, evolution
from landfall.queries import common, inference
from landfall.sources.readers import LONG, checked_rows, read_csv
from landfall.sources.records import json_documents, json_lines


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def test_inference_is_one_partial_aggregate_over_pruned_columns(spark, tmp_path):
    spark.range(100).selectExpr("id", "cast(id as string) a", "'x' b").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    text = plan(infer_table(df.select("id", "a").filter("id > 5")))
    assert "ReadSchema: struct<id:bigint,a:string>" in text
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,5)]" in text
    assert len(re.findall(r"^\(\d+\) Exchange$", text, re.M)) == 1
    assert len(re.findall(r"^\(\d+\) HashAggregate$", text, re.M)) == 2
    assert "Sort" not in text and "Python" not in text


def test_grouped_inference_shuffles_partial_results_only(spark, tmp_path):
    spark.range(100).selectExpr("id % 3 g", "cast(id as string) a").write.parquet(str(tmp_path / "t"))
    text = plan(infer_groups(spark.read.parquet(str(tmp_path / "t")), ["g"]))
    assert len(re.findall(r"^\(\d+\) Exchange$", text, re.M)) == 1
    assert len(re.findall(r"^\(\d+\) HashAggregate$", text, re.M)) == 2


def test_record_inference_hash_aggregates_before_the_first_shuffle(spark, zone):
    path = zone("a.json", '{"x": 1}')
    text = plan(json_keys(json_lines(spark, path)))
    tree = text[: text.index("\n\n")].splitlines()
    lowest = max(i for i, line in enumerate(tree) if "Exchange" in line)
    assert "HashAggregate" in tree[lowest + 1] and "Python" not in text


def test_record_scans_shuffle_nothing(spark, zone):
    assert "Exchange" not in plan(json_lines(spark, zone("a.json", '{"x": 1}')))


def test_document_summary_reads_no_text(spark, zone):
    text = plan(json_documents(spark, zone("a.json", json.dumps([{"x": i} for i in range(9)]))))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert len(schemas) == 2
    assert sorted("value:" in s for s in schemas) == [False, True]
    # Running frames only: a frame that looks ahead row by row is quadratic.
    assert "currentrow$(), unboundedfollowing" not in text and "1, unboundedfollowing" not in text


def test_header_scan_pushes_columns(spark, zone):
    text = plan(read_csv(spark, zone("a.csv", "a,b,c\n1,2,3")).select("b"))
    assert "ReadSchema: struct<b:string>" in text


def test_evolution_windows_are_per_table(spark):
    text = plan(evolution(spark.createDataFrame([("d", "t", 1, 1, "a", "int")], INVENTORY)))
    assert "SinglePartition" not in text


def test_a_cluster_needs_a_shared_folder():
    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Session:
        conf = Conf({"spark.master": "yarn"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace.shared_folder(Session)
    Session.conf[workspace.CHECKPOINT_DIR] = "hdfs:///shared"
    assert workspace.fresh_folder(Session, "x").startswith("hdfs:///shared/landfall/x-")


def test_one_hot_group_is_folded_before_the_shuffle(spark):
    hot = spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("g"),
        F.col("id").cast("string").alias("v"),
    )
    types = infer_groups(hot, ["g"])
    assert types.count() == 20_001
    assert types.filter("g = 'hot' and type = 'int'").count() == 1


def test_types_and_long_rows_come_from_one_scan(spark, zone):
    rows = checked_rows(spark, zone("a.csv", "a,b\n1,2\n1,2,3"), multiLine="true")
    both = rows.agg(F.count(LONG).alias("long"), *[F.max(c).alias(c) for c in ("a", "b")])
    assert plan(both).count("Scan csv") == 2  # once in the tree, once in the list
    assert both.first()["long"] == 1


def test_keys_are_numbered_without_a_list_of_all(spark, zone):
    # A document like a map: more keys than a range holds, each once, in an order of its own.
    keys = [f"k{i * 7919 % 20_000:05d}" for i in range(20_000)]
    lines = "\n".join(json.dumps({k: i for i, k in enumerate(keys[j : j + 50])}) for j in range(0, 20_000, 50))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = infer_json(json_lines(spark, zone("map.json", lines)))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [(r["pos"], r["name"]) for r in found.orderBy("pos").collect()] == list(enumerate(keys, 1))
    text = plan(found)
    assert "collect_list" not in text and "BroadcastHashJoin" in text


def test_balanced_files_are_alike_whatever_the_tasks(spark, tmp_path):
    # One task holds nine tenths of the rows.
    skewed = spark.range(0, 200_000, 1, 8).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    skewed = skewed.repartition(8, F.when(F.col("id") % 10 > 0, 0).otherwise(F.col("id")))
    folder = {}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(2 * 2**20))
    try:
        for name, balanced in (("as-is", False), ("balanced", True)):
            path = tmp_path / name
            assert write_files(skewed, str(path), balanced=balanced) == 200_000
            folder[name] = sorted(p.stat().st_size for p in path.glob("part-*"))
        # What is small shares a file.
        assert write_files(skewed.limit(2000), str(tmp_path / "small"), balanced=True) == 2000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert folder["as-is"][-1] > 5 * folder["as-is"][0]
    assert len(folder["balanced"]) > 3 and folder["balanced"][-1] <= 2 * folder["balanced"][0]
    assert len(list((tmp_path / "small").glob("part-*"))) == 1
    with pytest.raises(ValueError, match="either"):
        write_files(skewed, str(tmp_path / "both"), max_files=1, balanced=True)


def test_one_ordered_file_is_written_by_a_task_that_sorts_nothing(spark, tmp_path, monkeypatch):
    def write(df, path, *args, **options):
        plans.append((plan(df), path))
        return write_files(df, path, *args, **options)

    plans = []
    monkeypatch.setattr(common, "write_files", write)
    rows = [(k, 5, "O", "2-HIGH") for k in random.Random(3).sample(range(40_000), 5_000)]
    shape = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string"
    spark.createDataFrame(rows, shape).repartition(4).write.parquet(str(tmp_path / "orders.parquet"))
    inference.infer_types_head_bytes(spark, str(tmp_path)).collect()
    [(text, path)] = plans
    assert "Sort" not in text
    [file] = pathlib.Path(path.removeprefix("file:")).glob("part-*.csv")
    assert [int(line.split(",")[0]) for line in file.read_text().splitlines()[1:]] == sorted(r[0] for r in rows)
