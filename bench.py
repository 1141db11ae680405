"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR is the data folder, BENCH_CPUS the number of local threads. Each
query runs once to warm up and is then timed. Landing the files that a query
reads back is not counted. ``rows_per_s`` is the rows of the tables a query
works on over its time.
"""

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from landfall.queries import QUERIES
from landfall.queries.common import LANDING, load

# Query -> tables it works on.
HEADLINE = {
    "infer_types_tabular": ["customer", "orders", "events", "part", "lineitem"],
    "infer_types_landed_csv": ["orders", "lineitem"],
    "infer_json_lines": ["orders"],
    "infer_xml_tags": ["customer"],
    "scan_csv": ["orders"],
    "scan_tsv": ["lineitem"],
    "scan_json_array": ["customer"],
    "scan_xml_split": ["part"],
    "scan_text_lines": ["documents"],
    "drop_repeated_header_rows": ["customer"],
    "parse_inferred_values": ["lineitem"],
    "publish_replace_table": ["supplier"],
    "copy_table_clean": ["customer"],
    "schema_diff_strict": ["customer"],
    "schema_evolution": ["customer"],
    "sync_decision": ["customer"],
    "ingest_with_detection": ["lineitem"],
    "ingest_zone_status": ["customer", "supplier", "part", "nation", "pages"],
    "sync_tables_audit": ["customer", "supplier", "part"],
    "stream_new_files": ["events"],
    "land_clean_publish": ["customer"],
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    home = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("landfall-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{home}/warehouse")
        .config("spark.checkpoint.dir", f"{home}/shared")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    names = sys.argv[1:] or HEADLINE
    times, rates = {}, {}
    for name in names:
        for timed in (False, True):
            landed, start = LANDING["seconds"], time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if timed:
                took = time.perf_counter() - start - (LANDING["seconds"] - landed)
                rows = sum(load(spark, sf_dir, t).count() for t in HEADLINE.get(name, []))
                times[name], rates[name] = round(took, 3), round(rows / took)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "rows_per_s": rates,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
