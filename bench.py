"""Time the headline queries and print one JSON line.

``queries`` are this library's; ``plain`` holds the same work done the obvious way (four
scans per run, one database connection, one job per object) for comparison.
"""

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headrace.catalogue import QUERIES
from headrace.catalogue.audit import run_events
from headrace.catalogue.base import CATALOG_SOURCE, objects_frame, schema_with, sources_frame, table
from headrace.catalogue.relational import _to_derby
from headrace.operators import runlog, target
from headrace.plans.ingest import ingest_all, raise_for_failures
from headrace.session import new_dir, new_schema
from headrace.sources.relational import read_jdbc

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "full_extract", "incremental_extract", "custom_query_incremental", "document_match_extract",
    "delimited_extract", "fixed_width_extract", "file_drop_parquet", "landing_roundtrip", "bronze_append",
    "bronze_overwrite", "bronze_merge", "bronze_merge_partitioned", "bronze_merge_composite",
    "partitioned_write", "discover_objects", "adapt_delimited_config", "audit_run_log", "audit_last_status",
    "ingest_incremental_merge", "run_summary", "stream_file_drop",
]


def session() -> SparkSession:
    folder = tempfile.mkdtemp(prefix="headrace-bench-")
    builder = (SparkSession.builder.master(f"local[{CPUS}]").appName("headrace-bench")
               .config("spark.sql.shuffle.partitions", CPUS)
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "16g")
               .config("spark.scheduler.mode", "FAIR")
               .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
               .config("spark.checkpoint.dir", f"{folder}/shared"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    return spark


def drain(df: DataFrame) -> None:
    """Compute every row and column, and keep none."""
    df.write.format("noop").mode("overwrite").save()


def timed(work) -> float:
    began = time.perf_counter()
    work()
    return round(time.perf_counter() - began, 3)


def _joined_orders(schema: str) -> str:
    return (f"SELECT l.*, o.o_custkey, o.o_orderdate FROM {schema}.lineitem l "
            f"JOIN {schema}.orders o ON l.l_orderkey = o.o_orderkey")


def run_once(spark: SparkSession) -> None:
    """An incremental custom-query run with landing, metrics and append: one pass over the source."""
    schema = schema_with(spark, SF_DIR, "lineitem", "orders")
    objects = objects_frame(spark, {
        "ingestion_object_id": 1, "source_system_id": 1, "source_object_name": "lines",
        "custom_query": _joined_orders(schema), "load_type": "incremental", "incremental_column": "o_orderdate",
        "incremental_end_value": "1970-01-01", "target_schema": schema, "target_table": "bronze"})
    raise_for_failures(ingest_all(spark, sources_frame(spark, CATALOG_SOURCE), objects, f"{schema}.runs",
                                  landing_base=new_dir(spark)))


def run_four_scans(spark: SparkSession) -> None:
    """The same run with the batch evaluated for the maximum, the count, landing and bronze."""
    schema = schema_with(spark, SF_DIR, "lineitem", "orders")
    batch = spark.sql(_joined_orders(schema)).filter("o_orderdate > TIMESTAMP_NTZ '1970-01-01'")
    batch.agg(F.max("o_orderdate")).collect()
    batch.count()
    stamped = batch.withColumn("_ingested_at", F.current_timestamp())
    stamped.write.parquet(new_dir(spark))
    stamped.write.saveAsTable(f"{schema}.bronze")


def merge_share(spark: SparkSession, percent: int, partition_column: str | None = None):
    """Merge the newest rows, about this share of orders, into a target of all orders."""
    name, orders = f"{new_schema(spark)}.bronze", table(spark, SF_DIR, "orders")
    orders = orders.withColumn("o_year", F.year("o_orderdate"))
    target.append(orders, name, partition_column=partition_column)
    cut = orders.agg(F.percentile(F.unix_seconds(F.col("o_orderdate").cast("timestamp")),
                                  1 - percent / 100)).first()[0]
    batch = (orders.filter(F.unix_seconds(F.col("o_orderdate").cast("timestamp")) >= cut)
             .withColumn("o_totalprice", F.col("o_totalprice") + 1))
    return lambda: target.merge(batch, name, ["o_orderkey"])


def status_by_object(spark: SparkSession) -> None:
    runs = runlog.current_runs(run_events(spark, SF_DIR))
    for row in runs.select("table_id").distinct().orderBy("table_id").limit(10).collect():
        runlog.last_status_of(runs, row.table_id)


def main() -> None:
    spark = session()
    drain(QUERIES["ingest_incremental_merge"](spark, SF_DIR))  # warm the JVM
    names = sys.argv[1:] or HEADLINE
    queries = {}
    for name in names:
        queries[name] = min(timed(lambda: drain(QUERIES[name](spark, SF_DIR))) for _ in range(2))
    plain = {}
    if not sys.argv[1:]:
        queries["run_once"] = min(timed(lambda: run_once(spark)) for _ in range(2))
        plain["run_four_scans"] = min(timed(lambda: run_four_scans(spark)) for _ in range(2))
        queries["merge_1_percent"] = timed(merge_share(spark, 1))
        queries["merge_50_percent"] = timed(merge_share(spark, 50))
        queries["merge_1_percent_partitioned"] = timed(merge_share(spark, 1, "o_year"))
        options = _to_derby(table(spark, SF_DIR, "lineitem"), "lineitem",
                            "l_returnflag VARCHAR(1), l_linestatus VARCHAR(1)")
        paged = dict(page_column='"l_orderkey"', pages=4, fetch_size=50000)
        queries["jdbc_4_pages"] = timed(lambda: drain(read_jdbc(spark, options, name="lineitem", **paged)))
        plain["jdbc_1_page"] = timed(lambda: drain(read_jdbc(spark, options, name="lineitem", fetch_size=50000)))
        plain["audit_last_status_of_10_objects"] = timed(lambda: status_by_object(spark))
    print(json.dumps({"metric": "total time of the headline queries", "value": round(sum(queries.values()), 3),
                      "unit": "sec", "queries": queries, "plain": plain, "sf": float(Path(SF_DIR).name.removeprefix("sf"))}))


if __name__ == "__main__":
    main()
