"""Whole runs: metadata rows in, bronze tables and a run log out."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headrace.catalogue.base import (CATALOG_SOURCE, objects_frame, query, schema_with, shown,
                                     sources_frame, table)
from headrace.catalogue.bronze import _OLD
from headrace.operators import runlog, target
from headrace.plans.ingest import ingest_all, raise_for_failures
from headrace.plans.metadata import adapt_reports
from headrace.session import new_dir


@query(f"""WITH t AS (SELECT * FROM orders WHERE {_OLD}),
b AS (SELECT * FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) FROM t) AND o_orderstatus <> 'P')
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.o_orderkey = t.o_orderkey) UNION ALL SELECT * FROM b""")
def ingest_incremental_merge(spark, sf_dir):
    """An incremental run: watermark from the target, filter, landing, merge, run log."""
    schema = schema_with(spark, sf_dir, "orders")
    target.append(table(spark, sf_dir, "orders").filter(_OLD), f"{schema}.bronze", watermark_column="o_orderdate")
    objects = objects_frame(spark, {
        "ingestion_object_id": 102, "source_system_id": 1, "source_schema": schema,
        "source_object_name": "orders", "source_filter": "o_orderstatus != 'P'", "load_type": "INCREMENTAL",
        "write_mode": "merge", "incremental_column": "o_orderdate",
        "incremental_end_value": "1970-01-01 00:00:00", "primary_key_cols": "o_orderkey",
        "schema_evolution_mode": "merge", "target_schema": schema, "target_table": "bronze"})
    raise_for_failures(ingest_all(spark, sources_frame(spark, CATALOG_SOURCE), objects, f"{schema}.runs",
                                  landing_base=new_dir(spark)))
    return shown(spark, f"{schema}.bronze")


def _run_four(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Three objects and one without the key its merge needs."""
    schema = schema_with(spark, sf_dir, "orders", "customer", "lineitem", "part")
    common = {"source_system_id": 1, "source_schema": schema, "target_schema": schema}
    objects = objects_frame(
        spark,
        common | {"ingestion_object_id": 1, "source_object_name": "orders", "target_table": "b_orders",
                  "write_mode": "overwrite", "primary_key_cols": "o_orderkey", "pipeline_name": "sales"},
        common | {"ingestion_object_id": 2, "source_object_name": "customer", "target_table": "b_customer",
                  "write_mode": "merge", "primary_key_cols": "c_custkey", "pipeline_name": "sales"},
        common | {"ingestion_object_id": 3, "source_object_name": "lineitem", "target_table": "b_lineitem",
                  "partition_column": "l_returnflag", "pipeline_name": "sales"},
        common | {"ingestion_object_id": 4, "source_object_name": "part", "target_table": "b_part",
                  "write_mode": "merge", "pipeline_name": "sales"})
    return schema, ingest_all(spark, sources_frame(spark, CATALOG_SOURCE), objects, f"{schema}.runs",
                              pipeline_name="sales")


@query("""SELECT 1 AS ingestion_object_id, 'SUCCESS' AS status, count(*) AS rows_read FROM orders
UNION ALL SELECT 2, 'SUCCESS', count(*) FROM customer UNION ALL SELECT 3, 'SUCCESS', count(*) FROM lineitem
UNION ALL SELECT 4, 'FAILED', 0""")
def run_summary(spark, sf_dir):
    """A failing object does not stop the others."""
    _, results = _run_four(spark, sf_dir)
    return results.select("ingestion_object_id", "status", "rows_read")


@query("""SELECT 1 AS table_id, 'orders' AS source_table, 'SUCCESS' AS status, count(*) AS rows_copied FROM orders
UNION ALL SELECT 2, 'customer', 'SUCCESS', count(*) FROM customer
UNION ALL SELECT 3, 'lineitem', 'SUCCESS', count(*) FROM lineitem UNION ALL SELECT 4, 'part', 'FAILED', 0""")
def run_log_of_runs(spark, sf_dir):
    """What the run log says about those runs."""
    schema, _ = _run_four(spark, sf_dir)
    return runlog.current_runs(spark.table(f"{schema}.runs")).select(
        "table_id", "source_table", "status", "rows_copied")


@query("""SELECT 'SUCCESS' AS status, run, CASE run WHEN 2 THEN (SELECT count(*) FROM events WHERE value < 10) ELSE n END AS
rows_copied, CASE run WHEN 1 THEN 0 WHEN 2 THEN n ELSE (SELECT count(*) FROM events WHERE value < 10) END AS rows_deleted
FROM (SELECT count(*) AS n FROM events), (VALUES (1), (2), (3)) runs(run)""")
def run_log_deleted(spark, sf_dir):
    """Rows that overwrites took out, as the run log has them."""
    schema = schema_with(spark, sf_dir, "events")
    for condition in (None, "value < 10", None):
        objects = objects_frame(spark, {
            "ingestion_object_id": 1, "source_system_id": 1, "source_schema": schema, "source_object_name": "events",
            "write_mode": "overwrite", "source_filter": condition, "target_schema": schema, "target_table": "bronze"})
        raise_for_failures(ingest_all(spark, sources_frame(spark, CATALOG_SOURCE), objects, f"{schema}.runs"))
    runs = runlog.current_runs(spark.table(f"{schema}.runs"))
    return runs.select("status", F.row_number().over(Window.partitionBy("table_id").orderBy("trigger_time")).alias("run"),
                       "rows_copied", "rows_deleted")


@query("SELECT * FROM events WHERE event_type <> 'error'")
def ingest_file_drops(spark, sf_dir):
    """Two runs over a drop folder; files that came in between are all the second one reads."""
    schema, root = schema_with(spark, sf_dir, "events"), new_dir(spark)
    sources = sources_frame(spark, {"source_id": 4, "source_name": "Reports", "source_type": "SFTP",
                                    "root_path": root, "default_pattern": "*.parquet"})
    objects = objects_frame(spark, {
        "ingestion_object_id": 401, "source_system_id": 4, "source_schema": "inbox/shift_*",
        "source_object_name": "*.parquet", "file_format": "parquet", "write_mode": "append",
        "schema_evolution_mode": "merge", "target_schema": schema, "target_table": "bronze",
        "partition_column": "event_type"})
    events = table(spark, sf_dir, "events")
    for prefix, kinds in (("shift_1", ["view", "signup"]), ("shift_2", ["purchase", "click"]), ("other", ["error"])):
        events.filter(F.col("event_type").isin(kinds)).write.parquet(f"{root}/inbox/{prefix}")
        if prefix != "other":
            raise_for_failures(ingest_all(spark, sources, objects, f"{schema}.runs", ledger=f"{schema}.ledger",
                                          landing_base=f"{root}/landing"))
    return shown(spark, f"{schema}.bronze")


@query("""SELECT * REPLACE (CASE WHEN event_type IN ('view', 'error') THEN value + 1 ELSE value END AS value)
FROM events""")
def ingest_reports(spark, sf_dir):
    """Delimited reports from their own metadata table: the keyed one is merged on its second run."""
    schema, root = schema_with(spark, sf_dir, "events"), new_dir(spark)
    path = root if "://" in root else f"file://{root}"
    micros = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    reports = spark.createDataFrame(
        [(1, 3, "daily", "event_id", f"{path}/daily", "|", "bronze", True),
         (2, 3, "stopped", None, f"{path}/daily", "|", "other", False)],
        "config_master_id int, source_system_id int, report_name string, key_column string, "
        "external_path string, column_delimiter string, bronze_sink_table_name string, is_active boolean")
    objects = adapt_reports(reports.withColumn("bronze_sink_schema_name", F.lit(schema)), "spark_catalog").withColumn(
        "reader_options", F.create_map(F.lit("schema"), F.lit("event_id long, ts timestamp_ntz, user_id long, "
                                                              "event_type string, value double, props string"),
                                       F.lit("timestampNTZFormat"), F.lit(micros), F.lit("escape"), F.lit('"')))
    sources = sources_frame(spark, {"source_id": 3, "source_name": "Reports", "source_type": "s3"})
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    second = events.filter("event_type IN ('view', 'error')").withColumn("value", F.col("value") + 1)
    for batch in (events, second):
        batch.write.options(header=True, sep="|", escape='"', timestampNTZFormat=micros).mode("overwrite").csv(
            f"{root}/daily")
        raise_for_failures(ingest_all(spark, sources, objects, f"{schema}.runs", source_type="S3"))
    return shown(spark, f"{schema}.bronze")


_LATE = "orders WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders) - INTERVAL 30 DAY"


@query(f"""WITH counts AS (
SELECT 1 AS id, count(*) AS n, count(*) AS again, 2 * count(*) AS held FROM lineitem
UNION ALL SELECT 2, count(*), (SELECT count(*) FROM {_LATE}), count(*) FROM orders
UNION ALL SELECT 3, count(*), count(*), count(*) FROM customer
UNION ALL SELECT 4, count(*), count(*), count(*) FROM supplier
UNION ALL SELECT 5, count(*), count(*), count(*) FROM events
UNION ALL SELECT 6, 0, 0, 0)
SELECT id AS ingestion_object_id, CASE WHEN id = 6 THEN 'FAILED' ELSE 'SUCCESS' END AS first_status, n AS first_rows,
CASE WHEN id = 6 THEN 'FAILED' ELSE 'SUCCESS' END AS second_status, again AS second_rows, held AS target_rows
FROM counts""")
def ingest_every_source(spark, sf_dir):
    """Tables, a report, documents and an object without its key in one run, twice.

    The partitioned append holds everything twice, the look-back reads the last month again,
    the keyed report is merged, and what cannot run fails alone.
    """
    schema, root = schema_with(spark, sf_dir, "lineitem", "orders", "supplier", "region"), new_dir(spark)
    base = root if "://" in root else f"file://{root}"
    customer, events = table(spark, sf_dir, "customer"), table(spark, sf_dir, "events")
    customer.write.options(header=True, sep=";", escape='"').csv(f"{root}/reports/customer")
    events.write.json(f"{root}/store/clicks/events")
    sources = sources_frame(
        spark, CATALOG_SOURCE,
        {"source_id": 2, "source_name": "Reports", "source_type": "S3"},
        {"source_id": 3, "source_name": "Clicks", "source_type": "MONGODB", "root_path": f"{root}/store"})
    shop = {"source_system_id": 1, "source_schema": schema}
    rows = [
        shop | {"source_object_name": "lineitem", "partition_column": "l_returnflag"},
        shop | {"source_object_name": "orders", "load_type": "INCREMENTAL", "write_mode": "merge",
                "incremental_column": "o_orderdate", "watermark_lag_sec": 30 * 86400,
                "primary_key_cols": "o_orderkey"},
        {"source_system_id": 2, "source_object_name": "customer", "source_path": f"{base}/reports/customer",
         "column_delimiter": ";", "first_row_header": True, "file_format": "csv", "write_mode": "merge",
         "primary_key_cols": "c_custkey", "reader_options": {"schema": customer.schema.toDDL(), "escape": '"'}},
        shop | {"source_object_name": "supplier", "write_mode": "overwrite", "schema_evolution_mode": "none"},
        {"source_system_id": 3, "source_schema": "clicks", "source_object_name": "events", "page_column": "event_id",
         "write_mode": "overwrite", "reader_options": {"schema": events.schema.toDDL()}},
        shop | {"source_object_name": "region", "write_mode": "merge"}]
    objects = objects_frame(spark, *[r | {"ingestion_object_id": i, "target_schema": schema, "target_table": f"b{i}"}
                                     for i, r in enumerate(rows, 1)])
    first, second = [
        ingest_all(spark, sources, objects, f"{schema}.runs", landing_base=f"{root}/raw")
        .select("ingestion_object_id", F.col("status").alias(f"{run}_status"), F.col("rows_read").alias(f"{run}_rows"))
        for run in ("first", "second")]
    counts = [spark.table(f"{schema}.b{i}").agg(F.lit(i).cast("long").alias("ingestion_object_id"),
                                                F.count(F.lit(1)).alias("n")) for i in range(1, len(rows))]
    held = reduce(DataFrame.unionByName, counts)
    return (first.join(second, "ingestion_object_id").join(held, "ingestion_object_id", "left")
            .withColumn("target_rows", F.coalesce("n", F.lit(0).cast("long"))).drop("n"))
