"""Small append-only tables that several drivers may write at once.

Each writer owns a partition folder and writes straight into it: a job's commit cleans
the temporary files of its own folder only, so writers cannot disturb each other.
"""

import threading

from pyspark.sql import DataFrame, SparkSession

from headrace.functions.values import quoted, sql_text

_lock = threading.Lock()


def create_log(spark: SparkSession, table: str, schema: str, partition_by: list[str]) -> None:
    if "." in table:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted(table.rsplit('.', 1)[0])}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted(table)} ({schema}) USING parquet "
              f"PARTITIONED BY ({', '.join(partition_by)})")


def table_folder(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def append_event(df: DataFrame, table: str, partition: dict[str, str], mode: str = "append") -> None:
    """Add rows to one partition, or replace it; the rows carry the other columns."""
    spark = df.sparkSession
    leaf = "/".join(f"{k}={v}" for k, v in partition.items())
    spec = ", ".join(f"{k} = {sql_text(v)}" for k, v in partition.items())
    with _lock:
        df.coalesce(1).write.mode(mode).parquet(f"{table_folder(spark, table)}/{leaf}")
        spark.sql(f"ALTER TABLE {quoted(table)} ADD IF NOT EXISTS PARTITION ({spec})")
        spark.catalog.refreshTable(quoted(table))
