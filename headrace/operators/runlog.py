"""The run log: a start and an end event per run, folded to one row per run."""

import uuid
from datetime import date, datetime, timezone
from decimal import Decimal

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from headrace.functions.frames import small_frame
from headrace.operators.eventlog import append_event, create_log

RUNNING, SUCCESS, FAILED = "RUNNING", "SUCCESS", "FAILED"

RUN_COLUMNS = """config_master_id int, table_id int, delta_layer string, source_name string,
pipeline_name string, load_type string, frequency string, run_id string, trigger_type string,
trigger_id string, trigger_name string, trigger_time timestamp, end_time timestamp,
execution_duration_sec decimal(10,2), source_schema string, source_table string,
target_schema string, target_table string, rows_read long, rows_copied long, rows_deleted long,
total_cost decimal(10,4), department_id int, status string, created_at timestamp, error string,
event_time timestamp"""
_PARTITION = "business_date date, writer string"


def create_run_log(spark: SparkSession, table: str) -> None:
    create_log(spark, table, f"{RUN_COLUMNS}, {_PARTITION}", ["business_date", "writer"])


def _append(spark: SparkSession, table: str, event: dict) -> None:
    append_event(small_frame(spark, [event], RUN_COLUMNS), table, {
        "business_date": f"{event['business_date']:%Y-%m-%d}",
        "writer": spark.sparkContext.applicationId})


def start(spark: SparkSession, table: str, source: Row, obj: Row, pipeline_name: str | None = None,
          trigger_type: str = "MANUAL", trigger_id: str | None = None, business_date: date | None = None,
          frequency: str | None = None, department_id: int | None = None) -> dict:
    """Log that a run began; the returned event is what ``finish`` needs."""
    now = datetime.now(timezone.utc)
    event = {
        "config_master_id": obj.ingestion_object_id, "table_id": obj.ingestion_object_id,
        "delta_layer": obj.delta_layer, "source_name": source.source_name,
        "pipeline_name": obj.pipeline_name or pipeline_name, "load_type": obj.load_type,
        "frequency": frequency, "business_date": business_date or now.date(),
        "run_id": str(uuid.uuid4()), "trigger_type": trigger_type, "trigger_id": trigger_id,
        "trigger_time": now, "source_schema": obj.source_schema, "source_table": obj.source_object_name,
        "target_schema": obj.target_schema, "target_table": obj.target_table,
        "rows_read": 0, "rows_copied": 0, "rows_deleted": 0, "department_id": department_id,
        "status": RUNNING, "created_at": now, "event_time": now,
    }
    _append(spark, table, event)
    return event


def finish(spark: SparkSession, table: str, event: dict, status: str, rows_read: int = 0,
           rows_copied: int = 0, rows_deleted: int = 0, error: str | None = None) -> dict:
    """Log that a run ended, on the clock that started it."""
    now = datetime.now(timezone.utc)
    seconds = round((now - event["trigger_time"]).total_seconds(), 2)
    ended = event | {
        "end_time": now, "event_time": now, "status": status, "rows_read": rows_read,
        "rows_copied": rows_copied, "rows_deleted": rows_deleted, "error": error,
        "execution_duration_sec": Decimal(f"{seconds:.2f}"),
    }
    _append(spark, table, ended)
    return ended


def current_runs(events: DataFrame) -> DataFrame:
    """One row per run: its newest event; an end event wins over a start at the same time."""
    columns = [c for c in events.columns if c != "run_id"]
    order = F.struct("event_time", (F.col("status") != RUNNING).alias("ended"))
    return (events.groupBy("run_id").agg(F.max_by(F.struct(*columns), order).alias("_run"))
            .select("run_id", "_run.*").select(*events.columns))


def last_status(runs: DataFrame) -> DataFrame:
    """Status of the newest run of every object, in one pass."""
    return runs.groupBy("table_id").agg(F.max_by("status", "trigger_time").alias("status"))


def last_status_of(runs: DataFrame, object_id: int) -> str | None:
    """Status of the newest run of one object; None if it never ran."""
    newest = runs.filter(F.col("table_id") == object_id).orderBy(F.desc("trigger_time")).limit(1)
    row = newest.select("status").first()
    return row["status"] if row else None


def failures(runs: DataFrame, pipeline_name: str, run_id_prefix: str | None = None) -> DataFrame:
    """Failed runs of a pipeline, optionally those whose run id starts with a prefix."""
    failed = runs.filter((F.col("pipeline_name") == pipeline_name) & (F.col("status") == FAILED))
    return failed.filter(F.col("run_id").startswith(run_id_prefix)) if run_id_prefix else failed


def tally(runs: DataFrame) -> DataFrame:
    """Number of runs and rows per status."""
    return runs.groupBy("status").agg(F.count(F.lit(1)).alias("runs"),
                                      F.sum("rows_read").alias("rows_read"))
