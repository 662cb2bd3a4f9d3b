"""Runs: one object end to end, or every selected object with failures isolated."""

import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from headrace.functions.frames import small_frame
from headrace.functions.values import column_name
from headrace.operators import runlog, target
from headrace.operators.eventlog import append_event, create_log
from headrace.operators.incremental import apply_incremental, resolve_watermark, with_metrics
from headrace.operators.landing import land, landing_format
from headrace.operators.layout import load_layout, watermark_hint
from headrace.plans.metadata import discover, object_by_id, source_by_id, target_name
from headrace.sources.file_drop import LEDGER_SCHEMA, consumes, read_selected, select_files
from headrace.sources.registry import read_source
from headrace.sources.relational import filtered_above

log = logging.getLogger(__name__)

RESULT_SCHEMA = """ingestion_object_id long, run_id string, status string, rows_read long,
rows_copied long, error string"""

# Source types without a column watermark: each run reads whole files.
_FILE_TYPES = ("SFTP", "S3")
_DOCUMENT_TYPES = ("MONGODB", "MONGO")


class IngestFailed(RuntimeError):
    """Some objects of a run failed."""


def incremental_column(source: Row, obj: Row) -> str | None:
    """The column the run is incremental on; None for a full read.

    A document query runs verbatim, so no predicate is added to it.
    """
    if obj.load_type != "INCREMENTAL" or source.source_type in _FILE_TYPES:
        return None
    if source.source_type in _DOCUMENT_TYPES and obj.custom_query:
        return None
    return obj.incremental_column or None


def extract(spark: SparkSession, source: Row, obj: Row) -> DataFrame:
    """The rows a run reads: the whole object, or those above the resolved watermark."""
    column = incremental_column(source, obj)
    if column and obj.watermark_lag_sec and obj.write_mode != "merge":
        raise ValueError("watermark_lag_sec reads rows again, so it needs write_mode 'merge'")
    if not column:
        return read_source(spark, source, obj)
    name = target_name(obj)
    watermark = resolve_watermark(spark, name, column, obj.incremental_column_type,
                                  obj.incremental_end_value, watermark_hint(spark, name, column))
    done = False
    if watermark is not None:
        obj, done = filtered_above(spark, source, obj, column, watermark, obj.incremental_column_type, obj.watermark_lag_sec)
    rows = read_source(spark, source, obj)
    return rows if done else apply_incremental(rows, column, watermark, obj.incremental_column_type, obj.watermark_lag_sec)


def _apply(df: DataFrame, source: Row, obj: Row, landing_base: str | None, ingest_date: date,
           run_id: str, on_duplicate: str, batch_of: tuple[str, int] | None = None) -> tuple[int, int, int]:
    """Land and write one batch, reading the source once; returns rows read, written and deleted."""
    spark, name = df.sparkSession, target_name(obj)
    column, declared = incremental_column(source, obj), obj.incremental_column_type
    fmt = landing_format(obj.file_format)
    place = (landing_base, source.source_name, obj.source_schema, obj.source_object_name,
             ingest_date, run_id, obj.file_format)
    by = next((c for c in df.columns if c.lower() == (obj.partition_column or "").lower()), None)
    values = {"values": F.approx_count_distinct(column_name(by))} if by else {}
    seen = {}
    batch = target.stamp(df, datetime.now(timezone.utc))
    with target.scratch_tables(spark, name) as keep:
        if landing_base and fmt == "parquet":
            observed, metrics = with_metrics(batch, **values)
            path = land(observed, *place)
            batch, seen = spark.read.schema(batch.schema).parquet(path), metrics.get
        elif landing_base or obj.write_mode == "merge":
            observed, metrics = with_metrics(batch, **values)
            batch, seen = keep(observed), metrics.get
            if landing_base:
                land(batch, *place)
        result = target.write(
            batch, name, obj.write_mode, keys=obj.key_columns, on_duplicate=on_duplicate, order_by=column,
            evolution=obj.schema_evolution_mode, partition_column=obj.partition_column,
            watermark_column=column, watermark_type=declared, batch_of=batch_of,
            partition_values=seen.get("values"))
        return seen.get("rows", result.rows), result.rows, result.deleted


def prepare_logs(spark: SparkSession, run_log: str, ledger: str | None = None) -> None:
    """Create the run log and the ledger of consumed files if they are missing."""
    if not spark.catalog.tableExists(run_log):
        runlog.create_run_log(spark, run_log)
    if ledger and not spark.catalog.tableExists(ledger):
        create_log(spark, ledger, LEDGER_SCHEMA, ["object_key", "number"])


def _claim(spark: SparkSession, source: Row, obj: Row, ledger: str, run_id: str) -> tuple[list[Row], tuple[str, int]]:
    """The files no write of the target took in yet, noted under the number of the next one."""
    key = str(obj.ingestion_object_id)
    layout = load_layout(spark, target_name(obj))
    done = layout.applied.get(f"files-{key}", 0) if layout else 0
    seen = spark.table(ledger).filter((F.col("object_key") == key) & (F.col("number") <= done))
    files = select_files(spark, source, obj, seen)
    claimed = spark.createDataFrame([(f.file_path, f.modified, run_id) for f in files],
                                    "file_path string, modified timestamp, run_id string")
    # files that a failed run noted under this number are not its any more
    append_event(claimed, ledger, {"object_key": key, "number": str(done + 1)}, mode="overwrite")
    return files, (f"files-{key}", done + 1)


def ingest_object(spark: SparkSession, source: Row, obj: Row, run_log: str, landing_base: str | None = None,
                  ledger: str | None = None, pipeline_name: str | None = None,
                  trigger_type: str = "MANUAL", trigger_id: str | None = None,
                  business_date: date | None = None, on_duplicate: str = "error",
                  frequency: str | None = None, department_id: int | None = None,
                  secrets: Callable[[Row], dict[str, str]] | None = None) -> dict:
    """Run one object; a failure is logged and returned, never raised.

    ``ledger`` names the table of consumed files. A run's files are written there first, under the number its
    write will have; they count as consumed once the target shows a write of that number. So a run that
    fails, wherever it does, neither loses a file nor takes one in twice.
    """
    event, batch_of = None, None
    try:
        prepare_logs(spark, run_log, ledger)
        event = runlog.start(spark, run_log, source, obj, pipeline_name, trigger_type, trigger_id,
                             business_date, frequency, department_id)
        if secrets:
            source = Row(**(source.asDict() | {"options": (source.options or {}) | secrets(source)}))
        if source.source_type == "SFTP" and ledger and consumes(obj):
            files, batch_of = _claim(spark, source, obj, ledger, event["run_id"])
            rows = read_selected(spark, source, obj, files)
        else:
            rows = extract(spark, source, obj)
        if source.source_type == "S3":
            landing_base = obj.landing_path
        rows_read, rows_copied, rows_deleted = _apply(rows, source, obj, landing_base, event["created_at"].date(),
                                                      event["run_id"], on_duplicate, batch_of)
        runlog.finish(spark, run_log, event, runlog.SUCCESS, rows_read, rows_copied, rows_deleted)
        return _result(obj, event, runlog.SUCCESS, rows_read, rows_copied)
    except Exception as exc:
        log.error("object %s failed: %s", obj.ingestion_object_id, exc)
        if event is not None:
            try:
                runlog.finish(spark, run_log, event, runlog.FAILED, error=str(exc))
            except Exception:
                log.exception("could not log the failure of run %s", event["run_id"])
        return _result(obj, event, runlog.FAILED, error=str(exc))


def _result(obj: Row, event: dict | None, status: str, rows_read: int = 0, rows_copied: int = 0,
            error: str | None = None) -> dict:
    return {"ingestion_object_id": obj.ingestion_object_id, "run_id": event and event["run_id"],
            "status": status, "rows_read": rows_read, "rows_copied": rows_copied, "error": error}


def ingest_by_id(spark: SparkSession, sources: DataFrame, objects: DataFrame, object_id: int, run_log: str,
                 **options) -> DataFrame:
    """Run one object, enabled or not, of an active source; ``options`` are those of ``ingest_object``."""
    obj = object_by_id(objects, object_id)
    result = ingest_object(spark, source_by_id(sources, obj.source_system_id), obj, run_log, **options)
    return small_frame(spark, [result], RESULT_SCHEMA)


def ingest_all(spark: SparkSession, sources: DataFrame, objects: DataFrame, run_log: str,
               source_type: str | None = None, source_id: int | None = None,
               source_name: str | None = None, pipeline_name: str | None = None,
               max_parallel: int = 4, secrets: Callable[[Row], dict[str, str]] | None = None,
               **options) -> DataFrame:
    """Run every selected object; one result row each, ordered by object id.

    ``sources`` and ``objects`` are normalised frames (for delimited reports, the adapted
    ones). Objects with different targets run side by side as independent Spark jobs,
    each in its own FAIR pool; objects that share a target run one after the other.
    ``secrets`` gives a source's credentials as reader options, so that no metadata table
    holds them; ``options`` are those of ``ingest_object``.
    """
    chosen = discover(objects, sources, source_type, source_id, source_name, pipeline_name)
    # Metadata only: one row per object of this run.
    selected = chosen.orderBy("ingestion_object_id").collect()
    used = chosen.select(F.col("source_system_id").alias("source_id"))
    by_id = {s.source_id: s for s in
             sources.filter("is_active").join(used, "source_id", "left_semi").collect()}
    by_target: dict[str | int, list[Row]] = {}
    for obj in selected:
        named = obj.target_schema and obj.target_table  # an object without a target fails in its own run
        by_target.setdefault(target_name(obj).lower() if named else obj.ingestion_object_id, []).append(obj)
    prepare_logs(spark, run_log, options.get("ledger"))

    @inheritable_thread_target(spark)
    def run_in_turn(group: list[Row]) -> list[dict]:
        results = []
        for obj in group:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"object-{obj.ingestion_object_id}")
            results.append(ingest_object(spark, by_id[obj.source_system_id], obj, run_log, secrets=secrets,
                                         pipeline_name=pipeline_name, **options))
        return results

    with ThreadPoolExecutor(max_workers=max(1, max_parallel)) as pool:
        done = [r for group in pool.map(run_in_turn, by_target.values()) for r in group]
    return small_frame(spark, done, RESULT_SCHEMA).orderBy("ingestion_object_id")


def raise_for_failures(results: DataFrame) -> None:
    """Raise if any object of a run failed, naming them."""
    failed = [r.ingestion_object_id for r in results.filter(F.col("status") == runlog.FAILED).collect()]
    if failed:
        raise IngestFailed(f"{len(failed)} objects failed: {failed}; see the run log")
