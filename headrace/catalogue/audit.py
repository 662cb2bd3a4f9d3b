"""Queries over the run log. Every event of the data is a run: one start, and one end
unless it is a view, which plays a run still going on."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headrace.catalogue.base import query, table
from headrace.operators import runlog

_STATUS = ("CASE event_type WHEN 'view' THEN 'RUNNING' WHEN 'error' THEN 'FAILED' ELSE 'SUCCESS' END")
_RUNS = f"""SELECT 'run-' || event_id AS run_id, CAST(user_id AS INTEGER) AS table_id,
CASE WHEN user_id < 50 THEN 'sales' ELSE 'crm' END AS pipeline_name, ts AS trigger_time, {_STATUS} AS status,
CASE WHEN event_type IN ('view', 'error') THEN 0 ELSE CAST(floor(value) AS BIGINT) END AS rows_read FROM events"""


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start and end events, as the log holds them."""
    events = table(spark, sf_dir, "events").select(
        F.concat(F.lit("run-"), "event_id").alias("run_id"), F.col("user_id").cast("int").alias("table_id"),
        F.when(F.col("user_id") < 50, "sales").otherwise("crm").alias("pipeline_name"),
        F.col("ts").alias("trigger_time"), "event_type", "value")
    begun = events.withColumns({"event_time": F.col("trigger_time"), "status": F.lit(runlog.RUNNING),
                                "rows_read": F.lit(0).cast("long")})
    failed = F.col("event_type") == "error"
    ended = events.filter("event_type <> 'view'").withColumns({
        "event_time": F.col("trigger_time") + F.expr("INTERVAL 1 MINUTE"),
        "status": F.when(failed, runlog.FAILED).otherwise(runlog.SUCCESS),
        "rows_read": F.when(failed, 0).otherwise(F.floor("value")).cast("long")})
    return begun.unionByName(ended).drop("event_type", "value")


@query(f"""SELECT *, CASE WHEN status = 'RUNNING' THEN trigger_time ELSE trigger_time + INTERVAL 1 MINUTE END
AS event_time FROM ({_RUNS})""")
def audit_run_log(spark, sf_dir):
    return runlog.current_runs(run_events(spark, sf_dir))


@query(f"SELECT table_id, arg_max(status, trigger_time) AS status FROM ({_RUNS}) GROUP BY table_id")
def audit_last_status(spark, sf_dir):
    return runlog.last_status(runlog.current_runs(run_events(spark, sf_dir)))


@query(f"SELECT * FROM ({_RUNS}) WHERE pipeline_name = 'sales' AND status = 'FAILED' AND run_id LIKE 'run-1%'")
def audit_failures(spark, sf_dir):
    runs = runlog.current_runs(run_events(spark, sf_dir))
    return runlog.failures(runs, "sales", "run-1").drop("event_time")


@query(f"""SELECT status, count(*) AS runs, CAST(sum(rows_read) AS BIGINT) AS rows_read FROM ({_RUNS})
GROUP BY status""")
def audit_tally(spark, sf_dir):
    return runlog.tally(runlog.current_runs(run_events(spark, sf_dir)))
