"""Run the selected objects: ``spark-submit --py-files … -m headrace`` or ``python -m headrace``.

Metadata is read from catalog tables. Exits with 1 if any object failed.
"""

import argparse
import sys
from datetime import date

from pyspark.sql import SparkSession

from headrace.operators import runlog
from headrace.plans.ingest import ingest_all, ingest_by_id
from headrace.plans.metadata import adapt_reports, discover_reports, normalise_objects, normalise_sources


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="headrace", description=__doc__)
    parser.add_argument("--sources", required=True, help="table of source systems")
    kind = parser.add_mutually_exclusive_group(required=True)
    kind.add_argument("--objects", help="table of ingestion objects")
    kind.add_argument("--reports", help="table of delimited reports")
    parser.add_argument("--report-catalog", default="spark_catalog", help="catalog the reports' targets are in")
    parser.add_argument("--run-log", required=True, help="run-log table, created if missing")
    parser.add_argument("--ledger", help="table of consumed files, created if missing")
    parser.add_argument("--landing", help="base path of the raw landing; none means no landing")
    parser.add_argument("--source-type")
    parser.add_argument("--source-id", type=int)
    parser.add_argument("--source-name")
    parser.add_argument("--object-id", type=int, help="run this object alone, enabled or not")
    parser.add_argument("--business-date", type=date.fromisoformat)
    parser.add_argument("--pipeline")
    parser.add_argument("--max-parallel", type=int, default=4)
    parser.add_argument("--trigger-type", default="SCHEDULED")
    parser.add_argument("--trigger-id")
    parser.add_argument("--frequency", help="how often the job runs, for the run log")
    parser.add_argument("--department-id", type=int, help="who the run is for, for the run log")
    parser.add_argument("--on-duplicate", choices=("error", "latest"), default="error")
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> int:
    sources = normalise_sources(spark.table(args.sources))
    objects = (normalise_objects(spark.table(args.objects)) if args.objects
               else adapt_reports(spark.table(args.reports), args.report_catalog))
    options = {"landing_base": args.landing, "ledger": args.ledger, "trigger_type": args.trigger_type,
               "trigger_id": args.trigger_id, "business_date": args.business_date, "on_duplicate": args.on_duplicate,
               "frequency": args.frequency, "department_id": args.department_id}
    chosen = {"source_type": args.source_type, "source_id": args.source_id, "source_name": args.source_name}
    if args.object_id is not None:
        results = ingest_by_id(spark, sources, objects, args.object_id, args.run_log, pipeline_name=args.pipeline,
                               **options).collect()
    else:
        if args.reports:  # a report's source name is the report table's own
            objects = discover_reports(spark.table(args.reports), args.report_catalog, **chosen)
            chosen = {}
        results = ingest_all(spark, sources, objects, args.run_log, pipeline_name=args.pipeline,
                             max_parallel=args.max_parallel, **chosen, **options).collect()
    for r in results:
        print(f"{r.ingestion_object_id:>10}  {r.status:<8}  {r.rows_read:>12}  {(r.error or '').splitlines()[:1]}")
    failed = [r.ingestion_object_id for r in results if r.status == runlog.FAILED]
    print(f"{len(results)} objects, {len(failed)} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    options = arguments()
    session = SparkSession.builder.appName("headrace").config("spark.scheduler.mode", "FAIR").getOrCreate()
    sys.exit(run(session, options))
