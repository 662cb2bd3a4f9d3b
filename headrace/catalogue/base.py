"""What the catalogue's queries share: registration, input tables, metadata rows."""

from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession

from headrace.functions.frames import small_frame
from headrace.plans.metadata import OBJECT_SCHEMA, SOURCE_SCHEMA, normalise_objects, normalise_sources
from headrace.session import new_schema

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Tables in a Spark catalog stand in for a relational server.
CATALOG_SOURCE = {"source_id": 1, "source_name": "Sales", "source_type": "Postgres",
                  "options": {"catalog": "spark_catalog"}}


def query(sql: str | None = None, name: str | None = None):
    """Register a function under its name, with the SQL that must give the same rows."""
    def register(function: Query) -> Query:
        key = name or function.__name__
        QUERIES[key] = function
        if sql:
            ORACLES[key] = sql
        return function
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def schema_with(spark: SparkSession, sf_dir: str, *names: str) -> str:
    """A fresh schema that shows the given tables."""
    schema = new_schema(spark)
    for name in names:
        spark.sql(f"CREATE VIEW {schema}.{name} AS SELECT * FROM parquet.`{sf_dir}/{name}.parquet`")
    return schema


def sources_frame(spark: SparkSession, *rows: dict) -> DataFrame:
    return normalise_sources(small_frame(spark, [{"is_active": True} | r for r in rows], SOURCE_SCHEMA))


def objects_frame(spark: SparkSession, *rows: dict) -> DataFrame:
    return normalise_objects(small_frame(spark, list(rows), OBJECT_SCHEMA))


def one_source(spark: SparkSession, **row) -> Row:
    return sources_frame(spark, row).first()


def one_object(spark: SparkSession, **row) -> Row:
    return objects_frame(spark, {"ingestion_object_id": 1, "source_system_id": 1} | row).first()


def shown(spark: SparkSession, name: str) -> DataFrame:
    """A target's rows without the ingest time, which differs from run to run."""
    return spark.table(name).drop("_ingested_at")
