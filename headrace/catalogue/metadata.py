"""Queries over metadata tables: defaults, discovery, delimited reports.

The metadata rows are derived from the data tables by SQL both engines run, so there is
one source per supplier, one object per part and one report per customer.
"""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headrace.catalogue.base import query, table
from headrace.plans.metadata import (adapt_reports, discover, discover_reports, normalise_objects,
                                     normalise_sources)

SOURCES = """SELECT s_suppkey AS source_id, s_name AS source_name,
CASE s_nationkey % 6 WHEN 0 THEN 'Postgres' WHEN 1 THEN 'mySQL' WHEN 2 THEN 'ORACLE' WHEN 3 THEN 'sftp'
     WHEN 4 THEN 'MongoDb' ELSE 's3' END AS source_type,
CASE WHEN s_nationkey % 6 < 3 THEN NULL WHEN s_nationkey % 6 = 3 THEN 'Sftp' ELSE 'mongodb' END AS ingest_method,
CASE WHEN s_nationkey % 2 = 0 THEN '{{"tier":"' || CAST(s_suppkey AS VARCHAR(20)) || '"}}' END AS extra_params,
'db' || CAST(s_nationkey AS VARCHAR(20)) AS database_name, '/drop/' || s_name AS sftp_root_path,
CASE WHEN s_nationkey % 3 = 0 THEN '*.csv' END AS default_pattern, 'c' || s_name AS nosql_collection,
s_nationkey % 7 <> 0 AS is_active FROM {supplier}"""

OBJECTS = """SELECT p_partkey AS ingestion_object_id, p_size AS source_system_id, p_name AS source_object_name,
CASE WHEN p_type = 'SMALL' THEN 'view' END AS source_object_type,
CASE WHEN p_size % 3 = 0 THEN 'incremental' WHEN p_size % 3 = 1 THEN 'Full' END AS load_type,
CASE WHEN p_size % 4 = 0 THEN 'MERGE' WHEN p_size % 4 = 1 THEN 'Overwrite' END AS write_mode,
CASE WHEN p_size % 4 = 0 THEN ' p_partkey , ,p_brand,' WHEN p_size % 4 = 1 THEN '' END AS primary_key_cols,
CASE WHEN p_size % 2 = 0 THEN 'Merge' END AS schema_evolution_mode,
CASE WHEN p_size % 5 = 0 THEN 'silver' END AS delta_layer,
CASE WHEN p_size % 5 = 1 THEN 'gold' END AS target_medallion_layer,
p_brand AS pipeline_name, CASE WHEN p_size % 10 = 0 THEN p_size % 20 = 0 END AS is_enabled FROM {part}"""

REPORTS = """SELECT CAST(c_custkey AS INTEGER) AS config_master_id, c_nationkey AS source_system_id,
c_name AS report_name,
CASE c_mktsegment WHEN 'BUILDING' THEN 'c_custkey' WHEN 'MACHINERY' THEN '' END AS key_column,
c_mktsegment AS source_name,
CASE WHEN c_nationkey % 4 = 0 THEN NULL ELSE '/raw-bucket/' END AS source_bucket_name,
CASE WHEN c_nationkey % 5 = 0 THEN 's3://other/' || c_name WHEN c_nationkey % 5 = 1 THEN ' s3a://other/' || c_name
     WHEN c_nationkey % 5 = 2 THEN '//daily/' || c_name WHEN c_nationkey % 5 = 3 THEN 'daily/' || c_name
     END AS external_path,
CASE WHEN c_nationkey % 3 = 0 THEN 'full' WHEN c_nationkey % 3 = 1 THEN '' END AS load_type,
CASE WHEN c_nationkey % 2 = 0 THEN 'sink/' END AS raw_sink_bucket_name,
CASE WHEN c_nationkey % 3 = 0 THEN '/landing/x/' WHEN c_nationkey % 3 = 1 THEN '' END AS raw_sink_file_path,
CASE WHEN c_nationkey % 2 = 0 THEN '|' END AS column_delimiter, c_nationkey % 2 = 1 AS first_row_header,
'bronze' AS bronze_sink_schema_name, 'reports' AS bronze_sink_table_name,
CASE WHEN c_nationkey % 8 <> 0 THEN c_nationkey % 9 <> 0 END AS is_active,
CASE WHEN c_nationkey % 2 = 0 THEN 'nightly' WHEN c_nationkey % 3 = 0 THEN '' END AS pipeline_name FROM {customer}"""


def _derived(spark: SparkSession, sf_dir: str, sql: str, name: str) -> DataFrame:
    return spark.sql(sql, **{name: table(spark, sf_dir, name)})


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise_sources(_derived(spark, sf_dir, SOURCES, "supplier"))


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise_objects(_derived(spark, sf_dir, OBJECTS, "part"))


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, REPORTS, "customer")


_S, _O, _R = SOURCES.format(supplier="supplier"), OBJECTS.format(part="part"), REPORTS.format(customer="customer")


@query(f"""SELECT source_id, source_name, upper(source_type) AS source_type,
upper(coalesce(ingest_method, 'JDBC')) AS ingest_method, is_active,
'database=' || database_name || CASE WHEN extra_params IS NULL THEN '' ELSE ',tier=' || source_id END AS options,
sftp_root_path AS root_path, default_pattern, nosql_collection AS default_collection FROM ({_S})""",
       name="normalise_sources")
def source_rows(spark, sf_dir):
    options = F.transform(F.map_entries("options"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return sources(spark, sf_dir).withColumn("options", F.array_join(F.array_sort(options), ","))


@query(f"""SELECT ingestion_object_id, upper(coalesce(source_object_type, 'TABLE')) AS source_object_type,
upper(coalesce(load_type, 'FULL')) AS load_type, lower(coalesce(write_mode, 'append')) AS write_mode,
lower(coalesce(schema_evolution_mode, 'none')) AS schema_evolution_mode,
upper(coalesce(delta_layer, target_medallion_layer, 'BRONZE')) AS delta_layer,
coalesce(is_enabled, true) AS is_enabled,
CASE WHEN primary_key_cols <> '' THEN 'p_partkey|p_brand' END AS keys,
CASE WHEN primary_key_cols <> '' THEN 2 END AS n_keys FROM ({_O})""", name="normalise_objects")
def object_rows(spark, sf_dir):
    keys = F.col("key_columns")
    return objects(spark, sf_dir).select(
        "ingestion_object_id", "source_object_type", "load_type", "write_mode", "schema_evolution_mode",
        "delta_layer", "is_enabled", F.array_join(keys, "|").alias("keys"),
        F.when(keys.isNotNull(), F.size(keys)).alias("n_keys"))


# Filters a run may be started with.
_SELECTIONS = {
    "all": {},
    "type": {"source_type": "postgres"},
    "id": {"source_id": 7},
    "name": {"source_name": "SUPPLIER#000000011"},
    "pipeline": {"pipeline_name": "Brand#2"},
    "type and pipeline": {"source_type": "ORACLE", "pipeline_name": "Brand#4"},
    "no such source": {"source_id": -1},
}
_CONDITIONS = {
    "all": "true", "type": "source_type = 'Postgres'", "id": "source_id = 7",
    "name": "source_name = 'Supplier#000000011'", "pipeline": "pipeline_name = 'Brand#2'",
    "type and pipeline": "source_type = 'ORACLE' AND pipeline_name = 'Brand#4'",
    "no such source": "false",
}


@query(" UNION ALL ".join(
    f"SELECT '{label}' AS selection, ingestion_object_id FROM ({_O}) o JOIN ({_S}) s "
    f"ON o.source_system_id = s.source_id WHERE coalesce(is_enabled, true) AND is_active AND {condition}"
    for label, condition in _CONDITIONS.items()))
def discover_objects(spark, sf_dir):
    found = [discover(objects(spark, sf_dir), sources(spark, sf_dir), **chosen)
             .select(F.lit(label).alias("selection"), "ingestion_object_id")
             for label, chosen in _SELECTIONS.items()]
    return reduce(DataFrame.unionByName, found)


_REPORT_SELECTIONS = {
    "all": ({}, "true"),
    "type": ({"source_type": "s3"}, "true"),
    "other type": ({"source_type": "MYSQL"}, "false"),
    "id": ({"source_id": 3}, "source_system_id = 3"),
    "name": ({"source_name": "Building"}, "source_name = 'BUILDING'"),
    "pipeline": ({"pipeline_name": "nightly"}, "pipeline_name = 'nightly'"),
}


@query(" UNION ALL ".join(
    f"SELECT '{label}' AS selection, CAST(config_master_id AS BIGINT) AS ingestion_object_id FROM ({_R}) "
    f"WHERE is_active AND {condition}" for label, (_, condition) in _REPORT_SELECTIONS.items()))
def discover_delimited(spark, sf_dir):
    found = [discover_reports(reports(spark, sf_dir), "lake", **chosen)
             .select(F.lit(label).alias("selection"), "ingestion_object_id")
             for label, (chosen, _) in _REPORT_SELECTIONS.items()]
    return reduce(DataFrame.unionByName, found)


@query(f"""SELECT CAST(config_master_id AS BIGINT) AS ingestion_object_id, 'FILE' AS source_object_type,
CASE WHEN load_type <> '' THEN upper(load_type) ELSE 'FULL' END AS load_type,
CASE WHEN key_column <> '' THEN 'merge' ELSE 'append' END AS write_mode, 'csv' AS file_format,
'lake' AS target_catalog, 'BRONZE' AS delta_layer,
CASE WHEN pipeline_name <> '' THEN pipeline_name ELSE 's3_ingestion' END AS pipeline_name,
CASE WHEN trim(external_path) LIKE 's3://%' OR trim(external_path) LIKE 's3a://%' THEN trim(external_path)
     WHEN source_bucket_name IS NOT NULL
     THEN 's3://raw-bucket/' || ltrim(coalesce(external_path, ''), '/') END AS source_path,
CASE WHEN raw_sink_bucket_name <> '' AND raw_sink_file_path <> '' THEN 's3://sink/landing/x' END AS landing_path,
column_delimiter, first_row_header, coalesce(is_active, false) AS is_enabled FROM ({_R})""")
def adapt_delimited_config(spark, sf_dir):
    return adapt_reports(reports(spark, sf_dir), "lake").select(
        "ingestion_object_id", "source_object_type", "load_type", "write_mode", "file_format",
        "target_catalog", "delta_layer", "pipeline_name", "source_path", "landing_path", "column_delimiter",
        "first_row_header", "is_enabled")
