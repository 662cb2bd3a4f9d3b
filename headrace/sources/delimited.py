"""Delimited reports in object storage."""

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T

from headrace.plans.metadata import target_name


def known_columns(spark: SparkSession, obj: Row) -> T.StructType | None:
    """The columns of the object's target, if it exists and its schema is to stay."""
    replaced = obj.write_mode == "overwrite" and obj.schema_evolution_mode != "none"
    if replaced or not (obj.target_schema and obj.target_table) or not spark.catalog.tableExists(target_name(obj)):
        return None
    return spark.table(target_name(obj)).schema


def read_csv(spark: SparkSession, paths, delimiter: str | None = None, header: bool | None = None,
             schema: str | None = None, known: T.StructType | None = None, **options) -> DataFrame:
    """Delimited text; a header and commas by default.

    Without a schema the columns that are in `known`, by name in any case, have the types they have there, and
    others are text: only a first line is read before the data, and types cannot drift from run to run. All
    files must have the same header. Without either Spark infers the types, in a pass of its own.

    A value that does not fit the schema fails the read, unless the option ``mode`` says otherwise.
    """
    header = True if header is None else header
    options = {"mode": "FAILFAST", "header": header, "sep": delimiter or ",", **options}
    reader = spark.read.options(**options)
    if schema:
        return reader.schema(schema).csv(paths)
    if known is None:
        return reader.option("inferSchema", True).csv(paths)
    types = {f.name.lower(): f.dataType for f in known.fields if isinstance(f.dataType, T.AtomicType)}
    names = reader.csv(paths).columns
    fields = [T.StructField(n, types.get(n.lower(), T.StringType())) for n in names]
    # with a header its names are held against the schema in every file, not only in the first
    return reader.schema(T.StructType(fields)).option("enforceSchema", not header).csv(paths)


def read_delimited(spark: SparkSession, source: Row, obj: Row) -> DataFrame:
    if not obj.source_path:
        raise ValueError(f"report {obj.source_object_name!r} ({obj.ingestion_object_id}) has neither "
                         "a full path nor a bucket")
    options = dict(obj.reader_options or {})
    known = None if "schema" in options else known_columns(spark, obj)
    return read_csv(spark, obj.source_path, obj.column_delimiter, obj.first_row_header, known=known, **options)
