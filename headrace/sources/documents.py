"""Document collections: JSON documents under ``<root>/<database>/<collection>``.

Scalars may come wrapped (``{"$date": …}``, ``{"$oid": …}``, ``{"$numberLong": …}``).
"""

import uuid

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headrace.functions.values import column_name, quoted, statement

# The wrappers around scalars in extended JSON.
_WRAPPERS = ("$oid", "$numberLong", "$numberInt", "$numberDouble", "$numberDecimal")
_PLACEHOLDER = "__default__"

# Endings of files that Spark reads in several tasks each.
_SPLIT = ("json", "jsonl", "ndjson", "txt", "bz2")


def _scalar(column: Column, dtype: T.DataType) -> Column:
    """A value from JSON text, with its wrapper (if any) taken off."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        instant = F.timestamp_millis(F.get_json_object(column, "$.$date.$numberLong").cast("long"))
        if not isinstance(dtype, T.TimestampType):
            # An unzoned target shows the UTC wall clock, whatever the session zone is.
            instant = F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))
        unwrapped = F.coalesce(instant.cast(dtype), F.get_json_object(column, "$.$date").cast(dtype))
    else:
        unwrapped = F.coalesce(*[F.get_json_object(column, f"$.{w}") for w in _WRAPPERS], column).cast(dtype)
    # A wrapped value arrives as the JSON text of an object; plain ones are not parsed again.
    return F.when(column.startswith('{"$'), unwrapped).otherwise(column.cast(dtype))


def _wrappable(dtype: T.DataType) -> bool:
    return not isinstance(dtype, (T.StructType, T.ArrayType, T.MapType))


def read_json_documents(spark: SparkSession, path: str, schema: str | None = None, variant: str | None = None,
                        **options) -> DataFrame:
    """Documents with typed scalars. A line that is no document fails the read (``mode`` says otherwise).

    Without a schema Spark infers one, in a pass of its own, unless ``variant`` names a column for whole
    documents as VARIANT values: then one pass reads whatever fields they have, now or later, beside the
    columns of the schema, if there is one.
    """
    reader = spark.read.option("mode", "FAILFAST").options(**options)
    wanted = T.StructType.fromDDL(schema) if schema else T.StructType()
    if variant:
        documents = reader.option("singleVariantColumn", variant).json(path)
        return documents.select(*[_from_variant(F.col(column_name(variant)), f).alias(f.name) for f in wanted.fields],
                                column_name(variant))
    if not schema:
        return _unwrap_inferred(reader.json(path))
    as_stored = T.StructType([
        T.StructField(f.name, T.StringType() if _wrappable(f.dataType) else f.dataType)
        for f in wanted.fields])
    documents = reader.schema(as_stored).json(path)
    return documents.select(*[
        (_scalar(F.col(column_name(f.name)), f.dataType) if _wrappable(f.dataType)
         else F.col(column_name(f.name))).alias(f.name)
        for f in wanted.fields])


def _from_variant(document: Column, field: T.StructField) -> Column:
    """A field of a document, with its wrapper (if any) taken off."""
    name = field.name.replace("\\", "\\\\").replace('"', '\\"')
    if _wrappable(field.dataType):
        return _scalar(F.variant_get(document, f'$["{name}"]', "string"), field.dataType)
    return F.variant_get(document, f'$["{name}"]', field.dataType.simpleString())


def _unwrap_inferred(df: DataFrame) -> DataFrame:
    """Flatten top-level one-field wrapper structs of an inferred schema."""
    columns = []
    for f in df.schema.fields:
        column = F.col(column_name(f.name))
        if isinstance(f.dataType, T.StructType) and len(f.dataType.fields) == 1:
            inner = f.dataType.fields[0].name
            if inner == "$date":
                column = _scalar(F.to_json(column), T.TimestampType())
            elif inner in _WRAPPERS:
                column = column[inner]
        columns.append(column.alias(f.name))
    return df.select(*columns)


def query_documents(spark: SparkSession, documents: DataFrame, collection: str, query: str) -> DataFrame:
    """Run a query verbatim that names the collection as its table."""
    view = f"hr_{uuid.uuid4().hex[:12]}"
    documents.createOrReplaceTempView(view)
    try:
        return spark.sql(f"WITH {quoted(collection)} AS (SELECT * FROM {view}) SELECT * FROM ({statement(query)}) q")
    finally:
        spark.catalog.dropTempView(view)


def collection_of(source: Row, obj: Row) -> str:
    name = obj.source_object_name
    return name if name and name != _PLACEHOLDER else source.default_collection or ""


def _is_split(documents: DataFrame, options: dict[str, str]) -> bool:
    """Whether Spark cuts the collection's files into even tasks by itself."""
    if any(k.lower() == "multiline" and str(v).lower() == "true" for k, v in options.items()):
        return False
    names = (path.rsplit("/", 1)[-1].lower() for path in documents.inputFiles())
    return all("." not in name or name.rsplit(".", 1)[1] in _SPLIT for name in names)


def read_documents(spark: SparkSession, source: Row, obj: Row) -> DataFrame:
    """A collection, filtered or queried.

    Spark splits plain files over tasks by itself. Where it cannot split them (gzip, documents of
    several lines), a ``page_column`` spreads the rows again into pages of even size, of which a hot value fills several.
    """
    options = dict(source.options or {})
    database = obj.source_schema or options.get("database") or ""
    collection = collection_of(source, obj)
    path = "/".join(p.strip("/") if i else p.rstrip("/")
                    for i, p in enumerate([source.root_path, database, collection]) if p)
    documents = read_json_documents(spark, path, **(obj.reader_options or {}))
    if obj.custom_query:
        return query_documents(spark, documents, collection, obj.custom_query)
    if obj.source_filter:
        documents = documents.filter(F.expr(obj.source_filter))
    if obj.page_column and not _is_split(documents, obj.reader_options or {}):
        documents = documents.hint("rebalance", F.col(column_name(obj.page_column)))
    return documents
