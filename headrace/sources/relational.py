"""Relational objects: a table, a view or a query, over JDBC or a Spark catalog.

``source.options`` either holds Spark's JDBC options (``url``, ``driver``, ``user``,
``password``, …) or names a ``catalog`` Spark already knows.
"""

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headrace.functions.values import actual_name, comparison_type, quoted, statement

# How much earlier times are compared in the database, so that no time zone can matter.
_ZONE_SLACK = 2 * 86400


# How databases turn text into the types a text watermark may be declared as.
_FROM_TEXT = {
    "": {"integer": "CAST({} AS BIGINT)", "decimal": "CAST({} AS {type})", "double": "CAST({} AS DOUBLE PRECISION)",
         "date": "CAST({} AS DATE)", "timestamp_ntz": "CAST({} AS TIMESTAMP)"},
    "derby": {"double": "DOUBLE({})"},
    "mysql": {"integer": "CAST({} AS SIGNED)", "double": "({} + 0E0)", "timestamp_ntz": "CAST({} AS DATETIME(6))"},
    "oracle": {"integer": "TO_NUMBER({})", "double": "TO_BINARY_DOUBLE({})", "date": "TO_DATE({}, 'YYYY-MM-DD')",
               "timestamp_ntz": "TO_TIMESTAMP({}, 'YYYY-MM-DD HH24:MI:SS.FF')"},
    "sqlserver": {"double": "CAST({} AS FLOAT)", "timestamp_ntz": "CAST({} AS DATETIME2(6))"},
}


def _read_jdbc(spark: SparkSession, options: dict[str, str], table: str) -> DataFrame:
    return spark.read.format("jdbc").options(**options).option("dbtable", table).load()


def _database(options: dict[str, str]) -> str:
    return options["url"].split(":")[1]


def _dialect(spark: SparkSession, options: dict[str, str]):
    return spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(options["url"])


def _literal(spark: SparkSession, options: dict[str, str], value, dtype: T.DataType) -> str:
    """A value as the database writes it."""
    if isinstance(dtype, T.DateType):
        return f"{{d '{value}'}}"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return f"{{ts '{value}'}}"
    return str(value) if isinstance(dtype, T.NumericType) else _dialect(spark, options).compileValue(str(value))


def _page_predicates(spark: SparkSession, options: dict[str, str], rows: str, column: str, pages: int) -> list[str]:
    """Conditions that cut the rows into pages of one size, between quantiles that the database finds.

    One value a page comes to the driver. Rows of one value share a page, those without one are in the first.
    """
    keyed = f"SELECT {column} AS k FROM {rows} WHERE {column} IS NOT NULL"
    ranked = f"SELECT k, NTILE({pages}) OVER (ORDER BY k) AS page FROM ({keyed}) keyed"
    if _database(options) == "derby":  # has neither NTILE nor an order within OVER
        numbered = f"SELECT ROW_NUMBER() OVER () AS r, k FROM ({keyed} ORDER BY k) keyed"
        ranked = f"SELECT k, (r - 1) * {pages} / (SELECT COUNT({column}) FROM {rows}) AS page FROM ({numbered}) numbered"
    found = _read_jdbc(spark, options, f"(SELECT page, MIN(k) AS lo FROM ({ranked}) ranked GROUP BY page) ends")
    dtype = found.schema[1].dataType
    bounds = [_literal(spark, options, value, dtype) for _, value in sorted(found.collect(), key=lambda r: r[0])]
    cuts = list(dict.fromkeys(bounds))[1:]
    if not cuts:
        return []
    between = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *between, f"{column} >= {cuts[-1]}"]


def read_jdbc(spark: SparkSession, options: dict[str, str], schema: str | None = None,
              name: str | None = None, query: str | None = None, source_filter: str | None = None,
              fetch_size: int | None = None, page_column: str | None = None,
              pages: int | None = None, page_bounds: str = "range") -> DataFrame:
    """Read a table or query; the filter runs in the database, in its own dialect.

    Predicates added to the result (the watermark) are pushed down by Spark. With a
    ``page_column`` the rows are read as pages in parallel; rows of one value share a page, so the
    column should be a key. ``page_bounds`` cuts numbers and times into equal ranges between the
    ends, which an index gives at once ("range"), or into pages of equally many rows, for which the
    database sorts the column ("quantiles"): for keys that are not spread evenly. Text is always cut so.
    """
    if page_bounds not in ("range", "quantiles"):
        raise ValueError(f"page_bounds {page_bounds!r} is neither 'range' nor 'quantiles'")
    table = f"{schema}.{name}" if schema else name
    if query or source_filter:
        rows = statement(query) if query else f"SELECT * FROM {table}"
        if source_filter:
            rows = f"SELECT * FROM ({rows}) base WHERE ({source_filter})"
        table = f"({rows}) src"
    options = dict(options)
    if fetch_size:
        options["fetchsize"] = str(fetch_size)
    if not page_column:
        return _read_jdbc(spark, options, table)
    pages = pages or spark.sparkContext.defaultParallelism
    rows = table if table.startswith("(") else f"{table} src"
    ends = _read_jdbc(spark, options, f"(SELECT MIN({page_column}) AS lo, MAX({page_column}) AS hi FROM {rows}) ends")
    ranged = isinstance(ends.schema[0].dataType, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))
    if page_bounds == "quantiles" or not ranged:
        predicates = _page_predicates(spark, options, rows, page_column, pages)
        if not predicates:
            return _read_jdbc(spark, options, table)
        rest = {k: v for k, v in options.items() if k != "url"}
        return spark.read.jdbc(options["url"], table, predicates=predicates, properties=rest)
    low, high = ends.first()
    if low is not None:
        options |= {"partitionColumn": page_column.strip('"`[]'), "lowerBound": str(low), "upperBound": str(high),
                    "numPartitions": str(pages)}
    return _read_jdbc(spark, options, table)


def read_catalog(spark: SparkSession, catalog: str | None = None, schema: str | None = None,
                 name: str | None = None, query: str | None = None,
                 source_filter: str | None = None) -> DataFrame:
    """Read a catalog table, or run a query verbatim."""
    if query:
        rows = spark.sql(statement(query))
    else:
        rows = spark.table(quoted(".".join(p for p in (catalog, schema, name) if p)))
    return rows.filter(F.expr(source_filter)) if source_filter else rows


def _bound(spark: SparkSession, watermark: str, dtype: T.DataType, lag_seconds: int) -> str | None:
    """The watermark less the look-back as text of a number, date or time; None for other types."""
    value = F.lit(watermark).cast(dtype)
    if isinstance(dtype, T.NumericType):
        text = ((value - F.lit(lag_seconds)).cast(dtype) if lag_seconds else value).cast("string")
    elif isinstance(dtype, T.DateType):
        text = F.date_sub(value, -(-lag_seconds // 86400)).cast("string")
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        text = F.date_format(value - F.make_interval(secs=F.lit(lag_seconds)), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    else:
        return None
    return spark.range(1).select(text).first()[0]


def _from_text(options: dict[str, str], column: str, dtype: T.DataType) -> str | None:
    """The database's expression for a text column as a declared type; None for types it may read otherwise than Spark."""
    kind = "integer" if isinstance(dtype, T.IntegralType) else dtype.typeName()
    template = _FROM_TEXT.get(_database(options), {}).get(kind) or _FROM_TEXT[""].get(kind)
    return template and template.format(column, type=dtype.simpleString().upper())


def filtered_above(spark: SparkSession, source: Row, obj: Row, column: str, watermark: str, declared: str | None = None,
                   lag_seconds: int | None = None) -> tuple[Row, bool]:
    """The object with the watermark in its own filter, and whether nothing is left for Spark to compare.

    For JDBC objects only; others come back as they are. Text of a declared type is converted and compared by
    the database, which cannot be pushed down from Spark. With a ``page_column`` numbers, dates and times are
    filtered too, so that the pages are cut above the watermark: times some days early, as the exact
    predicate is the one Spark adds to what is read.
    """
    options = source.options or {}
    if "url" not in options:
        return obj, False
    schema = read_relational(spark, source, Row(**(obj.asDict() | {"page_column": None})), paged=False).schema
    column = actual_name(schema, column)
    dtype, lag = schema[column].dataType, lag_seconds or 0
    value, wanted = _dialect(spark, options).quoteIdentifier(column), comparison_type(dtype, declared)
    exact = wanted != dtype
    if exact:
        value = _from_text(options, value, wanted)
    elif not page_column(source, obj):
        return obj, False
    zoned = isinstance(wanted, (T.TimestampType, T.TimestampNTZType)) and not exact
    bound = _bound(spark, watermark, wanted, lag + _ZONE_SLACK if zoned else lag) if value else None
    if bound is None:
        return obj, False
    above = f"{value} > {_literal(spark, options, bound, wanted)}"
    filters = f"({obj.source_filter}) AND {above}" if obj.source_filter else above
    return Row(**(obj.asDict() | {"source_filter": filters})), exact


def page_column(source: Row, obj: Row) -> str | None:
    """The object's own page column; else, if its source asks for pages, its first key column."""
    return obj.page_column or (obj.key_columns[0] if obj.key_columns and "pages" in (source.options or {}) else None)


def read_relational(spark: SparkSession, source: Row, obj: Row, paged: bool = True) -> DataFrame:
    options = dict(source.options or {})
    if "catalog" in options:
        return read_catalog(spark, options["catalog"], obj.source_schema, obj.source_object_name,
                            obj.custom_query, obj.source_filter)
    if "url" not in options:
        raise ValueError(f"source {source.source_name!r} has neither a JDBC url nor a catalog")
    pages, bounds = options.pop("pages", None), options.pop("page_bounds", "range")
    # What is left goes to the driver, which need not know options of other readers.
    options = {k: v for k, v in options.items() if k not in ("database", "file_format")}
    by = page_column(source, obj) if paged else None
    if by and by != obj.page_column:
        by = _dialect(spark, options).quoteIdentifier(by)
    return read_jdbc(spark, options, obj.source_schema, obj.source_object_name, obj.custom_query,
                     obj.source_filter, obj.data_read_size, by, int(pages) if pages else None, bounds)
