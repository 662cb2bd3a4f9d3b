"""Column helpers: watermark text and literals, key lists, SQL quoting."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_text(column: Column, dtype: T.DataType) -> Column:
    """Exact text of a value; a zoned timestamp keeps its offset so it casts back to itself."""
    if isinstance(dtype, T.TimestampType):
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSSXXX")
    return column.cast("string")


def comparison_type(dtype: T.DataType, declared: str | None) -> T.DataType:
    """Type in which an incremental column is compared.

    A typed column compares in its own type, which keeps the predicate pushable. Text
    compares in the declared type, if there is one.
    """
    if isinstance(dtype, T.StringType) and declared:
        return T.DataType.fromDDL(declared)
    return dtype


def comparable(column: Column, dtype: T.DataType, declared: str | None) -> Column:
    target = comparison_type(dtype, declared)
    return column if target == dtype else column.cast(target)


def key_list(column: Column) -> Column:
    """Comma-separated text as an array of trimmed, non-blank names; NULL stays NULL."""
    names = F.filter(F.transform(F.split(column, ","), lambda name: F.trim(name)), lambda name: name != "")
    return F.when(column != "", names)


def quoted(name: str) -> str:
    """A backquoted identifier; dots separate its parts."""
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def column_name(name: str) -> str:
    """One backquoted column name, dots included."""
    return f"`{name.replace('`', '``')}`"


def actual_name(schema: T.StructType, name: str) -> str:
    """The column as the schema spells it; names match in any letter case, as in Spark."""
    for field in schema.fieldNames():
        if field.lower() == name.lower():
            return field
    raise ValueError(f"column {name!r} is not among {schema.fieldNames()}")


def sql_text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def statement(query: str) -> str:
    """A query that can stand in parentheses."""
    return query.strip().rstrip(";")
