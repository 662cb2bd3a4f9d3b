"""Schema comparison and alignment between a batch and its target."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headrace.functions.values import column_name, quoted

EVOLUTIONS = ("none", "merge", "overwrite")

# Conversions that keep every value.
_WIDER = {
    "tinyint": {"smallint", "int", "bigint", "float", "double"},
    "smallint": {"int", "bigint", "float", "double"},
    "int": {"bigint", "double"},
    "float": {"double"},
}


class SchemaMismatch(ValueError):
    """The batch does not fit the target and its evolution mode."""


def evolution_mode(value: str | None) -> str:
    mode = (value or "none").lower()
    if mode not in EVOLUTIONS:
        raise ValueError(f"schema_evolution_mode {value!r} is not one of {', '.join(EVOLUTIONS)}")
    return mode


def _merged(target: T.DataType, batch: T.DataType) -> T.DataType | None:
    """The target's type, with the batch's additional nested fields if there are any; None if its values do not fit."""
    if isinstance(batch, T.NullType):
        return target
    if isinstance(target, T.StructType) and isinstance(batch, T.StructType):
        have, given = _by_name(target), _by_name(batch)
        types = {k: _merged(f.dataType, given[k].dataType) if k in given else f.dataType for k, f in have.items()}
        extra = [T.StructField(f.name, f.dataType, True, f.metadata) for k, f in given.items() if k not in have]
        if None in types.values():
            return None
        if not extra and all(types[k] is f.dataType for k, f in have.items()):
            return target
        return T.StructType([T.StructField(f.name, types[k], f.nullable, f.metadata) for k, f in have.items()] + extra)
    if isinstance(target, T.ArrayType) and isinstance(batch, T.ArrayType):
        element = _merged(target.elementType, batch.elementType)
        return target if element is target.elementType else element and T.ArrayType(element, target.containsNull)
    if isinstance(target, T.MapType) and isinstance(batch, T.MapType):
        if _merged(target.keyType, batch.keyType) is not target.keyType:
            return None  # a field added to a key would make old and new keys differ
        value = _merged(target.valueType, batch.valueType)
        return target if value is target.valueType else value and T.MapType(target.keyType, value, target.valueContainsNull)
    fits = batch.simpleString() == target.simpleString() or target.simpleString() in _WIDER.get(batch.simpleString(), ())
    return target if fits else None


def _by_name(schema: T.StructType) -> dict[str, T.StructField]:
    """Fields by name; names match in any letter case, as in Spark."""
    found = {f.name.lower(): f for f in schema.fields}
    if len(found) < len(schema.fields):
        raise SchemaMismatch(f"names differ in letter case only: {schema.fieldNames()}")
    return found


def _paths(dtype: T.DataType, at: tuple[str, ...] = ()) -> set[tuple[str, ...]]:
    """Where all fields of a type are."""
    if isinstance(dtype, T.StructType):
        return {path for k, f in _by_name(dtype).items() for path in {(*at, k)} | _paths(f.dataType, (*at, k))}
    if isinstance(dtype, T.ArrayType):
        return _paths(dtype.elementType, (*at, "element"))
    if isinstance(dtype, T.MapType):
        return _paths(dtype.keyType, (*at, "key")) | _paths(dtype.valueType, (*at, "value"))
    return set()


def evolved(batch: T.StructType, target: T.StructType, evolution: str) -> T.StructType:
    """The target's schema after the batch; raises if the batch does not fit its evolution mode.

    Columns and the fields of structs, wherever they are nested, are added at the end; those the
    batch lacks stay and read NULL. ``none`` refuses both. A NULL-typed column stands for any type.
    """
    have, given = _by_name(target), _by_name(batch)
    types = {k: _merged(have[k].dataType, f.dataType) for k, f in given.items() if k in have}
    retyped = [f"{given[k].name}: {given[k].dataType.simpleString()} into {have[k].dataType.simpleString()}"
               for k, dtype in types.items() if dtype is None]
    if retyped:
        raise SchemaMismatch(f"column types differ: {'; '.join(retyped)}")
    if evolution == "none":
        untyped = {k for k, f in given.items() if isinstance(f.dataType, T.NullType)}
        old, new = ({p for p in _paths(schema) if len(p) == 1 or p[0] not in untyped} for schema in (target, batch))
        if old != new:
            added, missing = ([".".join(p) for p in sorted(paths)] for paths in (new - old, old - new))
            raise SchemaMismatch(f"schema differs: new columns {added}, missing columns {missing}")
        return target
    fields = [T.StructField(f.name, types.get(k, f.dataType), f.nullable, f.metadata) for k, f in have.items()]
    return T.StructType(fields + [f for k, f in given.items() if k not in have])


def alter_columns(spark: SparkSession, table: str, old: T.StructType, new: T.StructType) -> None:
    """Give a catalog table the new schema, which only adds to its own: columns, or fields within columns.

    Files written before read NULL for what they lack. SQL can add columns but not nested fields to a
    Parquet table; the catalog itself takes both.
    """
    nested = [f.name for f in old.fields if new[f.name].dataType != f.dataType]
    add = new.fields[len(old.fields):]
    if nested:
        state = spark._jsparkSession.sessionState()
        partitions = {c.name for c in spark.catalog.listColumns(table) if c.isPartition}
        data = T.StructType([f for f in new.fields if f.name not in partitions])
        schema = spark._jvm.org.apache.spark.sql.types.DataType.fromJson(data.json())
        state.catalog().alterTableDataSchema(state.sqlParser().parseTableIdentifier(quoted(table)), schema)
    elif add:
        columns = ", ".join(f"{column_name(f.name)} {f.dataType.simpleString()}" for f in add)
        spark.sql(f"ALTER TABLE {quoted(table)} ADD COLUMNS ({columns})")
    if nested or add:
        spark.catalog.refreshTable(quoted(table))


def _fitted(value: Column, given: T.DataType, wanted: T.DataType) -> Column:
    """A value in the wanted type: nested fields by name, absent ones NULL."""
    if given == wanted:
        return value
    if isinstance(wanted, T.StructType) and isinstance(given, T.StructType):
        have = _by_name(given)
        fields = [(_fitted(value.getField(have[k].name), have[k].dataType, f.dataType) if k in have
                   else F.lit(None).cast(f.dataType)).alias(f.name) for k, f in _by_name(wanted).items()]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(wanted, T.ArrayType) and isinstance(given, T.ArrayType):
        return F.transform(value, lambda x: _fitted(x, given.elementType, wanted.elementType))
    if isinstance(wanted, T.MapType) and isinstance(given, T.MapType):
        values = F.transform_values(value, lambda _, x: _fitted(x, given.valueType, wanted.valueType))
        return values if given.keyType == wanted.keyType else values.cast(wanted)
    return value.cast(wanted)


def align(df: DataFrame, target: T.StructType) -> DataFrame:
    """The batch with exactly the target's columns and nested fields; absent ones are NULL."""
    given = _by_name(df.schema)
    return df.select(*[
        (_fitted(F.col(column_name(given[k].name)), given[k].dataType, f.dataType) if k in given
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for k, f in _by_name(target).items()
    ])
