"""Bronze targets: append, overwrite and merge on catalog Parquet tables.

A merge rewrites only the (part, partition) pairs of the target that hold a matching key;
all other files stay as they are. See ``layout`` for how a target is stored.
"""

import threading
import uuid
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headrace.functions.values import actual_name, as_text, column_name, quoted
from headrace.operators.incremental import with_metrics
from headrace.operators.layout import (PART, Layout, begin, live_rows, load_layout, new_mark, publish, record_replaced,
                                       replaced_condition, with_place)
from headrace.operators.schema import align, alter_columns, evolution_mode, evolved

STAMP = "_ingested_at"

# Tasks whose merged rows share a part, by default: about 8 GB at Spark's default split size.
TASKS_PER_PART = 64

# Most bytes of batch keys that are sent to every executor, by default, if the session's own threshold is not lower.
BROADCAST_BYTES = 64 << 20

# A batch of at most so many keys is looked up by Bloom filters of the target's row groups.
LOOKUP_KEYS = 200

# A batch of at most so many partition values is written where its rows are: each task makes a file per value.
FEW_VALUES = 8

# Key types whose size in memory ``_key_summary`` knows: fixed ones, and those with a length in bytes.
_SIZED = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType, T.BinaryType)

# Key types whose Parquet statistics order like Spark's comparison, and those Parquet looks up in Bloom filters.
_RANGED = (T.IntegralType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType)
_LOOKED_UP = (T.IntegerType, T.LongType, T.DateType, T.StringType)


@dataclass
class WriteResult:
    rows: int
    watermark: str | None = None
    # rows an overwrite took out
    deleted: int = 0


@contextmanager
def scratch_tables(spark: SparkSession, beside: str):
    """Write a frame once, so that later steps neither compute it again nor disagree; dropped in the end."""
    made = []

    def keep(df: DataFrame) -> DataFrame:
        if "." in beside:
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted(beside.rsplit('.', 1)[0])}")
        made.append(quoted(f"{beside}__scratch_{uuid.uuid4().hex[:12]}"))
        df.write.format("parquet").saveAsTable(made[-1])
        return spark.table(made[-1])

    try:
        yield keep
    finally:
        for table in made:
            spark.sql(f"DROP TABLE IF EXISTS {table}")


def stamp(df: DataFrame, at=None) -> DataFrame:
    """Add the ingest time once; a frame that carries it keeps it."""
    if STAMP in df.columns:
        return df
    return df.withColumn(STAMP, F.lit(at) if at is not None else F.current_timestamp())


_opened: dict[SparkSession, tuple[int, str]] = {}
_lock = threading.Lock()


@contextmanager
def _open_files(spark: SparkSession):
    """Tasks keep the files of up to FEW_VALUES partitions open instead of sorting; writes side by side share the setting."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    with _lock:
        users, before = _opened.get(spark, (0, spark.conf.get(key)))
        _opened[spark] = users + 1, before
        if not users:
            spark.conf.set(key, str(FEW_VALUES))
    try:
        yield
    finally:
        with _lock:
            users, before = _opened.pop(spark)
            if users > 1:
                _opened[spark] = users - 1, before
            else:
                spark.conf.set(key, before)


def _rebalance(df: DataFrame, by: str) -> DataFrame:
    return df.hint("rebalance", F.col(column_name(by)))


def _write_part(df: DataFrame, layout: Layout, watermark_column: str | None = None,
                watermark_type: str | None = None, keys: list[str] | None = None,
                clustered: bool = False, tasks_per_part: int = TASKS_PER_PART,
                partition_values: int | None = None) -> WriteResult:
    """Write one batch as the layout's parts, counting it on the same pass.

    With a partition column the rows are first rebalanced on it, unless they are
    ``clustered`` already or are known to hold few ``partition_values``: a partition's rows
    meet in few files, and AQE splits a hot partition over several tasks. Merged rows come
    with their ``keys``: they are cut into a part per group of tasks, so that a later merge
    can leave most of them alone, and sorted by key within each task, which narrows the
    key ranges in the Parquet statistics; Bloom filters on the keys tell a small batch which
    row groups to read, in whatever order the keys came.
    """
    by = layout.partition_column
    few = bool(by) and partition_values is not None and partition_values <= FEW_VALUES
    if by and not clustered and not few:
        df = _rebalance(df, by)
    extra = {"written": F.count_if("_fresh")} if "_fresh" in df.columns else {}
    df, metrics = with_metrics(df, watermark_column, watermark_type, **extra)
    name, options = F.lit(layout.prefix), {}
    if keys:
        name = F.concat(name, F.lit("-"), F.floor(F.spark_partition_id() / tasks_per_part))
        options = {f"parquet.bloom.filter.enabled#{k}": "true" for k in keys if isinstance(df.schema[k].dataType, _LOOKED_UP)}
        options |= {"parquet.bloom.filter.adaptive.enabled": "true"} if options else {}
    df = df.drop("_fresh").withColumn(PART, name)
    if keys:
        df = df.sortWithinPartitions(*[F.col(column_name(c)) for c in [PART, *([by] if by else []), *keys]])
    with _open_files(df.sparkSession) if few and not keys else nullcontext():
        (df.write.format("parquet").mode("append").options(**options).partitionBy(PART, *([by] if by else []))
           .saveAsTable(quoted(layout.data)))
    seen = metrics.get
    return WriteResult(seen["written"] if extra else seen["rows"], seen.get("watermark"))


def _hint(column: str | None, result: WriteResult, previous: list[str] | None) -> list[str] | None:
    return [column, result.watermark] if column and result.watermark is not None else previous


def _create(df: DataFrame, view: str, partition_column: str | None, watermark_column, watermark_type,
            applied: dict[str, int], based_on: Layout | None = None, keys: list[str] | None = None,
            tasks_per_part: int = TASKS_PER_PART, partition_values: int | None = None) -> WriteResult:
    """Start a new data table with the batch as its only part, and show it."""
    spark = df.sparkSession
    if "." in view:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted(view.rsplit('.', 1)[0])}")
    if partition_column:
        partition_column = actual_name(df.schema, partition_column)
    layout = Layout(f"{view}__{uuid.uuid4().hex[:8]}", partition_column, 1, new_mark(),
                    retired_table=based_on.data if based_on else None, applied=applied)
    result = _write_part(df, layout, watermark_column, watermark_type, keys, tasks_per_part=tasks_per_part,
                         partition_values=partition_values)
    layout.watermark = _hint(watermark_column, result, None)
    publish(spark, view, layout, df.columns, based_on)
    return result


def _evolve(df: DataFrame, view: str, layout: Layout, evolution: str) -> tuple[DataFrame, list[str]]:
    """Fit the batch to the target, adding the columns and nested fields the evolution mode lets in."""
    spark = df.sparkSession
    wanted = evolved(df.schema, spark.table(view).schema, evolution)
    # a crashed write may have added some of them already
    stored = spark.table(layout.data).schema
    alter_columns(spark, layout.data, stored, evolved(wanted, stored, "merge"))
    return align(df, wanted), wanted.fieldNames()


def _applied(layout: Layout | None, batch_of: tuple[str, int] | None) -> dict[str, int] | None:
    """The last numbers applied, with this batch's; None if the target holds it already."""
    applied = dict(layout.applied) if layout else {}
    if batch_of and applied.get(batch_of[0], -1) >= batch_of[1]:
        return None
    return applied | dict([batch_of] if batch_of else [])


def append(df: DataFrame, view: str, evolution: str | None = None, partition_column: str | None = None,
           watermark_column: str | None = None, watermark_type: str | None = None,
           batch_of: tuple[str, int] | None = None, partition_values: int | None = None) -> WriteResult:
    """Add rows; the first write creates the target.

    ``batch_of`` = (stream, number) makes the write repeatable: a number at or below the
    last one applied for that stream is skipped. ``partition_values`` is about how many values
    ``partition_column`` has in the batch, if that is known: few ones need no shuffle.
    """
    spark, evo = df.sparkSession, evolution_mode(evolution)
    df = stamp(df)
    layout = load_layout(spark, view)
    if (applied := _applied(layout, batch_of)) is None:
        return WriteResult(0)
    if layout is None:
        return _create(df, view, partition_column, watermark_column, watermark_type, applied,
                       partition_values=partition_values)
    batch, columns = _evolve(df, view, layout, "merge" if evo == "overwrite" else evo)
    begun, (_, layout) = layout, begin(spark, layout)
    if (partition_column or "").lower() != (layout.partition_column or "").lower():
        partition_values = None  # counted for another column
    result = _write_part(batch, layout, watermark_column, watermark_type, partition_values=partition_values)
    layout.applied = applied
    layout.watermark = _hint(watermark_column, result, layout.watermark)
    publish(spark, view, layout, columns, begun)
    return result


def overwrite(df: DataFrame, view: str, evolution: str | None = None, partition_column: str | None = None,
              watermark_column: str | None = None, watermark_type: str | None = None,
              batch_of: tuple[str, int] | None = None, partition_values: int | None = None) -> WriteResult:
    """Replace all rows. The batch's schema replaces the target's unless evolution is none.

    The rows taken out are counted from the files' footers, without reading a column. ``batch_of`` and
    ``partition_values`` are those of ``append``.
    """
    spark, evo = df.sparkSession, evolution_mode(evolution)
    df = stamp(df)
    layout = load_layout(spark, view)
    if (applied := _applied(layout, batch_of)) is None:
        return WriteResult(0)
    deleted = 0 if layout is None else spark.table(view).count()
    if layout is not None and evo == "none":
        df = align(df, evolved(df.schema, spark.table(view).schema, evo))
    result = _create(df, view, partition_column, watermark_column, watermark_type, applied, layout,
                     partition_values=partition_values)
    result.deleted = deleted
    return result


def _no_null(keys: list[str]):
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(column_name(k)).isNotNull()
    return condition


def count_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key. NULL keys never match, so they are left out."""
    columns = [F.col(column_name(k)) for k in keys]
    return df.filter(_no_null(keys)).groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def latest_per_key(df: DataFrame, keys: list[str], order_by: str) -> DataFrame:
    """One row per key: the greatest ``order_by``, ties broken by the other columns in order.

    An aggregate with a map-side stage, so a hot key shrinks before the shuffle. Rows
    with a NULL key are all kept.
    """
    order_by = actual_name(df.schema, order_by)
    rest = [f.name for f in df.schema.fields
            if f.name not in (*keys, order_by, STAMP) and _orderable(f.dataType)]
    columns = df.columns
    # As a nested column a map cannot be part of an ordering, but it can be carried along.
    row = F.struct(*[F.col(column_name(c)) for c in columns])
    rank = F.struct(*[F.col(column_name(c)) for c in [order_by, *rest]])
    latest = (df.filter(_no_null(keys)).groupBy(*[F.col(column_name(k)) for k in keys])
                .agg(F.max_by(row, rank).alias("_row"))
                .select(*[F.col(f"_row.{column_name(c)}").alias(c) for c in columns]))
    return latest.unionByName(df.filter(~_no_null(keys)))


def _key_summary(df: DataFrame, keys: list[str]) -> dict:
    """One pass over the keys: how many there are, the most rows any has, their total size in memory,
    and the range of every key column."""
    size = F.lit(48)
    for k in keys:
        if isinstance(df.schema[k].dataType, (T.StringType, T.BinaryType)):
            size = size + F.octet_length(F.col(column_name(k)))
    ends = [F.max("_copies").alias("copies"), F.count(F.lit(1)).alias("keys"), F.sum(size).alias("bytes")]
    for i, k in enumerate(keys):
        if isinstance(df.schema[k].dataType, _RANGED):
            column, dtype = F.col(column_name(k)), df.schema[k].dataType
            ends += [as_text(F.min(column), dtype).alias(f"lo{i}"),
                     as_text(F.max(column), dtype).alias(f"hi{i}")]
    return count_per_key(df, keys).agg(*ends).first().asDict()


def _broadcastable(spark: SparkSession, summary: dict, types: list[T.DataType], most: int = BROADCAST_BYTES) -> bool:
    """Whether the batch's keys are measured, and within the session's broadcast threshold."""
    allowed = min(most, spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    return all(isinstance(t, _SIZED) for t in types) and (summary["bytes"] or 0) <= allowed


def _within(rows: DataFrame, keys: list[str], summary: dict) -> DataFrame:
    """Rows whose keys lie in the batch's range; Parquet statistics skip the others."""
    for i, k in enumerate(keys):
        if f"lo{i}" in summary:
            column, dtype = F.col(column_name(k)), rows.schema[k].dataType
            rows = rows.filter((column >= F.lit(summary[f"lo{i}"]).cast(dtype))
                               & (column <= F.lit(summary[f"hi{i}"]).cast(dtype)))
    return rows


def _looked_up(rows: DataFrame, keys: list[str], summary: dict, batch_keys: DataFrame) -> DataFrame:
    """Rows whose keys a small batch holds, as plain equalities: Parquet skips the row groups without them.

    At most ``LOOKUP_KEYS`` keys come to the driver; a larger batch is only joined.
    """
    chosen = [k for k in keys if isinstance(rows.schema[k].dataType, _LOOKED_UP)]
    if not chosen or not 0 < summary["keys"] <= LOOKUP_KEYS:
        return rows
    tests = [reduce(and_, [F.col(column_name(k)) == F.lit(key[k]) for k in chosen])
             for key in batch_keys.select(*map(column_name, chosen)).distinct().collect()]
    while len(tests) > 1:  # a balanced tree: deep expressions are slow to plan
        tests = [reduce(or_, tests[i:i + 2]) for i in range(0, len(tests), 2)]
    return rows.filter(tests[0])


def _matches(near: DataFrame, layout: Layout, batch_keys: DataFrame, keys: list[str]) -> DataFrame:
    """Keys and places of the target rows that the batch updates."""
    return (with_place(near.join(batch_keys, keys, "left_semi"), layout)
            .select(*[F.col(column_name(k)) for k in keys], "part", "place"))


def _marked(batch: DataFrame, batch_keys: DataFrame, repeated: DataFrame, keys: list[str]) -> DataFrame:
    """The batch's keys, with the whole row for keys that the target holds several times."""
    row = F.struct(*[F.col(column_name(c)) for c in batch.columns]).alias("_new")
    new = batch.join(repeated, keys, "left_semi").select(*[F.col(column_name(k)) for k in keys], row)
    return batch_keys.join(new, keys, "left").withColumn("_hit", F.lit(True))


def _updated(old: DataFrame, marked: DataFrame, keys: list[str]) -> DataFrame:
    """The old rows without those the batch replaces; rows of a repeated key are updated where they are."""
    columns, fresh = old.columns, F.col("_new").isNotNull()
    joined = old.join(marked, keys, "left").filter(F.col("_hit").isNull() | fresh)
    return joined.select(*[F.when(fresh, F.col(f"_new.{column_name(c)}")).otherwise(F.col(column_name(c))).alias(c)
                           for c in columns], fresh.alias("_fresh"))


def merge(df: DataFrame, view: str, keys: list[str] | None, evolution: str | None = None,
          partition_column: str | None = None, on_duplicate: str = "error", order_by: str | None = None,
          watermark_column: str | None = None, watermark_type: str | None = None,
          tasks_per_part: int = TASKS_PER_PART, broadcast_bytes: int = BROADCAST_BYTES,
          batch_of: tuple[str, int] | None = None, partition_values: int | None = None) -> WriteResult:
    """Upsert: a batch row replaces the target rows with equal keys, or is inserted.

    NULL keys never match. The batch is read several times, so it must be stable: files
    or a table, not a live source. Several batch rows for one key raise, or with
    ``on_duplicate="latest"`` the one with the greatest ``order_by`` wins.

    The target is read twice: its keys, to find the rows the batch updates, and then the storage
    places of these rows, to write them anew. ``tasks_per_part`` tasks write one part, the least
    that a later merge can leave alone; batch keys of up to ``broadcast_bytes`` in memory, and within
    the session's threshold, are sent to every executor instead of shuffling the target. ``batch_of`` is that
    of ``append``, and so is ``partition_values``, which counts for a first write.
    """
    spark, evo = df.sparkSession, evolution_mode(evolution)
    if not keys:
        raise ValueError(f"primary_key_cols must be set to merge into {view}")
    keys = [actual_name(df.schema, k) for k in keys]
    df = stamp(df)
    if on_duplicate not in ("error", "latest"):
        raise ValueError(f"on_duplicate {on_duplicate!r} is neither 'error' nor 'latest'")
    if on_duplicate == "latest" and not order_by:
        raise ValueError("on_duplicate='latest' needs an order_by column")
    layout = load_layout(spark, view)
    if (applied := _applied(layout, batch_of)) is None:
        return WriteResult(0)
    summary = _key_summary(df, keys)
    if (summary["copies"] or 0) > 1 and on_duplicate == "error":
        example = count_per_key(df, keys).filter("_copies > 1").first().asDict()
        raise ValueError(f"the batch has several rows for one key of {view}: {example}")

    with scratch_tables(spark, view) as keep:
        if (summary["copies"] or 0) > 1:
            df = latest_per_key(df, keys, order_by)
            df = df if layout is None else keep(df)
        if layout is None:
            return _create(df, view, partition_column, watermark_column, watermark_type, applied, keys=keys,
                           tasks_per_part=tasks_per_part, partition_values=partition_values)
        batch, columns = _evolve(df, view, layout, "merge" if evo == "overwrite" else evo)
        keys = [actual_name(batch.schema, k) for k in keys]
        batch_keys = batch.filter(_no_null(keys)).select(*[F.col(column_name(k)) for k in keys])
        small = _broadcastable(spark, summary, [df.schema[k].dataType for k in keys if k in df.columns], broadcast_bytes)
        sent = F.broadcast if small else lambda frame: frame

        begun, (shown, layout) = layout, begin(spark, layout)
        live = live_rows(spark, shown)
        near = _looked_up(_within(live, keys, summary), keys, summary, batch_keys)
        found, count = with_metrics(_matches(near, layout, sent(batch_keys), keys))
        matches = keep(found)
        out, clustered = batch.withColumn("_fresh", F.lit(True)), False
        if count.get["rows"]:
            record_replaced(matches, layout)
            layout.replaced = True
            old = live.filter(replaced_condition(layout)).select(*[F.col(column_name(c)) for c in columns])
            # Rows without a full key bypass the join, where they would all meet in one task.
            keyed, unkeyed = old.filter(_no_null(keys)), old.filter(~_no_null(keys)).withColumn("_fresh", F.lit(False))
            repeated = count_per_key(matches, keys).filter("_copies > 1").drop("_copies")
            if repeated.isEmpty():
                kept = keyed.join(sent(batch_keys), keys, "left_anti").withColumn("_fresh", F.lit(False))
                if small and layout.partition_column:
                    # Kept rows stay in the order they were read: only the batch is shuffled.
                    out, clustered = _rebalance(out, layout.partition_column), True
            else:
                kept = _updated(keyed, _marked(batch, batch_keys, repeated, keys), keys)
                out = out.join(repeated, keys, "left_anti")
            out = kept.unionByName(unkeyed).unionByName(out).select(*[F.col(column_name(c)) for c in columns], "_fresh")
        result = _write_part(out, layout, watermark_column, watermark_type, keys, clustered, tasks_per_part)
    layout.applied = applied
    layout.watermark = _hint(watermark_column, result, layout.watermark)
    publish(spark, view, layout, columns, begun)
    return result


def write(df: DataFrame, view: str, mode: str, keys: list[str] | None = None, on_duplicate: str = "error",
          order_by: str | None = None, **options) -> WriteResult:
    """Apply a batch in the configured mode; an unknown mode appends."""
    if mode == "merge":
        return merge(df, view, keys, on_duplicate=on_duplicate, order_by=order_by, **options)
    if mode == "overwrite":
        return overwrite(df, view, **options)
    return append(df, view, **options)
