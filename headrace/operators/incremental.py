"""Watermarks, incremental predicates and single-pass batch metrics."""

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headrace.functions.values import actual_name, as_text, column_name, comparable, comparison_type


def _max_text(df: DataFrame, column: str, declared: str | None):
    column = actual_name(df.schema, column)
    dtype = df.schema[column].dataType
    value, kind = comparable(F.col(column_name(column)), dtype, declared), comparison_type(dtype, declared)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        value = F.when(~F.isnan(value), value)  # nothing is greater than NaN: as a watermark it would end all loading
    return as_text(F.max(value), kind)


def max_watermark(df: DataFrame, column: str, declared: str | None = None,
                  at_least: str | None = None) -> str | None:
    """MAX of a column as exact text, NULL-free; None for an empty frame.

    ``at_least`` is a value the maximum probably reaches. Rows below it are skipped by
    Parquet statistics; if nothing is left, the whole column is read, so a wrong guess
    costs time and never changes the answer.
    """
    if at_least is not None:
        above = df.filter(beyond(df, column, at_least, declared, inclusive=True))
        found = above.agg(_max_text(df, column, declared)).first()[0]
        if found is not None:
            return found
    return df.agg(_max_text(df, column, declared)).first()[0]


def resolve_watermark(spark: SparkSession, target: str, column: str,
                      declared: str | None = None, initial: str | None = None,
                      at_least: str | None = None) -> str | None:
    """MAX over the target, or ``initial`` if the target is missing or empty.

    A target that lacks the column is an error: reloading everything because the
    watermark is unreadable would hide it.
    """
    if not spark.catalog.tableExists(target):
        return initial
    found = max_watermark(spark.table(target), column, declared, at_least)
    return initial if found is None else found


def beyond(df: DataFrame, column: str, watermark: str, declared: str | None = None,
           lag_seconds: int | None = None, inclusive: bool = False):
    """The predicate ``column > watermark`` (less the look-back) as a typed comparison.

    ``inclusive`` asks for ``>=``, where a watermark that is no value of the type matches
    nothing; the strict form raises.
    """
    column = actual_name(df.schema, column)
    dtype = df.schema[column].dataType
    wanted = comparison_type(dtype, declared)
    bound = F.lit(watermark).try_cast(wanted) if inclusive else F.lit(watermark).cast(wanted)
    if lag_seconds:
        if isinstance(wanted, (T.TimestampType, T.TimestampNTZType)):
            bound = bound - F.make_interval(secs=F.lit(lag_seconds))
        elif isinstance(wanted, T.DateType):
            # whole days, rounded up, so the look-back is never shorter than asked
            bound = F.date_sub(bound, -(-lag_seconds // 86400))
        elif isinstance(wanted, T.NumericType):
            bound = (bound - F.lit(lag_seconds)).cast(wanted)
        else:
            raise ValueError(f"a look-back needs a time or number column, not {wanted.simpleString()}")
    value = comparable(F.col(column_name(column)), dtype, declared)
    return value >= bound if inclusive else value > bound


def apply_incremental(df: DataFrame, column: str | None = None, watermark: str | None = None,
                      declared: str | None = None, lag_seconds: int | None = None,
                      source_filter: str | None = None) -> DataFrame:
    """Rows above the watermark that also pass the static filter; either may be absent."""
    if column and watermark is not None:
        df = df.filter(beyond(df, column, watermark, declared, lag_seconds))
    if source_filter:
        df = df.filter(F.expr(source_filter))
    return df


def with_metrics(df: DataFrame, column: str | None = None, declared: str | None = None,
                 **extra) -> tuple[DataFrame, Observation]:
    """Observe row count and maximum on the pass that writes the frame.

    Call it on the frame handed to the writer, after any shuffle: then the metrics
    belong to the job's last stage, whose tasks count once even if executors are lost
    and earlier stages run again.
    """
    metrics = [F.count(F.lit(1)).alias("rows")]
    if column:
        metrics.append(_max_text(df, column, declared).alias("watermark"))
    metrics += [value.alias(name) for name, value in extra.items()]
    observation = Observation()
    return df.observe(observation, *metrics), observation
