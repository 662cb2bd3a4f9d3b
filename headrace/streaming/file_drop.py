"""File drops as a stream: the checkpoint remembers which files were consumed."""

from pyspark.sql import DataFrame, SparkSession

from headrace.operators.target import write
from headrace.sources.file_drop import FORMATS, cut_lines, refuse_hidden


def read_drop_stream(spark: SparkSession, directory: str, pattern: str, file_format: str = "csv",
                     schema: str | None = None, layout: str | None = None,
                     max_files: int | None = None, **options) -> DataFrame:
    """Matching files as an unbounded frame. Streams need the schema (or layout) up front.

    As in batches, a value that does not fit fails the stream (``mode`` says otherwise), and so do files that
    match but are hidden to Spark when it starts.
    """
    fmt = file_format.lower().replace("fixedwidth", "fixed_width")
    if fmt not in FORMATS:
        raise ValueError(f"unsupported file_format {file_format!r}; supported: {', '.join(FORMATS)}")
    refuse_hidden(spark, directory, pattern)
    reader = spark.readStream.option("pathGlobFilter", pattern).option("mode", "FAILFAST").options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if fmt == "fixed_width":
        return cut_lines(reader.text(directory), layout)
    if fmt == "csv" and "header" not in options:
        reader = reader.option("header", True)
    return reader.schema(schema).format(fmt).load(directory)


def stream_file_drop(rows: DataFrame, target: str, checkpoint: str, evolution: str | None = None,
                     partition_column: str | None = None, keys: list[str] | None = None, **merge_options) -> None:
    """Add every file that is there now and was not consumed before, then stop; with ``keys`` they are merged.

    A micro-batch that is replayed after a crash carries the number it had, so the target
    skips it: files arrive exactly once. ``merge_options`` are those of ``merge``.
    """
    def apply(batch: DataFrame, number: int) -> None:
        # The query id is kept in the checkpoint, so it names the stream across restarts.
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        write(batch, target, "merge" if keys else "append", keys, evolution=evolution,
              partition_column=partition_column, batch_of=(stream, number), **merge_options)

    query = (rows.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
