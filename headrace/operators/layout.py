"""How a bronze target is stored, and what its view shows.

A Parquet table has no row-level MERGE and cannot be overwritten while it is read. So a
target is a *view* over one partitioned data table. Every write adds immutable parts
(``_part``) named by its number and a mark of its writer, and replacing the view publishes
them: it shows the parts below that number, and of that number those with the mark. So
readers see the old rows or the new ones; parts of a crashed write are not shown, and are
dropped once a write of their number is published.

The storage places, (part, partition value) pairs, that a merge replaces are rows of a small
table beside the data. The view leaves them out by a subquery over the partition columns, which
Spark answers before it chooses the files to read; view and state are as long for 5,000 places as for 5.

Of several writers on one target the first to publish wins; the others find the view
changed, drop their own parts and raise ``ConcurrentWrite``. The catalog has no
compare-and-set, so two that publish in the same instant are not told apart. Files a write
replaces are dropped by the write after it, so a reader has that long to finish.
"""

import itertools
import json
import uuid
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headrace.functions.values import column_name, quoted, sql_text

PART = "_part"
_STATE = "headrace.state"


@dataclass
class Layout:
    """What the view shows, kept in its properties."""

    data: str
    partition_column: str | None = None
    # number of the last published write, and the mark of its writer in its parts' names
    written: int = 0
    writer: str = ""
    # whether the last write replaced places, and the data table it replaced as a whole
    replaced: bool = False
    retired_table: str | None = None
    # last applied number per stream, so that a replayed batch changes nothing
    applied: dict[str, int] = field(default_factory=dict)
    # column and value of the last batch's watermark; a hint, see ``max_watermark``
    watermark: list[str] | None = None

    @property
    def places(self) -> str:
        """The table of replaced places."""
        return f"{self.data}__places"

    @property
    def prefix(self) -> str:
        """How the names of the last write's parts begin; other writers' marks differ."""
        return f"{part_prefix(self.written)}-{self.writer}"


def load_layout(spark: SparkSession, view: str) -> Layout | None:
    """The layout behind a target; None if the target does not exist."""
    if not spark.catalog.tableExists(view):
        return None
    state = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {quoted(view)}").collect()}.get(_STATE)
    if state is None:
        raise ValueError(f"{view} exists and is not a target of this library")
    return Layout(**json.loads(bytes.fromhex(state)))


def watermark_hint(spark: SparkSession, view: str, column: str) -> str | None:
    """A value the target's watermark column reached once; only ever a hint."""
    layout = load_layout(spark, view)
    if layout is None or layout.watermark is None or layout.watermark[0] != column:
        return None
    return layout.watermark[1]


def part_prefix(number: int) -> str:
    """How the names of a write's parts begin; they sort by number."""
    return f"{number:010d}"


def replaced_condition(layout: Layout) -> str:
    """SQL that is true for rows in the places the layout's write replaces."""
    place = f"CAST({column_name(layout.partition_column)} AS STRING)" if layout.partition_column else "NULL"
    spot = "concat({}, coalesce(concat('=', {}), ''))".format
    return (f"array_contains((SELECT collect_list({spot('part', 'place')}) FROM {quoted(layout.places)} "
            f"WHERE written = {sql_text(layout.prefix)}), {spot(PART, place)})")


def with_place(rows: DataFrame, layout: Layout) -> DataFrame:
    """Rows of the data table with the place they are stored in: the part, and the partition value as in the path."""
    value = F.col(column_name(layout.partition_column)) if layout.partition_column else F.lit(None)
    return rows.withColumns({"part": F.col(PART), "place": value.cast("string")})


def record_replaced(placed: DataFrame, layout: Layout) -> None:
    """Note the places of the rows as those the layout's write replaces."""
    (placed.select("part", "place").distinct().withColumn("written", F.lit(layout.prefix)).coalesce(1)
     .write.format("parquet").mode("append").partitionBy("written").saveAsTable(quoted(layout.places)))


def _live_condition(layout: Layout) -> str:
    """SQL that is true for live rows."""
    own = layout.prefix
    condition = (f"({PART} < {sql_text(part_prefix(layout.written))} OR "
                 f"({PART} >= {sql_text(own)} AND {PART} < {sql_text(own + '~')}))")
    return f"{condition} AND NOT {replaced_condition(layout)}" if layout.replaced else condition


def live_rows(spark: SparkSession, layout: Layout) -> DataFrame:
    """The target's rows with the part each is stored in."""
    return spark.table(layout.data).filter(_live_condition(layout))


class ConcurrentWrite(RuntimeError):
    """Another writer published first; nothing of this write is shown, and it can be run again."""


def publish(spark: SparkSession, view: str, layout: Layout, columns: list[str], based_on: Layout | None) -> None:
    """Show the layout: one catalog change.

    `based_on` is the layout this write began with. If the target shows another one by now,
    this write's parts are deleted and it fails.
    """
    now = load_layout(spark, view)
    if _version(now) != _version(based_on):
        if based_on is not None and layout.data == based_on.data:
            own = [p for p in stored_parts(spark, layout.data) if p.startswith(layout.prefix)]
            _drop_partitions(spark, layout.data, (f"PARTITION ({PART} = {sql_text(p)})" for p in own))
        else:
            _drop_data(spark, layout.data)
        raise ConcurrentWrite(f"another writer changed {view} during this write; run it again")
    spark.catalog.refreshTable(layout.data)
    # in hex: Spark hides property values that hold words like "token", which a table's name may
    state = json.dumps(asdict(layout), separators=(",", ":")).encode().hex()
    spark.sql(
        f"CREATE OR REPLACE VIEW {quoted(view)} WITH SCHEMA TYPE EVOLUTION "
        f"TBLPROPERTIES ({sql_text(_STATE)} = {sql_text(state)}) "
        f"AS SELECT {', '.join(column_name(c) for c in columns)} FROM {quoted(layout.data)} WHERE {_live_condition(layout)}")


def begin(spark: SparkSession, layout: Layout) -> tuple[Layout, Layout]:
    """What the target shows, and the layout of the next write.

    The files that the last write replaced are deleted first; nothing shows them any more.
    """
    if layout.retired_table:
        _drop_data(spark, layout.retired_table)
    if layout.replaced:
        column = layout.partition_column
        names = (f"PARTITION ({PART} = {sql_text(r.part)}" + (
            f", {column_name(column)} = {'null' if r.place is None else sql_text(r.place)})" if column else ")")
            for r in spark.table(layout.places).filter(F.col("written") == layout.prefix).toLocalIterator())
        _drop_partitions(spark, layout.data, names)
        _drop_partitions(spark, layout.places, (f"PARTITION (written = {sql_text(w)})" for w in stored_parts(spark, layout.places)
                                                if w < part_prefix(layout.written + 1)))
    # parts of a higher number may belong to a writer at work: they go once their number is published
    lost = (p for p in stored_parts(spark, layout.data) if p.startswith(part_prefix(layout.written)) and not p.startswith(layout.prefix))
    _drop_partitions(spark, layout.data, (f"PARTITION ({PART} = {sql_text(p)})" for p in lost))
    shown = replace(layout, replaced=False, retired_table=None)
    return shown, replace(shown, written=layout.written + 1, writer=new_mark())


def new_mark() -> str:
    return uuid.uuid4().hex[:12]


def _version(layout: Layout | None) -> tuple | None:
    return layout and (layout.data, layout.written, layout.writer)


def _drop_partitions(spark: SparkSession, table: str, specs, chunk: int = 500) -> None:
    """Drop partitions, some at a time; their names are not all held at once."""
    for some in iter(lambda names=iter(specs): list(itertools.islice(names, chunk)), []):
        spark.sql(f"ALTER TABLE {quoted(table)} DROP IF EXISTS {', '.join(some)}")


def _drop_data(spark: SparkSession, data: str) -> None:
    for table in (data, Layout(data).places):
        spark.sql(f"DROP TABLE IF EXISTS {quoted(table)}")


def stored_parts(spark: SparkSession, data: str) -> list[str]:
    """Names of the parts a data table holds, live or not."""
    found = spark.sql(f"SHOW PARTITIONS {quoted(data)}")
    name = F.substring_index(F.substring_index("partition", "/", 1), "=", -1)
    return sorted(r.name for r in found.select(name.alias("name")).distinct().collect())
