"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Above this rate the distribution is listed from 12 standard deviations below the mean on.
LONG = 100.0
# Rates of up to this many sources, a few kilobytes each, go to every task.
MOST_BROADCAST = 5000


def mixing_rates(docs: DataFrame, weights: Mapping[str, float] | None = None, temperature: float = 0.5,
                 total: int | None = None, source_column: str = "source") -> DataFrame:
    """Mean copies per document for each source: rows (source, rate).

    A source's share of `total` (the row count unless given) follows its weight, or without
    weights its row count to the power `temperature`. Sources that `weights` lacks get rate 0.
    """
    counts = docs.groupBy(F.col(source_column).alias("source")).agg(F.count("*").cast("double").alias("n"))
    if weights is None:
        # sqrt is exact in every engine, pow is not
        weight = F.sqrt("n") if temperature == 0.5 else F.pow("n", F.lit(temperature))
    else:
        pairs = [F.lit(x) for k, v in weights.items() for x in (k, float(v))]
        weight = F.coalesce(F.create_map(*pairs)[F.col("source")], F.lit(0.0))
    counts = counts.withColumn("weight", weight)
    sums = counts.agg(F.sum("weight").alias("w"), F.sum("n").alias("n")).first()
    goal = float(total if total is not None else sums.n or 0)
    return counts.select("source", (F.lit(goal) * F.col("weight") / F.lit(sums.w or 1.0) / F.col("n")).alias("rate"))


def _first(rate: Column) -> Column:
    """The smallest count that is listed; below it lies less than 1e-30 of the distribution."""
    return F.when(rate <= LONG, F.lit(0)).otherwise((rate - 12 * F.sqrt(rate)).cast("int"))


def _cdf(rate: Column) -> Column:
    """P(X <= k) of the Poisson distribution, for k from `_first` up to where it is 1 in double precision."""
    start = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("cdf"))
    last = (rate + 12 * F.sqrt(rate) + 24).cast("int")

    def add(state, k):
        p = state["p"] * rate / k
        return F.struct(p.alias("p"), F.concat(state["cdf"], F.array(F.element_at(state["cdf"], -1) + p)).alias("cdf"))

    def add_log(state, k):
        return F.concat(state, F.array(F.element_at(state, -1) + F.log(rate / k)))

    # exp(-rate) is 0 for large rates: logs relative to the first count listed
    logs = F.aggregate(F.sequence(_first(rate) + 1, last), F.array(F.lit(0.0)), add_log)
    weights = F.element_at(F.transform(F.array(logs), lambda x: F.transform(x, lambda v: F.exp(v - F.array_max(x)))), 1)
    sums = F.aggregate(weights, F.array().cast("array<double>"),
                       lambda state, w: F.concat(state, F.array(F.coalesce(F.get(state, F.size(state) - 1), F.lit(0.0)) + w)))
    long = F.element_at(F.transform(F.array(sums), lambda x: F.transform(x, lambda v: v / F.element_at(x, -1))), 1)
    return F.when(rate <= LONG, F.aggregate(F.sequence(F.lit(1), last), start, add, lambda state: state["cdf"])) \
        .otherwise(long)


def replicate(docs: DataFrame, rates: DataFrame, seed: int = 7, id_column: str = "doc_id",
              source_column: str = "source", copy_column: str | None = "copy") -> DataFrame:
    """Repeat each document by a Poisson count with its source's mean, and shuffle the copies.

    The count inverts the Poisson distribution at a number in [0, 1) hashed from the id and the
    seed, so a run repeats exactly and needs no state. Copies are dealt and sorted by a hash of
    id, copy and the row's place in the input: a random order over all partitions, also where
    many rows share one id. A null source has its own rate; sources without a rate give no rows;
    rows repeated under one id share their count; each row without an id draws its own, by its
    place. All columns are returned as they are, and the copy's number (from 1) as `copy_column`
    unless that is None; a column of that name in the documents raises a ValueError.
    """
    if copy_column in docs.columns:
        raise ValueError(f"the documents already have a column {copy_column}")
    table = rates.filter("rate > 0").select(F.col("source").alias("_source"), _first(F.col("rate")).alias("_first"),
                                            _cdf(F.col("rate")).alias("_cdf"))
    if rates.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST:  # else Spark joins by a shuffle
        table = F.broadcast(table)
    name = F.coalesce(F.col("_id").cast("string"), F.concat(F.lit("row "), F.col("_place").cast("string")))
    uniform = F.conv(F.substring(F.md5(F.concat(name, F.lit(f":{seed}"))), 1, 13), 16, 10).cast("double") / 2.0**52
    placed = docs.select(F.struct("*").alias("_row"), F.col(source_column).alias("_from"),
                         F.col(id_column).alias("_id"), F.monotonically_increasing_id().alias("_place"))
    rows = placed.select("_row", "_from", "_place", name.alias("_name"), uniform.alias("_u"))
    drawn = (rows.join(table, F.col("_from").eqNullSafe(F.col("_source")))
             .select("_row", "_name", "_place", (F.col("_first") + F.size(F.filter("_cdf", lambda c: c <= F.col("_u")))).alias("_n")))
    copies = drawn.filter("_n > 0").select("_row", "_name", "_place",
                                           F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_copy"))
    keyed = copies.withColumn("_key", F.xxhash64("_name", "_copy", "_place", F.lit(seed)))
    mixed = keyed.repartition("_key").sortWithinPartitions("_key")
    return mixed.select("_row.*", *([F.col("_copy").alias(copy_column)] if copy_column else []))


def mix_sources(docs: DataFrame, weights: Mapping[str, float] | None = None, temperature: float = 0.5,
                total: int | None = None, seed: int = 7, copy_column: str | None = "copy") -> DataFrame:
    """Rates of the sources, then their documents replicated to them."""
    return replicate(docs, mixing_rates(docs, weights, temperature, total), seed, copy_column=copy_column)
