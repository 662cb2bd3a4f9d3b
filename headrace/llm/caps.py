"""Near-duplicate vectors by spherical-cap filters over structured random product codes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headrace.llm.components import connected_components
from headrace.llm.tables import Workspace, ship_library, sorted_groups

THRESHOLD = 0.95
# Filters an average vector passes, members an average filter gets, vectors compared at once.
FILTERS_PER_VECTOR = 72
FILTER_SIZE = 24
BLOCK = 1024


@dataclass(frozen=True)
class ProductCode:
    """Filter directions: every combination of one code word per block of rotated coordinates."""

    rotation: np.ndarray
    words: tuple[np.ndarray, ...]
    least: float

    @classmethod
    def fitted(cls, dims: int, vectors: int, seed: int = 17) -> ProductCode:
        """A code for this many vectors; the cap's height is set on random directions, not on data."""
        rng = np.random.default_rng(seed)
        size = 1 << max(1, (dims - 1).bit_length())
        rotation = np.eye(size)
        for _ in range(3):  # sign flips and a Hadamard transform, three times
            rotation = _hadamard(rotation * rng.choice([-1.0, 1.0], size)) / np.sqrt(size)
        blocks = min(3, size)
        wanted = max(64.0, vectors * FILTERS_PER_VECTOR / FILTER_SIZE)
        per_block = int(np.ceil(wanted ** (1 / blocks)))
        words = []
        for width in np.diff(np.linspace(0, size, blocks + 1).astype(int)):
            w = rng.standard_normal((per_block, width))
            words.append(w / np.linalg.norm(w, axis=1, keepdims=True) / np.sqrt(blocks))
        code = cls(rotation[:dims], tuple(words), 0.0)
        sample = rng.standard_normal((400, dims))
        sums = code._parts(sample / np.linalg.norm(sample, axis=1, keepdims=True))
        picks = rng.integers(0, per_block, (blocks, 20000))
        scores = sum(p[:, k] for p, k in zip(sums, picks))
        share = min(0.5, FILTERS_PER_VECTOR / per_block ** blocks)
        return cls(code.rotation, code.words, float(np.quantile(scores, 1 - share)))

    def _parts(self, vectors: np.ndarray) -> list[np.ndarray]:
        turned, at, parts = vectors @ self.rotation, 0, []
        for words in self.words:
            parts.append(turned[:, at:at + words.shape[1]] @ words.T)
            at += words.shape[1]
        return parts

    def filters(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and numbers of all filters whose direction each unit vector exceeds the cap on.

        Decoded block by block: a partial sum goes on only if the best words of the blocks to
        come could still lift it over the cap. The best filter of all is always among them.
        """
        parts = self._parts(vectors)
        tops = [p.max(axis=1) for p in parts]
        best = sum(tops)
        least = np.minimum(self.least, best - 1e-12)
        rows, sums, codes = np.arange(len(vectors)), np.zeros(len(vectors)), np.zeros(len(vectors), np.int64)
        for i, part in enumerate(parts):
            rest = sum(tops[i + 1:]) if i + 1 < len(parts) else np.zeros(len(vectors))
            grown = sums[:, None] + part[rows]
            keep, word = np.nonzero(grown >= (least - rest)[rows][:, None])
            rows, sums, codes = rows[keep], grown[keep, word], codes[keep] * part.shape[1] + word
        return rows, codes


def _hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of every row, whose length is a power of two."""
    x, half = x.copy(), 1
    while half < x.shape[1]:
        y = x.reshape(len(x), -1, 2, half)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), -1)
        half *= 2
    return x


def _decode(code: ProductCode, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                vectors = _matrix(some.column("vector"), dims)
                rows, codes = code.filters(_unit(vectors))
                counts = np.bincount(rows, minlength=some.num_rows)
                order = np.lexsort((codes, rows))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()),
                                                 pa.array(codes[order]))
                yield pa.RecordBatch.from_arrays([some.column("entry"), lists], names=["entry", "filters"])
    return run


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1; a power of two first takes the largest component near 1, so that squares stay finite."""
    _, power = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))
    scaled = np.ldexp(vectors, -power)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    return pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def _verify(threshold: float, dims: int):
    """Links within each block pair of a filter, counted only in the first filter that two vectors share."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, ["filter", "one", "two"]):
            number, one, two, side, ids, copies = (table.column(c).to_numpy() for c in
                                                   ("filter", "one", "two", "side", "entry", "copies"))
            vectors = _unit(_matrix(table.column("vector"), dims))
            filters = pa.concat_arrays(table.column("filters").chunks)
            bounds, values = filters.offsets.to_numpy(), filters.values.to_numpy()
            lists = [values[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
            edges = np.flatnonzero((np.diff(number) != 0) | (np.diff(one) != 0) | (np.diff(two) != 0)) + 1
            for a, b in zip([0, *edges], [*edges, len(ids)]):
                part = vectors[a:b]
                linked = part @ part.T >= threshold
                if one[a] != two[a]:
                    linked &= side[a:b, None] != side[None, a:b]
                np.fill_diagonal(linked, False)
                left, right = np.nonzero(np.triu(linked))
                own = _first_common(lists[a:b], left, right) == number[a]
                linked[:] = False
                linked[left[own], right[own]] = True
                linked |= linked.T
                keep = np.flatnonzero(linked.any(axis=1))
                if len(keep):
                    yield _counted(ids[a:b], copies[a:b], linked, keep)
    return run


def _first_common(lists: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest filter two vectors share, for each pair."""
    if not len(left):
        return np.empty(0, np.int64)
    used = np.unique(np.concatenate([left, right]))
    names = np.unique(np.concatenate([lists[k] for k in used]))
    has = np.zeros((len(lists), len(names)), bool)
    for k in used:
        has[k, np.searchsorted(names, lists[k])] = True
    result = np.empty(len(left), np.int64)
    for at in range(0, len(left), 4096):
        both = has[left[at:at + 4096]] & has[right[at:at + 4096]]
        result[at:at + 4096] = names[both.argmax(axis=1)]
    return result


def _counted(ids, copies, linked, keep) -> pa.RecordBatch:
    roots = ids.copy()
    while True:
        least = np.minimum(roots, np.where(linked, roots[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (least == roots).all():
            break
        roots = least
    links = (linked * copies[None, :]).sum(axis=1)[keep]
    return pa.RecordBatch.from_arrays([pa.array(ids[keep]), pa.array(links.astype(np.int64)), pa.array(roots[keep])],
                                      names=["entry", "links", "root"])


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, id_column: str = "vec_id",
                 vector_column: str = "embedding") -> DataFrame:
    """One row per vector: id, n_links, component_id, kept.

    Two vectors are linked if their cosine in double precision is `threshold` or more. Equal
    vectors are one entry with a number of copies. Every entry is decoded to the list of all
    filters whose direction it exceeds the cap on; entries that share a filter are compared, in
    blocks where a filter has more than BLOCK of them, and a pair counts in the first filter it
    shares. Only counts and one root per entry leave a task. The code grows with the number of
    vectors so that filters keep their mean size; links found are exact, recall is measured in the
    tests (0.99 and more).

    Vectors of different lengths have no cosine: each length that two entries have gets a code of
    its own. Vectors that are null, empty, zero, or with null or non-finite components link with
    nothing, also not with their copies; finite ones of any size do. Rows repeated under one id
    count as one vector (the least), rows without an id as none; other columns are ignored; no
    rows give no rows.
    """
    spark = vectors.sparkSession
    ship_library(spark)
    work = Workspace(spark)
    vector = F.col(vector_column).cast("array<double>")
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), vector.alias("vector")).filter("id IS NOT NULL")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = (F.size("vector") > 0) & finite & F.exists("vector", lambda x: x != 0)
    rows = rows.groupBy("id").agg(F.min(F.when(usable, F.col("vector"))).alias("vector"))
    named = work.save(rows.withColumn("key", F.when(F.col("vector").isNotNull(), F.sha2(
        F.array_join(F.transform("vector", lambda x: (x + 0.0).cast("string")), ","), 256))))
    entries = work.save(named.filter("key IS NOT NULL").groupBy("key").agg(
        F.min("id").alias("entry"), F.count("*").alias("copies"), F.min("vector").alias("vector")))
    # as narrow as the vectors came
    narrow = vectors.schema[vector_column].dataType.simpleString() == "array<float>"
    compact = F.col("vector").cast("array<float>") if narrow else F.col("vector")
    lengths = (entries.groupBy(F.size("vector").alias("dims")).agg(F.count("*").alias("n")).filter("n > 1")
               .orderBy("dims").collect())
    found = spark.createDataFrame([], "entry long, links long, root long")
    for dims, count in lengths:
        some = entries.filter(F.size("vector") == dims).select("entry", "copies", compact.alias("vector"))
        found = found.unionByName(_links(work, some, dims, count, threshold))
    joined = connected_components(work, found.filter("entry <> root").select(F.col("entry").alias("a"),
                                                                             F.col("root").alias("b")))
    direct = found.groupBy("entry").agg(F.sum("links").alias("links"))
    classes = work.save(entries.select("key", "entry", "copies").join(direct, "entry", "left")
                        .join(joined.withColumnRenamed("node", "entry"), "entry", "left")
                        .select("key", F.coalesce("component", "entry").alias("component_id"),
                                (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    component = F.coalesce("component_id", "id")
    return (named.select("id", "key").join(classes, "key", "left")
            .select(F.col("id").alias(id_column), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    component.alias("component_id"), (component == F.col("id")).alias("kept")))


def _links(work: Workspace, entries: DataFrame, dims: int, count: int, threshold: float) -> DataFrame:
    """Rows (entry, links, root) of `count` entries (entry, copies, vector) of one length: what each task linked."""
    code = ProductCode.fitted(dims, count)
    lists = work.save(entries.select("entry", "vector").mapInArrow(_decode(code, dims),
                                                                  "entry long, filters array<long>"))
    sizes = work.save(lists.select(F.explode("filters").alias("filter")).groupBy("filter")
                      .agg(F.count("*").alias("n")).filter("n > 1")
                      .select("filter", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    hits = lists.select("entry", F.explode("filters").alias("filter")).join(sizes, "filter")
    own = F.pmod(F.xxhash64("entry", F.lit(5)), F.col("blocks")).cast("int")
    dealt = hits.select("filter", "entry", own.alias("own"), F.explode(F.expr("sequence(0, blocks - 1)")).alias("peer"))
    keys = ["filter", "one", "two"]
    dealt = dealt.select("filter", "entry", F.least("own", "peer").alias("one"), F.greatest("own", "peer").alias("two"),
                         (F.col("own") > F.col("peer")).cast("int").alias("side"))
    # of the filters only those a pair could have shared before
    before = F.filter("filters", lambda f: f <= F.col("filter")).alias("filters")
    full = (dealt.join(entries, "entry").join(lists, "entry")
            .select(*keys, "side", "entry", "copies", "vector", before)
            .repartition(*keys).sortWithinPartitions(*keys))
    return work.save(full.select(*keys, "side", "entry", "copies", "vector", "filters").mapInArrow(
        _verify(threshold, dims), "entry long, links long, root long"))
