"""Near-duplicate texts: an n-gram Jaccard join by a MinHash LSH forest."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from headrace.llm.components import hung_components
from headrace.llm.tables import Workspace, ship_library, sorted_groups, with_row_numbers
from headrace.llm.words import Words, mix, words_of

SHINGLE = 5
THRESHOLD = 0.8
TREES, DEPTH = 24, 6
# Shares of the linked pairs that the forest must be expected to hold before it stops.
TARGET_RECALL = 0.9995
# Documents compared at once in a task; larger candidate groups are cut into pairs of such blocks.
BLOCK = 256
_RARE = 12


def shingles_of(words: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words, and the n + 1 bounds of the texts among them.

    A text of fewer words is one shingle; one without words has none.
    """
    first, counts = words.first, np.diff(words.first)
    short = np.where(counts > 0, np.minimum(counts, size), 0)
    per_text = np.where(counts > 0, counts - short + 1, 0)
    bounds = np.concatenate([[0], np.cumsum(per_text)])
    starts = np.repeat(first[:-1] - bounds[:-1], per_text) + np.arange(bounds[-1])
    length = np.repeat(short, per_text)
    hashes = np.zeros(len(starts), np.uint64)
    for i in range(size):
        use = length > i
        at = starts if use.all() else np.where(use, starts + i, 0) - i
        hashes = hashes * np.uint64(0xC2B2AE3D27D4EB4F) + np.where(use, words.hashes[at + i], np.uint64(1)) \
            if len(words.hashes) else hashes
    return mix(hashes), bounds


def _multipliers(n: int) -> np.ndarray:
    return np.random.default_rng(99).integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minhashes(hashes: np.ndarray, bounds: np.ndarray, count: int) -> np.ndarray:
    """16 bits of the least value of each of `count` hash functions, for every text with shingles."""
    full = np.flatnonzero(np.diff(bounds))
    result = np.empty((len(full), count), ">u2")
    starts = bounds[full]
    factors = _multipliers(count)
    # pieces of about 64K shingles stay in the processor's cache
    cuts = np.unique(np.searchsorted(starts, np.arange(0, len(hashes) + 1, 1 << 16)))
    for a, b in zip([0, *cuts[cuts > 0]], [*cuts[cuts > 0], len(full)]):
        if a == b:
            continue
        part = hashes[starts[a]:starts[b] if b < len(full) else len(hashes)]
        at = starts[a:b] - starts[a]
        for k, factor in enumerate(factors):
            least = np.minimum.reduceat(part * factor, at)
            result[a:b, k] = mix(least) >> np.uint64(48)
    return result


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) to (id, key of the word sequence, signature or null); in slices of some texts."""
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            some = batch.slice(at, 2000)
            words = words_of(some.column(1))
            hashes, bounds = shingles_of(words)
            n = np.diff(bounds)
            signatures = minhashes(hashes, bounds, TREES * DEPTH)
            data = iter(signatures)
            rows = [next(data).tobytes() if k else None for k in n]
            yield pa.RecordBatch.from_arrays(
                [some.column(0), pa.array(_sequence_keys(words), pa.binary()), pa.array(rows, pa.binary())],
                names=["id", "key", "signature"])


def _sequence_keys(words: Words) -> list[bytes | None]:
    """128 bits that identify a text's words in order; none for a text without words."""
    counts = np.diff(words.first)
    full = np.flatnonzero(counts)
    keys: list[bytes | None] = [None] * len(counts)
    if not len(full):
        return keys
    place = np.arange(len(words.hashes)) - np.repeat(words.first[:-1], counts)
    parts = []
    for salt in (0x1234567, 0x89ABCDE):
        spot = mix(place.astype(np.uint64) * np.uint64(2) + np.uint64(salt))
        parts.append(np.add.reduceat(mix(words.hashes ^ spot) * (spot | np.uint64(1)), words.first[full]))
    for k, pair in zip(full, np.stack(parts, axis=1)):
        keys[k] = pair.tobytes()
    return keys


def _shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text, key) to (id, sorted distinct shingle hashes), without texts of another key."""
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            some = batch.slice(at, 2000)
            words = words_of(some.column(1))
            hashes, bounds = shingles_of(words)
            sets = [np.unique(hashes[a:b]).tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
            own = pa.array([k == key for k, key in zip(_sequence_keys(words), some.column(2).to_pylist())], pa.bool_())
            yield pa.RecordBatch.from_arrays([some.column(0).filter(own), pa.array(sets, pa.binary()).filter(own)],
                                             names=["id", "shingles"])


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two sets share: rare ones pair by pair, frequent ones as a product."""
    n = len(sets)
    owners = np.repeat(np.arange(n), [len(s) for s in sets])
    values = np.concatenate(sets) if n else np.empty(0, np.uint64)
    order = np.argsort(values, kind="stable")
    values, owners = values[order], owners[order]
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.empty(0, int)
    sizes = np.diff(np.concatenate([starts, [len(values)]]))
    counts = np.zeros(n * n, np.int64)
    for size in range(2, _RARE + 1):
        members = owners[starts[sizes == size][:, None] + np.arange(size)]
        for i in range(size):
            for j in range(i + 1, size):
                counts += np.bincount(members[:, i] * n + members[:, j], minlength=n * n)
    counts = counts.reshape(n, n)
    frequent = np.flatnonzero(sizes > _RARE)
    for at in range(0, len(frequent), 4096):
        some = frequent[at:at + 4096]
        table = np.zeros((n, len(some)), np.float32)
        for column, k in enumerate(some):
            table[owners[starts[k]:starts[k] + sizes[k]], column] = 1
        product = np.rint(table @ table.T).astype(np.int64)
        counts += np.triu(product, 1)
    return counts + counts.T


def _verify(depth: int, threshold: float):
    """For each block pair: every document's links, the expected share found, and a root it hangs on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, ["cluster", "one", "two"]):
            cluster, one, two, side, ids, copies = (table.column(c).to_numpy() for c in
                                                    ("cluster", "one", "two", "side", "id", "copies"))
            sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in table.column("shingles")]
            edges = np.flatnonzero((np.diff(cluster) != 0) | (np.diff(one) != 0) | (np.diff(two) != 0)) + 1
            out = []
            for a, b in zip([0, *edges], [*edges, len(ids)]):
                if b - a > 1:
                    out.append((cluster[a], *_links(sets[a:b], side[a:b], one[a] == two[a], ids[a:b], copies[a:b],
                                                    depth, threshold)))
            if out:
                sizes = [len(o[1]) for o in out]
                columns = [np.repeat([o[0] for o in out], sizes), *(np.concatenate(c) for c in list(zip(*out))[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns],
                                                 names=["cluster", "id", "links", "pairs", "expected", "root"])
    return run


def _links(sets, side, same_block, ids, copies, depth, threshold):
    shared = shared_counts(sets)
    sizes = np.array([len(s) for s in sets])
    jaccard = shared / np.maximum(1, sizes[:, None] + sizes[None, :] - shared)
    linked = jaccard >= threshold
    if not same_block:
        linked &= side[:, None] != side[None, :]
    np.fill_diagonal(linked, False)
    found = 1 - (1 - np.clip(jaccard, 0, 1) ** depth) ** TREES
    weight = np.where(linked, 1 / np.maximum(found, 1e-9), 0)
    roots = ids.copy()
    while True:  # the least id reachable by links
        least = np.minimum(roots, np.where(linked, roots[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (least == roots).all():
            break
        roots = least
    keep = linked.any(axis=1)
    return (ids[keep], (linked * copies[None, :]).sum(axis=1)[keep].astype(np.int64),
            linked.sum(axis=1)[keep].astype(np.int64), weight.sum(axis=1)[keep], roots[keep])


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, target_recall: float = TARGET_RECALL,
                    id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, class_id, n_links, kept.

    Two documents are linked if the sets of their five-word shingles (lower-cased words between
    white space) have a Jaccard similarity of `threshold` or more; class_id is the smallest id
    reachable by links, n_links counts the documents linked directly, copies included, and kept
    marks the smallest id.

    Texts of the same words are one entry with a number of copies. Every entry stands in TREES
    sorted prefix tries under DEPTH minhashes each. Entries that meet in a trie node at the current
    prefix length form candidate groups; all pairs of a group are compared exactly, in blocks, and
    only counts and one root per entry leave a task. From the similarities found follows the share
    of linked pairs that a prefix of this length was bound to bring together; below
    `target_recall` the prefixes are shortened and groups that grew are compared again.

    Null, empty and blank texts have no words and link with nothing; a text under five words is
    one shingle; rows repeated under one id count as one document, rows without an id as none;
    other columns are ignored; no rows give no rows.
    """
    spark = docs.sparkSession
    ship_library(spark)
    work = Workspace(spark)
    read = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text")) \
        .filter("id IS NOT NULL")
    signed = work.save(read.mapInArrow(_sign, "id long, key binary, signature binary"))
    ids = signed.agg(F.count("*").alias("n"), F.count_distinct("id").alias("d")).first()
    repeated = ids.n != ids.d
    if repeated:  # an id given to several rows counts once, with the least of them
        signed = work.save(signed.groupBy("id").agg(F.min(F.struct("key", "signature")).alias("s"))
                           .select("id", "s.key", "s.signature"))
    members = signed.filter("key IS NOT NULL")
    entries = work.save(members.groupBy("key").agg(F.min("id").alias("entry"), F.count("*").alias("copies"),
                                                   F.min("signature").alias("signature")))
    trees = F.array(*[F.struct(F.lit(t).alias("tree"), F.substring("signature", 2 * DEPTH * t + 1, 2 * DEPTH)
                               .alias("label")) for t in range(TREES)])
    tries = work.save(entries.select("entry", F.inline(trees)).sortWithinPartitions("tree", "label"))

    def clusters_at(depth: int) -> DataFrame:
        nodes = tries.select("entry", F.xxhash64("tree", F.expr(f"substring(label, 1, {2 * depth})")).alias("node"))
        hubs = work.save(nodes.groupBy("node").agg(F.min("entry").alias("a"), F.count("*").alias("n"))
                         .filter("n > 1").drop("n"))
        groups = hung_components(work, nodes.join(hubs, "node").select(F.col("entry").alias("node"), F.col("a").alias("hub")))
        return work.save(groups.select(F.col("node").alias("entry"), F.col("component").alias("cluster"))
                         .join(entries.select("entry", "key", "copies"), "entry"))

    done, sizes, sets, depth = None, None, None, DEPTH
    while True:
        groups = clusters_at(depth)
        # a group is known by its size and the sum over its members; unchanged ones stay compared
        mark = [F.count("*").alias("n"), F.sum(F.xxhash64("entry").cast("decimal(20,0)")).alias("mark")]
        now = work.save(groups.groupBy("cluster").agg(*mark))
        grown = now if done is None else now.join(sizes, ["cluster", "n", "mark"], "left_anti")
        todo = groups.join(grown.select("cluster", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "cluster")
        if sets is None:
            sets = _sets_of(work, read, todo, repeated)
        else:
            sets = sets.union(_sets_of(work, read, todo.join(sets.select(F.col("id").alias("entry")), "entry",
                                                             "left_anti"), repeated))
        links = _compare(todo, sets, depth, threshold)
        if done is not None:
            same = now.join(sizes, ["cluster", "n", "mark"], "left_semi").select("cluster")
            links = done.join(same, "cluster", "left_semi").unionByName(links)
        measured = Observation()
        done, sizes = work.save(links.observe(measured, F.sum("pairs").alias("pairs"),
                                              F.sum("expected").alias("expected"))), now
        pairs, expected = measured.get["pairs"], measured.get["expected"]
        if not expected or pairs / expected >= target_recall or depth <= 3:
            break
        depth -= 1

    joined = hung_components(work, done.select(F.col("id").alias("node"), F.col("root").alias("hub")))
    direct = done.groupBy(F.col("id").alias("entry")).agg(F.sum("links").alias("links"))
    classes = work.save(entries.select("key", "entry", "copies").join(direct, "entry", "left")
                        .join(joined.withColumnRenamed("node", "entry"), "entry", "left")
                        .select("key", F.coalesce("component", "entry").alias("class_id"),
                                (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    return (signed.select("id", "key").join(classes, "key", "left")
            .select(F.col("id").alias(id_column), F.coalesce("class_id", "id").alias("class_id"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    (F.coalesce("class_id", "id") == F.col("id")).alias("kept")))


def _sets_of(work: Workspace, read: DataFrame, groups: DataFrame, repeated: bool) -> DataFrame:
    """The shingle sets of the entries in candidate groups, from a second pass over the texts."""
    wanted = groups.select(F.col("entry").alias("id"), "key")
    sets = (read.join(wanted, "id").select("id", "text", "key")
            .mapInArrow(_shingle_sets, "id long, shingles binary"))
    return work.save(sets.dropDuplicates(["id"]) if repeated else sets)


def _compare(todo: DataFrame, sets: DataFrame, depth: int, threshold: float) -> DataFrame:
    """All pairs within each group, in pairs of blocks: every entry goes to as many as there are blocks."""
    own = F.pmod(F.xxhash64("entry", F.lit(5)), F.col("blocks")).cast("int")
    rows = todo.select(
        "cluster", "entry", "copies", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("peer"))
    rows = rows.select("cluster", F.col("entry").alias("id"), "copies", F.least("own", "peer").alias("one"),
                       F.greatest("own", "peer").alias("two"), (F.col("own") > F.col("peer")).cast("int").alias("side"))
    keys = ["cluster", "one", "two"]
    dealt = rows.join(sets, "id").repartition(*keys).sortWithinPartitions(*keys)
    return dealt.select(*keys, "side", "id", "copies", "shingles").mapInArrow(
        _verify(depth, threshold), "cluster long, id long, links long, pairs long, expected double, root long")


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """The documents, all columns, with one row of each class.

    Every row is compared, whatever its id; of a class the row of least id stays, one without an
    id only if no other has one.
    """
    rows = with_row_numbers(Workspace(docs.sparkSession), docs)
    classes = near_duplicates(rows.select(F.col("_number").alias("doc_id"), F.col("_row.text").alias("text")), **options)
    named = classes.select(F.col("doc_id").alias("_number"), "class_id").join(
        rows.select("_number", F.col("_row.doc_id").alias("_id")), "_number")
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_number")).alias("first")
    kept = named.groupBy("class_id").agg(first).select(F.col("first._number").alias("_number"))
    return rows.join(kept, "_number", "left_semi").select("_row.*")
