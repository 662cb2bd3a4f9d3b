"""Sharding by balanced label propagation."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headrace.llm.tables import Workspace, hash01, numbered

# How far a shard may grow over its quota while labels propagate.
SLACK = 1.3


def equal_texts(work: Workspace, nodes: DataFrame, piece: int) -> DataFrame:
    """Rows (node, hub, unit) of all rows whose text occurs again; hub is the text's first row.

    Linking every row to its hub is as many links as rows, however large the group. A unit is what
    should move as a whole: the group, or about `piece` rows of a larger one. Nulls and empty
    texts are a group like any other.
    """
    hubs = work.save(nodes.groupBy("digest").agg(F.min("node").alias("hub"), F.count("*").alias("n")).filter("n > 1"))
    part = F.pmod(F.xxhash64("node", F.lit(9)), F.ceil(F.col("n") / F.lit(max(1, piece))))
    return work.save(nodes.join(hubs, "digest").select("node", "hub", F.xxhash64("hub", part).alias("unit")))


def propagate(work: Workspace, links: DataFrame, shards: int, quota: int, rounds: int = 10,
              seed: int = 11) -> DataFrame:
    """Labels (node, label) of the linked nodes after balanced label propagation.

    Labels begin at random. In each round the nodes look at their neighbours' labels (a join
    and a pre-aggregated count) and want the commonest; half of them, others each round, may
    move, so that two neighbours do not keep swapping; a shard takes no more than it has room
    for below `quota`, chosen by hash. It ends early once nobody wants to move, or only to full
    shards: then no round would change anything. Only per-shard counts leave the executors.
    """
    both = work.save(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    start = F.pmod(F.xxhash64("a", F.lit(seed)), F.lit(shards)).cast("int").alias("label")
    written = work.save(both.select("a").distinct().select(F.col("a").alias("node"), start))
    labels = written
    for turn in range(rounds):
        votes = (both.join(labels.withColumnRenamed("node", "b"), "b")
                 .groupBy(F.col("a").alias("node"), F.col("label").alias("vote")).agg(F.count("*").alias("n")))
        # after the join on the node its few votes, one for each shard at most, are grouped where they are
        best = F.max(F.struct("n", -F.col("vote"))).alias("best")
        same = F.max(F.when(F.col("vote") == F.col("label"), F.col("n")).otherwise(0)).alias("same")
        asking = (hash01("node", F.lit(turn)) < 0.5).alias("active")
        want = F.when(F.col("best.n") > F.col("same"), -F.col("best.col2")).cast("int").alias("want")
        wants = work.save(votes.join(labels, "node").groupBy("node", "label").agg(best, same)
                          .select("node", "label", asking, want))
        sizes, asked = Counter(), Counter()
        for r in wants.groupBy("label", "want").agg(F.count("*").alias("n")).collect():
            sizes[r.label] += r.n
            if r.want is not None:
                asked[r.want] += r.n
        room = {s: max(0, quota - sizes[s]) for s in range(shards)}
        if not any(room[s] for s in asked):
            work.drop(wants)
            break
        share = F.create_map(*[F.lit(x) for s in range(shards) for x in
                               (s, min(1.0, 2.0 * room[s] / max(1, asked[s])))])
        moves = F.col("active") & (hash01("node", F.lit(turn), F.lit(seed)) < share[F.col("want")])
        labels = wants.select("node", F.when(moves, F.col("want")).otherwise(F.col("label")).alias("label"))
        work.drop(written)
        written = wants
    return labels


def shard(docs: DataFrame, shards: int = 24, rounds: int = 10, id_column: str = "doc_id",
          text_column: str = "text") -> DataFrame:
    """Put every row into one of `shards` shards whose row counts differ by one at most.

    Rows with equal texts are linked and end in one shard where its quota allows; a group larger
    than a shard fills several. Unlinked rows fill what is left, so no move of theirs cuts a link.
    Null counts as an empty text; every input row, repeated ones too, is placed once; other columns are
    ignored; no rows give no rows.
    Returns id, size (UTF-8 bytes + 8), text_crc32, law, shard, slot, grown_shard.
    """
    spark = docs.sparkSession
    work = Workspace(spark)
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    nodes = work.save(docs.select(
        F.col(id_column).alias("id"), (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.sha2(text, 256).alias("digest"),
        F.monotonically_increasing_id().alias("node")))
    total = nodes.count()
    quotas = [total // shards + (s < total % shards) for s in range(shards)]
    groups = equal_texts(work, nodes, total // (8 * shards))
    links = groups.filter("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    # room to move: what is over the exact quota gives way afterwards, as whole units
    labels = propagate(work, links, shards, int(SLACK * total / shards), rounds)

    # in the order of their units rows go, or give way, as whole groups
    spread, order = F.xxhash64("unit", F.lit(3)), [F.col("unit"), F.col("node")]
    at_home = numbered(work.save(labels.join(groups, "node")), ["label"], spread, order, "rank")
    quota = F.create_map(*[F.lit(x) for s in range(shards) for x in (s, quotas[s])])
    settled = work.save(at_home.filter(F.col("rank") < quota[F.col("label")])
                        .select("node", F.col("label").alias("shard")))
    taken = {r.shard: r.n for r in settled.groupBy("shard").agg(F.count("*").alias("n")).collect()}

    rest = work.save(nodes.select("node").join(settled, "node", "left_anti").join(groups, "node", "left")
                     .select("node", F.coalesce("unit", "node").alias("unit"), F.lit(0).alias("all")))
    ends, end = [], 0
    for s in range(shards):
        end += quotas[s] - taken.get(s, 0)
        ends.append(end)
    free = F.size(F.filter(F.array(*[F.lit(e) for e in ends]), lambda e: e <= F.col("rank"))).cast("int")
    filled = numbered(rest, ["all"], spread, order, "rank").select("node", free.alias("shard"))
    placed = work.save(settled.union(filled))
    slots = numbered(placed, ["shard"], F.xxhash64("node", F.lit(3)), [F.col("node")], "slot")
    return (nodes.join(slots, "node")
            .select(F.col("id").alias(id_column), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))
