"""Benchmark decontamination by spaced-seed hashing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headrace.llm.tables import Workspace, with_row_numbers

# Fixed masks: 1 is a token that counts, 0 one that may differ.
MASKS = ("1111101", "1101011011")
# Words are runs of anything but white space and ASCII punctuation.
SEPARATORS = r"[\x00-/:-@\[-`{-\x7f]+"
# Test hashes of up to this size are offered as a broadcast; more are joined by a shuffle.
BROADCAST_BYTES = 32 << 20


def tokens(text: Column) -> Column:
    """Lower-case words; text that begins or ends in a separator has an empty word there."""
    return F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), SEPARATORS)


def _seeded(rows: DataFrame, words: Column, keep: list[str], masks: list[str], carry: bool = False) -> DataFrame:
    """Rows (keep, at, mask, seed): a hash of the tokens each mask selects at each position.

    `carry` adds the words as `_words`, for rows that are few.

    The words go through explode so that they are computed once per text; all that follows is
    one generated loop that carries positions and hashes only.
    """
    def seed(number: int, mask: str) -> str:
        chosen = ", ".join(f"get(_words, at + {i})" for i, bit in enumerate(mask) if bit == "1")
        return f"CASE WHEN at + {len(mask)} <= size(_words) THEN xxhash64({number}, {chosen}) END"

    split = rows.select(*keep, F.explode_outer(F.array(words)).alias("_words"))
    positions = split.select(*keep, "_words", F.explode_outer(F.expr("sequence(0, size(_words) - 1)")).alias("at"))
    kept = [*keep, "_words"] if carry else keep
    hashes = positions.select(*kept, "at", F.array(*[F.expr(seed(n, m)) for n, m in enumerate(masks)]).alias("seeds"))
    return hashes.select(*kept, "at", F.posexplode_outer("seeds").alias("mask", "seed")).filter("seed IS NOT NULL")


def _distinct_places(seeded: DataFrame, key: str, flank: int, spans: Column, at: Column) -> DataFrame:
    """Rows (key, mask, seed, at): of the places whose compared words are the same, only one, chosen by `at`.

    Without it a text of equal words would meet an item of equal words in the product of their lengths.
    """
    left = F.least(F.col("at"), F.lit(flank))
    window = F.slice("_words", F.col("at") - left + 1, left + F.get(spans, F.col("mask")) + flank)
    return (seeded.select(key, "mask", "seed", "at", F.xxhash64(left, window).alias("_window"))
            .groupBy(key, "mask", "seed", "_window").agg(at.alias("at")).drop("_window"))


def _short_masks(items: DataFrame, shortest: int) -> list[str]:
    """A solid mask for each token count below the shortest mask's; at most that many."""
    counts = items.select(F.size("item_words").alias("n")).filter(F.col("n") < shortest).distinct().collect()
    return ["1" * r.n for r in sorted(counts)]


def find_leaks(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, flank: int = 5,
               share: float = 0.8) -> DataFrame:
    """Alignments of documents with test items that agree in most tokens around a seed hit.

    Every token position of documents (doc_id, text) and items (item_id, text) is hashed under
    each fixed mask, which ignores some of the tokens, and equal hashes are joined. Around a hit
    the aligned tokens from `flank` before to `flank` after the mask's span, as far as the item
    reaches, are compared one to one; the hit stands if at least `share` of them are equal. Items
    shorter than every mask must occur whole. Hashes of documents are not shuffled while the test
    side measures under BROADCAST_BYTES, and are joined by a shuffle beyond; that first join only
    names the documents with hits. Their texts alone are hashed once more, and places of a text
    (or of an item) that are compared by the very same words count once, the first of the text
    against the last of the item: repeated words do not multiply. Items of equal words count as
    the one of smallest id.

    Returns distinct (doc_id, item_id, offset, matched, compared), offset being the document's
    word at which the item would begin, with the best hit of each alignment. Null and empty texts
    leak nothing; rows with one id count as one document, those without an id as none; ids of any
    type are compared as they are; other columns are ignored; an empty table on either side gives
    no rows.
    """
    work = Workspace(docs.sparkSession)
    words = F.array_remove(tokens(F.col("text")), "")
    items = work.save(benchmark.groupBy(words.alias("item_words")).agg(F.min("item_id").alias("item_id"))
                      .filter("size(item_words) > 0 AND item_id IS NOT NULL"))
    every = [*masks, *_short_masks(items, min(map(len, masks)))]
    spans = F.array(*[F.lit(len(m)) for m in every])
    whole = (F.col("mask") < len(masks)) | (F.size("item_words") == F.get(spans, F.col("mask")))
    places = _seeded(items, F.col("item_words"), ["item_id", "item_words"], every, carry=True).filter(whole)
    test = work.save(_distinct_places(places, "item_id", flank, spans, F.max("at")).withColumnRenamed("at", "item_at"))
    small = test.count() * 64 <= BROADCAST_BYTES
    seeds = test.select("seed").distinct()

    read = docs.select("doc_id", "text").filter("doc_id IS NOT NULL AND text IS NOT NULL")
    train = _seeded(read, tokens(F.col("text")), ["doc_id"], every)
    named = work.save(train.join(F.broadcast(seeds) if small else seeds, "seed", "left_semi").select("doc_id").distinct())
    hit = work.save(read.join(named, "doc_id", "left_semi"))
    places = _seeded(hit, tokens(F.col("text")), ["doc_id"], every, carry=True)
    places = places.join(F.broadcast(seeds) if small else seeds, "seed", "left_semi")
    places = _distinct_places(places, "doc_id", flank, spans, F.min("at"))
    pairs = (places.join(F.broadcast(test) if small else test, ["mask", "seed"]).groupBy("doc_id", "item_id")
             .agg(F.collect_list(F.struct("mask", "at", "item_at")).alias("hits")))

    def verified(doc_words: Column) -> Column:
        def compare(hit):
            shift = hit["at"] - hit["item_at"]
            low = F.greatest(F.lit(0), hit["item_at"] - flank)
            high = F.least(F.size("item_words"), hit["item_at"] + F.get(spans, hit["mask"]) + flank)
            same = F.size(F.filter(F.sequence(low, high - 1), lambda i:
                                   F.get(F.col("item_words"), i) == F.get(doc_words, i + shift)))
            return F.struct(shift.alias("offset"), same.alias("matched"), (high - low).alias("compared"))
        return F.filter(F.transform("hits", compare), lambda h: h["matched"] >= share * h["compared"])

    texts = pairs.join(items, "item_id").join(hit, "doc_id")
    # as a lambda's variable the words are split once for all hits of a text
    found = F.element_at(F.transform(F.array(tokens(F.col("text"))), verified), 1)
    best = F.max(F.struct((F.col("h.matched") / F.col("h.compared")).alias("share"), "h.matched", "h.compared"))
    return (texts.select("doc_id", "item_id", F.explode(found).alias("h"))
            .groupBy("doc_id", "item_id", F.col("h.offset").alias("offset")).agg(best.alias("best"))
            .select("doc_id", "item_id", "offset", "best.matched", "best.compared"))


def leaked_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per leaking document: its best aligned item, and how many items it overlaps.

    Of equal shares the longer comparison counts, then the smaller item id, then the smaller offset.
    """
    leaks = find_leaks(docs, benchmark, **options)
    best = F.min(F.struct((-F.col("matched") / F.col("compared")).alias("share"), (-F.col("compared")).alias("length"),
                          "item_id", "offset", "matched", "compared"))
    items = leaks.groupBy("doc_id", "item_id").agg(best.alias("b"))
    return (items.groupBy("doc_id").agg(F.count("*").alias("n_items"), F.min("b").alias("b"))
            .select("doc_id", "n_items", "b.item_id", F.col("b.offset").cast("long").alias("word_offset"),
                    F.col("b.matched").cast("long").alias("matched"),
                    F.col("b.compared").cast("long").alias("compared")))


def remove_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents, all columns, without the rows that overlap a test item, whatever their id."""
    rows = with_row_numbers(Workspace(docs.sparkSession), docs)
    texts = rows.select(F.col("_number").alias("doc_id"), F.col("_row.text").alias("text"))
    leaked = find_leaks(texts, benchmark, **options).select(F.col("doc_id").alias("_number")).distinct()
    return rows.join(leaked, "_number", "left_anti").select("_row.*")
