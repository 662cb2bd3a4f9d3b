"""Scoring texts with a hierarchical Pitman-Yor language model: a restaurant per previous word."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headrace.llm.tables import Workspace, ship_library
from headrace.llm.words import mix, words_of

STRENGTH = 1.0
BURN_IN, SAMPLES = 2, 3
# Table counts of dishes with up to this many customers are weighed by a recursion, others by an integral.
SMALL = 1024
# Points of that integral.
POINTS = 48
# Counts at which a dish's weights are computed; a polynomial through them gives the others.
NODES = 32
_CHEBYSHEV = np.cos(np.pi * (np.arange(NODES) + 0.5) / NODES)
# Pairs, and words, whose probabilities go to every task when texts are scored.
FREQUENT = 1 << 18
COMMON = 1 << 17
# Other pairs of the texts are joined with the model in this many rounds, each with its own shuffle files.
ROUNDS = 4
# Bits (a power of two) of the filter that tells most pairs the join would not find; two a pair.
FILTER_BITS = 26
# Tokens a counting task holds at once.
HELD_TOKENS = 1_000_000
# Dishes that a task seats at once.
SEATED = 400_000
# Repeated pairs of one context or word from which on its rows are dealt to several tasks, so many to each.
HOT_PAIRS = 1 << 16
_END = np.int64(0x0E4D0E4D0E4D0E4D)


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers (63 bits) and the words before of all tokens, ends included, and the texts' bounds.

    The first word of a text follows an end.
    """
    words = words_of(texts)
    counts = np.diff(words.first)
    bounds = np.concatenate([[0], np.cumsum(counts + 1)])
    place = np.arange(len(words.hashes)) + np.repeat(np.arange(len(counts)), counts)
    numbers = np.full(bounds[-1], _END, np.int64)
    numbers[place] = (words.hashes >> np.uint64(1)).astype(np.int64)
    contexts = np.concatenate([[_END], numbers[:-1]]).astype(np.int64)[:len(numbers)]
    return numbers, contexts, bounds


def _pair_hash(contexts: np.ndarray, numbers: np.ndarray, seed: int = 0) -> np.ndarray:
    return mix(mix(contexts.astype(np.uint64) + np.uint64(seed)) + numbers.astype(np.uint64))


def _distinct(contexts: np.ndarray, numbers: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct (row, context, word), by row, and how often it occurs.

    Pairs are brought together by hash; two with one hash may give several places with a share each. Rows are below 2 ** 16.
    """
    order = np.argsort(_pair_hash(contexts, numbers))
    order = order[np.argsort(rows[order].astype(np.uint16), kind="stable")]
    c, w, r = contexts[order], numbers[order], rows[order]
    new = np.ones(len(order), bool)
    new[1:] = (c[1:] != c[:-1]) | (w[1:] != w[:-1]) | (r[1:] != r[:-1])
    at = np.flatnonzero(new)
    return order[at], np.diff(np.append(at, len(order)))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (context, word) in texts to learn from, added up over HELD_TOKENS before they leave the task.

    Pairs of texts held out are marked and count nothing.
    """
    held, tokens = [], 0

    def flush():
        numbers, contexts, out = (np.concatenate(x) for x in zip(*held))
        at, n = _distinct(contexts, numbers, out)
        return pa.RecordBatch.from_arrays([pa.array(contexts[at]), pa.array(numbers[at]), pa.array(np.where(out[at], 0, n)),
                                           pa.array(out[at])], names=["context", "word", "n", "asked"])
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            some = batch.slice(at, 200)
            numbers, contexts, bounds = tokens_of(some.column("text"))
            out = some.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            held.append((numbers, contexts, np.repeat(out, np.diff(bounds))))
            tokens += len(numbers)
            if tokens > HELD_TOKENS:
                yield flush()
                held, tokens = [], 0
    if held:
        yield flush()


def _cut(to: np.ndarray, **columns: np.ndarray) -> pa.RecordBatch:
    """A row per bucket: its number and, in each column, the bytes of its rows."""
    order = np.argsort(to.astype(np.uint16), kind="stable")
    to = to[order]
    first = np.flatnonzero(np.diff(to, prepend=-1))
    ends, arrays = np.append(first, len(to)), [pa.array(to[first].astype(np.int32))]
    for x in columns.values():
        data = np.ascontiguousarray(x[order])
        offsets = (ends * (data.nbytes // max(1, len(data)))).astype(np.int32)
        arrays.append(pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(data)]))
    return pa.RecordBatch.from_arrays(arrays, names=["bucket", *columns])


def _opened(blocks: pa.Table | pa.RecordBatch, name: str, kind: type, width: int = 0) -> np.ndarray:
    """A column of the rows of all blocks that have it, lists of `width` numbers as rows."""
    out = np.frombuffer(b"".join(x for x in blocks.column(name).to_pylist() if x is not None), kind)
    return out.reshape(-1, width) if width else out


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(keys.astype(np.uint64) + np.uint64(11)) % np.uint64(buckets)).astype(np.int64)


def _buckets(spark: SparkSession) -> int:
    """How many buckets rows are dealt to: as many as shuffles have partitions."""
    return min(1 << 15, max(2 * ROUNDS, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def _count_blocks(buckets: int):
    """The counts of `_count` as blocks, by the hash of the pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _count(batches):
            context, word = (some.column(c).to_numpy() for c in ("context", "word"))
            yield _cut(_bucket(_pair_hash(context, word), buckets), context=context, word=word,
                       n=some.column("n").to_numpy().astype(np.int32), asked=some.column("asked").to_numpy(zero_copy_only=False))
    return run


def _merge(blocks: pa.Table) -> pa.Table:
    """The pairs of a bucket that are met again or asked for, and sums over all of its pairs by word and by context.

    Rows of sums have no context; single and live count a word's pairs met once and again, out_single and out_live those of the
    context of that name.
    """
    context, word, n, asked = (_opened(blocks, c, kind) for c, kind in (
        ("context", np.int64), ("word", np.int64), ("n", np.int32), ("asked", np.bool_)))
    code = _pair_hash(context, word)
    order = np.argsort(code)
    c, w, code = context[order], word[order], code[order]
    differs = (c[1:] != c[:-1]) | (w[1:] != w[:-1])
    if (differs & (code[1:] == code[:-1])).any():  # two pairs with one hash
        order = np.lexsort((word, context))
        c, w = context[order], word[order]
        differs = (c[1:] != c[:-1]) | (w[1:] != w[:-1])
    at = np.flatnonzero(np.append(True, differs))
    c, w, n, asked = c[at], w[at], np.add.reduceat(n[order].astype(np.int64), at), np.logical_or.reduceat(asked[order], at)
    learned = n > 0
    keep = learned & ((n > 1) | asked)
    pairs = {"context": c[keep], "word": w[keep], "n": n[keep], "asked": asked[keep]}
    c, w, n = c[learned], w[learned], n[learned]
    words, place = np.unique(np.concatenate([w, c]), return_inverse=True)
    as_word, as_context, once = place[:len(w)], place[len(w):], n == 1

    def sums(at, weights=None):
        return np.bincount(at, weights, len(words)).astype(np.int64)
    total = {"word": words, "n": sums(as_word, n), "single": sums(as_word[once]), "live": sums(as_word[~once]),
             "out_single": sums(as_context[once]), "out_live": sums(as_context[~once])}
    schema = pa.schema([(name, pa.bool_() if name == "asked" else pa.int64()) for name in _names(_MERGED)])
    return pa.concat_tables([pa.table({name: x[name] if name in x else pa.nulls(rows, schema.field(name).type)
                                       for name in schema.names}, schema)
                             for x, rows in ((pairs, int(keep.sum())), (total, len(words)))])


# --- table counts -------------------------------------------------------------------------------

def _log_gamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function for x > 0, by Stirling's series from 10 on."""
    x = np.asarray(x, float)
    shift = np.zeros_like(x)
    for _ in range(10):
        low = x < 10
        shift = shift - np.where(low, np.log(np.where(low, x, 1.0)), 0.0)
        x = np.where(low, x + 1, x)
    y = 1 / (x * x)
    return shift + (x - 0.5) * np.log(x) - x + 0.9189385332046727 + (1 / 12 - y * (1 / 360 - y * (1 / 1260 - y / 1680))) / x


@lru_cache(8)
def _log_ways(discount: float) -> np.ndarray:
    """Logs of the weights with which n <= SMALL customers sit at t tables, [n, t]: generalised Stirling numbers."""
    logs = np.full((SMALL + 1, SMALL + 1), -np.inf)
    logs[1, 1] = 0.0
    t = np.arange(SMALL + 1)
    for n in range(1, SMALL):
        with np.errstate(invalid="ignore", divide="ignore"):
            stay = logs[n] + np.log(np.maximum(n - t * discount, 1e-300))
        logs[n + 1, 1:] = np.logaddexp(logs[n, :-1], stay[1:])
    return logs


def log_sum_of_sizes(n: np.ndarray, t: np.ndarray, discount: float) -> np.ndarray:
    """log P(t tables hold n customers in all), table sizes being independent Sibuya(discount) numbers.

    Times n! / (t! discount ** t) it is the generalised Stirling number. It is the n-th coefficient of
    (1 - (1 - z) ** discount) ** t, an integral over a parabola through the saddle point.
    """
    n, t = np.asarray(n, float), np.asarray(t, float)
    def mean(log_x):  # of a size, tilted by z = 1 - x
        return -np.expm1(log_x) * discount * np.exp((discount - 1) * log_x) / -np.expm1(discount * log_x)

    low, high = np.full(n.shape, -60.0), np.full(n.shape, -1e-9)
    for _ in range(30):  # log x of the saddle
        mid = (low + high) / 2
        more = mean(mid) > n / t
        low, high = np.where(more, mid, low), np.where(more, high, mid)
    sigma = np.maximum(-np.log1p(-np.exp((low + high) / 2)), 3.0 / n)
    # far from the branch point z = 1 a circle through the saddle does, as far as its peak is wide
    circle = sigma > 0.4
    far = np.maximum(sigma, 0.4)
    spread = t * (mean(np.log(-np.expm1(0.001 - far))) - mean(np.log(-np.expm1(-0.001 - far)))) / 0.002
    arc = np.minimum(np.pi, 9 / np.sqrt(np.maximum(spread, 1.0)))
    reach = np.sqrt(40 / (n * sigma * min(1.0, 2 * (1 - discount))))
    steps = (np.arange(POINTS) + 0.5) / POINTS
    turn = np.where(circle[..., None], 1, 1 + 1j * reach[..., None] * steps)
    s = sigma[..., None] * turn ** 2 + np.where(circle[..., None], 1j * arc[..., None] * steps, 0)
    held = np.log1p(-np.exp(discount * np.log(-np.expm1(-s))))
    logs = n[..., None] * s + t[..., None] * held + np.log(turn)
    top = logs.real.max(axis=-1)
    total = np.exp(logs - top[..., None]).real.sum(axis=-1)
    out = top + np.log(np.maximum(total, 1e-300) * np.where(circle, arc, 2 * sigma * reach) / np.pi / POINTS)
    return np.where(t == n, n * np.log(discount), out)


def draw_tables(n: np.ndarray, strength: np.ndarray, base: np.ndarray, discount: float,
                uniform: np.ndarray) -> np.ndarray:
    """For each dish the number of tables of its n customers, all of them seated anew.

    `strength` is the restaurant's, plus the discount for each table of another dish there; `base`
    is the probability of the dish at a new table. A count t weighs the rising product of
    `strength` by `discount` over t, times base ** t, times the generalised Stirling number of
    (n, t): the Gibbs conditional with the sizes summed out. `uniform` inverts its distribution.
    """
    n = np.asarray(n, np.int64)
    out = np.ones(len(n), np.int64)
    ways, a, log_base = _log_ways(discount), strength / discount, np.log(base)
    small = np.flatnonzero((n > 1) & (n <= SMALL))
    small = small[np.argsort(n[small].astype(np.uint16), kind="stable")]
    sizes, first = np.unique(n[small], return_index=True)
    for size, at in zip(sizes, np.split(small, first[1:])):
        t = np.arange(1, size + 1)
        rising = np.cumsum(np.log(strength[at, None] + discount * (t - 1)), axis=1)
        logs = rising + t * log_base[at, None] + ways[size, 1:size + 1]
        cdf = np.cumsum(np.exp(logs - logs.max(axis=1, keepdims=True)), axis=1)
        out[at] = np.minimum(1 + (cdf <= uniform[at, None] * cdf[:, -1:]).sum(axis=1), size)
    for some in np.array_split(np.flatnonzero(n > SMALL), max(1, np.count_nonzero(n > SMALL) // 1000)):
        if not len(some):
            continue
        size, own, logb = n[some], a[some], log_base[some]

        def weight(t, i=slice(None)):
            return (_log_gamma(own[i] + t) - _log_gamma(t + 1.0) + t * logb[i]
                    + log_sum_of_sizes(np.broadcast_to(size[i], np.shape(t)), t, discount))

        low, high = np.ones(len(some), np.int64), size.copy()
        while (low < high).any():  # the weights have one peak
            mid = (low + high) // 2
            rises = (low < high) & (weight(np.minimum(mid + 1, size)) > weight(mid))
            low, high = np.where(rises, mid + 1, low), np.where(rises, high, np.minimum(high, mid))
        near = np.clip(low, 2, size - 1)
        bend = 2 * weight(near) - weight(near - 1) - weight(near + 1)
        reach = np.ceil(8 / np.sqrt(np.maximum(bend, 1e-12)) + 8).astype(np.int64)
        for i, k in enumerate(some):
            t = np.arange(max(1, low[i] - reach[i]), min(size[i], low[i] + reach[i]) + 1)
            if len(t) > 3 * NODES:  # smooth: a polynomial through the weights of some counts
                at = t[0] + (t[-1] - t[0]) * (1 + _CHEBYSHEV) / 2
                fit = np.polynomial.chebyshev.chebfit(_CHEBYSHEV, weight(at, np.full(NODES, i)), NODES - 1)
                logs = np.polynomial.chebyshev.chebval(np.linspace(-1, 1, len(t)), fit)
            else:
                logs = weight(t, np.full(len(t), i))
            cdf = np.cumsum(np.exp(logs - logs.max()))
            out[k] = t[min(len(t) - 1, int(np.searchsorted(cdf, uniform[k] * cdf[-1], side="right")))]
    return out


def _uniform(contexts: np.ndarray, numbers: np.ndarray, seed: int) -> np.ndarray:
    """A random number in [0, 1) for each pair: a hash of its context and word."""
    return (_pair_hash(contexts, numbers, seed) >> np.uint64(11)).astype(float) / 2.0**53


def _seat(discount: float, seed: int, names: tuple[str, ...]):
    """Dishes of the root with n, strength and base to rows of `names`, t being the tables of the n customers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _together(batches, SEATED):
            word, n, strength, base = (some[c].to_numpy() for c in ("word", "n", "strength", "base"))
            t = pa.array(draw_tables(n, strength, base, discount, _uniform(np.zeros(len(word), np.int64), word, seed)))
            yield from pa.table({c: t if c == "t" else some[c] for c in names}).to_batches()
    return run


def _seat_pairs(everywhere: Broadcast, step: int, discount: float, seed: int, names: tuple[str, ...]):
    """Pairs seated anew, in rows of `names`; drawn adds up the tables of the samples.

    Common words have their tables, as contexts, and probabilities, as words, in the broadcast; rows have those of others.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, tables, bases = everywhere.value
        for some in _together(batches, SEATED):
            n, t = (some[c].to_numpy() for c in ("n", "t"))
            if "pair" in names:
                pair = some["pair"].to_numpy()
                c, w = pair // step, pair % step
                context, word, held, base = numbers[c], numbers[w], tables[c], bases[w]
            else:
                context, word, c, w = (some[x].to_numpy() for x in ("context", "word", "c", "w"))
                held, base = (np.where(at >= 0, source[at], some[x].to_numpy()) if len(source) else some[x].to_numpy()
                              for at, source, x in ((c, tables, "_tables"), (w, bases, "base")))
            new = draw_tables(n, STRENGTH + discount * (held - t), base, discount, _uniform(context, word, seed))
            changed = {"t": pa.array(new), "drawn": pc.add(some["drawn"], pa.array(new))}
            yield from pa.table({x: changed.get(x, some[x]) for x in names}).to_batches()
    return run


def _table_sums(everywhere: Broadcast, step: int):
    """Sums of the tables in a task by word and by context: rows (word, more, out_more)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = everywhere.value[0]
        sums = np.zeros((2, len(numbers)))
        for batch in batches:
            pair, t = (batch.column(c).to_numpy() for c in ("pair", "t"))
            for own, at in zip(sums, (pair % step, pair // step)):
                own += np.bincount(at, t, len(numbers))
        at = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(numbers[at]), *(pa.array(x[at].astype(np.int64)) for x in sums)],
                                         names=["word", "more", "out_more"])
    return run


def _places(numbers: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The place of each word among the ascending numbers, or -1."""
    if not len(numbers):
        return np.full(len(words), -1)
    place = np.minimum(np.searchsorted(numbers, words), len(numbers) - 1)
    return np.where(numbers[place] == words, place, -1)


class Lookup:
    """Places of many numbers among distinct keys, by hash."""

    def __init__(self, keys: np.ndarray):
        bits = len(keys).bit_length() + 1
        self._shift = np.uint64(64 - bits)
        code = mix(keys.astype(np.uint64)) >> self._shift
        order = np.argsort(code)
        self._keys, self._places = keys[order], order
        self._first = np.searchsorted(code[order], np.arange((1 << bits) + 1, dtype=np.uint64))

    def __call__(self, numbers: np.ndarray) -> np.ndarray:
        """The place of each number, or -1."""
        code = (mix(numbers.astype(np.uint64)) >> self._shift).astype(np.int64)
        at, end = self._first[code], self._first[code + 1]
        out = np.full(len(numbers), -1)
        todo = np.flatnonzero(at < end)
        at, end, numbers = at[todo], end[todo], numbers[todo]
        while len(todo):
            hit = self._keys[at] == numbers
            out[todo[hit]] = self._places[at[hit]]
            at += 1
            left = ~hit & (at < end)
            todo, at, end, numbers = todo[left], at[left], end[left], numbers[left]
        return out


def _ranked(everywhere: Broadcast):
    """Rows with context and word, and their ranks c and w."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = Lookup(everywhere.value)
        for batch in batches:
            c, w = (rank(batch.column(x).to_numpy()).astype(np.int32) for x in ("context", "word"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(c), pa.array(w)], names=[*batch.schema.names, "c", "w"])
    return run


def _together(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Tables of about so many rows."""
    held, count = [], 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count >= rows:
            yield pa.Table.from_batches(held)
            held, count = [], 0
    if count:
        yield pa.Table.from_batches(held)


_COUNTED = "bucket int, context binary, word binary, n binary, asked binary"
_MERGED = "context long, word long, n long, asked boolean, single long, live long, out_single long, out_live long"
_NEAR = "pair long, n long, t long, drawn long"
_FAR = "context long, word long, c int, w int, n long, t long, drawn long"
_KEPT = ("word long, word_n long, single long, live long, out_single long, out_live long, common boolean, roots array<double>, "
         "backs array<double>, n long, t long, tables long")


def _names(schema: str) -> tuple[str, ...]:
    return tuple(column.split()[0] for column in schema.split(", "))


# --- the model ----------------------------------------------------------------------------------

@dataclass(frozen=True)
class Model:
    """The pairs (context, word, n, asked, c, w) met again or asked for, those met again by two kinds: near (pair, n, drawn) of
    common words, far (context, word, c, w, n, drawn) others; words (word, word_n, common, roots, backs), `numbers` of the common
    ones, and sizes.

    A pair is asked for if a text held out has it; c and w are the ranks of its words among the common ones, or -1.
    drawn adds up a pair's tables, roots and backs list probabilities as a word and as a context, all over the samples.
    A word occurs as often as a context as it does as a word.
    """

    pairs: DataFrame
    near: DataFrame
    far: DataFrame
    words: DataFrame
    numbers: np.ndarray
    discount: float
    size: int
    total: int
    unknown: list[float]


def _looked_up(rows: DataFrame, table: DataFrame, key: str, rank: str, other: str, hot: DataFrame | None) -> DataFrame:
    """Rows with the table's columns for their key, null for common keys.

    Rows of a hot key (key, salts) are cut by `other`.
    """
    common = rows.filter(F.col(rank) >= 0).withColumns(
        {c: F.lit(None).cast(kind) for c, kind in table.dtypes if c != key})
    rows = rows.filter(F.col(rank) < 0)
    if hot is None:
        return common.unionByName(rows.join(table, key, "left"))
    one, hot = F.lit(1), F.broadcast(hot)
    salted = rows.join(hot, key, "left").withColumn("_salt", F.pmod(F.xxhash64(other), F.coalesce("salts", one)).cast("int"))
    copies = (table.join(hot, key, "left")
              .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", one) - 1))).drop("salts"))
    return common.unionByName(salted.drop("salts").join(copies, [key, "_salt"], "left").drop("_salt"))


def _hot(work: Workspace, table: DataFrame, key: str, live: str) -> DataFrame | None:
    """Keys of HOT_PAIRS repeated pairs and more: no more of them than pairs / HOT_PAIRS."""
    salts = (1 + F.col(live) / HOT_PAIRS).cast("int").alias("salts")
    hot = work.save(table.filter(F.col(live) >= HOT_PAIRS).select(F.col("word").alias(key), salts).coalesce(1))
    return None if hot.isEmpty() else hot


def _discount(one, two) -> float:
    """The leave-one-out estimate of absolute discounting."""
    return float(np.clip((one or 0) / max(1, (one or 0) + 2 * (two or 0)), 0.1, 0.9))


def train(work: Workspace, texts: DataFrame, seed: int = 5) -> Model:
    """The model of all texts (text, held_out) that are not held out.

    Counts of (context, word) are added up in the tasks and meet once, in blocks. In a sweep every customer of
    every pair is seated anew, given the context's tables and the word's root probability as the
    sweep before left them; then the root's customers, the tables of the pairs, are seated anew, and
    both totals are counted again. Only table counts are kept. BURN_IN sweeps are followed by SAMPLES.
    A pair met once has one table in every sweep: such pairs, most of all, are counted once per word
    and per context, and the state that sweeps pass on holds the others. So do words met once at the
    root, and contexts without a repeated pair keep their tables: sweeps leave out words that are both.
    Tables and probabilities of the COMMON commonest words go to all tasks before each sweep; only pairs with another
    word are joined.
    """
    spark, step = work.spark, COMMON
    counted = work.save_tidy(texts.select("text", "held_out").mapInArrow(_count_blocks(_buckets(spark)), _COUNTED)
                             .groupBy("bucket").applyInArrow(_merge, _MERGED))
    names = work.save_tidy(counted.filter("context IS NULL").groupBy("word").agg(
        F.sum("n").alias("word_n"), *[F.sum(c).alias(c) for c in ("single", "live", "out_single", "out_live")]))
    met_again = counted.filter("context IS NOT NULL").select("context", "word", "n", "asked")
    served, lone = F.col("single") + F.col("live"), (F.col("single") == 1) & (F.col("live") == 0)
    still = lone & (F.col("out_live") == 0)
    per_word = names.agg(
        F.sum("word_n").alias("total"), F.sum(served).alias("pairs"), F.sum("single").alias("single"), F.count("*").alias("t"),
        F.count(F.when(still, 1)).alias("still"), *[F.count(F.when(served == k, 1)).alias(f"served_{k}") for k in (1, 2)]).first()
    total, size = int(per_word.total or 0), int(per_word.t)
    low = _discount(per_word.single, met_again.filter("n = 2").count())
    top, base = _discount(per_word.served_1, per_word.served_2), 1.0 / (size + 1)

    def root(customers: float, tables: float, served, own):
        return (served - top * own + (STRENGTH + top * tables) * base) / (STRENGTH + customers)

    often = work.save_tidy(names.orderBy(F.desc("word_n"), "word").limit(step).select("word", F.lit(True).alias("common")))
    numbers = np.sort(often.select("word").toArrow()["word"].to_numpy())
    pairs = work.save_tidy(met_again.mapInArrow(
        _ranked(spark.sparkContext.broadcast(numbers)), "context long, word long, n long, asked boolean, c int, w int"))
    work.drop(counted)
    names = names.join(F.broadcast(often), "word", "left").withColumn("common", F.coalesce("common", F.lit(False)))
    nothing, one, none = F.array().cast("array<double>"), F.lit(1).cast("long"), F.lit(0).cast("long")
    kept = work.save_tidy(names.filter(~still).withColumns({
        "roots": nothing, "backs": nothing, "n": served, "t": one, "tables": F.col("out_single") + F.col("out_live")})
        .select(*_names(_KEPT)))
    rare = kept.filter("NOT common")
    hot_words, hot_contexts = _hot(work, rare, "word", "live"), _hot(work, rare, "context", "out_live")
    customers, tables = float(per_word.pairs or 0), float(size)
    again = pairs.filter("n > 1").withColumns({"t": one, "drawn": none, "pair": F.col("c").cast("long") * step + F.col("w")})
    near = again.filter("c >= 0 AND w >= 0").select(*_names(_NEAR))
    far = again.filter("c < 0 OR w < 0").select(*_names(_FAR))
    unknown, alone, passed = [], [], []
    for sweep in range(BURN_IN + SAMPLES if total else 0):
        if sweep == BURN_IN:
            near, far = near.withColumn("drawn", none), far.withColumn("drawn", none)
        now = root(customers, tables, F.col("n"), F.col("t"))
        shared = kept.filter("common").select("word", "tables", now.alias("base")).toArrow()
        held, bases = np.zeros(len(numbers)), np.ones(len(numbers))
        place = np.searchsorted(numbers, shared["word"].to_numpy())
        held[place], bases[place] = shared["tables"].to_numpy(), shared["base"].to_numpy()
        everywhere = spark.sparkContext.broadcast((numbers, held, bases))
        rare = kept.filter("NOT common")
        rows = _looked_up(far, rare.filter("out_live > 0").select(
            F.col("word").alias("context"), F.col("tables").cast("double").alias("_tables")), "context", "c", "word", hot_contexts)
        rows = _looked_up(rows, rare.filter("live > 0").select("word", now.alias("base")), "word", "w", "context", hot_words)
        near, far = (work.save_tidy(x.mapInArrow(_seat_pairs(everywhere, step, low, seed + 100 * sweep, _names(schema)), schema))
                     for x, schema in ((near, _NEAR), (rows, _FAR)))
        work.drop(*passed)
        # the root, whose customers are the tables just drawn; its names are (0, word)
        sums = near.select("pair", "t").mapInArrow(_table_sums(everywhere, step), "word long, more long, out_more long")
        sums = sums.unionByName(far.select("word", F.col("t").alias("more"), none.alias("out_more"))).unionByName(
            far.select(F.col("context").alias("word"), none.alias("more"), F.col("t").alias("out_more")))
        fresh = kept.withColumn("roots", F.concat("roots", F.array(now))) if sweep > BURN_IN else kept
        fresh = fresh.join(sums.groupBy("word").agg(*[F.sum(c).alias(c) for c in ("more", "out_more")]), "word", "left").withColumns({
            "n": F.col("single") + F.coalesce("more", none), "tables": F.col("out_single") + F.coalesce("out_more", none),
            "base": F.lit(base), "strength": STRENGTH + top * (tables - F.col("t"))}).drop("t", "more", "out_more")
        if sweep >= BURN_IN:
            back = (STRENGTH + low * F.col("tables")) / (STRENGTH + F.col("word_n"))
            fresh = fresh.withColumn("backs", F.concat("backs", F.array(back)))
        passed = [near, far, kept]
        kept = work.save_tidy(fresh.mapInArrow(_seat(top, seed + 100 * sweep + 1, _names(_KEPT)), _KEPT))
        work.drop(passed.pop())
        everywhere.unpersist()
        now = kept.agg(F.sum("n").alias("n"), F.sum("t").alias("t")).first()
        customers, tables = (float((x or 0) + per_word.still) for x in (now.n, now.t))
        if sweep >= BURN_IN:
            unknown.append(root(customers, tables, 0, 0))
            alone.append(root(customers, tables, 1, 1))
    if not total:
        unknown = alone = [1.0] * SAMPLES
    now = root(customers, tables, F.col("n"), F.col("t"))
    back = (STRENGTH + low * F.col("out_single")) / (STRENGTH + F.col("word_n"))
    words = kept.select("word", "word_n", "common", F.concat("roots", F.array(now)).alias("roots"), "backs").unionByName(
        names.filter(still).select("word", "word_n", "common", F.array(*map(F.lit, alone)).alias("roots"),
                                   F.array(*[back] * SAMPLES).alias("backs")))
    return Model(pairs, near.drop("t"), far.drop("t"), words, numbers, low, size, total, unknown)


# --- scores -------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Common:
    """The commonest words by number, as words (count, roots) and as contexts (guests, backs).

    `pairs` are the frequent pairs of them, rank of the context * COMMON + rank of the word, with `p`. `listed` are
    the bits of the filter.
    """

    numbers: np.ndarray
    counts: np.ndarray
    roots: np.ndarray
    guests: np.ndarray
    backs: np.ndarray
    pairs: np.ndarray
    p: np.ndarray
    listed: np.ndarray

    def may_list(self, contexts: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """False for pairs that the model's tables of pairs certainly lack."""
        out = np.ones(len(numbers), bool)
        for place in _bits(contexts, numbers):
            out &= (self.listed[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
        return out

    def ranks(self, numbers: np.ndarray) -> np.ndarray:
        """The place of each word here, or -1."""
        return self._ranks(numbers)

    @cached_property
    def _ranks(self) -> Lookup:
        return Lookup(self.numbers)

    @cached_property
    def frequent(self) -> Lookup:
        """The places of pairs among the frequent ones."""
        return Lookup(self.pairs)


def _stack(column: pa.ChunkedArray) -> np.ndarray:
    """Lists of one number per sample as rows."""
    return np.asarray(column.combine_chunks().flatten()).reshape(-1, SAMPLES)


def _bits(contexts: np.ndarray, numbers: np.ndarray) -> list[np.ndarray]:
    """A pair's places in the filter."""
    code, last = _pair_hash(contexts, numbers), np.uint64((1 << FILTER_BITS) - 1)
    return [code & last, code >> np.uint64(32) & last]


def _set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs to words (at, bits) of the filter."""
    for some in _together(batches, 500_000):
        place = np.sort(np.concatenate(_bits(some["context"].to_numpy(), some["word"].to_numpy())))
        at, first = np.unique(place >> np.uint64(6), return_index=True)
        bits = np.bitwise_or.reduceat(np.uint64(1) << (place & np.uint64(63)), first)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(bits.view(np.int64))], names=["at", "bits"])


def _common(work: Workspace, model: Model) -> tuple[Common, DataFrame, DataFrame]:
    """The common words, and the listed pairs of the model by two kinds: near (pair, n, drawn) and far (context, word, c, w, n, drawn).

    Pairs met once are listed if they are asked for; any other one is in a single text, from which the model learned.
    """
    step = COMMON
    top = model.words.filter("common").toArrow().sort_by("word")
    once = model.pairs.filter("n = 1 AND asked").withColumns({
        "drawn": F.lit(SAMPLES).cast("long"), "pair": F.col("c").cast("long") * step + F.col("w")})
    near, far = (table.unionByName(once.filter(kind).select(*table.columns)) for table, kind in (
        (model.near, "c >= 0 AND w >= 0"), (model.far, "c < 0 OR w < 0")))
    set_bits = model.pairs.filter("c >= 0 AND w >= 0").select("context", "word").mapInArrow(
        _set_bits, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    listed = np.zeros(max(1, 1 << FILTER_BITS >> 6), np.uint64)
    listed[set_bits["at"].to_numpy()] = set_bits["bits"].to_numpy().view(np.uint64)
    roots, backs = (_stack(top[c]) for c in ("roots", "backs"))
    counts = top["word_n"].to_numpy().astype(float)
    often = model.near.orderBy(F.desc("n"), "pair").limit(FREQUENT).toArrow().sort_by("pair")
    pairs = often["pair"].to_numpy()
    c, w = pairs // step, pairs % step
    own = (often["n"].to_numpy() - model.discount * often["drawn"].to_numpy() / SAMPLES) / (STRENGTH + counts[c])
    return Common(model.numbers, counts, roots, counts, backs, pairs, own + (backs[c] * roots[w]).mean(axis=1), listed), near, far


# Kinds of a text's other pairs: of common words (key: the pair), with one rare word (key: that word, code: the rank of
# the other, times two, and one more if the rare word is the context) and of rare words (key: the word, code: the context).
_BOTH_COMMON, _ONE_RARE, _BOTH_RARE = range(3)
_TEXTS = "n_tokens long, n_known long, base_score double, score double"
_BLOCKS = "kind int, bucket int, rows binary, key binary, code binary, times binary, out binary"
_SUMS = "bucket int, rows binary, known binary, base binary, more binary"


def _score_common(everywhere: Broadcast, low: float, total: int, size: int, buckets: int, names: tuple[str, ...]):
    """Sums over each text's pairs of common words that are frequent or certainly not listed, and over its common words;
    blocks of its other pairs with their counts."""
    step = COMMON

    def rows_of(columns: dict[str, pa.Array], like: pa.Schema) -> pa.RecordBatch:
        count = len(next(iter(columns.values())))
        kinds = {"doc_id": like.field("doc_id").type, "held_out": pa.bool_(), "base_score": pa.float64(), "score": pa.float64(),
                 "kind": pa.int32(), "bucket": pa.int32(), **dict.fromkeys(("rows", "key", "code", "times", "out"), pa.binary())}
        return pa.RecordBatch.from_arrays([columns[c] if c in columns else pa.nulls(count, kinds.get(c, pa.int64())) for c in names],
                                          names=list(names))

    def blocks(held: list[list], like: pa.Schema) -> Iterator[pa.RecordBatch]:
        for kind, parts in enumerate(held):
            rows, key, code, times, out = (np.concatenate(x) for x in zip(*parts))
            if len(rows):
                to = _bucket(key, buckets) if kind != _BOTH_RARE else np.zeros(len(key), np.int64)
                cut = _cut(to, rows=rows, key=key, code=code, times=times.astype(np.int32), out=out)
                columns = dict(zip(cut.schema.names, cut.columns))
                yield rows_of(columns | {"kind": pa.array(np.full(cut.num_rows, kind, np.int32))}, like)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = everywhere.value
        held, tokens, like = [[], [], []], 0, None
        for batch in batches:
            like = batch.schema
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                numbers, contexts, bounds = tokens_of(some.column("text"))
                count = some.num_rows
                out = some.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
                rows = np.repeat(np.arange(count), np.diff(bounds))
                w = common.ranks(numbers)
                c = np.concatenate([common.ranks(contexts[:1]), w[:-1]])[:len(w)]
                both = (w >= 0) & (c >= 0)
                pair = np.where(both, c * step + w, -1)
                place = common.frequent(pair)
                p = np.append(common.p, 0.0)[place]
                rest = np.flatnonzero(both & (p == 0))
                listed = common.may_list(contexts[rest], numbers[rest])
                alone, rest = rest[~listed], rest[listed]
                p[alone] = (np.where(out[rows[alone]], 0.0, (1 - low) / (STRENGTH + common.guests[c[alone]]))
                            + (common.backs[c[alone]] * common.roots[w[alone]]).mean(axis=1))
                done, known = p > 0, w >= 0
                base = np.log10((common.counts[w[known]] + 1) / (total + size + 1))
                ids = some.column("row").to_numpy()
                kinds = ((_BOTH_COMMON, rest, pair, np.zeros(len(w), np.int8)),
                         (_ONE_RARE, np.flatnonzero((w < 0) & (c >= 0)), numbers, (2 * c).astype(np.int32)),
                         (_ONE_RARE, np.flatnonzero((w >= 0) & (c < 0)), contexts, (2 * w + 1).astype(np.int32)),
                         (_BOTH_RARE, np.flatnonzero((w < 0) & (c < 0)), numbers, contexts))
                for kind, places, key, code in kinds:
                    first, times = _distinct(code[places], key[places], rows[places])
                    places = places[first]
                    held[kind].append((ids[rows[places]], key[places], code[places], times, out[rows[places]]))
                yield rows_of({"row": some.column("row"), "doc_id": some.column("doc_id"), "held_out": some.column("held_out"),
                               "n_tokens": pa.array(np.diff(bounds)),
                               "n_known": pa.array(np.bincount(rows[known], minlength=count)),
                               "base_score": pa.array(np.bincount(rows[known], base, count).astype(float)),
                               "score": pa.array(np.bincount(rows[done], np.log10(p[done]), count).astype(float))}, like)
                tokens += len(numbers)
                if tokens > HELD_TOKENS:
                    yield from blocks(held, like)
                    held, tokens = [[], [], []], 0
        if tokens:
            yield from blocks(held, like)
    return run


def _blocks(buckets: int, key: str):
    """Rows to blocks of all their columns, by the key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _together(batches, 500_000):
            columns = {c: _stack(some[c]) if pa.types.is_list(some[c].type) else some[c].to_numpy() for c in some.column_names}
            yield _cut(_bucket(columns[key], buckets), **columns)
    return run


def _in_blocks(rows: DataFrame, buckets: int, key: str) -> DataFrame:
    schema = ", ".join(["bucket int", *(f"{c} binary" for c in rows.columns)])
    return rows.mapInArrow(_blocks(buckets, key), schema).withColumn("round", F.col("bucket") % ROUNDS)


def _texts_pairs(texts: pa.Table, code: type) -> tuple[np.ndarray, ...]:
    return tuple(_opened(texts, name, kind) for name, kind in (
        ("rows", np.int64), ("key", np.int64), ("code", code), ("times", np.int32), ("out", np.bool_)))


def _seen(keys: np.ndarray, table: pa.Table, table_keys: np.ndarray, out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """n and drawn of pairs by key; a pair that is not listed was met once, if the model learned from the text, or never."""
    order = np.argsort(table_keys)
    place = _places(table_keys[order], keys)
    once = np.where(out, 0, 1)
    n, drawn = (_opened(table, name, np.int64)[order] for name in ("n", "drawn"))
    if not len(n):
        return once, once * SAMPLES
    return np.where(place >= 0, n[place], once), np.where(place >= 0, drawn[place], once * SAMPLES)


def _row_sums(buckets: int, rows: np.ndarray, known: np.ndarray, base: np.ndarray, more: np.ndarray) -> pa.Table:
    """Sums by row, in blocks by the row.

    Their buckets grow as the root of the others, so that the blocks do not get ever smaller.
    """
    buckets = max(16, 4 * math.isqrt(buckets))
    own, at = np.unique(rows, return_inverse=True)
    known, base, more = (np.bincount(at, x, len(own)).astype(float) for x in (known, base, more))
    return pa.Table.from_batches([_cut(_bucket(own, buckets), rows=own, known=known, base=base, more=more)])


def _sum_near(everywhere: Broadcast, low: float, buckets: int):
    """A bucket of pairs of common words, and the listed ones of the model, to sums by row."""
    step = COMMON

    def run(texts: pa.Table, model: pa.Table) -> pa.Table:
        common = everywhere.value
        rows, pair, _, times, out = _texts_pairs(texts, np.int8)
        n, drawn = _seen(pair, model, _opened(model, "pair", np.int64), out)
        c, w = pair // step, pair % step
        p = (n - low * drawn / SAMPLES) / (STRENGTH + common.guests[c]) + (common.backs[c] * common.roots[w]).mean(axis=1)
        none = np.zeros(len(rows))
        return _row_sums(buckets, rows, none, none, times * np.log10(p))
    return run


def _sum_one_rare(everywhere: Broadcast, model: tuple[float, int, int, list[float]], buckets: int):
    """A bucket of pairs with one rare word, and the model's words and listed pairs, to sums by row."""
    low, total, size, unknown = model
    step = 2 * COMMON

    def run(texts: pa.Table, model: pa.Table) -> pa.Table:
        common = everywhere.value
        rows, key, code, times, out = _texts_pairs(texts, np.int32)
        words = _opened(model, "word", np.int64)
        order = np.argsort(words)
        words, place = words[order], _places(words[order], key)
        # one more word, that no place but -1 names, for all unknown ones
        word_n = np.append(_opened(model, "word_n", np.int64)[order], 0)[place]
        own_roots, own_backs = (np.concatenate([_opened(model, name, float, SAMPLES)[order], np.reshape(last, (1, SAMPLES))])[place]
                                for name, last in (("roots", unknown), ("backs", [1.0] * SAMPLES)))
        listed = _places(words, _opened(model, "key", np.int64)) * step + _opened(model, "code", np.int32)
        n, drawn = _seen(np.where(place >= 0, place * step + code, -1), model, listed, out)
        is_word, other = code % 2 == 0, code // 2
        guests = np.where(is_word, common.guests[other], word_n)
        both = np.where(is_word[:, None], common.backs[other] * own_roots, own_backs * common.roots[other])
        p = (n - low * drawn / SAMPLES) / (STRENGTH + guests) + both.mean(axis=1)
        base = np.log10((word_n + 1) / (total + size + 1))
        return _row_sums(buckets, rows, times * (is_word & (place >= 0)), times * base * is_word, times * np.log10(p))
    return run


def _rare_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of pairs of rare words to rows."""
    for batch in batches:
        rows, word, context, times, out = _texts_pairs(batch, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (rows, context, word, times.astype(np.int64), out)],
                                         names=["row", "context", "word", "times", "out"])


def _sum_rare(model: tuple[float, int, int, list[float]], buckets: int):
    """Pairs of rare words with the columns of the model's tables, null for what it has not met, to sums by row."""
    low, total, size, unknown = model

    def filled(column: pa.ChunkedArray, row: list[float]) -> np.ndarray:
        out = np.tile(row, (len(column), 1))
        met = column.is_valid().to_numpy()
        out[met] = _stack(column.drop_null())
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _together(batches, 100_000):
            n, drawn, guests, word_n = (pc.fill_null(some[c], 0).to_numpy() for c in ("n", "drawn", "guests", "word_n"))
            both = filled(some["roots"], unknown) * filled(some["backs"], [1.0] * SAMPLES)
            p = (n - low * drawn / SAMPLES) / (STRENGTH + guests) + both.mean(axis=1)
            times = some["times"].to_numpy()
            yield from _row_sums(buckets, some["row"].to_numpy(), times * (word_n > 0),
                                 times * np.log10((word_n + 1) / (total + size + 1)), times * np.log10(p)).to_batches()
    return run


def _add(blocks: pa.Table) -> pa.Table:
    """The sums of a bucket of rows."""
    rows, at = np.unique(_opened(blocks, "rows", np.int64), return_inverse=True)
    sums = [np.bincount(at, _opened(blocks, c, float), len(rows)).astype(float) for c in ("known", "base", "more")]
    return pa.table({"row": rows, "known": sums[0].astype(np.int64), "base": sums[1], "more": sums[2]})


def score(docs: DataFrame, held_out: int = 2, folds: int = 7, seed: int = 5) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from the documents whose crc32 of the id, modulo `folds`, is not `held_out`,
    and gives log10 probabilities of every whole text: its words and one end token. Each word that
    occurs before another is a Pitman-Yor restaurant; all share the root restaurant as their
    parent, whose base is uniform over the words and one more for all unknown ones. Seatings are
    sampled by Gibbs sweeps and predictive probabilities averaged over the samples; after a word
    not met before the root alone counts. base_score is the add-one unigram score. The perplexity
    of a text is 10 ** (-score / n_tokens).

    Probabilities of the COMMON commonest words, and of the FREQUENT commonest pairs of them that were
    met twice, go to all tasks, with a filter of the pairs that a join can find: those met again, and
    those met once that a document held out has too. Where a document's pair is not found, it was met once if the
    model learned from the document, else never. A document's other pairs are counted and meet the model's in blocks, in ROUNDS,
    by ranks where a word is common; only pairs of two rare words are joined as rows. A null text counts as empty (one end token), a
    null id is learned from; repeated rows are scored each; other columns are ignored; no rows
    give no rows.
    """
    spark = docs.sparkSession
    ship_library(spark)
    work = Workspace(spark)
    out = F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")), F.lit(folds)) == held_out
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                        F.coalesce(out, F.lit(False)).alias("held_out"))
    model = train(work, texts, seed)
    common, near, far = _common(work, model)
    common = spark.sparkContext.broadcast(common)
    buckets, sizes = _buckets(spark), (model.discount, model.total, model.size, model.unknown)
    schema = f"row long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, {_TEXTS}, {_BLOCKS}"
    numbered = texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text")
    parts = work.save_tidy(numbered.mapInArrow(_score_common(common, *sizes[:3], buckets, _names(schema)), schema)
                           .withColumn("round", F.col("bucket") % ROUNDS), "kind", "round")
    words = model.words.filter("NOT common").select("word", "word_n", "roots", "backs")
    word_is_rare = F.col("w") < 0
    one_rare = far.filter("(c < 0) != (w < 0)").select(
        F.when(word_is_rare, F.col("word")).otherwise(F.col("context")).alias("key"),
        F.when(word_is_rare, 2 * F.col("c")).otherwise(2 * F.col("w") + 1).alias("code"), "n", "drawn")

    def of(kind):
        return parts.filter(F.col("kind") == kind).select("round", *_names(_BLOCKS)[1:])

    def met(kind, r, model, run):
        """Blocks of one round with the model's of the same buckets, to sums."""
        def one_round(blocks):
            return blocks.filter(F.col("round") == r).drop("round").groupBy("bucket")
        return one_round(of(kind)).cogroup(one_round(model)).applyInArrow(run, _SUMS)

    near_blocks = work.save(_in_blocks(near, buckets, "pair"), "round")
    rare_blocks = work.save(_in_blocks(words, buckets, "word").unionByName(
        _in_blocks(one_rare, buckets, "key"), allowMissingColumns=True), "round")
    sums = [work.save_tidy(
        met(_BOTH_COMMON, r, near_blocks, _sum_near(common, model.discount, buckets))
        .unionByName(met(_ONE_RARE, r, rare_blocks, _sum_one_rare(common, sizes, buckets)))
        .groupBy("bucket").applyInArrow(_add, "row long, known long, base double, more double")) for r in range(ROUNDS)]
    once = F.when(F.col("out"), 0).otherwise(1).cast("long")
    rare = (of(_BOTH_RARE).mapInArrow(_rare_pairs, "row long, context long, word long, times long, out boolean")
            .join(far.filter("c < 0 AND w < 0").select("context", "word", "n", "drawn"), ["context", "word"], "left")
            .withColumns({"n": F.coalesce("n", once), "drawn": F.coalesce("drawn", once * SAMPLES)})
            .join(words.select("word", "word_n", "roots"), "word", "left")
            .join(words.select(F.col("word").alias("context"), F.col("word_n").alias("guests"), "backs"), "context", "left"))
    sums.append(work.save_tidy(rare.drop("context", "word", "out").mapInArrow(_sum_rare(sizes, buckets), _SUMS)
                               .groupBy("bucket").applyInArrow(_add, "row long, known long, base double, more double")))
    rest = reduce(DataFrame.unionByName, sums).groupBy("row").agg(*[F.sum(c).alias(c) for c in ("known", "base", "more")])
    return (parts.filter("kind IS NULL").join(rest, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more", F.lit(0.0))).alias("score")))
