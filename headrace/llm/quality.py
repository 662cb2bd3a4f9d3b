"""Quality classifier: weak labels from overlapping labellers, and a hashed linear scorer."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headrace.llm.tables import Workspace, ship_library
from headrace.llm.words import NOT_ALNUM, utf8_buffers, words_of

FEATURE_BITS = 19
PREFIX = 5
# The scorer learns from this many documents at most, those of least hash, one in so many of them without a known label.
SAMPLE = 12000
UNKNOWN = 6
# Features in fewer documents of the sample, or less unlike the average, get no weight.
LEAST_DOCUMENTS = 8
LEAST_Z = 5.0

# Common English insults.
INSULTS = ("idiot", "stupid", "moron", "loser", "scum", "trash", "pathetic", "disgusting", "worthless", "clown")


HEURISTICS = ("symbols", "marks", "digits", "lines", "words", "length")
TOXIC_HEURISTICS = ("any insult", "several insults", "share of insults")


def _bytes(characters: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters.encode())] = True
    return table


_SYMBOLS, _MARKS, _DIGITS = _bytes("#$%&*|~^=<>{}@_\\"), _bytes(".,;:!?"), _bytes("0123456789")
_LINE_END, _CHARACTER = _bytes("\n"), np.arange(256) & 0xC0 != 0x80


def heuristic_votes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Votes of the HEURISTICS on each text, 1 for good, -1 for bad, 0 for no opinion; of TOXIC_HEURISTICS, 1 or 0."""
    data, offsets = utf8_buffers(texts)

    def count(table: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(table[data])])[offsets])

    def fresh(items) -> np.ndarray:
        rows = np.repeat(np.arange(len(texts)), np.diff(items.first))
        order = np.lexsort((items.hashes, rows))
        new = np.ones(len(rows), bool)
        new[1:] = (np.diff(rows[order]) != 0) | (items.hashes[order][1:] != items.hashes[order][:-1])
        return np.bincount(rows[order], new, len(texts)) / np.maximum(1, np.diff(items.first))

    def vote(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
        return np.where(bad, -1, np.where(good, 1, 0))

    words, lines = words_of(texts), words_of(texts, _LINE_END)
    chars, n_words, n_lines = np.maximum(1, count(_CHARACTER)), np.diff(words.first), np.diff(lines.first)
    symbols, digits = count(_SYMBOLS) / chars, count(_DIGITS) / chars
    marks = count(_MARKS) / np.maximum(1, n_words)
    new_words, new_lines = fresh(words), fresh(lines)
    votes = np.stack([
        vote(symbols < 0.01, symbols > 0.05),
        vote((marks > 0.03) & (marks < 0.5), (marks < 0.005) | (marks > 0.9)),
        vote(digits < 0.05, digits > 0.2),
        vote(new_lines > 0.9, (new_lines < 0.5) & (n_lines >= 4)),
        vote((new_words > 0.3) & (n_words > 20), (new_words < 0.15) & (n_words > 20)),
        vote((chars > 100) & (n_words > 15), n_words < 4)], axis=1)
    plain = words_of(texts, NOT_ALNUM)
    hits = np.isin(plain.hashes, words_of(pa.array(INSULTS)).hashes)
    n_plain = np.diff(plain.first)
    insults = np.bincount(np.repeat(np.arange(len(texts)), n_plain), hits, len(texts))
    # a text without insults may be toxic all the same: no opinion
    toxic = np.stack([insults > 0, insults > 1, insults > 0.01 * n_plain], axis=1)
    return votes, toxic.astype(int)


@dataclass(frozen=True)
class WeakLabels:
    """Estimated rates P(vote | class) of each labeller, and the share of the positive class."""

    names: tuple[str, ...]
    rates: np.ndarray  # labeller, class, vote + 1
    prior: float

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(positive | votes) for rows of votes. No opinion says nothing: labellers that overlap may be silent together."""
        logs = np.log(self.rates)
        odds = np.log(self.prior) - np.log(1 - self.prior)
        score = odds + sum(np.where(votes[:, j] != 0, logs[j, 1, votes[:, j] + 1] - logs[j, 0, votes[:, j] + 1], 0)
                           for j in range(len(self.names)))
        return 1 / (1 + np.exp(-np.clip(score, -50, 50)))


def estimate(patterns: np.ndarray, counts: np.ndarray, names: tuple[str, ...], prior: float = 0.5,
             steps: int = 100) -> WeakLabels:
    """Expectation-maximisation over vote patterns and how often each occurs.

    It begins at the summed votes, known labels first. Each labeller's rates have a prior that its votes are right,
    worth 2 % of its votes, which also settles which class is positive; the prior of known labels
    (the labeller "label") is worth 20 times their votes, so that heuristics cannot outvote them.
    """
    total = max(1.0, float(counts.sum()))
    trust = np.array([12.0 if n == "label" else 1.0 for n in names])
    post = 1 / (1 + np.exp(-np.clip(patterns @ trust + np.log(prior / (1 - prior)), -50, 50)))
    held = WeakLabels(names, np.full((len(names), 2, 3), 1 / 3), prior)
    for _ in range(steps):
        share = float(np.clip((counts * post).sum() / total, 1e-3, 1 - 1e-3))
        rates = np.empty((len(names), 2, 3))
        for j in range(len(names)):
            seen = np.array([counts[patterns[:, j] == v].sum() for v in (-1, 0, 1)])
            for c in (0, 1):
                weight = counts * (post if c else 1 - post)
                got = np.array([weight[patterns[:, j] == v].sum() for v in (-1, 0, 1)])
                right = np.array([seen[0] + 1, seen[1] + 1, 0.0] if c == 0 else [0.0, seen[1] + 1, seen[2] + 1])
                got = got + (20.0 if names[j] == "label" else 0.02) * right + 0.5
                rates[j, c] = got / got.sum()
        held = WeakLabels(names, rates, share)
        post = held.posterior(patterns)
    return held


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_id, _text) to (_id, _key, good, bad): the votes of both sets of heuristics, and a hash of id and text."""
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            some = batch.slice(at, 500)
            lists = [pa.array(list(v.astype(np.int32)), pa.list_(pa.int32())) for v in heuristic_votes(some.column("_text"))]
            yield pa.RecordBatch.from_arrays([some.column("_id"), some.column("_key"), *lists], names=["_id", "_key", "good", "bad"])


def _with_labels(votes: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The votes with the known label as the last one of each set, and whether there is one."""
    def vote(name: str) -> Column:
        return F.array(F.when(F.col(name) == 1, 1).when(F.col(name) == 0, -1).otherwise(0))

    if labels is None:
        known = votes.withColumns({"_q": F.lit(None).cast("int"), "_t": F.lit(None).cast("int")})
    else:
        marks = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(
            F.min("quality").alias("_q"), F.max("toxic").alias("_t"))
        known = votes.join(marks, "_id", "left")
    return known.select("_key", F.concat("good", vote("_q")).alias("good"), F.concat("bad", vote("_t")).alias("bad"),
                        F.coalesce("_q", "_t").isNotNull().alias("known"))


def weak_labels(votes: DataFrame, column: str, names: list[str], prior: float) -> WeakLabels:
    """The label model from the counts of vote patterns: at most 3 to the number of labellers rows."""
    rows = votes.groupBy(column).agg(F.count("*").alias("n")).collect()
    patterns = np.array([r[column] for r in rows], int).reshape(-1, len(names))
    return estimate(patterns, np.array([r.n for r in rows], float), tuple(names), prior)


def _features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and hashed feature of every word, word beginning and heuristic vote; repeats included."""
    words = words_of(texts, NOT_ALNUM, prefix=PREFIX)
    shift = np.uint64(64 - FEATURE_BITS)
    rows = np.repeat(np.arange(len(texts)), np.diff(words.first))
    long = words.lengths > PREFIX
    votes, _ = heuristic_votes(texts)
    marks = ((votes + 2 + 4 * np.arange(votes.shape[1])).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> shift
    all_rows = [rows, rows[long], np.repeat(np.arange(len(texts)), votes.shape[1])]
    return (np.concatenate(all_rows),
            np.concatenate([words.hashes >> shift, words.prefixes[long] >> shift, marks.ravel()]).astype(np.int64))


def _distinct(rows: np.ndarray, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.unique(rows << FEATURE_BITS | features)
    return keys >> FEATURE_BITS, keys & ((1 << FEATURE_BITS) - 1)


def _train_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            some = batch.slice(at, 500)
            rows, features = _distinct(*_features(some.column("_text")))
            cuts = np.searchsorted(rows, np.arange(some.num_rows + 1))
            lists = [features[a:b].astype("<i4").tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(lists, pa.binary()), some.column("good"), some.column("bad")],
                                             names=["features", "good", "bad"])


def fit_scorer(lists: list[np.ndarray], targets: np.ndarray, steps: int = 200, rate: float = 0.05,
               decay: float = 1e-5) -> np.ndarray:
    """Weights (feature, output) and a last row of biases: logistic regression on soft labels.

    Labels count by how sure they are. Only features whose documents differ from the average
    by LEAST_Z standard deviations take part; words of chance would otherwise be learned by heart.
    """
    size = 1 << FEATURE_BITS
    weights = np.zeros((size + 1, targets.shape[1]), np.float32)
    if not lists:
        return weights
    documents, positive = np.zeros(size), np.zeros((targets.shape[1], size))
    for x, y in zip(lists, targets):  # a list names each feature once
        documents[x] += 1
        for out in range(len(y)):
            positive[out, x] += y[out]
    for out in range(targets.shape[1]):
        y = targets[:, out]
        mean = float(np.clip(y.mean(), 1e-6, 1 - 1e-6))
        z = (positive[out] - mean * documents) / np.sqrt(mean * (1 - mean) * np.maximum(documents, 1))
        names = np.flatnonzero((documents >= LEAST_DOCUMENTS) & (np.abs(z) >= LEAST_Z))
        place = np.full(size, -1, np.int32)
        place[names] = np.arange(len(names))
        # only the features that take part are laid out for all documents
        taken = [p[p >= 0] for p in (place[x] for x in lists)]
        at, own = np.concatenate(taken).astype(np.int64), np.repeat(np.arange(len(lists)), [len(t) for t in taken])
        sure = (2 * y - 1) ** 2 / len(y)
        w, bias = np.zeros(len(names)), float(np.log(mean / (1 - mean)))
        m, v = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
        for step in range(1, steps + 1):
            score = bias + np.bincount(own, w[at], len(y))
            error = (1 / (1 + np.exp(-np.clip(score, -50, 50))) - y) * sure
            slope = np.append(np.bincount(at, error[own], len(names)) + decay * w, error.sum())
            m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope ** 2
            move = rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-9)
            w, bias = w - move[:-1], bias - move[-1]
        weights[names, out], weights[size, out] = w, bias
    return weights


def _scorer(weights: np.ndarray):
    used = weights[:-1].any(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.empty((batch.num_rows, 2))
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                rows, features = _features(some.column("_text"))
                rows, features = _distinct(rows[used[features]], features[used[features]])
                for out in range(2):
                    sums = np.bincount(rows, weights[features, out], some.num_rows) + weights[-1, out]
                    scores[at:at + 500, out] = 1 / (1 + np.exp(-np.clip(sums, -50, 50)))
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(scores[:, 0]), pa.array(scores[:, 1])],
                                             names=["_row", "_quality", "_toxicity"])
    return run


def scored(docs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Rows (_row, _quality, _toxicity): every document's columns and its two probabilities.

    Two label models are fitted by expectation-maximisation on the vote patterns of all
    documents, one over quality labellers and one over toxicity labellers; known labels are a
    labeller among the others and abstain elsewhere. Their posteriors label at most SAMPLE different
    rows, those of least hash, one in UNKNOWN of them without a known label at any size, and the
    hashed linear scorer trained on these scores every document. Weights are 2 ** FEATURE_BITS rows, whatever the data.

    Null and empty texts are scored by their votes alone; each of several rows is scored;
    clashing column names are kept apart; no rows give no rows.
    """
    spark = docs.sparkSession
    ship_library(spark)
    work = Workspace(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    texts = texts.withColumn("_key", F.xxhash64("_id", "_text", F.lit(23)))
    votes = work.save(_with_labels(texts.mapInArrow(_vote, "_id long, _key long, good array<int>, bad array<int>"), labels))
    models = [weak_labels(votes, "good", [*HEURISTICS, "label"], 0.8), weak_labels(votes, "bad", [*TOXIC_HEURISTICS, "label"], 0.1)]
    # repeats of a row are one document to learn from
    unknown = SAMPLE // UNKNOWN
    parts = [votes.filter(c).groupBy("_key").agg(F.first("good").alias("good"), F.first("bad").alias("bad"))
             .orderBy("_key").limit(n) for c, n in (("known", SAMPLE - unknown), ("NOT known", unknown))]
    chosen = work.save(parts[0].unionByName(parts[1]).dropDuplicates(["_key"]))
    sample = (texts.select("_key", "_text").join(F.broadcast(chosen), "_key").dropDuplicates(["_key"]).select("_text", "good", "bad")
              .mapInArrow(_train_features, "features binary, good array<int>, bad array<int>").collect())
    lists = [np.frombuffer(r.features, "<i4") for r in sample]
    targets = np.stack([m.posterior(np.array([r[c] for r in sample], int).reshape(len(sample), len(m.names)))
                        for m, c in zip(models, ("good", "bad"))], axis=1)
    weights = fit_scorer(lists, targets)
    plain = docs.select(F.struct("*").alias("_row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    return plain.mapInArrow(
        _scorer(weights), T.StructType([plain.schema["_row"], T.StructField("_quality", T.DoubleType()),
                                               T.StructField("_toxicity", T.DoubleType())]))


def accepted(docs: DataFrame, labels: DataFrame | None = None, least_quality: float = 0.5,
             most_toxicity: float = 0.3) -> DataFrame:
    """The documents, all columns, that score as good and not toxic."""
    return _accepted(docs, labels, least_quality, most_toxicity).select("_row.*")


def _accepted(docs, labels, least_quality, most_toxicity) -> DataFrame:
    return scored(docs, labels).filter((F.col("_quality") >= least_quality) & (F.col("_toxicity") < most_toxicity))


def accepted_scores(docs: DataFrame, labels: DataFrame | None = None, least_quality: float = 0.5,
                    most_toxicity: float = 0.3) -> DataFrame:
    """The accepted documents' ids with both probabilities."""
    return _accepted(docs.select("doc_id", "text"), labels, least_quality, most_toxicity).select(
        "_row.doc_id", F.col("_quality").alias("quality"), F.col("_toxicity").alias("toxicity"))
