"""Dealt operators against plain models of them, on texts and vectors that strain them."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from headrace.llm import caps, decontaminate, mixing, pitman_yor, secret_ledger, shards
from headrace.llm.tables import Workspace, read_table

SF_DIR = "/root/testdata/sf0.001"


def brute_leaks(docs, items, flank=5, share=0.8):
    """The best alignment of every leaking document, from all pairs of positions."""
    best, leaking = {}, defaultdict(set)
    shortest = min(map(len, decontaminate.MASKS))
    for i, d in docs:
        for k, item in items:
            masks = decontaminate.MASKS if len(item) >= shortest else ("1" * len(item),)
            for m in masks:
                for at in range(len(d) - len(m) + 1):
                    for own in range(len(item) - len(m) + 1):
                        if any(b == "1" and d[at + j] != item[own + j] for j, b in enumerate(m)):
                            continue
                        low, high, shift = max(0, own - flank), min(len(item), own + len(m) + flank), at - own
                        same = sum(0 <= x + shift < len(d) and d[x + shift] == item[x] for x in range(low, high))
                        if same >= share * (high - low):
                            leaking[i].add(k)
                            key = (-same / (high - low), -(high - low), k, shift, same)
                            best[i] = min(best.get(i, key), key)
    return {i: (len(leaking[i]), k, shift, same, -length) for i, (_, length, k, shift, same) in best.items()}


@pytest.mark.parametrize("kind", ["long", "string"])
def test_leaks_match_brute_force(spark, kind):
    rng = np.random.default_rng(11)
    items = [list(rng.choice(["a", "b", "c"], n)) for n in (3, 6, 7, 9, 14, 25, 40)] + [["a"] * 20, ["b"] * 4]
    docs = [list(rng.choice(["a", "b", "c", "d"], n, p=[0.4, 0.3, 0.2, 0.1])) for n in rng.integers(1, 60, 60)]
    for i in range(0, 60, 3):
        item = items[i % 7].copy()
        item[int(rng.integers(len(item)))] = "x"
        docs[i][5:5] = item
    docs += [["a"] * 150, ["a", "b"] * 70, ["c"] * 8]
    named = [(str(i) if kind == "string" else i, w) for i, w in enumerate(docs)]
    tests = [(f"item {k}" if kind == "string" else k, w) for k, w in enumerate(items)]
    rows = spark.createDataFrame([(i, " ".join(w)) for i, w in named], f"doc_id {kind}, text string")
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in tests], f"item_id {kind}, text string")
    got = {r.doc_id: tuple(r)[1:] for r in decontaminate.leaked_documents(rows, bench).collect()}
    got = {i: (n, k, shift, same, length) for i, (n, k, shift, same, length) in got.items()}
    assert got == brute_leaks(named, tests)
    clean = {r.doc_id for r in decontaminate.remove_leaks(rows, bench).collect()}
    assert clean == {i for i, _ in named} - set(got)


def test_repeated_words_do_not_multiply(spark):
    text = spark.createDataFrame([(1, "word " * 30000)], "doc_id long, text string")
    spans = F.array(*[F.lit(len(m)) for m in decontaminate.MASKS])
    seeded = decontaminate._seeded(text, decontaminate.tokens(F.col("text")), ["doc_id"], list(decontaminate.MASKS), True)
    assert decontaminate._distinct_places(seeded, "doc_id", 5, spans, F.min("at")).count() < 60
    bench = spark.createDataFrame([(7, "word " * 200)], "item_id long, text string")
    row = decontaminate.leaked_documents(text, bench).first()
    assert (row.item_id, row.matched) == (7, row.compared)


def test_vectors_of_any_length_and_size(spark):
    rng = np.random.default_rng(6)
    long = rng.standard_normal(24).tolist()
    rows = [(i, rng.standard_normal(24).tolist()) for i in range(20)]
    rows += [(30, long), (31, [x * 1e300 / 4 for x in long]), (32, [x * 1e-300 for x in long])]
    rows += [(40, [1.0, 2.0]), (41, [1.0, 2.0]), (42, [2.0, 4.001]), (43, [-1.0, -2.0]), (44, [1.0, 2.0, 0.0])]
    rows += [(50, [1e200]), (51, [3.0]), (52, [-3.0]), (53, [float("inf")]), (54, [0.0])]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept)
           for r in caps.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert [got[i] for i in (30, 31, 32)] == [(2, 30, True), (2, 30, False), (2, 30, False)]
    assert [got[i] for i in (40, 41, 42)] == [(2, 40, True), (2, 40, False), (2, 40, False)]
    assert got[50] == (1, 50, True) and got[51] == (1, 50, False)
    assert all(got[i] == (0, i, True) for i in (*range(20), 43, 44, 52, 53, 54))


def test_rows_without_id_draw_each_their_own(spark):
    rows = spark.range(2000).select(F.when(F.col("id") < 100, F.col("id")).alias("doc_id"), F.lit("same text").alias("text"),
                                    F.lit("s").alias("source"))
    drawn = mixing.mix_sources(rows, total=8000)
    assert abs(drawn.count() - 8000) < 6 * math.sqrt(8000)
    one = rows.select(F.lit(1).alias("doc_id"), "text", "source")
    spread = mixing.replicate(one, mixing.mixing_rates(one, total=8000)).select(F.spark_partition_id().alias("p"))
    sizes = [r["count"] for r in spread.groupBy("p").count().collect()]
    assert sum(sizes) % 2000 == 0 and (len(sizes) == 1 or max(sizes) < 0.5 * sum(sizes))


def test_ledger_joins_unseen_pairs_of_several_commits(spark):
    docs, folder = read_table(spark, SF_DIR, "documents").select("doc_id", "text"), f"{Workspace(spark).folder}/ledger"
    plain = secret_ledger.scan_versions(docs, folder + "_one").collect()
    half = F.col("doc_id") % 2 == 0
    secret_ledger.scan_unseen(docs.filter(half), folder)
    seen = spark.read.parquet(folder).count()
    secret_ledger.scan_unseen(docs, folder)
    ledger = spark.read.parquet(folder)
    assert seen < ledger.count() == ledger.select("blob").distinct().count() == docs.select("text").distinct().count()
    files = set(ledger.inputFiles())
    got = secret_ledger.scan_versions(docs, folder).collect()
    assert set(spark.read.parquet(folder).inputFiles()) == files

    def told(rows):
        return sorted((r.doc_id, r.blob, sorted(map(tuple, r.findings))) for r in rows)
    assert told(got) == told(plain)


def reference_model(train, seed=5):
    """The model by plain loops over dictionaries: p(context, word) and the sizes."""
    strength, sweeps = pitman_yor.STRENGTH, pitman_yor.BURN_IN + pitman_yor.SAMPLES
    numbers, contexts, _ = pitman_yor.tokens_of(pa.array(train))
    n = Counter(zip(contexts.tolist(), numbers.tolist()))
    pairs, guests = sorted(n), Counter(contexts.tolist())
    held, served = Counter(c for c, _ in pairs), Counter(w for _, w in pairs)

    def discount(counts):
        met = Counter(counts)
        return min(0.9, max(0.1, met[1] / max(1, met[1] + 2 * met[2])))
    low, top, base = discount(n.values()), discount(served.values()), 1 / (len(served) + 1)
    words = sorted(served)
    t, own = dict.fromkeys(pairs, 1), dict.fromkeys(words, 1)
    drawn, roots, backs, unknown = Counter(), defaultdict(list), defaultdict(list), []

    def from_root(w):
        return (max(0, served[w] - top * own[w]) + (strength + top * sum(own.values())) * base) \
            / (strength + sum(served.values()))

    def seat(keys, counts, strengths, bases, by, number):
        u = (pitman_yor._pair_hash(*np.array(keys, np.int64).T, number) >> np.uint64(11)).astype(float) / 2.0**53
        return dict(zip(keys, pitman_yor.draw_tables(np.array(counts), np.array(strengths), np.array(bases), by, u).tolist()))
    for sweep in range(sweeps):
        t = seat(pairs, [n[p] for p in pairs], [strength + low * (held[p[0]] - t[p]) for p in pairs],
                 [from_root(w) for _, w in pairs], low, seed + 100 * sweep)
        held, served = Counter(), Counter()
        for (c, w), k in t.items():
            held[c] += k
            served[w] += k
        tables = sum(own.values())
        seated = seat([(0, w) for w in words], [served[w] for w in words], [strength + top * (tables - own[w]) for w in words],
                      [base] * len(words), top, seed + 100 * sweep + 1)
        own = {w: k for (_, w), k in seated.items()}
        if sweep >= pitman_yor.BURN_IN:
            drawn.update(t)
            for w in words:
                roots[w].append(from_root(w))
            for c in held:
                backs[c].append((strength + low * held[c]) / (strength + guests[c]))
            unknown.append((strength + top * sum(own.values())) * base / (strength + sum(served.values())))

    def probability(c, w):
        seen = (n[c, w] - low * drawn[c, w] / pitman_yor.SAMPLES) / (strength + guests[c]) if (c, w) in n else 0
        return seen + np.mean([b * r for b, r in zip(backs.get(c, [1.0] * pitman_yor.SAMPLES), roots.get(w, unknown))])
    return probability


@pytest.mark.parametrize("frequent, common, hot", [(1 << 18, 1 << 17, 1 << 16), (5, 20, 3)])
def test_language_model_matches_plain_loops(spark, monkeypatch, frequent, common, hot):
    for name, value in (("FREQUENT", frequent), ("COMMON", common), ("HOT_PAIRS", hot)):
        monkeypatch.setattr(pitman_yor, name, value)
    rng = np.random.default_rng(21)
    words = np.array([f"w{i}" for i in range(60)])
    texts = [" ".join(words[(rng.pareto(1.0, n) * 3).astype(int) % 60]) for n in rng.integers(1, 40, 150)]
    texts[7], texts[8] = None, "Nobody wrote THESE words before"
    got = {r.doc_id: r for r in pitman_yor.score(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    train = [t for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 7 != 2]
    p = reference_model(train)
    for i, text in enumerate(texts):
        numbers, contexts, _ = pitman_yor.tokens_of(pa.array([text], pa.string()))
        want = sum(math.log10(p(c, w)) for c, w in zip(contexts.tolist(), numbers.tolist()))
        assert got[i].score == pytest.approx(want, abs=1e-9)
    # probabilities after any context, known or not, add up to one over the vocabulary and the unknown words
    vocabulary = sorted(set(pitman_yor.tokens_of(pa.array(train))[0].tolist()))
    for c in (*vocabulary[:5], 12345):
        assert sum(p(c, w) for w in vocabulary) + p(c, 1) == pytest.approx(1, abs=1e-9)


def test_shards_of_every_row_with_sizes(spark):
    rows = read_table(spark, SF_DIR, "documents").select("doc_id", "text")
    got = {r.doc_id: r for r in shards.shard(rows).collect()}
    texts = {r.doc_id: (r.text or "").encode() for r in rows.collect()}
    assert {i: (r.size, r.text_crc32) for i, r in got.items()} == \
        {i: (len(t) + 8, zlib.crc32(t)) for i, t in texts.items()}
    assert {r.law for r in got.values()} == {"rows"} and {r.shard for r in got.values()} == set(range(24))


def test_counting_holds_few_tokens_and_counts_no_text_held_out(monkeypatch):
    monkeypatch.setattr(pitman_yor, "HELD_TOKENS", 1000)
    out = [i % 7 == 2 for i in range(3000)]
    batch = pa.RecordBatch.from_arrays([pa.array([f"w{i} v{i}" for i in range(3000)]), pa.array(out)], names=["text", "held_out"])
    got = list(pitman_yor._count(iter([batch])))
    assert max(b.num_rows for b in got) <= 1000 + 600
    rows = pa.Table.from_batches(got).to_pylist()
    assert sum(r["n"] for r in rows) == 3 * (3000 - sum(out))
    assert {r["n"] for r in rows if r["asked"]} == {0} and sum(r["asked"] for r in rows) == 3 * sum(out)


def _plain_counts(contexts, numbers, out):
    counts, asked = Counter(), set()
    for c, w, o in zip(contexts.tolist(), numbers.tolist(), out.tolist()):
        if o:
            asked.add((c, w))
        else:
            counts[c, w] += 1
    return counts, asked


@pytest.mark.parametrize("collide", [False, True])
def test_counted_pairs_meet_in_blocks(monkeypatch, collide):
    rng = np.random.default_rng(17)
    texts = [" ".join(f"w{i}" for i in (rng.pareto(1.0, 20) * 3).astype(int) % 200) for _ in range(600)]
    out = np.arange(600) % 7 == 2
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(out)], names=["text", "held_out"])
    numbers, contexts, bounds = pitman_yor.tokens_of(batch.column("text"))
    counts, asked = _plain_counts(contexts, numbers, np.repeat(out, np.diff(bounds)))
    monkeypatch.setattr(pitman_yor, "HELD_TOKENS", 1000)
    if collide:  # few hashes, many pairs to each
        plain = pitman_yor._pair_hash
        monkeypatch.setattr(pitman_yor, "_pair_hash", lambda c, w, seed=0: plain(c, w, seed) % np.uint64(50))
    blocks = pa.Table.from_batches(pitman_yor._count_blocks(8)(iter([batch])))
    assert blocks.num_rows <= 8 * (600 * 21 // 1000 + 1)
    merged = [pitman_yor._merge(blocks.filter(pc.equal(blocks["bucket"], b))) for b in set(blocks["bucket"].to_pylist())]
    rows = pa.concat_tables(merged).to_pylist()
    pairs = {(r["context"], r["word"]): r["n"] for r in rows if r["context"] is not None}
    assert len(pairs) == sum(r["context"] is not None for r in rows)
    assert pairs == {p: n for p, n in counts.items() if n > 1 or p in asked}
    sums = Counter()
    for r in rows:
        if r["context"] is None:
            sums.update({(r["word"], k): r[k] for k in ("n", "single", "live", "out_single", "out_live")})
    want = Counter()
    for (c, w), n in counts.items():
        want.update({(w, "n"): n, (w, "live" if n > 1 else "single"): 1, (c, "out_live" if n > 1 else "out_single"): 1})
    assert +sums == want


@pytest.mark.parametrize("size", [0, 1, 5000])
def test_places_by_hash(size):
    keys = np.random.default_rng(6).choice(1 << 40, size, replace=False)
    asked = np.concatenate([keys[::3], np.arange(-1, 2000)])
    where = {k: i for i, k in enumerate(keys.tolist())}
    assert pitman_yor.Lookup(keys)(asked).tolist() == [where.get(k, -1) for k in asked.tolist()]


@pytest.mark.parametrize("size", [6, 26])
def test_the_filter_of_listed_pairs_misses_none(monkeypatch, size):
    monkeypatch.setattr(pitman_yor, "FILTER_BITS", size)
    context, word = np.random.default_rng(4).integers(0, 2**63, (2, 5000))
    batch = pa.RecordBatch.from_arrays([pa.array(context[:1000]), pa.array(word[:1000])], names=["context", "word"])
    listed = np.zeros(1 << size >> 6, np.uint64)
    for some in pitman_yor._set_bits(iter([batch])):
        listed[some["at"].to_numpy()] |= some["bits"].to_numpy().view(np.uint64)
    common = pitman_yor.Common(*[np.empty(0)] * 7, listed)
    may = common.may_list(context, word)
    assert may[:1000].all() and (size < 26 or may[1000:].mean() < 0.01)
