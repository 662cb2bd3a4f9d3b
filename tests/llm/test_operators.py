"""Dealt operators against brute force, and on odd rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from compare import compare, open_duckdb
from pyspark.sql import functions as F

from headrace.llm import (caps, chat, decontaminate, forest, mixing, pitman_yor, quality, queries, secret_ledger,
                          shards, token_ids)
from headrace.llm.tables import Workspace, read_table

SF_DIR = "/root/testdata/sf0.001"
ODD = [(1, None, "en", "a", 0, "x"), (2, "", None, "a", None, None), (3, "  \n ", "en", None, 3, "x"),
       (4, "one two three", "en", "b", 13, None), (4, "one two three", "en", "b", 13, None),
       (None, "no id at all but some words here", "en", "b", 5, "y"), (5, "word " * 30000, "en", "b", 150000, "z"),
       (6, 'Token = "abcdef12" token: abc AKIA' + "A" * 16 + " " + "0" * 24, "en", "c", 1, None)]
DOCS = "doc_id long, text string, lang string, source string, n_chars long, blob string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return read_table(spark, SF_DIR, "documents")


@pytest.fixture
def path(spark):
    return f"{Workspace(spark).folder}/out"


def tokenizer_path():
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_agrees_with_sql(spark, name):
    con = open_duckdb(SF_DIR)
    assert compare(spark, con, SF_DIR, name, queries.QUERIES[name], queries.ORACLES[name]) == ""


def test_ledger_scans_only_what_it_has_not_seen(spark, odd, path):
    first = {r.doc_id: r for r in secret_ledger.span_digest(secret_ledger.scan_versions(odd, path)).collect()}
    assert (first[6].n_assign, first[6].n_access, first[6].n_hex) == (1, 1, 1)
    assert first[1].base_sha256 == hashlib.sha256(b"").hexdigest()
    ledger = spark.read.parquet(path).count()
    assert secret_ledger.scan_versions(odd, path).count() == len(ODD)
    assert spark.read.parquet(path).count() == ledger
    newer = (*secret_ledger.RULES[1:], secret_ledger.Rule("assign", 2, "(Token)", 0, 0))
    found = {r.doc_id: r.findings for r in secret_ledger.scan_versions(odd, path, newer).collect()}
    assert spark.read.parquet(path).count() == 2 * ledger
    assert [f.kind for f in found[6]].count("hex") == 1


def test_chat_keeps_any_text(spark):
    rows = [(1, 0, "user", "a\\<b[[:]</s>"), (1, 1, "assistant", "[/INST]\n\\"), (2, 0, "to<ol[", ""), (2, 0, None, None),
            (3, 1, "assistant", " x "), (3, None, "user", "é")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1))
    read = {r.conv_id: r for r in chat.parse_conversations(chat.format_conversations(turns)).collect()}
    assert [tuple(t) for t in read[1].turns] == [r[2:] for r in rows[:2]] and read[1].valid
    assert sorted(tuple(t) for t in read[2].turns) == [("", ""), ("to<ol[", "")] and not read[2].valid
    assert read[3].learned == " x " and [t.role for t in read[3].turns] == ["user", "assistant"]


def test_leaks_tolerate_substitutions(spark, odd):
    item = [f"w{i}" for i in range(30)]
    changed = [w if i % 9 else "other" for i, w in enumerate(item)]
    texts = [(10, "start " + " ".join(item) + " end"), (11, " ".join(changed)), (12, " ".join(item[:4])),
             (13, "Tiny, item!"), (14, "tiny thing item")]
    more = spark.createDataFrame([(i, t, "en", "a", 1, "x") for i, t in texts], DOCS)
    bench = spark.createDataFrame([(1, " ".join(item)), (2, "tiny item"), (3, None), (4, "")], "item_id long, text string")
    assert {r.doc_id: r.item_id for r in decontaminate.leaked_documents(odd.union(more), bench).collect()} == \
        {10: 1, 11: 1, 13: 2}
    kept = decontaminate.remove_leaks(odd.union(more), bench)
    assert kept.columns == odd.columns and kept.count() == len(ODD) + 2


def test_vectors_match_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((60, 24))
    vectors = np.concatenate([base, base[:40] + 0.18 * rng.standard_normal((40, 24)), base[:5]])
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(200, None), (201, []), (202, [0.0] * 24), (203, [float("nan")] * 24), (204, [None] * 24), (None, rows[0][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("entry", F.lit(1))
    got = {r.vec_id: r for r in caps.near_vectors(frame).collect()}
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    assert sum(got[i].n_links for i in range(len(vectors))) >= 0.98 * linked.sum() > 0
    assert all(got[i].n_links <= linked[i].sum() for i in range(len(vectors)))
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i in range(200, 205))


def brute_links(rows):
    sets = {}
    for i, text in rows:
        words = (text or "").lower().split()
        if words:
            sets[i] = frozenset(tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4)))
    return {i: sum(j != i and len(a & b) >= 0.8 * len(a | b) for j, b in sets.items()) for i, a in sets.items()}


def test_near_duplicates_match_brute_force(spark, docs, odd):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    links = brute_links(rows)
    got = {r.doc_id: r for r in forest.near_duplicates(docs).collect()}
    assert {i: got[i].n_links for i in links} == links
    result = {r.doc_id: r for r in forest.near_duplicates(odd).collect()}
    assert sorted(result) == [1, 2, 3, 4, 5, 6] and all(r.n_links == 0 and r.kept for r in result.values())
    assert forest.deduplicated(odd).columns == odd.columns


def test_label_model_comes_close_to_the_true_rates():
    rng = np.random.default_rng(1)
    truth = rng.random(20000) < 0.6
    right = np.array([0.95, 0.85, 0.8, 0.7, 0.65, 0.6])
    votes = np.where(rng.random((20000, 6)) < right, np.where(truth, 1, -1)[:, None], np.where(truth, -1, 1)[:, None])
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.estimate(patterns, counts.astype(float), tuple("abcdef"))
    best = np.log(0.6 / 0.4) + votes @ np.log(right / (1 - right)) > 0
    got = ((model.posterior(votes) > 0.5) == truth).mean()
    assert got > (best == truth).mean() - 0.01 and got > ((votes.sum(axis=1) > 0) == truth).mean()
    assert list(model.rates[:, 1, 2]) == sorted(model.rates[:, 1, 2], reverse=True)


def test_classifier_on_held_out_labels(spark):
    table = read_table(spark, "/root/testdata/sf0.01", "documents")
    labels = read_table(spark, "/root/testdata/sf0.01", "labels")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    kept = {r.doc_id for r in quality.accepted_scores(table, labels.filter(half)).collect()}
    rest = labels.filter(~half).collect()
    clean = [r.doc_id in kept for r in rest if r.quality == 1 and r.toxic == 0]
    assert np.mean(clean) > 0.9


def test_training_rows_are_bounded_and_mixed(spark, monkeypatch):
    """Many rows of one id, repeated ones, and more labels than the sample holds: one in six stays unlabelled."""
    seen, fit = [], quality.fit_scorer
    monkeypatch.setattr(quality, "SAMPLE", 300)
    monkeypatch.setattr(quality, "fit_scorer", lambda lists, targets: (seen.append((lists, targets)), fit(lists, targets))[1])
    docs = spark.range(4000).selectExpr(
        "CASE WHEN id < 2000 THEN 7 ELSE id END AS doc_id", "CASE WHEN id < 500 THEN 'one text' ELSE concat('text ', id, ' idiot') END AS text")
    labels = spark.range(2500, 4000).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality", "0 AS toxic")
    assert quality.scored(docs, labels).count() == 4000
    lists, targets = seen[0]
    assert len(lists) == 300
    # all known labels say not toxic: rows without one are less sure of it
    assert (targets[:, 1] > 100 * targets[:, 1].min()).sum() == 50
    quality.scored(docs, labels.limit(10)).count()
    assert len(seen[1][0]) == 60
    quality.scored(docs.limit(0), labels).count()
    assert not seen[2][0]


def test_classifier_takes_odd_rows(spark, odd):
    assert quality.accepted(odd).columns == odd.columns
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 1), (None, 1, 1), (6, None, None)],
                                   "doc_id long, quality int, toxic int")
    assert quality.scored(odd, labels).count() == len(ODD)


def test_language_model_base_scores_and_gain(spark, docs, odd):
    rows = docs.select("doc_id", "text").union(odd.select("doc_id", "text"))
    got = pitman_yor.score(rows.withColumn("row", F.lit(1))).collect()
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in {r.doc_id for r in got} if i is not None}
    texts = [(r.doc_id, (r.text or "").encode().lower().split() + [None]) for r in rows.collect()]
    counts = Counter(w for i, t in texts if not out.get(i, False) for w in t)
    total, size = sum(counts.values()), sum(counts.values()) + len(counts) + 1
    want = sorted(((i is None, i or 0), len(t), sum(w in counts for w in t),
                   round(sum(math.log10((counts[w] + 1) / size) for w in t), 4)) for i, t in texts)
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.n_tokens, r.n_known, round(r.base_score, 4)) for r in got) == want
    assert {r.train_tokens for r in got} == {total} and all(r.held_out == out.get(r.doc_id, False) for r in got)
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_language_model_learns_word_pairs(spark, monkeypatch):
    rng = np.random.default_rng(8)
    follows = {"of": "tea", "is": "jam", "at": "rye"}
    texts = [" ".join(f"{w} {follows[w]}" for w in rng.choice(list(follows), 30)) for _ in range(60)]
    seen = texts + ["of tea", "of jam", "is jam", "is tea"]
    rows = spark.createDataFrame(list(enumerate(seen)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in pitman_yor.score(rows, held_out=-1).collect()}
    assert got[60] > got[61] + 0.5 and got[62] > got[63] + 0.5
    monkeypatch.setattr(pitman_yor, "HOT_PAIRS", 1)
    monkeypatch.setattr(pitman_yor, "COMMON", 3)
    monkeypatch.setattr(pitman_yor, "FREQUENT", 2)
    other = {r.doc_id: r.score for r in pitman_yor.score(rows, held_out=-1).collect()}
    assert other == pytest.approx(got, abs=1e-6)


def test_all_customers_of_a_hot_dish_are_seated_anew(monkeypatch):
    count, discount, n = 4000, 0.6, 900
    dishes = (np.full(count, n), np.full(count, 40.0), np.full(count, 0.1), discount,
              np.random.default_rng(4).random(count))
    exact = pitman_yor.draw_tables(*dishes)
    assert exact.std() > 1  # a sample, not a formula
    monkeypatch.setattr(pitman_yor, "SMALL", 100)
    pitman_yor._log_ways.cache_clear()
    assert (pitman_yor.draw_tables(*dishes) == exact).mean() > 0.999
    pitman_yor._log_ways.cache_clear()
    # a chain in which every customer stands up in each sweep has the same mean
    rng, sizes, seen = np.random.default_rng(5), [60], []
    strength, base = 40.0, 0.1
    for sweep in range(400):
        for _ in range(60):
            at = rng.choice(len(sizes), p=np.array(sizes) / 60)
            sizes[at] -= 1
            sizes = [x for x in sizes if x]
            weights = np.array([x - discount for x in sizes] + [(strength + discount * len(sizes)) * base])
            at = rng.choice(len(weights), p=weights / weights.sum())
            sizes = sizes + [1] if at == len(sizes) else sizes[:at] + [sizes[at] + 1] + sizes[at + 1:]
        if sweep >= 100:
            seen.append(len(sizes))
    drawn = pitman_yor.draw_tables(np.full(count, 60), *dishes[1:])
    assert abs(drawn.mean() - np.mean(seen)) < 0.6


@pytest.mark.parametrize("repeat", [1, 3])
def test_shards_are_even_and_keep_groups(spark, docs, odd, repeat):
    rows = docs.select("doc_id", "text")
    for _ in range(repeat - 1):
        rows = rows.union(docs.select("doc_id", "text"))
    got = shards.shard(rows.union(odd.select("doc_id", "text")), 8).collect()
    sizes = Counter(r.shard for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and sum(sizes.values()) == rows.count() + len(ODD)
    for s in sizes:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
    groups = Counter((r.text_crc32, r.size) for r in got if r.size > 8)
    places = {(r.text_crc32, r.size, r.shard) for r in got if r.size > 8}
    split = Counter(p[:2] for p in places)
    assert sum(split[g] > 1 for g, n in groups.items() if n > 1) <= 0.15 * max(1, sum(n > 1 for n in groups.values()))


def test_elias_fano_selects_what_was_coded():
    rng = np.random.default_rng(2)
    for n, high in ((0, 1), (1, 0), (5, 3), (700, 10**7), (300, 2)):
        values = np.sort(rng.integers(0, high + 1, n))
        code = token_ids.ef_encode(values)
        assert (token_ids.ef_decode(n, *code[:3]) == values).all()
        assert all(token_ids.ef_select(i, *code) == v for i, v in enumerate(values))


def test_ids_are_the_tokenizers(spark, docs, odd, path):
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(tokenizer_path())
    extra = odd.filter("doc_id IS NOT NULL").select((F.col("doc_id") + 10**6).alias("doc_id"), "text")
    odd_text = spark.createDataFrame([(-1, "x.'s é, 5. the., ª ½. don't 'S <|endoftext|>y"),
                                      (-2, "ſtraße Σας Í 가 z\x0bq\x0c\x1c﻿")],
                                     "doc_id long, text string")
    rows = docs.select("doc_id", "text").union(extra).union(odd_text)
    token_ids.write_ids(rows, path, tokenizer_path())
    got = sorted(token_ids.read_documents(token_ids.open_ids(spark, path)).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted(r.doc_id for r in rows.collect())
    want = Counter((r.doc_id, np.array([*whole.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4").tobytes())
                   for r in rows.collect())
    assert Counter((r.doc_id, bytes(r.ids)) for r in got) == want
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1]]
    block = token_ids.open_ids(spark, path).orderBy("part", "block").first().asDict()
    assert token_ids.document_ids(block, 0).tobytes() == bytes(got[0].ids)


def test_ids_of_raw_case_and_marks():
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(tokenizer_path())
    texts = ["<|ENDOFTEXT|> end", "<|endoftext|>", "J\u030c", "T\u0308x A\u030a. \u212b İstanbul I\u0307x", "THE The the. THE, DON'T",
             "x \u030c\n\u0308y X<|StartOfText|>\u030cY ΣΑΣ ΣΑΣ. ǅ ẞ \tQ"]
    want = [np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert token_ids.encode_texts(texts, tokenizer_path()) == want


def test_mixing_rates_and_null_sources(spark, docs, odd):
    rates = mixing.mixing_rates(docs, {"src0": 3.0, "src1": 1.0}, total=500)
    by = Counter(r.source for r in mixing.replicate(docs, rates).collect())
    assert set(by) == {"src0", "src1"} and abs(by["src0"] / sum(by.values()) - 0.75) < 0.08
    assert abs(sum(by.values()) - 500) < 100
    mixed = mixing.mix_sources(odd, copy_column=None, total=200)
    assert mixed.columns == odd.columns and mixed.filter("source IS NULL").count() > 0
    with pytest.raises(ValueError, match="already have"):
        mixing.mix_sources(odd, copy_column="blob")


def test_mixing_at_large_rates(spark, tmp_path):
    rows = spark.range(62000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.lit("en").alias("lang"),
                                     F.when(F.col("id") < 3, F.lit(None)).when(F.col("id") == 3, "rare")
                                     .otherwise("big").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    rates = {r.source: r.rate for r in mixing.mixing_rates(rows).collect()}
    assert rates["rare"] > 200
    mixed = mixing.mix_sources(rows)
    by = Counter(r.doc_id for r in mixed.filter("doc_id <= 3").collect())
    assert all(abs(by[i] - rates["rare" if i == 3 else None]) < 6 * math.sqrt(rates["rare"]) for i in range(4))
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    con = open_duckdb(SF_DIR)
    con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    counts = "SELECT doc_id, count(*) FROM ({}) AS m WHERE doc_id <= 3 GROUP BY doc_id"
    assert dict(con.execute(counts.format(queries.ORACLES["op10_source_mixing"])).fetchall()) == by
    many = spark.createDataFrame([(None, 2.0e4)], "source string, rate double")
    drawn = [r["count"] for r in mixing.replicate(rows.limit(3), many).groupBy("doc_id").count().collect()]
    assert len(drawn) == 3 and all(abs(n - 2.0e4) < 6 * math.sqrt(2.0e4) for n in drawn)


def test_rows_without_or_with_shared_ids_take_part(spark):
    text, leak = "some words of a text that is long enough " * 4, "a passage of the benchmark that nobody may ever train on"
    rows = spark.createDataFrame([(None, text), (9, text), (9, text), (9, "another text altogether and clean"),
                                  (None, leak), (7, leak), (7, "clean words under the id of a leak"), (None, None),
                                  (None, None)], "doc_id long, text string")
    kept = Counter(map(tuple, forest.deduplicated(rows).collect()))
    assert kept == Counter([(9, text), (9, "another text altogether and clean"), (7, leak), (None, None), (None, None),
                            (7, "clean words under the id of a leak")])
    bench = spark.createDataFrame([(1, leak)], "item_id long, text string")
    clean = decontaminate.remove_leaks(rows, bench)
    assert clean.columns == rows.columns
    assert Counter(map(tuple, clean.collect())) == Counter(t for t in map(tuple, rows.collect()) if t[1] != leak)


def test_empty_texts_share_a_shard(spark):
    rows = [(i, None if i % 2 else "") for i in range(6)] + [(i, f"text {i}") for i in range(6, 200)]
    got = shards.shard(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()
    assert len(got) == 200 and len({r.shard for r in got if r.size == 8}) == 1


def test_empty_tables(spark, odd, path):
    none, bench = odd.limit(0), spark.createDataFrame([], "item_id long, text string")
    assert secret_ledger.scan_versions(none, path + "1").count() == 0
    assert decontaminate.leaked_documents(odd, bench).count() == 0
    assert decontaminate.leaked_documents(none, bench).count() == 0
    assert caps.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert quality.accepted(none).count() == 0
    assert forest.near_duplicates(none).count() == 0
    assert pitman_yor.score(none).count() == 0
    assert shards.shard(none).count() == 0
    assert mixing.mix_sources(none).count() == 0
    token_ids.write_ids(none, path, tokenizer_path())
    assert token_ids.read_documents(token_ids.open_ids(spark, path)).count() == 0
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.turn_digest(chat.parse_conversations(chat.format_conversations(turns))).count() == 0


def test_pipeline_decisions_take_effect(spark):
    import corpus_pipeline
    kept = read_table(spark, SF_DIR, "documents")
    columns, work = kept.columns, Workspace(spark)
    for name, stage in corpus_pipeline.STAGES[:3]:
        after = work.save(stage(spark, kept, SF_DIR))
        assert after.columns == columns and 0 < after.count() <= kept.count(), name
        kept = after
    assert kept.groupBy("text").count().filter("count > 1").count() == 0
    bench = [re.sub(r"\s+", " ", r.text) for r in read_table(spark, SF_DIR, "benchmark").collect()]
    assert not any(b in re.sub(r"\s+", " ", r.text) for r in kept.collect() for b in bench)
    mixed = work.save(corpus_pipeline.mix(spark, kept, SF_DIR))
    assert mixed.columns == columns
    assert corpus_pipeline.shard(spark, mixed, SF_DIR).count() == mixed.count()
