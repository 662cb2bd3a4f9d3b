"""Fingerprints, manifests and repaired conversations against brute force, and on odd rows."""

import hashlib
import heapq
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from headrace.llm import merkle, piecewise, queries, repair
from headrace.llm.tables import read_table

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, _row string, tree string, part long"
ODD = [(1, None, "en", "a", 0), (2, "", None, "a", None), (3, "  \n ", "en", None, 3), (4, "one two three", "en", "b", 13),
       (4, "one two three", "en", "b", 13), (4, "One Two", "en", "b", 13), (None, "no id at all", "en", "b", 5),
       (None, None, None, None, None), (5, "word " * 300000, "en", "b", 150000), (6, "café ÉA " * 40, "en", "", 1)]


def frame(spark, rows=ODD):
    return spark.createDataFrame([(*r, "x", "y", 7) for r in rows], DOCS)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- fingerprints


def slow_fingerprint(text):
    window, hashes = [0] * 7, []
    for byte in text.encode():
        window = [byte, *window[:6]]
        x = sum((8 - i) * b for i, b in enumerate(window))
        y = 0
        for i, b in enumerate(window):
            y ^= b << 5 * i & 0xFFFFFFFF
        x = (x + y) * 0x9E3779B1 & 0xFFFFFFFF
        x = (x ^ x >> 15) * 0x85EBCA6B & 0xFFFFFFFF
        hashes.append(x ^ x >> 13)
    level = 2
    while sum(h % (1 << level) == 0 for h in hashes) > 63:
        level += 1

    def signature(level):
        sums = [0]
        for h in hashes:
            sums[-1] += h
            if h % (1 << level) == 0:
                sums.append(0)
        return "".join(piecewise.ALPHABET[int(piecewise.mix(np.array([s], np.uint64))[0]) >> 58] for s in sums if s)
    return f"{1 << level}:{signature(level)}:{signature(level + 1)}"


def slow_likeness(a, b):
    common = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    run, longest = [[0] * (len(b) + 1) for _ in range(len(a) + 1)], 0
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            common[i + 1][j + 1] = common[i][j] + 1 if x == y else max(common[i][j + 1], common[i + 1][j])
            run[i + 1][j + 1] = run[i][j] + 1 if x == y else 0
            longest = max(longest, run[i + 1][j + 1])
    shorter = min(len(a), len(b))
    return 2 * common[-1][-1] / (len(a) + len(b)) if shorter and longest >= min(7, -(-shorter // 3)) else 0.0


def test_fingerprints_are_those_of_the_slow_way(spark):
    texts = [r.text for r in read_table(spark, SF_DIR, "documents").limit(25).collect()]
    texts += ["", "a", "abc", "x" * 3000, "line of text\n" * 400, "é" * 70, "ab" * 5000]
    for text in texts:
        assert piecewise.fingerprint(text) == slow_fingerprint(text)
    long = "".join(texts) * 60  # several pieces of the working size
    assert len(long) > 2 << 20 and piecewise.fingerprint(long) == slow_fingerprint(long)


def test_likeness_is_that_of_the_slow_way():
    rng = random.Random(3)
    left = ["".join(rng.choices("ABCD", k=rng.randrange(65))) for _ in range(200)]
    right = [x[rng.randrange(9):] + "".join(rng.choices("ABCD", k=rng.randrange(5))) for x in left]
    right = [x[:64] for x in right]
    assert piecewise.signature_likeness(left, right).tolist() == [slow_likeness(a, b) for a, b in zip(left, right)]


def test_fingerprints_compare_compatible_block_sizes_only():
    run = "ABCDEFGHIJ"
    near = piecewise.likeness([f"8:{run}:x", f"8:{run}:xy", f"8:y:{run}", f"8:{run}:y", "8:a:b", "4::"],
                              [f"8:{run}K:z", f"4:z:{run}K", f"16:{run}K:z", f"32:{run}:z", "8:a:b", "4:A:"])
    assert near.tolist() == [20 / 21, 20 / 21, 20 / 21, 0.0, 1.0, 0.0]


@pytest.mark.parametrize("partitions", [1, 5])
def test_neighbours_across_partitions(spark, partitions):
    docs = read_table(spark, SF_DIR, "documents").repartition(partitions)
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, str(partitions == 1).lower())
    got = {r.doc_id: r for r in piecewise.neighbour_fingerprints(docs).collect()}
    spark.conf.unset(coalesce)
    texts = [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()]
    assert len(got) == len(texts)
    for at, (doc_id, text) in enumerate(texts):
        following, row = texts[(at + 1) % len(texts)], got[doc_id]
        changed = text[:len(text) - len(text) // 4] + following[1][:len(text) // 4]
        assert (row.n_chars, row.edited_sha256) == (len(text), sha(changed))
        assert row.edited_fingerprint == piecewise.fingerprint(changed)
        assert row.near_edited == piecewise.likeness([row.fingerprint], [row.edited_fingerprint])[0]
        assert row.near_next == piecewise.likeness([row.fingerprint], [got[following[0]].fingerprint])[0]
    assert np.mean([r.near_edited > 0.5 for r in got.values()]) > 0.95
    assert np.mean([r.near_next < 0.5 for r in got.values()]) > 0.95


def test_fingerprints_of_odd_rows(spark):
    got = piecewise.neighbour_fingerprints(frame(spark)).collect()
    assert len(got) == len(ODD)
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].fingerprint == by_id[2].fingerprint == "4::" and by_id[1].near_next == by_id[1].near_edited == 1.0
    assert by_id[5].n_chars == 1500000 and by_id[3].edited_sha256 == sha("  \n" + "o")  # the tie goes by hash, all begin alike
    assert sum(r.doc_id == 4 for r in got) == 3 and sum(r.doc_id is None for r in got) == 2
    assert all(0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1 for r in got)
    (alone,) = piecewise.neighbour_fingerprints(frame(spark, ODD[3:4])).collect()
    assert alone.near_next == 1.0 and alone.edited_sha256 == sha("one two th" + "one")
    assert piecewise.neighbour_fingerprints(frame(spark, [])).count() == 0


def test_equal_rows_are_split_over_partitions(spark):
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    got = piecewise.neighbour_fingerprints(frame(spark, [(1, "same text here", "en", "a", 1)] * 400)).collect()
    spark.conf.unset(coalesce)
    assert len(got) == 400 and {r.near_next for r in got} == {1.0}


# --- manifest


def slow_manifest(rows, harm):
    """Leaves, roots and proofs by lists, level by level."""
    def leaf(doc_id, text, lang, source, n_chars):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))

    def climb(nodes, at):
        """Root over nodes, and the siblings of one of them."""
        ways = []
        while len(nodes) > 1:
            run = at // 16 * 16
            ways.append(("".join(nodes[run:at]), "".join(nodes[at + 1:run + 16])))
            nodes, at = [sha("".join(nodes[i:i + 16])) for i in range(0, len(nodes), 16)], at // 16
        return nodes[0], ways

    by_source = defaultdict(list)
    for r in rows:
        by_source[r[3]].append((r[0] is not None, r[0] or 0, leaf(*r), r))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    leaves = {s: [x[2] for x in sorted(by_source[s], key=lambda x: x[:3])] for s in order}
    subroots = [climb(leaves[s], 0)[0] for s in order]
    result = []
    for which, s in enumerate(order):
        for at, (_, _, own, r) in enumerate(sorted(by_source[s], key=lambda x: x[:3])):
            subroot, ways = climb(leaves[s], at)
            root, more = climb(subroots, which)
            node = leaf(r[0], harm(r[1]), *r[2:]) if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 else own
            for left, right in ways + more:
                node = sha(left + node + right)
            result.append((r[0], own, subroot, root, sha("".join(a + b for a, b in ways + more)), node, node == root))
    return result


def lower(text):
    return text and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def key(row):
    return tuple(str(v) for v in row)


@pytest.mark.parametrize("rows", [ODD, ODD[:1], ODD[3:4], ODD[2:5]])
def test_manifest_of_odd_rows(spark, rows):
    got = sorted(map(tuple, merkle.manifest(frame(spark, rows)).collect()), key=key)
    assert got == sorted(slow_manifest(rows, lower), key=key)


def test_manifest_over_several_blocks(spark):
    """Small blocks: the levels above them are worked through in several steps, of a source and of the sources."""
    rows = [(i, f"Text {i}", "en", "hot" if i % 3 else f"s{i}", i) for i in range(1500)]
    got = sorted(map(tuple, merkle.manifest(frame(spark, rows), levels=1).collect()), key=key)
    assert got == sorted(slow_manifest(rows, lower), key=key)


def test_manifest_of_no_rows(spark):
    assert merkle.manifest(frame(spark, [])).count() == 0


def test_versions_share_what_they_do_not_copy():
    tree = merkle.BlockTree([sha(str(i)) for i in range(600)], 3)
    before = len(tree.children)
    version = tree.changed(sha("other"), 300)
    assert len(tree.children) == before + 4  # the leaf and three ancestors
    old, new = tree.children[tree.root], tree.children[version]
    assert sum(a != b for a, b in zip(old, new)) == 1 and version != tree.root
    again = merkle.BlockTree([sha("other" if i == 300 else str(i)) for i in range(600)], 3)
    assert tree.digests[version] == again.digests[again.root]


# --- conversations

WHITE = " \t\n\x0b\x0c\r"
NEXT = {0: 2, 1: 2, 2: 3, 3: 2}
AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def faults_of(rows):
    faults, seen = [], set()
    for _, role, text in rows:
        kept = text.rstrip(WHITE)
        faults.append(1 if not kept else 2 if (role, text) in seen else 0 if kept[-1] in ".!?" else 3)
        seen.add((role, text))
    return faults


def slow_repair(rows):
    """The cheapest way through all configurations, the least audit first among equals."""
    faults, waiting, done = faults_of(rows), [(0, "", 0, 0, ())], set()
    while True:
        cost, audit, at, state, out = heapq.heappop(waiting)
        if (at, state) in done:
            continue
        done.add((at, state))
        if at == len(rows) and state in (0, 3):
            break
        made = "user" if NEXT[state] == 2 else "assistant"
        heapq.heappush(waiting, (cost + 3, audit + "I", at, NEXT[state], (*out, f"{made}:")))
        if at < len(rows):
            _, role, text = rows[at]
            heapq.heappush(waiting, (cost + 4, audit + "D", at + 1, state, out))
            if faults[at] not in (1, 2):
                more = 3 if faults[at] == 3 else 0
                if (state, role[:1]) in AFTER:
                    heapq.heappush(waiting, (cost + more, audit + "K", at + 1, AFTER[state, role[:1]], (*out, f"{role}:{text}")))
                heapq.heappush(waiting, (cost + 3 + more, audit + "R", at + 1, NEXT[state], (*out, f"{made}:{text}")))
    turns = [t for t, _, _ in rows if t is not None]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, faults.count(1), faults.count(2), faults.count(3), illegal, cost, audit, sha("\n".join(out)))


def slow_damage(rows):
    by_id = defaultdict(list)
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        harm, kept = zlib.crc32(name.encode()) % 20, by_id[conv_id]
        text = "" if harm == 1 else "".join(c for c in text if c not in ".!?") if harm == 2 else text
        kept += [(turn, "user" if harm == 4 else role, text)] * {0: 0, 3: 2}.get(harm, 1)
    return {k: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, sha(f"{len(r[1])}:{r[1]}{r[2]}"))) for k, v in by_id.items()}


def any_rows(rng, n):
    return [(i, rng.choice(["system", "user", "assistant", "tool", "user", "assistant"]),
             rng.choice(["", "a.", "b!", "c? ", "d.", "e", "f\n", " "])) for i in range(n)]


def test_audits_are_the_least_of_the_cheapest():
    rng = random.Random(5)
    for _ in range(1500):
        rows = any_rows(rng, rng.randrange(14))
        kinds = [max(-1, "sua".find(r[0])) % 4 * 4 + f for (_, r, _), f in zip(rows, faults_of(rows))]
        assert repair.audit_of(kinds) == slow_repair(rows)[6]


def check_repair(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(
        {"_key": F.lit(1), "_at": F.lit("x"), "kind": F.lit(0)})
    got = {r[0]: tuple(r)[1:] for r in repair.repaired(frame).collect()}
    assert got == {k: slow_repair(v) for k, v in slow_damage(rows).items()}


def test_repair_on_the_test_table(spark):
    got = {r[0]: tuple(r)[1:] for r in queries.op13_conversation_repair(spark, SF_DIR).collect()}
    rows = [tuple(r) for r in read_table(spark, SF_DIR, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert got == {k: slow_repair(v) for k, v in slow_damage(rows).items()}


@pytest.mark.parametrize("bits", [10, 2])
def test_repair_of_odd_and_long_conversations(spark, monkeypatch, bits):
    """One conversation holds most rows; with small blocks its tree has several levels."""
    monkeypatch.setattr(repair, "BLOCK_BITS", bits)
    rng = random.Random(bits)
    rows = [(7, t, r, f"{x}{t % 9}" if x.strip() else x) for t, r, x in any_rows(rng, 700)]
    rows += [(c, t, r, x) for c in range(20, 60) for t, r, x in any_rows(rng, rng.randrange(6))]
    rows += [(None, 1, "user", "a."), (None, None, None, None), (None, None, "assistant", "b."), (8, 3, "", "c."), (8, 3, "", "c."),
             (8, -5, "User", "d."), (9, 1, "user", "word " * 200000 + "."), (9, 2, "assistant", "é "), (10, 5, "system", "only.")]
    dropped = next(i for i in range(100, 999) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    check_repair(spark, [*rows, (dropped, 0, "user", "gone.")])


def test_repair_of_no_rows(spark):
    assert repair.repaired(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
