"""One query per operator, over the whole test tables, and the SQL that must agree where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headrace.llm import (caps, chat, decontaminate, forest, merkle, mixing, piecewise, pitman_yor, quality, repair,
                          secret_ledger, shards, token_ids)
from headrace.llm.tables import Workspace, read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two commits, each half of the rows, and then every row against the ledger of both."""
    ledger, docs = f"{Workspace(spark).folder}/ledger", read_table(spark, sf_dir, "documents")
    first = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    secret_ledger.scan_unseen(docs.filter(first), ledger)
    secret_ledger.scan_unseen(docs.filter(~first), ledger)
    return secret_ledger.span_digest(secret_ledger.scan_versions(docs, ledger))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaked_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op3_embedding_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caps.near_vectors(read_table(spark, sf_dir, "embeddings"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.accepted_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_duplicates(read_table(spark, sf_dir, "documents"))


def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score(read_table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard(read_table(spark, sf_dir, "documents"))


def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    folder = f"{Workspace(spark).folder}/ids"
    token_ids.write_ids(read_table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"))
    documents = token_ids.read_documents(token_ids.open_ids(spark, folder))
    return documents.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = F.lit("</s>[INST] ok [/INST]").alias("text")
    roles = F.explode(F.array(*[F.struct(F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role"))
                                for i, r in enumerate(("user", "assistant"))])).alias("t")
    extra = spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), roles).select("conv_id", "t.turn", "t.role",
                                                                                        control)
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    written = Workspace(spark).save(chat.format_conversations(turns))
    return chat.turn_digest(chat.parse_conversations(written))


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(read_table(spark, sf_dir, "documents"))


def op11_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piecewise.neighbour_fingerprints(read_table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(read_table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repaired(read_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_secret_scan, op2_decontamination, op3_embedding_near_dup, op4_quality_classifier, op5_ngram_jaccard_join,
    op6_language_model, op7_sharding, op8_token_ids, op9_chat_formatting, op10_source_mixing,
    op11_document_fingerprints, op12_merkle_manifest, op13_conversation_repair)}


def _secret_sql() -> str:
    parts = []
    for rank, rule in enumerate(secret_ledger.RULES):
        pattern = rule.pattern.replace("'", "''")
        parts.append(f"""
            SELECT doc_id, {rank} AS rank, '{rule.kind}' AS kind, i, string_split_regex(t, '{pattern}')[i] AS gap,
                   regexp_extract_all(t, '{pattern}', 0)[i] AS whole,
                   regexp_extract_all(t, '{pattern}', {rule.group})[i] AS value, {rule.least} AS least
            FROM d, UNNEST(generate_series(1, len(regexp_extract_all(t, '{pattern}', 0)))) AS s(i)""")
    return f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        pieces AS ({' UNION ALL '.join(parts)}),
        placed AS (SELECT *, sum(length(gap) + length(whole)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS stop
                   FROM pieces),
        spans AS (SELECT doc_id, rank, kind, (stop - length(whole))::BIGINT AS start, stop::BIGINT AS stop,
                         kind || ':' || (stop - length(whole))::BIGINT || ':' || stop::BIGINT AS name
                  FROM placed WHERE length(value) >= least),
        sums AS (SELECT doc_id, count(*) FILTER (WHERE rank = 0) AS n_assign, count(*) FILTER (WHERE rank = 1) AS n_access,
                        count(*) FILTER (WHERE rank = 2) AS n_hex,
                        string_agg(name, ',' ORDER BY start, rank) FILTER (WHERE rank < 3) AS base,
                        string_agg(name, ',' ORDER BY start, rank) AS spans
                 FROM spans GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
               coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM d LEFT JOIN sums ON d.doc_id = sums.doc_id"""


def _chat_sql() -> str:
    template = chat.INSTRUCT
    marks = " ".join(f"WHEN '{role}' THEN {len(m.before) + len(m.after)}" for role, m in template.marks.items())
    other = len(template.other.before) + len(template.named) + len(template.other.after)
    special = r"length(regexp_replace({0}, '[^<\[\\]', '', 'g'))"
    roles = "|".join(template.marks)
    return rf"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
        sized AS (SELECT *, length(text) + {special.format('text')} + CASE role {marks}
                         ELSE {other} + length(role) + {special.format('role')} END AS chars FROM turns)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), ''))
                   AS loss_sha256,
               sum(chars)::BIGINT AS formatted_chars,
               regexp_full_match(string_agg(role, ',' ORDER BY turn, role, text),
                                 '(system,)?user,assistant(,user,assistant)*') AS valid
        FROM sized GROUP BY conv_id"""


_MIXING_SQL = """
    WITH counts AS (SELECT source, count(*)::DOUBLE AS n FROM documents GROUP BY source),
    rates AS (SELECT source, (SELECT sum(n) FROM counts) * sqrt(n) / (SELECT sum(sqrt(n)) FROM counts) / n AS rate
              FROM counts),
    terms AS (SELECT source, k, CASE WHEN k = 0 THEN exp(-rate)
                     ELSE exp(-rate + k * ln(rate) - lgamma(k + 1)) END AS p
              FROM rates, UNNEST(generate_series(0, (rate + 12 * sqrt(rate) + 24)::INTEGER)) AS s(k)),
    cdf AS (SELECT source, list(c ORDER BY k) AS cdf
            FROM (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms) GROUP BY source),
    drawn AS (SELECT d.*, len(list_filter(cdf, lambda c: c <= u)) AS n_copies
              FROM (SELECT *, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':7'), 1, 13))::BIGINT
                              / 4503599627370496.0::DOUBLE AS u FROM documents) d
              JOIN cdf ON d.source IS NOT DISTINCT FROM cdf.source)
    SELECT doc_id, text, lang, source, n_chars, copy::INTEGER AS copy
    FROM drawn, UNNEST(generate_series(1, n_copies)) AS s(copy)"""

def _merkle_sql(levels: int = 7, upper: int = 4) -> str:
    """Level by level, for up to 16 ** levels documents of a source and 16 ** upper sources."""
    def leaf(text: str) -> str:
        values = [f"{v}::VARCHAR" for v in (*merkle.FIELDS[:-1], text)]
        return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"

    crc = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''),
        lambda ch: ascii(ch)::BIGINT)), lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda a, b: xor(a >> 1, 3988292384 * (a & 1)))))"""
    lower = f"translate(text, '{merkle.UPPER}', '{merkle.UPPER.lower()}')"
    parts = [f"leaves AS (SELECT doc_id, source, {leaf('text')} AS leaf, {leaf(lower)} AS other, {crc} % 5 = 0 AS hit FROM documents)",
             """n0 AS (SELECT doc_id, source, leaf, CASE WHEN hit THEN other ELSE leaf END AS changed, leaf AS d,
                row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                count(*) OVER (PARTITION BY source) AS cnt FROM leaves)""",
             "wn0 AS (SELECT doc_id, source, leaf, pos, '' AS proof, changed AS folded FROM n0)"]

    def climb(name: str, key: str, count: int, join: str) -> None:
        for k in range(count):
            run = f"OVER (PARTITION BY {key}pos // 16 ORDER BY pos ROWS BETWEEN"
            parts.append(f"""s{name}{k} AS (SELECT *, coalesce(string_agg(d, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                coalesce(string_agg(d, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k})""")
            parts.append(f"""w{name}{k + 1} AS (SELECT w.* REPLACE (w.pos // 16 AS pos, w.proof || l || r AS proof,
                CASE WHEN cnt > 1 THEN sha256(l || folded || r) ELSE folded END AS folded)
                FROM w{name}{k} w JOIN s{name}{k} s ON {join}w.pos = s.pos)""")
            parts.append(f"""{name}{k + 1} AS (SELECT {key}pos // 16 AS pos, (cnt + 15) // 16 AS cnt,
                CASE WHEN cnt > 1 THEN sha256(string_agg(d, '' ORDER BY pos)) ELSE min(d) END AS d
                FROM {name}{k} GROUP BY {key}pos // 16, cnt)""")

    climb("n", "source, ", levels, "w.source IS NOT DISTINCT FROM s.source AND ")
    parts.append(f"""u0 AS (SELECT source, d, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos,
        count(*) OVER () AS cnt FROM n{levels})""")
    parts.append(f"""wu0 AS (SELECT w.doc_id, w.leaf, u.d AS subroot, u.pos, w.proof, w.folded
        FROM wn{levels} w JOIN u0 u ON w.source IS NOT DISTINCT FROM u.source)""")
    climb("u", "", upper, "")
    return f"""WITH {', '.join(parts)}
        SELECT doc_id, leaf, subroot, d AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = d AS verified
        FROM wu{upper}, u{upper}"""


ORACLES: dict[str, str] = {"op1_secret_scan": _secret_sql(), "op9_chat_formatting": _chat_sql(),
                           "op10_source_mixing": _MIXING_SQL, "op12_merkle_manifest": _merkle_sql()}
