"""Secret scans over every version of every text, with a ledger of scanned blobs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headrace.llm.tables import Workspace


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a Java and RE2 pattern, the group whose length counts, and its least length."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


# The kinds of the contract, in their order, and one more.
BASE_KINDS = ("assign", "access", "hex")
_WORDS = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
RULES = (
    Rule("assign", 1, rf"""({_WORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", group=2, least=6),
    Rule("access", 1, "AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, "[0-9a-f]{24,}"),
    Rule("private_key", 1, "-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----"),
)

_PIECE = "struct<kind:string,i:int,gap:int,len:int,value:int>"


def _pieces(text: Column, rule: Rule, wanted: Column) -> Column:
    """The matches of one rule, each with the length of the text before it since the last one."""
    pattern = F.lit(rule.pattern)
    gaps = F.transform(F.split(text, rule.pattern, -1), lambda s: F.length(s))
    whole = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda s: F.length(s))
    value = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda s: F.length(s)) \
        if rule.group else whole
    rows = F.transform(whole, lambda n, i: F.struct(
        F.lit(rule.kind).alias("kind"), i.cast("int").alias("i"), F.get(gaps, i).alias("gap"), n.alias("len"),
        F.get(value, i).alias("value")))
    return F.when(wanted & text.rlike(rule.pattern), rows.cast(f"array<{_PIECE}>")).otherwise(
        F.array().cast(f"array<{_PIECE}>"))


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Ledger rows (blob, scanned, findings) for blobs (blob, text, missing).

    `missing` names the "kind@version" pairs a blob still needs; `findings` are the structs
    (kind, start, end) in code points, end exclusive. Offsets are running sums over a blob's
    matches, so that the work follows the text's length however many matches it has.
    """
    all_pieces = F.concat(*[_pieces(F.col("text"), r, F.array_contains("missing", f"{r.kind}@{r.version}"))
                            for r in rules])
    least = F.create_map(*[F.lit(x) for r in rules for x in (r.kind, r.least)])
    found = blobs.select("blob", "missing", F.explode_outer(all_pieces).alias("p"))
    before = Window.partitionBy("blob", "p.kind").orderBy("p.i")
    end = F.sum(F.col("p.gap") + F.col("p.len")).over(before).cast("long")
    placed = found.select("blob", "missing", "p", end.alias("end"))
    keep = F.col("p").isNotNull() & (F.col("p.value") >= least[F.col("p.kind")])
    finding = F.when(keep, F.struct(F.col("p.kind").alias("kind"), (F.col("end") - F.col("p.len")).alias("start"),
                                    F.col("end").alias("end")))
    return placed.groupBy("blob").agg(F.first("missing").alias("scanned"),
                                      F.sort_array(F.collect_list(finding)).alias("findings"))


def _known(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("scanned"))).alias("done"))


def scan_unseen(versions: DataFrame, ledger_path: str, rules: tuple[Rule, ...] = RULES,
                text_column: str = "text") -> None:
    """Scan every blob that lacks a rule version in the ledger, under those rules only.

    A version's text is addressed by its SHA-256; equal texts are scanned once, however many
    paths carry them, and never again under the same rule version. The new ledger rows are
    appended to the Parquet folder `ledger_path` in one commit: a run that fails leaves none.
    Addresses alone are compared with the ledger; texts move only if some are unseen.
    """
    spark = versions.sparkSession
    work = Workspace(spark)
    texts = versions.select(F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    pairs = F.array(*[F.lit(f"{r.kind}@{r.version}") for r in rules])
    # grouped by the text itself: copies meet before the shuffle, and no pass is spent on sorting
    blobs = texts.distinct().select(F.sha2("text", 256).alias("blob"), "text")
    if _exists(spark, ledger_path):
        known = _known(spark.read.parquet(ledger_path))
        unseen = work.save(texts.select(F.sha2("text", 256).alias("blob")).distinct().join(known, "blob", "left")
                           .select("blob", F.array_except(pairs, F.coalesce("done", F.array().cast("array<string>")))
                                   .alias("missing")).filter(F.size("missing") > 0))
        if unseen.isEmpty():
            return
        blobs = blobs.join(unseen, "blob")
    else:
        blobs = blobs.select("blob", "text", pairs.alias("missing"))
    scan_blobs(blobs, rules).write.mode("append").parquet(ledger_path)


def scan_versions(versions: DataFrame, ledger_path: str, rules: tuple[Rule, ...] = RULES,
                  id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Scan what the ledger lacks, and join the findings back to all versions.

    Returns one row per input row: id, blob, findings (kind, start, end). A null text counts as
    an empty one, repeated rows are all reported, other columns are ignored, and an empty table
    gives no rows.
    """
    spark = versions.sparkSession
    work = Workspace(spark)
    scan_unseen(versions, ledger_path, rules, text_column)
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    addressed = versions.select(F.col(id_column).alias("id"), F.sha2(text, 256).alias("blob"))

    current = [f"{r.kind}@{r.version}" for r in rules]
    ledger = spark.read.parquet(ledger_path)
    kinds = F.transform(F.array_intersect("scanned", F.array(*[F.lit(c) for c in current])),
                        lambda s: F.substring_index(s, "@", 1))
    rows = ledger.select("blob", F.filter("findings", lambda f: F.array_contains(kinds, f["kind"])).alias("findings"))
    resolved = work.save(rows.groupBy("blob").agg(
        F.array_distinct(F.flatten(F.collect_list("findings"))).alias("findings")))
    return addressed.join(resolved, "blob").select(F.col("id").alias(id_column), "blob", "findings")


def _exists(spark, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def span_digest(report: DataFrame, kinds: tuple[str, ...] = tuple(r.kind for r in RULES)) -> DataFrame:
    """The contract's columns: counts per base kind, hash of the base spans, all spans as text."""
    rank = F.create_map(*[F.lit(x) for i, k in enumerate(kinds) for x in (k, i)])
    ordered = F.array_sort(F.transform("findings", lambda f: F.struct(
        f["start"].alias("start"), rank[f["kind"]].alias("rank"), f["end"].alias("end"), f["kind"].alias("kind"))))
    base = F.filter("ordered", lambda f: f["rank"] < len(BASE_KINDS))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda f: F.concat_ws(
            ":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("ordered", lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return report.withColumn("ordered", ordered).select(
        "doc_id", *[count(kind) for kind in BASE_KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("ordered")).alias("spans"))
