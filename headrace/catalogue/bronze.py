"""Queries over bronze targets: append, overwrite, merge, evolution, partitions."""

from pyspark.sql import functions as F

from headrace.catalogue.base import query, shown, table
from headrace.operators import target
from headrace.session import new_schema

# The target slice and the batch overlap in 1999, and together cover the whole table.
_OLD = "o_orderdate < TIMESTAMP '2000-01-01'"
_NEW = "o_orderdate >= TIMESTAMP '1999-01-01'"

_SLICES = f"""WITH t AS (SELECT * FROM orders WHERE {_OLD}),
b AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate,
      o_orderpriority FROM orders WHERE {_NEW})"""
_MERGED = f"""{_SLICES} SELECT * FROM b UNION ALL
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.o_orderkey = t.o_orderkey)"""


def _slices(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.filter(_OLD), orders.filter(_NEW).withColumn("o_totalprice", F.col("o_totalprice") + 1)


def _fresh(spark) -> str:
    return f"{new_schema(spark)}.bronze"


@query(f"{_SLICES} SELECT * FROM t UNION ALL SELECT * FROM b")
def bronze_append(spark, sf_dir):
    name = _fresh(spark)
    for rows in _slices(spark, sf_dir):
        target.append(rows, name)
    return shown(spark, name)


@query(f"{_SLICES} SELECT * FROM b")
def bronze_overwrite(spark, sf_dir):
    name = _fresh(spark)
    for rows in _slices(spark, sf_dir):
        target.overwrite(rows, name)
    return shown(spark, name)


@query(_MERGED)
def bronze_merge(spark, sf_dir):
    name = _fresh(spark)
    for rows in _slices(spark, sf_dir):
        target.merge(rows, name, ["o_orderkey"])
    return shown(spark, name)


@query(_MERGED)
def bronze_merge_partitioned(spark, sf_dir):
    """Only the partitions that hold a matching key are rewritten; a rerun changes nothing."""
    name = _fresh(spark)
    old, new = _slices(spark, sf_dir)
    target.merge(old, name, ["o_orderkey"], partition_column="o_orderpriority")
    for _ in range(2):
        target.merge(new, name, ["o_orderkey"])
    return shown(spark, name)


@query("""WITH t AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '2000-01-01'),
b AS (SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01'
      QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC,
      l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC,
      l_returnflag DESC, l_linestatus DESC) = 1),
k AS (SELECT DISTINCT l_orderkey, l_linenumber FROM t)
SELECT t.* FROM t WHERE NOT EXISTS (
  SELECT 1 FROM b WHERE b.l_orderkey = t.l_orderkey AND b.l_linenumber = t.l_linenumber)
UNION ALL SELECT b.* FROM t JOIN b ON b.l_orderkey = t.l_orderkey AND b.l_linenumber = t.l_linenumber
UNION ALL SELECT b.* FROM b WHERE NOT EXISTS (
  SELECT 1 FROM k WHERE b.l_orderkey = k.l_orderkey AND b.l_linenumber = k.l_linenumber)""")
def bronze_merge_composite(spark, sf_dir):
    """Two key columns, repeated on both sides: the batch's latest row updates every target row."""
    name, rows = _fresh(spark), table(spark, sf_dir, "lineitem")
    target.append(rows.filter("l_shipdate < TIMESTAMP '2000-01-01'"), name)
    target.merge(rows.filter("l_shipdate >= TIMESTAMP '1999-01-01'"), name, ["l_orderkey", "l_linenumber"],
                 on_duplicate="latest", order_by="l_shipdate")
    return shown(spark, name)


_KEYED = """CASE WHEN c_mktsegment <> 'BUILDING' THEN c_custkey END AS c_custkey, c_name, c_nationkey,
c_acctbal, c_mktsegment"""


@query(f"""WITH t AS (SELECT {_KEYED} FROM customer WHERE c_acctbal < 6000),
b AS (SELECT * REPLACE (c_acctbal * 2 AS c_acctbal) FROM (SELECT {_KEYED} FROM customer WHERE c_acctbal >= 3000))
SELECT * FROM b UNION ALL SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.c_custkey = t.c_custkey)""")
def bronze_merge_null_keys(spark, sf_dir):
    """NULL keys never match: such rows stay, and such batch rows are inserted."""
    name = _fresh(spark)
    rows = table(spark, sf_dir, "customer").selectExpr(
        "CASE WHEN c_mktsegment <> 'BUILDING' THEN c_custkey END AS c_custkey", "c_name", "c_nationkey",
        "c_acctbal", "c_mktsegment")
    target.append(rows.filter("c_acctbal < 6000"), name)
    target.merge(rows.filter("c_acctbal >= 3000").withColumn("c_acctbal", F.col("c_acctbal") * 2), name,
                 ["c_custkey"])
    return shown(spark, name)


@query("""SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, NULL AS p_label FROM part
WHERE p_size <= 25 UNION ALL
SELECT p_partkey, p_name, p_brand, NULL, p_size, p_retailprice, p_brand || '/' || p_type FROM part WHERE p_size > 25""")
def evolve_append(spark, sf_dir):
    """The batch brings a new column and lacks an old one; both read NULL where they were not."""
    name, part = _fresh(spark), table(spark, sf_dir, "part")
    target.append(part.filter("p_size <= 25"), name, "merge")
    target.append(part.filter("p_size > 25").withColumn("p_label", F.concat_ws("/", "p_brand", "p_type"))
                  .drop("p_type"), name, "merge")
    return shown(spark, name)


@query("""SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, NULL AS p_label FROM part
WHERE p_size < 20 UNION ALL
SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, p_type AS p_label FROM part WHERE p_size >= 20""")
def evolve_merge(spark, sf_dir):
    name, part = _fresh(spark), table(spark, sf_dir, "part")
    target.append(part.filter("p_size <= 25"), name, "merge")
    target.merge(part.filter("p_size >= 20").withColumn("p_label", F.col("p_type")), name, ["p_partkey"], "merge")
    return shown(spark, name)


@query("""SELECT doc_id, text, lang, CASE WHEN hit THEN n_chars END AS n_chars, source, CASE WHEN hit THEN lang || '/' || source END
AS label, CASE WHEN hit THEN length(text) END AS length FROM (SELECT *, n_chars % 2 = 1 OR lang = 'en' AS hit FROM documents)""")
def evolve_nested(spark, sf_dir):
    """A field is added in a struct, in an array of structs and in a map's values: by a merge, then by an append."""
    name, docs = _fresh(spark), table(spark, sf_dir, "documents")
    narrow = ["doc_id", "text", "named_struct('lang', lang) AS facts", "array(named_struct('source', source)) AS parts",
              "map('text', named_struct('source', source)) AS by_name"]
    wide = ["doc_id", "text", "named_struct('n_chars', n_chars, 'lang', lang) AS facts",
            "array(named_struct('label', concat(lang, '/', source), 'source', source)) AS parts",
            "map('text', named_struct('source', source, 'length', CAST(length(text) AS BIGINT))) AS by_name"]
    target.append(docs.filter("lang <> 'de'").selectExpr(*narrow), name, "merge")
    target.merge(docs.filter("lang = 'en' OR (lang <> 'de' AND n_chars % 2 = 1)").selectExpr(*wide), name, ["doc_id"], "merge")
    target.append(docs.filter("lang = 'de' AND n_chars % 2 = 0").selectExpr(*narrow), name, "merge")
    target.append(docs.filter("lang = 'de' AND n_chars % 2 = 1").selectExpr(*wide), name, "merge")
    return shown(spark, name).selectExpr("doc_id", "text", "facts.lang", "facts.n_chars", "parts[0].source AS source",
                                         "parts[0].label AS label", "by_name['text'].length AS length")


@query("SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_retailprice * 2 AS double_price FROM part")
def evolve_overwrite(spark, sf_dir):
    """Another schema, one column of another type: the old schema is gone."""
    name, part = _fresh(spark), table(spark, sf_dir, "part")
    target.overwrite(part, name, "overwrite")
    target.overwrite(part.select(F.col("p_partkey").cast("string").alias("p_partkey"),
                                 (F.col("p_retailprice") * 2).alias("double_price")), name, "overwrite")
    return shown(spark, name)


@query("SELECT * FROM events")
def partitioned_write(spark, sf_dir):
    """One folder per event type."""
    name = _fresh(spark)
    target.append(table(spark, sf_dir, "events"), name, partition_column="event_type")
    return shown(spark, name)
