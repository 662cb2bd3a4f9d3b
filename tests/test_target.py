from contextlib import contextmanager
from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headrace.operators import target
from headrace.operators.layout import ConcurrentWrite, begin, load_layout, stored_parts
from headrace.operators.schema import SchemaMismatch
from headrace.session import new_schema


@pytest.fixture(scope="module")
def schema(spark):
    return new_schema(spark)


@pytest.fixture
def name(schema, request):
    return f"{schema}.t{abs(hash(request.node.name)) % 10**9}"


def rows(spark, name):
    return sorted(map(tuple, spark.table(name).drop("_ingested_at").collect()), key=repr)


def replaced(spark, layout):
    return spark.table(layout.places).filter(F.col("written") == layout.prefix).collect() if layout.replaced else []


def frame(spark, values, ddl="id long, v string"):
    return spark.createDataFrame(values, ddl)


def test_merge_needs_keys(spark, name):
    with pytest.raises(ValueError, match="primary_key_cols"):
        target.write(frame(spark, [(1, "a")]), name, "merge", keys=[])


def test_unknown_mode_appends(spark, name):
    for _ in range(2):
        target.write(frame(spark, [(1, "a")]), name, "upsert-ish")
    assert rows(spark, name) == [(1, "a"), (1, "a")]


def test_unknown_evolution(spark, name):
    with pytest.raises(ValueError, match="schema_evolution_mode"):
        target.append(frame(spark, [(1, "a")]), name, "rename")


@pytest.mark.parametrize("mode", ["append", "overwrite", "merge"])
@pytest.mark.parametrize("batch", [
    ([(1, "a", 2)], "id long, v string, extra int"), ([(1,)], "id long"), ([(1, 2.5)], "id long, v double"),
    ([(1, "a")], "id long, w string")])
def test_without_evolution_a_differing_schema_fails(spark, schema, mode, batch):
    name = f"{schema}.none_{mode}_{len(batch[1])}_{batch[1][-1]}"
    target.append(frame(spark, [(1, "a")]), name)
    with pytest.raises(SchemaMismatch):
        target.write(frame(spark, *batch), name, mode, keys=["id"])
    assert rows(spark, name) == [(1, "a")]


def test_a_retyped_column_fails_even_when_evolving(spark, name):
    target.append(frame(spark, [(1, "a")]), name)
    with pytest.raises(SchemaMismatch, match="types differ"):
        target.append(frame(spark, [("x", "a")], "id string, v string"), name, "merge")


NESTED = "id long, s struct<a:int,inner:struct<x:int>>, l array<struct<a:int>>, m map<string,struct<a:int>>"
WIDER = """id long, s struct<B:string,A:int,inner:struct<y:int,x:int>>, l array<struct<b:int,a:int>>,
m map<string,struct<a:int,b:array<struct<c:int>>>>"""


@pytest.mark.parametrize("write", ["append", "merge"])
@pytest.mark.parametrize("first", ["append", "merge"])
def test_nested_fields_are_added(spark, schema, write, first):
    """In a struct, in structs of an array and as a map's values; matched by name in any case and order."""
    name = f"{schema}.nested_{write}_{first}"
    old = (1, (1, (2,)), [(3,), None], {"k": (4,), "z": None})
    new = (2, ("b", 5, (7, 6)), [(9, 8)], {"k": (1, [(2,)])})
    target.write(frame(spark, [old, (3, None, None, None)], NESTED), name, first, keys=["id"], evolution="merge")
    target.write(frame(spark, [new], WIDER), name, write, keys=["id"], evolution="merge")
    got = {r.id: r for r in spark.table(name).collect()}
    plain = spark.table(name).schema["s"].dataType.simpleString()
    assert plain == "struct<a:int,inner:struct<x:int,y:int>,B:string>"
    assert got[1].s == (1, (2, None), None) and got[1].l == [(3, None), None] and got[1].m == {"k": (4, None), "z": None}
    assert got[2].s == (5, (6, 7), "b") and got[2].l == [(8, 9)] and got[2].m == {"k": (1, [(2,)])}
    assert got[3].s is got[3].l is got[3].m is None
    # the batch may lack nested fields in turn, and rows are rewritten with them
    target.write(frame(spark, [(1, (7, (8,)), [(1,)], {})], NESTED), name, "merge", keys=["id"], evolution="merge")
    got = {r.id: r for r in spark.table(name).collect()}
    assert len(got) == 3 and got[1].s == (7, (8, None), None) and got[2].s == (5, (6, 7), "b")
    assert spark.table(name).filter("s.B = 'b' AND m['k'].b[0].c = 2").count() == 1


def test_nested_types_that_do_not_fit(spark, name):
    target.append(frame(spark, [(1, (1, (2,)), [], {})], NESTED), name, "merge")
    before = spark.table(name).schema
    for ddl, value in (("s struct<a:string,inner:struct<x:int>>", ("x", (1,))), ("s struct<a:int,inner:int>", (1, 1)),
                       ("s array<int>", [1]), ("l array<int>", [1]), ("m map<int,struct<a:int>>", {1: (1,)})):
        with pytest.raises(SchemaMismatch, match="types differ"):
            target.append(frame(spark, [(1, value)], f"id long, {ddl}"), name, "merge")
    with pytest.raises(SchemaMismatch, match="new columns .*'s.b'"):
        target.append(frame(spark, [(1, ("x", 5, (7, 6)), [], {})], WIDER), name)
    with pytest.raises(SchemaMismatch, match="missing columns .*'s.inner.x'"):
        target.append(frame(spark, [(1, (5, (6,)), [], {})], NESTED.replace("x:int", "y:int")), name)
    target.append(frame(spark, [(2, None, [], {})], NESTED.replace("s struct<a:int,inner:struct<x:int>>", "s void")), name)
    assert spark.table(name).schema == before and spark.table(name).count() == 2


def test_nested_numbers_widen(spark, name):
    target.append(frame(spark, [(1, (1,))], "id long, s struct<a:bigint>"), name)
    target.append(frame(spark, [(2, (2,))], "id long, s struct<a:int>"), name)
    assert rows(spark, name) == [(1, (1,)), (2, (2,))]


def test_nested_fields_of_a_crashed_write(spark, name):
    """A write that added a field and then failed: readers go on, and the next write may add it too, or another."""
    target.append(frame(spark, [(1, (1,))], "id long, s struct<a:int>"), name)
    layout, batch = load_layout(spark, name), frame(spark, [(2, (2, "b"))], "id long, s struct<a:int,b:string>")
    target._evolve(target.stamp(batch), name, layout, "merge")
    assert [r.s.a for r in spark.table(name).collect()] == [1]
    target.append(frame(spark, [(3, (3, "c"))], "id long, s struct<a:int,c:string>"), name, "merge")
    target.append(batch, name, "merge")
    assert {r.id: (r.s.a, r.s.b, r.s.c) for r in spark.table(name).collect()} == {
        1: (1, None, None), 2: (2, "b", None), 3: (3, None, "c")}


def test_a_narrower_number_widens(spark, name):
    target.append(frame(spark, [(1, "a")]), name)
    target.append(frame(spark, [(2, "b")], "id int, v string"), name)
    assert spark.table(name).schema["id"].dataType.simpleString() == "bigint"
    assert rows(spark, name) == [(1, "a"), (2, "b")]


def test_columns_match_by_name_in_any_case_and_order(spark, name):
    target.append(frame(spark, [(1, "a")]), name)
    target.merge(frame(spark, [("b", 1)], "V string, ID long"), name, ["Id"])
    assert rows(spark, name) == [(1, "b")]
    assert spark.table(name).columns == ["id", "v", "_ingested_at"]


def test_duplicate_batch_keys(spark, name):
    batch = frame(spark, [(1, "a", 1), (1, "b", 2), (None, "c", 1), (None, "c", 1)], "id long, v string, n int")
    with pytest.raises(ValueError, match="several rows for one key"):
        target.merge(batch, name, ["id"])
    with pytest.raises(ValueError, match="order_by"):
        target.merge(batch, name, ["id"], on_duplicate="latest")
    with pytest.raises(ValueError, match="neither"):
        target.merge(batch, name, ["id"], on_duplicate="any")
    target.merge(batch, name, ["id"], on_duplicate="latest", order_by="n")
    assert rows(spark, name) == [(1, "b", 2), (None, "c", 1), (None, "c", 1)]


def test_latest_carries_maps(spark, name):
    batch = frame(spark, [(1, 1, {"a": 1}), (1, 2, {"b": 2})], "id long, n int, m map<string,int>")
    target.merge(batch, name, ["id"], on_duplicate="latest", order_by="n")
    assert rows(spark, name) == [(1, 2, {"b": 2})]


def test_merge_twice_changes_nothing(spark, name):
    target.append(frame(spark, [(1, "a"), (2, "b")]), name)
    for _ in range(2):
        target.merge(frame(spark, [(2, "c"), (3, "d")]), name, ["id"])
        assert rows(spark, name) == [(1, "a"), (2, "c"), (3, "d")]


def test_every_target_row_of_a_key_is_updated(spark, name):
    target.append(frame(spark, [(1, "a"), (1, "b"), (2, "c")]), name)
    result = target.merge(frame(spark, [(1, "x"), (3, "y")]), name, ["id"])
    assert rows(spark, name) == [(1, "x"), (1, "x"), (2, "c"), (3, "y")]
    assert result.rows == 3


def test_empty_batches(spark, name):
    empty = frame(spark, [])
    assert target.append(empty, name).rows == 0
    assert target.merge(empty, name, ["id"]).rows == 0
    assert rows(spark, name) == []
    target.append(frame(spark, [(1, "a")]), name)
    assert target.merge(empty, name, ["id"]).rows == 0
    assert rows(spark, name) == [(1, "a")]
    target.overwrite(empty, name)
    assert rows(spark, name) == []


@pytest.mark.parametrize("ddl,values", [
    ("date", [date(2024, 1, 1), date(2024, 1, 2)]),
    ("timestamp_ntz", [datetime(2024, 1, 1, 1, 2, 3), datetime(2024, 1, 2)]),
    ("timestamp", [datetime(2024, 1, 1, 1, 2, 3), datetime(2024, 1, 2)]),
    ("string", ["it's a/b=c \\ %41", "plain"]),
    ("int", [1, 2]), ("boolean", [True, False]), ("decimal(6,2)", None)])
def test_merge_rewrites_touched_partitions_only(spark, schema, ddl, values):
    from decimal import Decimal
    values = values or [Decimal("1.50"), Decimal("2.00")]
    name = f"{schema}.by_{ddl[:7].strip('(')}_{len(ddl)}"
    batch = [(i, p, "old") for i, p in enumerate([*values, None])]
    target.append(frame(spark, batch, f"id long, p {ddl}, v string"), name, partition_column="p")
    first = stored_parts(spark, load_layout(spark, name).data)
    for value in (0, 2):
        change = [(value, batch[value][1], "new")]
        target.merge(frame(spark, change, f"id long, p {ddl}, v string"), name, ["id"])
        layout = load_layout(spark, name)
        assert [r.part for r in replaced(spark, layout)] == first
        assert spark.table(name).count() == 3
    # the files replaced by the first merge are gone, the untouched partition is as it was
    target.append(frame(spark, [(9, values[0], "last")], f"id long, p {ddl}, v string"), name)
    held = spark.sql(f"SHOW PARTITIONS {layout.data}").filter(f"partition LIKE '_part={first[0]}/%'").count()
    assert held == 1
    assert {(r.id, r.v) for r in spark.table(name).collect()} == {(0, "new"), (1, "old"), (2, "new"), (9, "last")}


def test_an_unpartitioned_merge_rewrites_touched_parts_only(spark, name):
    target.merge(spark.range(0, 800, 1, 8).withColumn("v", F.lit("old")), name, ["id"], tasks_per_part=1)
    first = stored_parts(spark, load_layout(spark, name).data)
    assert len(first) == 8
    result = target.merge(spark.range(795, 805).withColumn("v", F.lit("new")), name, ["id"])
    layout = load_layout(spark, name)
    assert result.rows == 10 and [r.part for r in replaced(spark, layout)] == first[7:]
    got = spark.table(name).groupBy("v").agg(F.count("id"), F.sum("id")).collect()
    target.append(spark.range(0).withColumn("v", F.lit("none")), name)
    assert set(first) - set(stored_parts(spark, layout.data)) == set(first[7:])
    assert sorted(map(tuple, got)) == [("new", 10, sum(range(795, 805))), ("old", 795, sum(range(795)))]


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_a_hot_key(spark, name, broadcast):
    """A third of the target holds one key. Its rows are updated where they are, not made again in one task."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("long")
        target.append(spark.range(0, 90000, 1, 8).select(key.alias("k"), F.lit("old").alias("v")), name)
        batch = spark.range(45000).select(F.col("id").alias("k"), F.lit("new").alias("v"))
        assert target.merge(batch, name, ["k"]).rows == 30001 + 29999 + 15000
        assert spark.table(name).count() == 90000 + 15000
        assert spark.table(name).filter("v = 'new'").count() == 30001 + 29999 + 15000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("by", [None, "p"])
@pytest.mark.parametrize("repeat", [False, True])
def test_a_merge_reads_the_target_twice(spark, name, monkeypatch, by, repeat):
    """Its keys, and then the places with a match; also where keys are repeated on both sides."""
    rows = spark.range(1000).selectExpr("id", "id % 3 AS p", "'old' AS v")
    target.append(rows.union(rows.filter("id < 10")) if repeat else rows, name, partition_column=by)
    plans, data = [], load_layout(spark, name).data.split(".")[1]
    write, scratch = target._write_part, target.scratch_tables

    def watched(df, *rest, **more):
        plans.append(plan_of(df))
        return write(df, *rest, **more)

    @contextmanager
    def watching(*args):
        with scratch(*args) as keep:
            yield lambda df: (plans.append(plan_of(df)), keep(df))[1]

    monkeypatch.setattr(target, "_write_part", watched)
    monkeypatch.setattr(target, "scratch_tables", watching)
    batch = spark.range(500, 1500).union(spark.range(5)).selectExpr("id", "id % 3 AS p", "'new' AS v")
    batch = batch.union(batch.filter("id < 3")) if repeat else batch
    target.merge(batch, name, ["id"], on_duplicate="latest", order_by="id")
    # NULL keys go around the join in a branch of their own, of the same places
    scans = [line for plan in plans for line in plan.splitlines() if "Scan parquet" in line and data + "[" in line]
    narrow = [line for line in scans if "v#" not in line.split("]")[0]]
    assert len(narrow) == 1 and len(scans) <= 3
    assert all("array_contains" in line for line in scans if line not in narrow)
    want = [(1500 + 10 * repeat, 1005 + 5 * repeat)]
    assert spark.table(name).agg(F.count("id"), F.count_if(F.col("v") == "new")).collect() == want


def test_state_does_not_grow_with_the_places(spark, schema):
    """View and state are as long for 150 replaced places as for 5, and only live places are read."""
    lengths = {}
    for n in (5, 150):
        name = f"{schema}.places_{n}"
        target.append(spark.range(150).selectExpr("id", "id AS p", "'old' AS v"), name, partition_column="p")
        target.merge(spark.range(n).selectExpr("id", "id AS p", "'new' AS v"), name, ["id"])
        described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
        lengths[n] = len(described["View Text"]) - len(name) * 3, len(str(load_layout(spark, name)))
        assert len(replaced(spark, load_layout(spark, name))) == n
        shown = spark.table(name)
        assert shown.groupBy("v").count().orderBy("v").collect() == [("new", n)] + [("old", 150 - n)] * (n < 150)
        filters = next(line for line in plan_of(shown).splitlines() if "Scan parquet" in line).split("PartitionFilters")[1]
        assert "array_contains(Subquery" in filters
    assert abs(lengths[5][0] - lengths[150][0]) < 30 and abs(lengths[5][1] - lengths[150][1]) < 10


def row_groups_read(df):
    """Rows that the scans of a frame read, after Parquet skipped what cannot match."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    scans, waiting = [], [plan.executedPlan() if "Adaptive" in plan.nodeName() else plan]
    while waiting:
        node = waiting.pop()
        if "Scan" in node.nodeName():
            scans.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]
        waiting += [node.plan()] if "QueryStage" in node.nodeName() else []
    return sum(scans)


@pytest.mark.parametrize("keys,ddl", [(["k"], "long"), (["k"], "string"), (["k", "n"], "long")])
def test_bloom_filters_find_scattered_keys(spark, schema, keys, ddl, monkeypatch):
    """50 random keys of 200,000 in random order: most row groups are skipped, in range as they are."""
    name = f"{schema}.bloom_{ddl}_{len(keys)}"
    scattered = spark.range(0, 200000, 1, 64).select(
        F.pmod(F.xxhash64("id"), F.lit(10**15)).cast(ddl).alias("k"), (F.col("id") % 2).alias("n"), F.lit("old").alias("v"))
    target.merge(scattered, name, keys)
    batch = scattered.filter("n = 0").orderBy(F.xxhash64("k", F.lit(1))).limit(50).withColumn("v", F.lit("new"))
    seen, matches = [], target._matches

    def watched(near, *rest):
        seen.append(row_groups_read(near))
        return matches(near, *rest)

    monkeypatch.setattr(target, "_matches", watched)
    with target.scratch_tables(spark, name) as keep:
        batch = keep(batch)
        target.merge(batch, name, keys)
        monkeypatch.setattr(target, "LOOKUP_KEYS", 0)
        target.merge(batch, name, keys)
    assert spark.table(name).groupBy("v").count().orderBy("v").collect() == [("new", 50), ("old", 199950)]
    assert seen[0] < 0.75 * seen[1] and seen[1] > 190000


def test_kept_rows_are_not_shuffled_for_a_small_batch(spark, name, monkeypatch):
    plans = []
    write = target._write_part
    monkeypatch.setattr(target, "_write_part", lambda df, *rest, **more: (
        plans.append(df._jdf.queryExecution().sparkPlan().toString()), write(df, *rest, **more))[1])
    start = spark.range(1000).selectExpr("id", "id % 3 AS p", "'old' AS v")
    batch = spark.range(10).selectExpr("id", "id % 3 AS p", "'new' AS v")
    target.append(start, name, partition_column="p")
    target.merge(batch, name, ["id"])
    target.merge(batch, name, ["id"], broadcast_bytes=10)
    small, large = plans[1], plans[2]
    assert "Union" in small.split("REBALANCE")[0] and "REBALANCE" in small
    assert "REBALANCE" not in large and "Union" in large  # the writer adds it above the union
    assert spark.table(name).groupBy("v").count().orderBy("v").collect() == [("new", 10), ("old", 990)]


def test_a_row_may_change_its_partition(spark, name):
    target.append(frame(spark, [(1, "a"), (2, "b")]), name, partition_column="v")
    target.merge(frame(spark, [(1, "b")]), name, ["id"])
    assert rows(spark, name) == [(1, "b"), (2, "b")]


def test_a_crashed_write_stays_invisible(spark, name):
    target.append(frame(spark, [(1, "a")]), name)
    layout = load_layout(spark, name)
    before = stored_parts(spark, layout.data)
    target._write_part(target.stamp(frame(spark, [(7, "z")])), begin(spark, layout)[1])
    [orphan] = set(stored_parts(spark, layout.data)) - set(before)
    assert rows(spark, name) == [(1, "a")]
    target.append(frame(spark, [(2, "b")]), name)
    assert rows(spark, name) == [(1, "a"), (2, "b")]
    target.append(frame(spark, [(3, "c")]), name)
    assert rows(spark, name) == [(1, "a"), (2, "b"), (3, "c")]
    assert orphan not in stored_parts(spark, layout.data)


def test_a_target_may_be_named_like_a_secret(spark, name):
    for i in (1, 2):
        target.append(frame(spark, [(i, "a")]), f"{name}_token")
    assert rows(spark, f"{name}_token") == [(1, "a"), (2, "a")]


def _add(spark, name):
    return target.append(frame(spark, [(7, "z")]), name)


def _upsert(spark, name):
    return target.merge(frame(spark, [(1, "m"), (7, "z")]), name, ["id"])


def _replace(spark, name):
    return target.overwrite(frame(spark, [(7, "z")]), name)


@pytest.mark.parametrize("exists", [True, False])
@pytest.mark.parametrize("slow, quick", [(_add, _add), (_add, _upsert), (_upsert, _add), (_add, _replace),
                                         (_replace, _add)])
def test_the_first_of_two_writers_wins(spark, name, monkeypatch, slow, quick, exists):
    if exists:
        target.append(frame(spark, [(1, "a"), (2, "b")]), name)
    publish, won = target.publish, []

    def late(*args):  # the other writer runs from start to end before this one publishes
        monkeypatch.setattr(target, "publish", publish)
        quick(spark, name)
        won.extend(rows(spark, name))
        publish(*args)

    monkeypatch.setattr(target, "publish", late)
    with pytest.raises(ConcurrentWrite):
        slow(spark, name)
    assert rows(spark, name) == won
    slow(spark, name)
    again = rows(spark, name)
    assert (7, "z") in again and (slow is _replace or len(again) >= len(won))


def test_columns_added_by_a_crashed_write(spark, name):
    target.append(frame(spark, [(1, "a")]), name)
    spark.sql(f"ALTER TABLE {load_layout(spark, name).data} ADD COLUMNS (extra int)")
    target.append(frame(spark, [(2, "b", 5)], "id long, v string, extra int"), name, "merge")
    assert rows(spark, name) == [(1, "a", None), (2, "b", 5)]


def test_overwrite_keeps_the_old_table_for_one_write(spark, name):
    target.overwrite(frame(spark, [(1, "a")]), name)
    old = load_layout(spark, name).data
    target.overwrite(spark.table(name).drop("_ingested_at").withColumn("v", F.upper("v")), name)
    assert rows(spark, name) == [(1, "A")] and spark.catalog.tableExists(old)
    target.append(frame(spark, [(2, "b")]), name)
    assert not spark.catalog.tableExists(old)


def test_a_foreign_table_is_refused(spark, name):
    frame(spark, [(1, "a")]).write.saveAsTable(name)
    with pytest.raises(ValueError, match="not a target"):
        target.append(frame(spark, [(1, "a")]), name)


def test_replayed_stream_batch_is_skipped(spark, name):
    for number in (0, 1, 1, 0):
        target.append(frame(spark, [(number, "a")]), name, batch_of=("s", number))
    target.append(frame(spark, [(0, "other stream")]), name, batch_of=("r", 0))
    assert rows(spark, name) == [(0, "a"), (0, "other stream"), (1, "a")]


def _merged(old, new):
    """Plain rules: equal full keys update every old row, all other batch rows are inserted."""
    by_key = {(a, b): v for a, b, v in new if a is not None and b is not None}
    out = [(a, b, by_key.get((a, b), v)) for a, b, v in old]
    held = {(a, b) for a, b, _ in old}
    return out + [r for r in new if r[0] is None or r[1] is None or (r[0], r[1]) not in held]


_key = st.one_of(st.none(), st.integers(0, 3))
_row = st.tuples(_key, st.one_of(st.none(), st.sampled_from(["x", "y"])), st.integers(0, 9))


@settings(max_examples=16, deadline=None, suppress_health_check=list(HealthCheck))
@given(old=st.lists(_row, max_size=8), new=st.lists(_row, max_size=6, unique_by=lambda r: r[:2] if None not in r[:2] else object()),
       by=st.sampled_from([None, "b", "v"]), broadcast=st.sampled_from(["10m", "-1"]))
def test_merge_follows_the_rules(spark, schema, old, new, by, broadcast):
    import uuid
    name, ddl = f"{schema}.m{uuid.uuid4().hex[:10]}", "a int, b string, v int"
    target.append(frame(spark, old[:4], ddl), name, partition_column=by)
    target.append(frame(spark, old[4:], ddl), name)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        target.merge(frame(spark, new, ddl), name, ["a", "b"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    assert rows(spark, name) == sorted(_merged(old, new), key=repr)


def test_what_may_be_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for threshold, want in (("0", False), ("-1", False), ("1k", True)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            assert target._broadcastable(spark, {"bytes": 480}, [T.LongType()]) == want
        assert not target._broadcastable(spark, {"bytes": 480}, [T.LongType(), T.ArrayType(T.StringType())])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
