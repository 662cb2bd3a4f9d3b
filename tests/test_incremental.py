from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from headrace.operators import target
from headrace.operators.incremental import apply_incremental, max_watermark, resolve_watermark, with_metrics
from headrace.operators.layout import watermark_hint
from headrace.session import new_dir, new_schema


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


VALUES = [
    ("long", 2**53 + 1, 2**53 + 2, 2**53 + 3), ("double", 0.1, 0.30000000000000004, 1e300),
    ("decimal(30,10)", Decimal("1.0000000001"), Decimal("1.0000000002"), Decimal("99999999999999999999.5")),
    ("date", date(1999, 12, 31), date(2024, 2, 29), date(2024, 3, 1)),
    ("timestamp_ntz", datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 0, 1), datetime(2024, 1, 1, 0, 0, 0, 2)),
    ("timestamp", datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 0, 1), datetime(2024, 1, 1, 0, 0, 0, 2)),
    ("string", "a'b", "a\\c", "b"),
]


@pytest.mark.parametrize("dtype,low,mid,high", VALUES)
def test_watermark_text_is_exact(spark, dtype, low, mid, high):
    df = spark.createDataFrame([(low,), (mid,), (None,)], f"c {dtype}")
    found = max_watermark(df, "c")
    more = spark.createDataFrame([(low,), (mid,), (high,)], f"c {dtype}")
    assert apply_incremental(more, "c", found).collect() == more.filter(F.col("c") == F.lit(high).cast(dtype)).collect()
    for hint in (found, max_watermark(more, "c"), "no such value"):
        assert max_watermark(df, "c", at_least=hint) == found


def test_declared_type_orders_text_as_numbers(spark):
    df = spark.createDataFrame([("9",), ("10",), ("100",)], "c string")
    assert max_watermark(df, "c") == "9"
    assert max_watermark(df, "c", "bigint") == "100"
    assert [r.c for r in apply_incremental(df, "c", "9", "bigint").collect()] == ["10", "100"]


@pytest.mark.parametrize("dtype,rows,lag,kept", [
    ("timestamp_ntz", [datetime(2024, 1, 1, 0, 0, s) for s in (0, 5, 9)], 4, 1),
    ("date", [date(2024, 1, d) for d in (1, 2, 3)], 1, 1), ("date", [date(2024, 1, d) for d in (1, 2, 3)], 86401, 2),
    ("int", [1, 5, 9], 5, 2)])
def test_look_back(spark, dtype, rows, lag, kept):
    df = spark.createDataFrame([(r,) for r in rows], f"c {dtype}")
    assert apply_incremental(df, "c", max_watermark(df, "c"), lag_seconds=lag).count() == kept


def test_look_back_needs_an_ordered_type(spark):
    df = spark.createDataFrame([("a",)], "c string")
    with pytest.raises(ValueError, match="look-back"):
        apply_incremental(df, "c", "a", lag_seconds=1)


def test_no_watermark_reads_everything(spark):
    assert apply_incremental(spark.range(3), "id", None).count() == 3


def test_resolve(spark):
    name = f"{new_schema(spark)}.t"
    assert resolve_watermark(spark, name, "c", initial="5") == "5"
    target.append(spark.createDataFrame([(None,)], "c int"), name)
    assert resolve_watermark(spark, name, "C", initial="5") == "5"
    target.append(spark.createDataFrame([(7,)], "c int"), name, watermark_column="c")
    assert resolve_watermark(spark, name, "C", initial="5") == "7"
    assert watermark_hint(spark, name, "c") == "7" and watermark_hint(spark, name, "d") is None
    with pytest.raises(ValueError, match="not among"):
        resolve_watermark(spark, name, "other")


def test_a_lowered_maximum_is_found_despite_the_hint(spark):
    name = f"{new_schema(spark)}.t"
    target.append(spark.createDataFrame([(1, 5), (2, 9)], "k int, c int"), name, watermark_column="c")
    target.merge(spark.createDataFrame([(2, 3)], "k int, c int"), name, ["k"])
    assert resolve_watermark(spark, name, "c", at_least=watermark_hint(spark, name, "c")) == "5"


def test_predicates_reach_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    text = plan(apply_incremental(orders, "o_orderdate", "2001-01-01", lag_seconds=60,
                                  source_filter="o_orderstatus = 'F'").select("o_orderkey"))
    assert "GreaterThan(o_orderdate,2000-12-31T23:59)" in text
    assert "EqualTo(o_orderstatus,F)" in text and "o_totalprice" not in text


def test_metrics_of_an_empty_batch(spark):
    df, metrics = with_metrics(spark.range(0), "id")
    df.write.parquet(new_dir(spark))
    assert metrics.get == {"rows": 0, "watermark": None}


def test_nan_is_no_watermark(spark):
    rows = spark.createDataFrame([(1.5,), (float("nan"),), (None,)], "v double")
    assert float(max_watermark(rows, "v")) == 1.5
    assert max_watermark(rows.filter("isnan(v)"), "v") is None
