import pytest

from headrace.operators.layout import load_layout
from headrace.session import new_dir, new_schema
from headrace.streaming import file_drop as drop
from headrace.streaming.file_drop import read_drop_stream, stream_file_drop


def test_files_arrive_once(spark):
    folder, checkpoint, name = new_dir(spark), new_dir(spark), f"{new_schema(spark)}.t"
    counts = []
    for n in (3, 0, 4):
        if n:
            spark.range(n).coalesce(1).write.mode("append").option("header", True).csv(folder)
        rows = read_drop_stream(spark, folder, "*.csv", "csv", "id long", max_files=1)
        stream_file_drop(rows, name, checkpoint)
        counts.append(spark.table(name).count())
    assert counts == [3, 3, 7]
    assert len(load_layout(spark, name).applied) == 1


def test_a_new_checkpoint_is_a_new_stream(spark):
    folder, name = new_dir(spark), f"{new_schema(spark)}.t"
    spark.range(3).write.parquet(folder)
    for _ in range(2):
        stream_file_drop(read_drop_stream(spark, folder, "*.parquet", "parquet", "id long"), name, new_dir(spark))
    assert spark.table(name).count() == 6


def test_fixed_width_stream(spark):
    folder, name = new_dir(spark), f"{new_schema(spark)}.t"
    spark.createDataFrame([("ab12",)], "value string").write.text(folder)
    stream_file_drop(read_drop_stream(spark, folder, "*.txt", "fixed_width", layout="a:2:string;n:2:int"), name,
                     new_dir(spark))
    assert [tuple(r)[:2] for r in spark.table(name).collect()] == [("ab", 12)]


def test_unsupported_format(spark):
    with pytest.raises(ValueError, match="unsupported"):
        read_drop_stream(spark, "/nowhere", "*", "xlsx")


def test_what_does_not_fit_fails_the_stream(spark):
    folder, name = new_dir(spark), f"{new_schema(spark)}.t"
    spark.createDataFrame([("id",), ("1",), ("zz",)], "value string").coalesce(1).write.text(folder)
    rows = read_drop_stream(spark, folder, "*.txt", "csv", "id int")
    with pytest.raises(Exception, match="MALFORMED"):
        stream_file_drop(rows, name, new_dir(spark))
    spark.createDataFrame([("id",)], "value string").coalesce(1).write.text(f"{folder}/_late.csv")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_hidden.csv")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path).close()
    with pytest.raises(ValueError, match="_hidden.csv"):
        read_drop_stream(spark, folder, "*.csv", "csv", "id int")


def test_merged_stream_is_applied_once(spark, monkeypatch):
    """A crash after the target was written: the batch comes again under its number and changes nothing."""
    folder, checkpoint, name = new_dir(spark), new_dir(spark), f"{new_schema(spark)}.t"
    spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string").write.parquet(folder)
    written, write = [], drop.write

    def crash(*args, **options):
        written.append(write(*args, **options).rows)
        if len(written) == 1:
            raise RuntimeError("lost")

    monkeypatch.setattr(drop, "write", crash)

    def run():
        rows = read_drop_stream(spark, folder, "*.parquet", "parquet", "id long, v string")
        stream_file_drop(rows, name, checkpoint, keys=["id"], on_duplicate="latest", order_by="v")

    with pytest.raises(Exception, match="lost"):
        run()
    run()
    spark.createDataFrame([(2, "c"), (2, "d"), (3, "e")], "id long, v string").write.mode("append").parquet(folder)
    run()
    assert written == [2, 0, 2]
    assert sorted(tuple(r)[:2] for r in spark.table(name).collect()) == [(1, "a"), (2, "d"), (3, "e")]
