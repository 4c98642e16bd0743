import glob
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from sanitaria.sinks import export as E


def numbers(spark, n=5000):
    return spark.range(n, numPartitions=4).select(F.col("id").alias("munic_res"), (F.col("id") * 10).alias("val_tot"))


def size(path):
    return sum(os.path.getsize(f) for f in glob.glob(f"{path}/*.csv"))


def test_caps(spark, root):
    whole = E.export_capped(spark, numbers(spark), root)
    assert (whole.rows, whole.total, whole.cut) == (5000, 5000, False)
    assert spark.read.csv(root, header=True).count() == 5000
    capped = E.export_capped(spark, numbers(spark), root + "rows", max_rows=100)
    assert (capped.rows, capped.total, capped.cut) == (100, 5000, True)
    assert [r[0] for r in spark.read.csv(root + "rows", header=True).collect()] == [str(k) for k in range(100)]
    assert spark.read.csv(root + "rows", header=True).count() == 100
    E.export_capped(spark, numbers(spark), root + "bytes", max_bytes=20_000)
    assert 20_000 - 2_000 < size(root + "bytes") < 50_000
    assert E.capped_rows(numbers(spark), max_bytes=1).count() == 0


def test_limited(spark, root):
    numbers(spark).createOrReplaceTempView("export_numbers")
    E.export_limited(spark, "select * from export_numbers", root, limit=7)
    assert spark.read.csv(root, header=True).count() == 7
    assert E.resolve(spark, "export_numbers").count() == 5000
    for limit in (0, 100_001):
        with pytest.raises(ValueError, match="limit"):
            E.export_limited(spark, "select * from export_numbers", root, limit=limit)


def test_insert_statements(spark):
    df = spark.createDataFrame([("O'Neil", 1, None, ["a", "b"]), (None, None, True, None)], "s string, n int, b boolean, l array<string>")
    assert [r.statement for r in E.insert_statements(df, "t").collect()] == [
        "INSERT INTO t (s, n, b, l) VALUES ('O''Neil', 1, NULL, '[a, b]');",
        "INSERT INTO t (s, n, b, l) VALUES (NULL, NULL, true, NULL);",
    ]


def dated(spark):
    return spark.createDataFrame(
        [("a.dbc", date(2020, 1, 1), 1), ("a.dbc", date(2021, 1, 1), 2), ("b.dbc", date(2020, 12, 31), 3), (None, date(2020, 5, 5), 4)],
        "source_file string, dt_inter date, n int",
    )


@pytest.mark.parametrize("kind", ["csv", "parquet", "sql"])
def test_one_output_per_value(spark, root, kind):
    E.export_by_partition(dated(spark), "sihsus", "2020-01-01", "2020-12-31", root, file_format=kind)
    assert sorted(os.path.basename(p) for p in glob.glob(f"{root}/by_*")) == ["by_source_file=a.dbc", "by_source_file=b.dbc"]
    if kind == "parquet":
        assert {r.n for r in spark.read.parquet(root).collect()} == {1, 3}


def test_export_errors(spark, root):
    with pytest.raises(ValueError):
        E.export_by_partition(dated(spark), "sihsus", "2020-01-01", "2020-12-31", root, partition_column="nope")
    with pytest.raises(ValueError):
        E.export_by_partition(dated(spark), "sihsus", "2020-01-01", "2020-12-31", root, file_format="xml")
    with pytest.raises(ValueError):
        E.export_by_partition(dated(spark), "sim", "2020-01-01", "2020-12-31", root)


def test_round_trips(spark, root):
    E.export_csv(dated(spark), root + "c")
    assert spark.read.csv(root + "c", sep=";", header=True).count() == 4
    E.export_json(dated(spark), root + "j")
    assert spark.read.json(root + "j").count() == 4
    E.export_sample(numbers(spark), root + "s", 50, seed=1)
    assert spark.read.csv(root + "s", sep=";", header=True).count() == 50
    E.export_summary(dated(spark), root + "m")
    assert spark.read.csv(root + "m", sep=";", header=True).count() == 3


def test_copy_range(spark):
    spark.sql("drop table if exists copied_range")
    E.copy_range(dated(spark), "sihsus", "2020-01-01", "2020-06-30", "copied_range")
    assert spark.table("copied_range").count() == 2
    with pytest.raises(Exception, match="TABLE_OR_VIEW_ALREADY_EXISTS"):
        E.copy_range(dated(spark), "sihsus", "2020-01-01", "2020-06-30", "copied_range")
    E.copy_range(dated(spark), "sihsus", "2021-01-01", "2021-06-30", "copied_range", overwrite=True)
    assert spark.table("copied_range").count() == 1
    spark.sql("drop table copied_range")
