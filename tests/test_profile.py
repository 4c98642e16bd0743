import pytest
from pyspark.sql import functions as F

from sanitaria.operators import profile as P


def pct(stats):
    return {r.column: (r.null_pct, r.fill_pct) for r in stats.collect()}


def test_fill_percentages(spark):
    rows = [(None if i < 2 else 355030 + i, "2020-01-01", None if i < 4 else "A01") for i in range(10)]
    df = spark.createDataFrame(rows, "codmunres int, dtobito string, causabas string")
    assert pct(P.column_stats(df)) == {"codmunres": (20, 80), "dtobito": (0, 100), "causabas": (40, 60)}


def test_arrays_count_null_and_empty(spark):
    df = spark.createDataFrame([(["A01"],), (["B02", "C03"],), ([None],), (None,), (None,), ([],)], "causabas array<string>")
    assert pct(P.column_stats(df)) == {"causabas": (50, 50)}


def test_rounding_to_two_decimals(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    assert pct(P.column_stats(df)) == {"x": (33.33, 66.67)}


def test_empty_table_has_no_statistics(spark):
    assert P.column_stats(spark.createDataFrame([], "x int")).count() == 0


@pytest.mark.parametrize("distinct", [4, 10, 6, 5000])
def test_distinct_counts(spark, distinct):
    df = spark.range(20_000).select((F.col("id") % distinct).alias("x"), F.array((F.col("id") % distinct).cast("string")).alias("y"))
    for exact in (False, True):
        counts = {r.column: r.distinct_count for r in P.column_stats(df, exact=exact).collect()}
        for c in ("x", "y"):
            assert abs(counts[c] - distinct) <= (0 if exact else max(1, 0.05 * distinct))


def test_histogram(spark):
    df = spark.createDataFrame([(1.001,), (1.004,), (2.0,), (None,)], "x double")
    rows = [(None if r.x is None else float(r.x), r["count"], r.pct_population) for r in P.histogram(df, "x").collect()]
    assert rows == [(1.0, 2, 50.0), (2.0, 1, 25.0), (None, 1, 25.0)]


def test_summary(spark):
    df = spark.range(1, 101).select(F.col("id").alias("n"), F.lit("a").alias("s"), F.lit(None).cast("int").alias("z"))
    rows = {r.column_name: r for r in P.summarize(df).collect()}
    assert (rows["n"].min, rows["n"].max, rows["n"].avg, rows["n"].q50, rows["n"]["count"]) == ("1", "100", 50.5, 50.0, 100)
    assert rows["s"].avg is None and rows["z"].null_percentage == 100.0 and rows["z"].approx_unique == 0


def test_table_facts(spark):
    df = spark.range(3)
    assert [(r.column_name, r.column_type) for r in P.schema_table(df).collect()] == [("id", "bigint")]
    assert P.table_stats(df, "t").first().row_count == 3
    df.createOrReplaceTempView("facts_view")
    assert "facts_view" in [r.name for r in P.tables(spark).collect()]
