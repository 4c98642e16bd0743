import random
from datetime import date, datetime

from sanitaria.operators.ask import ask
from sanitaria.operators.distinct import with_distinct_counts
from sanitaria.operators.profile import column_stats, heavy_hitters
from pyspark.sql import functions as F

SCHEMA = (
    "g string, tiny tinyint, small smallint, whole int, real double, text string, day date, at timestamp, "
    "items array<string>, raw binary"
)


def rows_of(n: int) -> list[tuple]:
    r = random.Random(5)
    pick = lambda *v: r.choice(v)
    return [
        (
            pick(None, "a", "b", "c"), pick(None, -128, 0, 5, 127), pick(None, -32_768, -32_767, -1, 0, 1, 32_767),
            pick(None, -(2**31), 0, 2**31 - 1), pick(None, 0.0, -0.0, 1.5, float("nan"), float("inf")), pick(None, "", "null", "é"),
            pick(None, date(2020, 1, 1), date(1900, 1, 1)), pick(None, datetime(2018, 2, 17, 23, 30), datetime(2020, 1, 1)),
            pick(None, [], [None], ["null"], ["a", "b"], ["a,b"]), pick(None, b"", b"\x00", b"\xff"),
        )
        for _ in range(n)
    ]


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_counts_equal_the_engines_own(spark):
    df = spark.createDataFrame(rows_of(700), SCHEMA).repartition(5)
    names = [c for c in df.columns if c != "g"]
    for keys in ([], ["g"], ["g", "tiny"]):
        got = with_distinct_counts(df, keys, [F.count("*").alias("rows")], {f"d_{n}": n for n in names})
        want = df.groupBy(*keys).agg(F.count("*").alias("rows"), *(F.countDistinct(n).alias(f"d_{n}") for n in names))
        assert got.columns == want.columns and "Expand" not in plan(got)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_empty_tables_and_groups_without_values(spark):
    none = spark.createDataFrame([], "g string, a int, b smallint")
    assert with_distinct_counts(none, [], [], {"x": "a", "y": "b"}).collect() == [(0, 0)]
    assert with_distinct_counts(none, ["g"], [], {"x": "a", "y": "b"}).collect() == []
    void = spark.createDataFrame([("k", None, None)], none.schema)
    assert with_distinct_counts(void, ["g"], [], {"x": "a", "y": "b"}).collect() == [("k", 0, 0)]


def test_question_with_several_distinct_counts(spark):
    df = spark.createDataFrame(rows_of(300), SCHEMA)
    distinct = [(c, "count_distinct") for c in ("whole", "text", "day")]
    spec = {"projections": ["g", *distinct, ("real", "count")], "group_by": ["g"], "order_by": ("g", "ASC")}
    got = ask(df, spec)
    assert "Expand" not in plan(got)
    want = df.groupBy("g").agg(F.countDistinct("whole"), F.countDistinct("text"), F.countDistinct("day"), F.count("real"))
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.orderBy(F.col("g").asc_nulls_last()).collect()]


def test_exact_statistics_do_not_copy_rows(spark):
    df = spark.createDataFrame(rows_of(400), SCHEMA)
    got = column_stats(df, exact=True)
    assert "Expand" not in plan(got)
    want = {c: df.select(c).where(F.col(c).isNotNull()).distinct().count() for c in df.columns}
    assert {r["column"]: r.distinct_count for r in got.collect()} == want
    assert column_stats(df.limit(0), exact=True).collect() == []


def test_heavy_hitters_of_many_values(spark):
    # 200 values in geometric steps among 100,000 that occur once or twice; the sketch holds 2,000.
    common = spark.range(200).select(F.expr("explode(sequence(1, 40 + 20 * id))").alias("i"), F.concat(F.lit("v"), "id").alias("x"))
    rare = spark.range(150_000).select(F.concat(F.lit("r"), F.col("id") % 100_000).alias("x"))
    df = common.select("x").unionAll(rare).unionAll(spark.range(99).select(F.lit(None).cast("string"))).repartition(8, F.rand(1))
    got = [tuple(r) for r in heavy_hitters(df, "x", 50, tracked=2_000).collect()]
    want = [(r.x, r["count"]) for r in df.where("x is not null").groupBy("x").count().orderBy(F.desc("count"), "x").limit(50).collect()]
    assert [g[:2] for g in got] == want
    assert all(g[2] for g in got)
    assert heavy_hitters(df.limit(0), "x").collect() == []
    assert [tuple(r)[:2] for r in heavy_hitters(spark.range(4).selectExpr("id % 2 as id"), "id", 5).collect()] == [("0", 2), ("1", 2)]
