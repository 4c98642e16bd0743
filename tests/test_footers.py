"""Footer statistics and per-file sketches on small stores."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from sanitaria.operators import profile as P
from sanitaria.operators import sketches as K
from sanitaria.operators.stats_cache import cached_stats, fresh_stats
from sanitaria.sinks.store import write_store
from sanitaria.sources.footers import footer_facts
from sanitaria.sources.store import data_files, scan_store

DEATHS = "uf string, source_file string, codmunres int, dtobito date, causabas array<string>, idade string"


def deaths(spark, rows):
    return spark.createDataFrame(rows, DEATHS).withColumn("dtobito", F.col("dtobito").cast("date"))


def by_column(stats, *names):
    return {r["column"]: tuple(r[n] for n in names) for r in stats.collect()}


def test_fill_of_footers_follows_the_array_rule(spark, root):
    rows = [("SP", "DOSP2020.dbc", k if k % 5 else None, None, [["A00"], None, [], [None]][k % 4], "401") for k in range(20)]
    write_store(deaths(spark, rows), root, "sim")
    write_store(deaths(spark, [("RJ", "DORJ2020.dbc", 7, None, ["B11"], None)]), root, "sim")
    stats = P.footer_stats(spark, root, "sim")
    found = by_column(stats, "row_count", "fill_pct", "min", "max", "scanned")
    assert found["codmunres"] == (21, round(17 / 21 * 100, 2), "1", "19", False)
    assert found["causabas"] == (21, round(11 / 21 * 100, 2), None, None, True)  # NULL and [] count as null, [NULL] does not
    assert found["uf"] == (21, 100.0, "RJ", "SP", False)
    assert found["dtobito"] == (21, 0.0, None, None, False) and found["idade"][1] == 95.24
    exact = by_column(P.column_stats(scan_store(spark, root, "sim", filename=False)), "row_count", "fill_pct")
    assert {k: v[:2] for k, v in found.items()} == exact


def test_full_arrays_need_no_scan(spark, root):
    write_store(deaths(spark, [("SP", "DOSP2020.dbc", 1, None, ["A00", "B11"], "1")] * 3), root, "sim")
    assert by_column(P.footer_stats(spark, root, "sim"), "fill_pct", "scanned")["causabas"] == (100.0, False)


def test_footers_are_read_by_tasks_without_rows(spark, root):
    write_store(deaths(spark, [("SP", "DOSP2020.dbc", 1, None, None, "1")]), root, "sim")
    plan = footer_facts(data_files(spark, root, "sim"))._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" in plan and "FileScan parquet" not in plan and "content" not in plan.split("ReadSchema")[-1]


def test_files_without_statistics_or_without_a_column_are_scanned_or_null(spark, root):
    os.makedirs(f"{root}/sim/uf=SP")
    table = pa.table({"source_file": ["DOSP2020.dbc"] * 4, "codmunres": pa.array([1, None, 3, 4], pa.int32())})
    pq.write_table(table, f"{root}/sim/uf=SP/a.parquet", write_statistics=False)
    pq.write_table(table.select(["source_file"]), f"{root}/sim/uf=SP/b.parquet")
    found = by_column(P.footer_stats(spark, root, "sim"), "row_count", "fill_pct", "scanned")
    assert found["codmunres"] == (8, 37.5, True) and found["source_file"] == (8, 100.0, True) and found["idade"] == (8, 0.0, False)


def test_no_store(spark, root):
    assert P.footer_stats(spark, root, "sim").count() == 0
    assert K.refresh_sketches(spark, root, "sim") == 0


def test_sketches_follow_the_files(spark, root):
    load = lambda name, n: write_store(
        deaths(spark, [(name[2:4], name, k, None, None, str(k % 3)) for k in range(n)]), root, "sim", "replace", by_file=True
    )
    load("DOSP2020.dbc", 40), load("DORJ2020.dbc", 10)
    assert K.refresh_sketches(spark, root, "sim") == len(data_files(spark, root, "sim").collect())
    assert by_column(K.merged_stats(spark, root, "sim"), "row_count", "distinct_count")["codmunres"] == (50, 40)
    load("DOSP2020.dbc", 5)  # written again: its sketches no longer count
    assert by_column(K.merged_stats(spark, root, "sim"), "row_count")["codmunres"] == (10,)
    assert 0 < K.refresh_sketches(spark, root, "sim") <= 5
    found = by_column(K.merged_stats(spark, root, "sim"), "row_count", "distinct_count", "q50")
    assert found["codmunres"][:2] == (15, 10) and found["idade"] == (15, 3, None)
    before = sorted(map(tuple, K.merged_stats(spark, root, "sim").collect()), key=str)
    K.compact_sketches(spark, root, "sim")
    assert len(os.listdir(K.sketches_path(root, "sim"))) == 1
    assert sorted(map(tuple, K.merged_stats(spark, root, "sim").collect()), key=str) == before
    assert K.refresh_sketches(spark, root, "sim") == 0


def test_cached_statistics_come_from_sketches(spark, root):
    rows = deaths(spark, [("SP", "DOSP2020.dbc", k, None, None, None) for k in range(9)])
    write_store(rows, root, "sim")
    assert fresh_stats(spark, root, "sim") is None
    assert by_column(cached_stats(spark, root, "sim"), "row_count", "distinct_count")["codmunres"] == (9, 9)
    assert fresh_stats(spark, root, "sim") is not None and K.refresh_sketches(spark, root, "sim") == 0
