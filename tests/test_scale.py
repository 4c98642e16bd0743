"""What keeps work and memory of a task bounded when tables grow."""

import glob
import os

from pyspark.sql import functions as F

from checks import registry, storage, views
from checks.landing_files import write_named_files
from sanitaria.functions import columns as C
from sanitaria.operators.transform import clean_columns, transform
from sanitaria.sinks.store import write_store
from sanitaria.sources.store import scan_store, store_layout


def test_cleaning_searches_every_value_once(spark):
    rows = spark.createDataFrame([("\t a\x00 ", " "), (None, "é\n"), ("", "x")], "A string, b string")
    cleaned = clean_columns(rows)
    plan = cleaned._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("translate(") == 2
    assert [tuple(r) for r in cleaned.collect()] == [("a", None), (None, "é"), (None, "x")]


def test_missing_columns_are_added_behind_the_sort(spark, root):
    raw = spark.createDataFrame(
        [("SP", "DOSP2015.dbc", "02012015"), ("SP", "DOSP2015.dbc", "01012015"), (None, "DOXX2015.dbc", None), ("", "x", None)],
        "uf string, source_file string, dtobito string",
    ).coalesce(1)
    narrow = transform(raw, "sim", fill=False)
    assert narrow.columns == ["uf", "source_file", "dtobito"] or set(narrow.columns) == {"uf", "source_file", "dtobito"}
    assert write_store(narrow, f"{root}/a", "sim", fill=True) == 4
    assert write_store(transform(raw, "sim"), f"{root}/b", "sim") == 4
    a, b = (scan_store(spark, f"{root}/{x}", "sim", filename=False) for x in "ab")
    assert a.schema == b.schema and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert a.where("uf IS NULL").count() == 2
    stored = spark.read.parquet(f"{root}/a/sim/uf=SP")
    assert [r.dtobito.day for r in stored.orderBy(F.col("_metadata.row_index")).collect()] == [1, 2]
    assert len(stored.columns) == len(a.columns) - 1
    assert store_layout(spark, f"{root}/a", "sim") == "state" and store_layout(spark, f"{root}/c", "sim") is None


def test_a_task_writes_one_landing_file_of_a_name(spark, tmp_path):
    rows = spark.range(25_000, numPartitions=1).select(
        F.lit("SP").alias("uf"), F.concat(F.lit("DOSP201"), F.col("id") % 2, F.lit(".dbc")).alias("source_file"),
        F.col("id").cast("string").alias("idade"),
    )
    folder = write_named_files(rows, str(tmp_path / "in"), "csv")
    files = glob.glob(f"{folder}/*/*.csv")
    found = spark.read.csv(files, header=True)
    assert found.count() == 25_000 and found.distinct().count() == 25_000
    assert len(files) <= 4  # two names; a batch is 10,000 rows


def test_dealt_tasks_stay_bounded(spark, monkeypatch):
    monkeypatch.setattr(views, "DEALT_ROWS", 100)
    assert views.dealt(spark.range(5_000)).rdd.getNumPartitions() == 50


def test_a_query_loads_only_the_systems_it_reads(spark, monkeypatch):
    monkeypatch.setattr(registry, "_STORES", {})
    folder = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
    registry.admissions(spark, folder)
    root = registry.store(spark, folder, "sihsus")
    assert store_layout(spark, root, "sihsus") == "state" and store_layout(spark, root, "sim") is None
    assert not glob.glob(f"{root.removeprefix('file:')}/ibge*")
    rows = registry.admissions(spark, folder).count()
    assert registry.store(spark, folder) == root and store_layout(spark, root, "sim") == "state"
    assert registry.admissions(spark, folder).count() == rows == views.table(spark, folder, "orders").count()
    assert registry.municipalities(spark, folder).count() > 0


def test_stored_rows_are_written_again_without_the_columns_they_lack(spark, monkeypatch):
    written = []
    monkeypatch.setattr(storage, "write_store", lambda df, *a, **k: written.append((df.columns, k)) or write_store(df, *a, **k))
    folder = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
    assert storage.write_modes(spark, folder).count() > 0
    assert [k["fill"] for _, k in written] == [True] * 3
    assert all(set(columns) == set(registry._ADMISSION_COLUMNS) for columns, _ in written)


def test_a_code_list_is_split_once(spark):
    rows = spark.createDataFrame([("*a01/b342*bad",), ("x",), (None,)], "c string")
    found = rows.select(C.diagnosis_list(F.col("c")).alias("c"))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    assert [r.c for r in found.collect()] == [["A01", "B342"], None, None]
