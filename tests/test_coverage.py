from datetime import date

import pytest
from pyspark.sql import functions as F

from sanitaria.operators import coverage as K
from sanitaria.sources.inventory import select_landing_files, with_period


def files(spark, *names, system="sihsus"):
    rows = spark.createDataFrame([(n, 1000) for n in names], "name string, size_bytes bigint")
    return with_period(rows, system)


@pytest.mark.parametrize(
    "names, missing",
    [
        (("RDSP1801.dbc", "RDSP1802.dbc", "RDSP1803.dbc"), 0),
        (("RDSP1801.dbc", "RDSP1802.dbc", "RDSP1804.dbc"), 1),
        (("RDSP1212.dbc", "RDSP1401.dbc"), 12),
        (("RDSP1801.dbc", "RDSP1804.dbc", "RDSP1806.dbc"), 3),
        ((), 0),
        (("RDSP1801.dbc", "garbage.dbc", "RDSP1803.dbc"), 1),
        (("RDSP9912.dbc", "RDSP0001.dbc"), 0),
        (("RDSP1804.dbc", "RDSP1801.dbc", "RDSP1802.dbc"), 1),
    ],
)
def test_missing_months(spark, names, missing):
    table = files(spark, *names)
    assert K.missing_periods(table, "sihsus", by=None).first()[0] == missing
    assert K.missing_period_list(table, "sihsus").count() == missing


def test_yearly_systems_miss_years(spark):
    table = files(spark, "DOSP2010.dbc", "DOSP2013.dbc", system="sim")
    assert K.missing_periods(table, "sim").first().missing_periods == 2
    assert {r.year for r in K.missing_period_list(table, "sim").collect()} == {2011, 2012}


def test_updates_ignore_case(spark):
    available = files(spark, "RDSP2001.dbc", "RDSP2002.dbc")
    processed = files(spark, "rdsp2001.dbc")
    assert [r.name for r in K.new_files(available, processed).collect()] == ["RDSP2002.DBC"]
    line = K.update_summary(available, processed).first()
    assert (line.processed_count, line.available_count, line.new_count, line.is_up_to_date) == (1, 2, 1, False)
    assert K.update_summary(processed, available).first().is_up_to_date


def test_selection(spark):
    listing = spark.createDataFrame(
        [
            ("/dissemin/publicos/SIHSUS/200801_/Dados/", "RDSP0801.dbc"),
            ("/dissemin/publicos/SIHSUS/199201_200712/Dados/", "RDSP0802.dbc"),
            ("/dissemin/publicos/SIHSUS/200801_/Dados/", "RDRJ0803.DBC"),
            ("/dissemin/publicos/SIHSUS/200801_/Dados/", "RDSP0803.txt"),
        ],
        "folder string, name string",
    )
    chosen = select_landing_files(listing, "sihsus", date(2008, 1, 1), date(2008, 12, 31))
    assert {r.name for r in chosen.collect()} == {"RDSP0801.dbc", "RDRJ0803.DBC"}
    only = spark.createDataFrame([("rdrj0803.dbc",)], "name string")
    assert [r.name for r in select_landing_files(listing, "sihsus", date(2008, 1, 1), date(2008, 12, 31), only=only).collect()] == ["RDRJ0803.DBC"]
    assert select_landing_files(listing, "sihsus", date(2008, 1, 2), date(2008, 2, 28), ["SP"]).count() == 0
    with pytest.raises(ValueError):
        select_landing_files(listing, "sihsus", date(2008, 2, 1), date(2008, 1, 1))


def test_yearly_selection_by_overlap(spark):
    listing = spark.createDataFrame([("DOSP2015.dbc",), ("DORSP95.dbc",), ("DOSP2016.dbc",)], "name string")
    chosen = select_landing_files(listing, "sim", date(2015, 6, 1), date(2015, 7, 1))
    assert [r.name for r in chosen.collect()] == ["DOSP2015.dbc"]


def test_estimates(spark):
    table = files(spark, "RDSP2001.dbc", "RDSP2002.dbc", "RDRJ2001.dbc", "RDRJ2003.dbc")
    total = K.estimate_scope(table).first()
    assert (total.file_count, total.download_bytes, total.store_bytes, total.csv_bytes) == (4, 4000, 2400, 12000)
    rows = {r.uf: r for r in K.estimate_by_uf(table).collect()}
    assert rows["SP"].store_bytes == 1200 and rows["RJ"].last_period == "2020-03"
    assert K.estimate_scope(table.where("false")).first().download_bytes == 0
    assert K.estimate_unsized(table, "sim").first().download_bytes == 4 * 5 * 1024 * 1024


def test_timeline(spark):
    table = files(spark, "RDSP2001.dbc", "RDRJ2001.dbc", "RDSP2002.dbc")
    assert [(r.period, r.files) for r in K.timeline(table).collect()] == [("2020-01", 2), ("2020-02", 1)]
    by_state = {r.uf: r for r in K.coverage_by_uf(table.withColumn("x", F.lit(1)), "sihsus").collect()}
    assert by_state["SP"].missing_periods == 0 and by_state["SP"].size_bytes == 2000
