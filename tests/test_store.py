import pytest
from pyspark.sql import functions as F

from sanitaria.operators import stats_cache as S
from sanitaria.operators.coverage import overview, storage_stats
from sanitaria.operators.profile import dictionary
from sanitaria.sinks import manifest as M
from sanitaria.sinks.store import insert_new_files, write_store
from sanitaria.sources.inventory import with_period
from sanitaria.sources.store import data_files, municipality_path, register_views, scan_store

FACTS = "uf string, source_file string, munic_res int, val_tot float"


def facts(spark, *names):
    return spark.createDataFrame([(n[2:4], n, 355030, 1.0) for n in names], FACTS)


def test_drifted_columns_are_united_by_name(spark, root):
    write_store(spark.createDataFrame([("SP", "350600", 100, "x")], "uf string, munic_res string, val_tot int, sp_only_col string"), root, "sihsus")
    write_store(spark.createDataFrame([("RJ", "330455", 200)], "uf string, munic_res string, val_tot int"), root, "sihsus")
    rows = {r.uf: r for r in scan_store(spark, root, "sihsus", merge_schema=True).collect()}
    assert rows["SP"].sp_only_col == "x" and rows["RJ"].sp_only_col is None
    assert "uf=SP" in rows["SP"].filename
    assert [r.uf for r in scan_store(spark, root, "sihsus", ufs=["rj"], merge_schema=True).collect()] == ["RJ"]


def test_missing_store_is_an_error(spark, root):
    with pytest.raises(ValueError):
        scan_store(spark, root, "sim")


def test_state_filter_prunes_partitions(spark, root):
    write_store(facts(spark, "RDSP2001.dbc", "RDRJ2001.dbc"), root, "sihsus")
    plan = scan_store(spark, root, "sihsus", ufs=["SP"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(uf" in plan or "PartitionFilters: [uf" in plan


def test_files_are_inserted_once(spark, root):
    assert insert_new_files(facts(spark, "RDSP2001.dbc", "RDRJ2001.dbc"), root, "sihsus") == 2
    assert insert_new_files(facts(spark, "rdsp2001.dbc", "RDSP2002.dbc"), root, "sihsus") == 1
    assert insert_new_files(facts(spark, "RDSP2001.dbc", "RDSP2002.dbc"), root, "sihsus") == 0
    assert scan_store(spark, root, "sihsus").count() == 3


def test_replace_swaps_only_the_states_at_hand(spark, root):
    write_store(facts(spark, "RDSP2001.dbc", "RDRJ2001.dbc"), root, "sihsus")
    write_store(facts(spark, "RDSP2002.dbc"), root, "sihsus", mode="replace", compression="gzip")
    assert {r.source_file for r in scan_store(spark, root, "sihsus").collect()} == {"RDSP2002.dbc", "RDRJ2001.dbc"}
    with pytest.raises(ValueError):
        write_store(facts(spark, "RDSP2002.dbc"), root, "sihsus", mode="merge")


def test_a_store_has_one_layout(spark, root):
    write_store(facts(spark, "RDSP2001.dbc"), root, "sihsus")
    with pytest.raises(ValueError, match="laid out"):
        insert_new_files(facts(spark, "RDSP2002.dbc"), root, "sihsus")


def test_manifest_order_does_not_trust_clocks(spark, root, monkeypatch):
    names = lambda *n: spark.createDataFrame([(x,) for x in n], "source_file string")
    later = F.lit("2999-01-01").cast("timestamp")
    monkeypatch.setattr(M.F, "current_timestamp", lambda: later)
    M.add_files(names("RDSP2001.dbc", "RDSP2002.dbc"), root, "sihsus")
    monkeypatch.setattr(M.F, "current_timestamp", lambda: F.lit("1999-01-01").cast("timestamp"))
    M.remove_files(names("RDSP2001.dbc"), root, "sihsus")
    assert [r.source_file for r in M.listed_files(spark, root, "sihsus").collect()] == ["RDSP2002.dbc"]
    M.clear(spark, root, "sihsus")
    assert M.listed_files(spark, root, "sihsus").count() == 0


def test_one_hot_state_is_split_over_tasks(spark, root):
    """A state far above the advisory size must not be written by one task."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        hot = spark.range(200_000, numPartitions=8).select(
            F.lit("SP").alias("uf"), F.lit("RDSP2001.dbc").alias("source_file"), F.rand(1).alias("x"), F.rand(2).alias("y")
        )
        assert write_store(hot, root, "sihsus", rebalance=True) == 200_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert data_files(spark, root, "sihsus").count() > 3


def test_manifest(spark, root):
    def listed():
        return [(r.uf, r.position, r.source_file) for r in M.listed_files(spark, root, "sihsus").orderBy("uf", "position").collect()]

    names = lambda *n: spark.createDataFrame([(x,) for x in n], "source_file string")
    assert listed() == []
    M.migrate_list(spark, ["RDSP2002.dbc", "RDSP9912.dbc", "RDSPxxxx.dbc"], root, "sihsus")
    M.add_files(names("RDRJ2001.dbc", "RDSP2002.dbc"), root, "sihsus")
    assert listed() == [("RJ", 1, "RDRJ2001.dbc"), ("SP", 1, "RDSP9912.dbc"), ("SP", 2, "RDSP2002.dbc"), ("SP", 3, "RDSPxxxx.dbc")]
    M.remove_files(names("RDSP2002.dbc"), root, "sihsus")
    assert ("SP", 2, "RDSPxxxx.dbc") in listed() and M.listed_files(spark, root, "sim").count() == 0
    M.clear(spark, root, "sihsus")
    assert listed() == []
    M.add_files(names("RDSP2002.dbc"), root, "sihsus")
    assert listed() == [("SP", 1, "RDSP2002.dbc")]


def test_processed_files_fall_back_to_the_store(spark, root):
    write_store(facts(spark, "RDSP2001.dbc", "RDRJ2001.dbc"), root, "sihsus")
    assert {r[0] for r in M.processed_files(spark, root, "sihsus").collect()} == {"RDSP2001.dbc", "RDRJ2001.dbc"}
    M.add_files(spark.createDataFrame([("RDSP2001.dbc",)], "source_file string"), root, "sihsus")
    assert {r[0] for r in M.processed_files(spark, root, "sihsus").collect()} == {"RDSP2001.dbc"}


def test_stats_cache_follows_files_and_version(spark, root, monkeypatch):
    write_store(facts(spark, "RDSP2001.dbc"), root, "sihsus")
    assert S.fresh_stats(spark, root, "sihsus") is None
    assert S.cached_stats(spark, root, "sihsus").where("column = 'munic_res'").first().fill_pct == 100
    assert S.fresh_stats(spark, root, "sihsus") is not None
    monkeypatch.setattr(S, "STATS_VERSION", 99)
    assert S.fresh_stats(spark, root, "sihsus") is None
    monkeypatch.undo()
    write_store(facts(spark, "RDRJ2001.dbc"), root, "sihsus")
    assert S.fresh_stats(spark, root, "sihsus") is None


def test_views_and_dictionary(spark, root):
    write_store(facts(spark, "RDSP2001.dbc", "RDRJ2001.dbc"), root, "sihsus")
    spark.createDataFrame(
        [(355030, "SP", "Sao Paulo", "I", "X")],
        "codigo_municipio_6_digitos int, sigla_uf string, nome_municipio string, "
        "nome_regiao_geografica_imediata string, nome_regiao_geografica_intermediaria string",
    ).write.parquet(municipality_path(root))
    assert register_views(spark, root) == ["ibge_locais", "sihsus_all", "sihsus"]
    assert spark.sql("select municipio_res from sihsus").first()[0] == "Sao Paulo"
    spark.createDataFrame([("A", "b")], "code string, label string").createOrReplaceTempView("sihsus_dim_diag")
    tree = dictionary(
        spark, "sihsus", S.cached_stats(spark, root, "sihsus"), spark.table("ibge_locais"),
        descriptions=spark.createDataFrame([("munic_res", "Residence")], "column string, description string"),
    ).collect()
    views = {(r.view, r.role) for r in tree}
    assert views == {("sihsus", "main"), ("sihsus_dim_diag", "dim")}
    by_name = {r.column: r for r in tree}
    assert by_name["munic_res"].fill_pct == 100 and not by_name["munic_res"].fill_pct_approx
    assert by_name["munic_res"].description == "Residence"
    assert by_name["municipio_res"].fill_pct_approx and by_name["municipio_res"].distinct_count == 1


def test_store_listing(spark, root):
    write_store(facts(spark, "RDSP2001.dbc", "RDRJ2001.dbc"), root, "sihsus")
    files = data_files(spark, root, "sihsus")
    assert {r.uf: r.files for r in storage_stats(files).collect()} == {"SP": 1, "RJ": 1}
    named = with_period(facts(spark, "RDSP2001.dbc", "RDRJ1903.dbc").select(F.col("source_file").alias("name"), F.lit(10).alias("size_bytes")), "sihsus")
    line = overview(named, "sihsus", scan_store(spark, root, "sihsus")).first()
    assert (line.files, line.size_bytes, line.states, line.first_period, line.last_period, line.row_count) == (2, 20, 2, "2019-03", "2020-01", 2)
