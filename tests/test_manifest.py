import os
from concurrent.futures import ThreadPoolExecutor

from sanitaria.sinks import manifest as M


def names(spark, *files):
    return spark.createDataFrame([(f,) for f in files], "source_file string")


def listed(spark, root, system="sihsus"):
    return sorted(r.source_file for r in M.listed_pieces(spark, root, system).collect())


def test_writers_at_once_lose_no_event(spark, root, monkeypatch):
    monkeypatch.setattr(M, "SUM_EVERY", 4)  # sums are taken between the writes
    files = [f"RDSP{k:04d}.dbc" for k in range(10)]
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda f: M.add_files(names(spark, f), root, "sihsus"), files))
    assert listed(spark, root) == files
    assert len(M._numbers(spark, M.events_path(root))) == len(files)
    M.sum_up(spark, root)
    assert listed(spark, root) == files


def test_a_number_is_given_once(spark, root):
    with ThreadPoolExecutor(16) as pool:
        numbers = sorted(pool.map(lambda _: M.claim(spark, root), range(64)))
    assert numbers == list(range(1, 65))


def test_sums_keep_the_order_of_events_and_what_is_under_way(spark, root):
    M.add_files(names(spark, "RDSP2001.dbc", "RDRJ2001.dbc"), root, "sihsus")
    M.remove_files(names(spark, "RDSP2001.dbc"), root, "sihsus")
    late = M.claim(spark, root)  # a writer that has its number and no events yet
    M.add_files(names(spark, "RDMG2001.dbc"), root, "sihsus")
    M.sum_up(spark, root)
    assert listed(spark, root) == ["RDMG2001.dbc", "RDRJ2001.dbc"]
    row = [("sihsus", "RDAC2001.dbc", None, "add", None, late)]
    spark.createDataFrame(row, M.SCHEMA).write.parquet(f"{M.events_path(root)}/{late}")
    assert listed(spark, root) == ["RDAC2001.dbc", "RDMG2001.dbc", "RDRJ2001.dbc"]
    M.sum_up(spark, root)
    M.sum_up(spark, root)
    assert listed(spark, root) == ["RDAC2001.dbc", "RDMG2001.dbc", "RDRJ2001.dbc"] and listed(spark, root, "sim") == []
    M.add_files(names(spark, "RDSP2001.dbc"), root, "sihsus")
    M.clear(spark, root, "sihsus")
    M.add_files(names(spark, "RDSP2001.dbc"), root, "sihsus")
    M.sum_up(spark, root)
    assert listed(spark, root) == ["RDSP2001.dbc"]


def test_reading_opens_the_sum_and_what_came_after(spark, root):
    for k in range(4):
        M.add_files(names(spark, f"RDSP200{k}.dbc"), root, "sihsus")
    M.sum_up(spark, root)
    M.add_files(names(spark, "RDSP2009.dbc"), root, "sihsus")
    opened = {os.path.basename(os.path.dirname(f)) for f in M.listed_pieces(spark, root, "sihsus").inputFiles()}
    assert opened == {"5", "6"}  # the sum is number 5, the last event number 6


def test_older_logs_are_taken_over(spark, root):
    old = [("sihsus", "RDSP1999.dbc", None, "add", None, 1_700_000_000_000_000), ("sihsus", "RDRJ1999.dbc", None, "add", None, 7)]
    spark.createDataFrame(old, M.SCHEMA).write.parquet(M.manifest_path(root))
    M.remove_files(names(spark, "RDSP1999.dbc"), root, "sihsus")
    assert listed(spark, root) == ["RDRJ1999.dbc"]
    M.sum_up(spark, root)
    assert listed(spark, root) == ["RDRJ1999.dbc"]
