import os
import struct

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sanitaria.operators.transform import transform
from sanitaria.sinks import manifest as M
from sanitaria.sources import dimensions as D
from sanitaria.sources.fixed_width import RecordReader, layouts, read_layout, scan_fixed_width
from sanitaria.sources.landing import header_name, scan_landing
from sanitaria.sources.store import scan_store
from sanitaria.operators import stats_cache as S
from sanitaria.sinks.store import insert_new_files
from sanitaria.streaming.ingest import load_batch, load_report, start_ingest


def write_dbf(path, names, rows, deleted=()):
    widths = [max([1, *(len(r[i].encode("latin-1")) for r in rows)]) for i in range(len(names))]
    header = struct.pack("<B3BIHH20x", 3, 124, 1, 1, len(rows), 33 + 32 * len(names), 1 + sum(widths))
    fields = b"".join(struct.pack("<11sc4xBB14x", n.encode(), b"C", w, 0) for n, w in zip(names, widths))
    body = b"".join(
        (b"*" if i in deleted else b" ") + b"".join(v.encode("latin-1").ljust(w) for v, w in zip(row, widths))
        for i, row in enumerate(rows)
    )
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as file:
        file.write(header + fields + b"\r" + body + b"\x1a")


def test_fixed_width_records(spark, root):
    rows = [(f"{i:04d}", "São" if i % 2 else "", "x" * (i % 5)) for i in range(1000)]
    write_dbf(f"{root}/DOSP2020.dbf", ["CODE", "NAME", "EXTRA"], rows, deleted={3, 500})
    write_dbf(f"{root}/DORJ2021.dbf", ["CODE"], [("0001",)])
    got = scan_fixed_width(spark, "sim", root, splitbytes="2000", batchrecords="64").collect()
    assert len(got) == 999 and {(r.uf, r.source_file) for r in got} == {("SP", "DOSP2020.dbc"), ("RJ", "DORJ2021.dbc")}
    by_code = {r.code: r for r in got if r.uf == "SP"}
    assert by_code["0001"].name == "São" and by_code["0002"].name is None and "0003" not in by_code
    assert set(by_code) == {r[0] for i, r in enumerate(rows) if i not in (3, 500)}


def test_fixed_width_splits_cover_every_record(spark, root, monkeypatch):
    path = f"{root}/DOSP2020.dbf"
    write_dbf(path, ["A"], [(f"{i:05d}",) for i in range(777)])
    reader = RecordReader(StructType([StructField("a", StringType())]), {"path": root, "splitbytes": "100"})
    layout = read_layout(path)
    with monkeypatch.context() as closed:
        closed.setattr("sanitaria.sources.fixed_width.read_layout", lambda path: pytest.fail("opened while planning"))
        parts = reader.partitions()
    shares = [p.ranges[0].records(layout) for p in parts]
    assert len(parts) > 10 and [k for share in shares for k in share] == list(range(777)) and layout.width == 6
    assert max(map(len, shares)) - min(map(len, shares)) <= 1
    read = [v for p in parts for batch in reader.read(p) for v in batch.column(0).to_pylist()]
    assert read == [f"{i:05d}" for i in range(777)]
    packed = RecordReader(StructType([StructField("a", StringType())]), {"path": root}).partitions()
    assert len(packed) == 1 and packed[0].ranges[0].parts == 1


def test_fixed_width_headers_are_read_by_tasks(spark, root, monkeypatch):
    rows = [("1", "2")]
    for year in range(2000, 2006):
        write_dbf(f"{root}/DOSP{year}.dbf", ["A", "B"] if year < 2004 else ["B", "C"], rows)
    found = {tuple(r.names): (r.first.rsplit("/", 1)[1], r.files) for r in layouts(spark, root).collect()}
    assert found == {("a", "b"): ("DOSP2000.dbf", 4), ("b", "c"): ("DOSP2004.dbf", 2)}
    monkeypatch.setattr("sanitaria.sources.fixed_width.field_names", lambda path: pytest.fail("opened by the driver"))
    scanned = scan_fixed_width(spark, "sim", root, StructType([StructField(n, StringType()) for n in ("b", "__file")]))
    assert sorted(r.b for r in scanned.collect()) == ["1"] * 2 + ["2"] * 4
    monkeypatch.undo()
    assert scan_fixed_width(spark, "sim", root).columns[:3] == ["a", "b", "c"]
    os.makedirs(f"{root}-none")
    assert scan_fixed_width(spark, "sim", f"{root}-none").count() == 0


def test_header_names():
    assert header_name(" MUNIC\x00_RES\n") == "munic_res"


def land(root, name, text):
    os.makedirs(root, exist_ok=True)
    with open(f"{root}/{name}", "w") as file:
        file.write(text)


def test_landing_groups_are_united_by_name(spark, root):
    land(f"{root}/a", "RDSP2001.csv", "MUNIC_RES;SEXO\n350600;1\n; \n")
    land(f"{root}/b", "RDRJ2002.csv", "SEXO;VAL_TOT\n3;12.5\n")
    rows = scan_landing(spark, "sihsus", [[f"{root}/a"], [f"{root}/b"]]).collect()
    assert {(r.uf, r.source_file, r.munic_res, r.sexo, r.val_tot) for r in rows} == {
        ("SP", "RDSP2001.dbc", "350600", "1", None), ("SP", "RDSP2001.dbc", None, None, None),
        ("RJ", "RDRJ2002.dbc", None, "3", "12.5"),
    }


def test_landing_files_are_read_by_their_own_headers(spark, root):
    land(root, "RDSP2001.csv", "MUNIC_RES;SEXO\n350600;1\n")
    land(root, "RDSP2002.csv", "SEXO;MUNIC_RES;NOVA\n3;355030;x\n")
    land(root, "RDSP2003.csv", "")
    rows = scan_landing(spark, "sihsus", [root]).collect()
    assert {(r.source_file, r.munic_res, r.sexo, r.nova) for r in rows} == {
        ("RDSP2001.dbc", "350600", "1", None), ("RDSP2002.dbc", "355030", "3", "x"),
    }


def test_stream_reads_by_header_and_encoding(spark, root):
    landing, store = f"{root}/in", f"{root}/store"
    land(f"{landing}/a", "DOSP2020.csv", "sexo;racacor;dtobito\n1;2;20200101\n")
    land(f"{landing}/b", "DOSP2020.csv", "dtobito;extra;sexo\n20200102;x;2\n")
    start_ingest(spark, f"{landing}/*", store, "sim", f"{root}/log", max_files=1, encoding="ISO-8859-1").awaitTermination()
    rows = scan_store(spark, store, "sim").collect()
    assert {(str(r.dtobito), r.sexo, r.racacor) for r in rows} == {("2020-01-01", "M", "Preta"), ("2020-01-02", "F", "Ignorado")} or {
        (str(r.dtobito), r.sexo) for r in rows
    } == {("2020-01-01", "M"), ("2020-01-02", "F")}
    assert M.listed_pieces(spark, store, "sim").count() == 2 and M.listed_files(spark, store, "sim").count() == 1


def test_stream_restarts_without_duplicates(spark, root):
    landing, store, log = f"{root}/in", f"{root}/store", f"{root}/log"
    land(landing, "DOSP2020.csv", "dtobito;sexo\n20200101;1\n20200102;2\n")
    run = lambda: start_ingest(spark, landing, store, "sim", log).awaitTermination()
    run()
    run()
    assert scan_store(spark, store, "sim").count() == 2
    land(landing, "DORJ2020.csv", "dtobito;sexo\n20200103;1\n")
    run()
    rows = scan_store(spark, store, "sim").collect()
    assert {(r.uf, r.sexo) for r in rows} == {("SP", "M"), ("SP", "F"), ("RJ", "M")}
    assert M.listed_files(spark, store, "sim").count() == 2
    # A lost checkpoint replays all files; the manifest keeps them from loading twice.
    start_ingest(spark, landing, store, "sim", log + "2").awaitTermination()
    assert scan_store(spark, store, "sim").count() == 3


def test_load_repairs_a_half_written_file(spark, root):
    raw = spark.createDataFrame(
        [("SP", "RDSP2001.dbc", "300", "1"), ("SP", "RDSP2001.dbc", "20", "3"), ("SP", "RDSP2001.dbc", "30", "1")],
        "uf string, source_file string, idade string, sexo string",
    )
    insert_new_files(transform(raw.limit(1), "sihsus"), root, "sihsus")
    assert scan_store(spark, root, "sihsus").count() == 1 and M.listed_files(spark, root, "sihsus").count() == 0
    assert load_batch(raw, root, "sihsus", audit=True) == 3
    assert scan_store(spark, root, "sihsus").count() == 3
    assert [r.source_file for r in M.listed_files(spark, root, "sihsus").collect()] == ["RDSP2001.dbc"]
    assert load_batch(raw, root, "sihsus") == 0 and scan_store(spark, root, "sihsus").count() == 3
    more = raw.limit(1).withColumn("source_file", F.lit("RDSP2002.dbc"))
    assert load_batch(more, root, "sihsus", batch=1, audit=True, statistics=True) == 1
    newest = load_report(spark, root).first()
    assert (newest.batch, newest.files, newest.rows, newest.lost_values, newest.unplaced) == (1, 1, 1, 1, 0)
    assert newest.bytes > 0 and S.fresh_stats(spark, root, "sihsus") is not None


def test_reload_replaces_exactly_the_file(spark, root):
    landing = f"{root}/in"
    land(landing, "RDSP2001.csv", "MUNIC_RES;SEXO\n350600;1\n350601;1\n")
    land(landing, "RDRJ2001.csv", "MUNIC_RES;SEXO\n330455;3\n")
    store = f"{root}/store"
    assert load_batch(scan_landing(spark, "sihsus", [landing]), store, "sihsus") == 3
    land(f"{root}/new", "RDSP2001.csv", "MUNIC_RES;SEXO\n355030;3\n")
    corrected = scan_landing(spark, "sihsus", [f"{root}/new"])
    assert load_batch(corrected, store, "sihsus", batch=1, reload=True) == 1
    assert {(r.uf, r.munic_res, r.sexo) for r in scan_store(spark, store, "sihsus").collect()} == {("SP", 355030, "F"), ("RJ", 330455, "F")}
    assert load_batch(corrected, store, "sihsus", batch=2) == 0
    M.remove_files(corrected.select("source_file"), store, "sihsus")
    assert load_batch(corrected, store, "sihsus", batch=3) == 1 and scan_store(spark, store, "sihsus").count() == 2


def test_raw_loads_have_a_store_of_their_own(spark, root):
    raw = spark.createDataFrame([("SP", "RDSP2001.dbc", "x")], "uf string, source_file string, idade string")
    assert load_batch(raw, root, "sihsus", raw=True) == 1 and load_batch(raw, root, "sihsus") == 1
    assert scan_store(spark, root, "sihsus").first().idade is None
    assert scan_store(spark, f"{root}/raw", "sihsus", merge_schema=True).first().idade == "x"


def test_municipality_list(spark):
    raw = spark.createDataFrame(
        [("35", "São Paulo", "Inter", "Imed", "3550308", " São Paulo "), ("x", "Nowhere", "a", "b", "12345", "?"), ("35", "Piauí", "I2", "J2", "3550308", "Later")],
        ["UF", "Nome_UF", "Nome Região Geográfica Intermediária", "Nome Região Geográfica Imediata", "Código Município Completo", "Nome_Município"],
    )
    built = D.build_municipalities(raw)
    first = built.first()
    assert (first.uf, first.sigla_uf, first.codigo_municipio_6_digitos, first.nome_municipio) == (35, "SP", 355030, "São Paulo")
    lookup = {r.codigo_municipio: r for r in D.municipality_lookup(built).collect()}
    assert list(lookup) == [355030] and (lookup[355030].nome, lookup[355030].uf) == ("Later", "Piauí")


def test_dimension_tables(spark, root):
    land(root, "d.csv", "code;label\n1;a\n2;b\n")
    for name in ("dim_cid10",):
        spark.sql(f"drop table if exists {name}")
        assert D.load_dimension(spark, name, root) == 2
        assert D.load_dimension(spark, name, root, replace=False) == 4
        assert D.load_dimension(spark, name, root) == 2
        status = {r.dimension: (r.row_count, r.loaded) for r in D.dimension_status(spark).collect()}
        assert status["dim_cid10"] == (2, True) and status["dim_ocupacoes"] == (-1, False)
        spark.sql(f"drop table {name}")
    view = D.register_csv(spark, root, "landed_csv")
    assert dict(view.dtypes) == {"code": "int", "label": "string"}
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        D.register_csv(spark, root, "landed_csv", replace=False)
