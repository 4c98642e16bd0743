"""Lines that are no rows: where they go, and what the report says."""

import os

from sanitaria.sources.landing import scan_checked, scan_landing
from sanitaria.sources.store import scan_store
from sanitaria.streaming.ingest import failures_path, load_files, load_report, rejected_lines


def write(folder, name, data):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "wb") as file:
        file.write(data if isinstance(data, bytes) else data.encode())


SP = 'CODMUNRES;SEXO;IDADE\n355030;1;401\n355031;3;EXTRA;9\n\n355032\n"355;033";2;"4""01"\n355034;2;\n355031;3;EXTRA;9\n'


def test_every_line_is_a_row_or_rejected(spark, root):
    write(root, "DOSP2020.csv", SP)
    write(root, "DORJ2020.csv", b"SEXO;CODMUNRES\r\n1;330455\r\n2;33\xff0455\r\n1;2;3\r\n")
    write(root, "DOMG2020.csv", "\n")
    found = scan_checked(spark, "sim", [root])
    rows = sorted((r["uf"], r["codmunres"]) for r in found.rows.collect())
    assert rows == [("RJ", "330455"), ("SP", "355030"), ("SP", "355034"), ("SP", "355;033")]
    bad = sorted((r["source_file"], r["line"], r["reason"], r["text"]) for r in found.rejected.collect())
    assert bad == [
        ("DORJ2020.dbc", 3, "bytes", "2;33�0455"), ("DORJ2020.dbc", 4, "fields", "1;2;3"),
        ("DOSP2020.dbc", 3, "fields", "355031;3;EXTRA;9"), ("DOSP2020.dbc", 4, "fields", "355032"),
        ("DOSP2020.dbc", 7, "fields", "355031;3;EXTRA;9"),
    ]
    assert [(p.split("/")[-1], r) for p, r in found.failed] == [("DOMG2020.csv", "no header")]
    assert scan_landing(spark, "sim", [root]).count() == 4


def test_other_encodings(spark, root):
    write(root, "DOSP2020.csv", "CODMUNRES;SEXO\n355030;São\n355031\n".encode("latin-1"))
    found = scan_checked(spark, "sim", [root], encoding="ISO-8859-1")
    assert [r["sexo"] for r in found.rows.collect()] == ["São"]
    assert [(r["line"], r["text"]) for r in found.rejected.collect()] == [(3, "355031")]


def test_blocks_of_one_file_are_counted_on(spark, root):
    lines = ["CODMUNRES;SEXO", *(f"{k};1" if k % 50 else f"{k};1;more" for k in range(1, 2_001))]
    write(root, "DOSP2020.csv", "\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        found = scan_checked(spark, "sim", [root])
        assert sorted(r["line"] for r in found.rejected.collect()) == [k + 1 for k in range(50, 2_001, 50)]
        assert found.rows.count() == 1_960
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_loads_keep_and_replace_what_they_reject(spark, root):
    landing = f"{root}/in"
    write(landing, "DOSP2020.csv", SP)
    assert load_files(spark, root, "sim", [landing]) == 3
    report = load_report(spark, root).collect()
    assert [(r["files"], r["rows"], r["rejected"], r["failed"]) for r in report] == [(1, 3, 3, 0)]
    assert rejected_lines(spark, root, "sim").count() == 3
    write(landing, "DOSP2020.csv", "CODMUNRES;SEXO;IDADE\n355030;1;401\n1;2\n")
    write(landing, "DOMG2020.csv", "\n")
    assert load_files(spark, root, "sim", [landing]) == 0  # loaded before
    assert rejected_lines(spark, root, "sim").count() == 3
    assert load_files(spark, root, "sim", [landing], reload=True) == 1
    assert [(r["line"], r["text"]) for r in rejected_lines(spark, root, "sim").collect()] == [(3, "1;2")]
    assert scan_store(spark, root, "sim").count() == 1
    assert spark.read.parquet(failures_path(root)).where("reason = 'no header'").count() == 2


def test_nothing_to_reject_and_nothing_to_load(spark, root):
    write(root, "DOMG2020.csv", "\n")
    found = scan_checked(spark, "sim", [root])
    assert found.rows.count() == 0 and found.rejected.count() == 0 and len(found.failed) == 1
