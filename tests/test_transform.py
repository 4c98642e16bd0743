from datetime import date

import pytest
from pyspark.sql import functions as F

from sanitaria.operators.enrich import with_labels, with_loaded_municipality, with_municipality
from sanitaria.operators.transform import cast_losses, transform
from sanitaria.systems import DEATH, HOSPITAL, get_system, system_names

STAGING = "UF string, SOURCE_FILE string, MUNIC_RES string, SEXO string, IDADE string, VAL_TOT string, DT_INTER string"


def staging(spark):
    return spark.createDataFrame(
        [
            ("SP", "RDSP2001.dbc", "350600", "M", " 45", "1500.50", "20200115"),
            ("RJ", "RDRJ2002.dbc", "330455", "3", "300", "x", "15022020"),
            ("MG", "RDMG2003.dbc", None, "1", "28\t", "1200", "bad"),
        ],
        STAGING,
    )


def test_registry():
    assert sorted(system_names()) == ["sihsus", "sim"]
    assert len(HOSPITAL.fields) == 113 and len(DEATH.fields) == 91
    assert get_system("SIM").residence == "codmunres" and get_system("sihsus").residence == "munic_res"
    assert HOSPITAL.date_columns == ["nasc", "dt_inter", "dt_saida", "gestor_dt"]
    assert len(DEATH.date_columns) == 11 and len(HOSPITAL.code_columns) == 14
    assert len(DEATH.columns_of("array<string>")) == 8 and len(DEATH.columns_of("boolean")) == 7
    assert len(HOSPITAL.columns_of("float")) == 18 and len(HOSPITAL.columns_of("tinyint")) == 38
    with pytest.raises(ValueError):
        get_system("nothing")


def test_every_row_is_kept_in_canonical_shape(spark):
    result = transform(staging(spark), "sihsus")
    assert result.columns == list(HOSPITAL.fields) and result.schema == HOSPITAL.schema
    rows = {r.uf: r for r in result.collect()}
    assert rows["SP"].sexo is None and rows["RJ"].sexo == "F" and rows["MG"].sexo == "M"
    assert [rows[u].idade for u in ("SP", "RJ", "MG")] == [45, None, 28]
    assert rows["SP"].dt_inter == date(2020, 1, 15) and rows["RJ"].dt_inter == date(2020, 2, 15)
    assert rows["MG"].dt_inter is None and rows["RJ"].val_tot is None and rows["SP"].val_tot == 1500.5
    assert rows["SP"].n_aih is None


def test_raw_mode_only_cleans(spark):
    result = transform(staging(spark), "sihsus", raw=True)
    assert result.columns == list(HOSPITAL.fields)
    assert dict(result.dtypes)["idade"] == "string" and dict(result.dtypes)["cnes"] == "int"
    assert {r.idade for r in result.collect()} == {"45", "300", "28"}


def test_undated_rows_can_be_dropped(spark):
    result = transform(staging(spark), "sihsus", drop_undated=True, with_year=True)
    assert {(r.uf, r.ano_inter) for r in result.select("uf", "ano_inter").collect()} == {("SP", 2020), ("RJ", 2020)}


def test_death_columns(spark):
    raw = spark.createDataFrame(
        [("SP", "DOSP2020.dbc", "401", "*A01*J128", "0905", "1", "3550308", "1", "070000")],
        "uf string, source_file string, idade string, causabas string, horaobito string, acidtrab string, "
        "codmunres string, lococor string, nudiasobco string",
    )
    row = with_labels(transform(raw, "sim"), "sim").first()
    assert (row.idade, row.idade_valor, row.idade_unidade) == ("401", 1, "anos")
    assert row.causabas == ["A01", "J128"] and row.horaobito == "09:05:00" and row.acidtrab is True
    assert row.nudiasobco is None and row.sexo is None and row.lococor_desc == "hospital" and row.esc_desc is None


def test_cast_losses(spark):
    losses = {r.column: (r.present, r.lost) for r in cast_losses(staging(spark), "sihsus").collect()}
    assert losses["idade"] == (3, 1) and losses["val_tot"] == (3, 1) and losses["munic_res"] == (2, 0)


def dimension(spark):
    return spark.createDataFrame(
        [(355030, "SP", "Sao Paulo", "Imediata", "Inter"), (330455, "RJ", "Rio", "I2", "X2")],
        "codigo_municipio_6_digitos int, sigla_uf string, nome_municipio string, "
        "nome_regiao_geografica_imediata string, nome_regiao_geografica_intermediaria string",
    )


@pytest.mark.parametrize("codes", [(355030, 999999), (3550308, 999999)])
def test_enrichment(spark, codes):
    facts = spark.createDataFrame([(c,) for c in codes], "codmunres int")
    rows = {r.codmunres: r for r in with_municipality(facts, dimension(spark), "codmunres").collect()}
    assert (rows[codes[0]].uf_res, rows[codes[0]].municipio_res) == ("SP", "Sao Paulo")
    assert rows[999999].uf_res is None and len(rows) == 2


def test_enrichment_without_dimension(spark):
    facts = spark.createDataFrame([(355030,)], "munic_res int")
    assert with_municipality(facts, None, "munic_res").columns == ["munic_res"]
    empty = spark.createDataFrame([], "codigo_municipio int, nome string, uf string, regiao_imediata string, regiao_intermediaria string")
    assert with_loaded_municipality(facts, empty, "munic_res").columns == ["munic_res"]


def test_admission_options_need_admission_dates(spark):
    raw = spark.createDataFrame([("SP", "DOSP2020.dbc", "20200101")], "uf string, source_file string, dtobito string")
    for option in ("drop_undated", "with_year"):
        with pytest.raises(ValueError, match="dates"):
            transform(raw, "sim", **{option: True})
