"""Cleaning, typing and decoding, row by row over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import registry as R
from checks import views as V
from checks.registry import register
from sanitaria.functions import columns as C
from sanitaria.operators import transform as X
from sanitaria.systems import DEATH, HOSPITAL


def _typed(spark, sf):
    return X.transform(V.admissions(spark, sf), HOSPITAL)


def _typed_deaths(spark, sf):
    return X.transform(V.deaths(spark, sf), DEATH)


def _admission(*columns):
    return lambda spark, sf: _typed(spark, sf).selectExpr(*columns)


def _death(*columns):
    return lambda spark, sf: _typed_deaths(spark, sf).selectExpr(*columns)


def _joined(name):
    return f"array_join({name}, '|') AS {name}"


@register(
    "prj_01_clean",
    f"""SELECT doc_id, md5({R.sql_clean('text')}) AS text_md5, length({R.sql_clean('text')}) AS n_chars,
        {R.sql_clean('lang')} AS lang FROM documents
        UNION ALL SELECT page_id, md5({R.sql_clean('html')}), length({R.sql_clean('html')}), NULL FROM pages""",
)
def clean_texts(spark, sf):
    """Whole document and page texts."""
    def cleaned(name, key, text, lang):
        body = C.clean(F.col(text))
        return V.dealt(V.table(spark, sf, name)).select(
            F.col(key).alias("doc_id"),
            F.md5(body.cast("binary")).alias("text_md5"),
            F.length(body).cast("bigint").alias("n_chars"),
            lang.alias("lang"),
        )

    documents = cleaned("documents", "doc_id", "text", C.clean(F.col("lang")))
    return documents.unionByName(cleaned("pages", "page_id", "html", F.lit(None).cast("string")))


register(
    "prj_02_parse_date",
    f"WITH {R.ADMISSIONS_CLEAN} SELECT dt_inter AS raw_date, {R.sql_date('dt_inter')} AS parsed, "
    f"{R.sql_date('dt_inter', True)} AS parsed_any FROM adm_clean",
)(
    lambda spark, sf: V.admissions(spark, sf)
    .select(C.clean(F.col("dt_inter")).alias("raw_date"))
    .select(
        "raw_date",
        C.parse_date(F.col("raw_date")).alias("parsed"),
        C.parse_date(F.col("raw_date"), allow_future=True).alias("parsed_any"),
    )
)

register(
    "prj_03_date_columns",
    f"WITH {R.ADMISSIONS} SELECT source_file, dt_inter, dt_saida, CAST(NULL AS DATE) AS nasc, "
    "CAST(NULL AS DATE) AS gestor_dt FROM adm",
)(_admission("source_file", "dt_inter", "dt_saida", "nasc", "gestor_dt"))

register(
    "prj_04_numbers",
    f"WITH {R.ADMISSIONS} SELECT munic_res, idade, dias_perm, uti_mes_to, qt_diarias, cbor, "
    "round(CAST(val_tot AS DOUBLE), 2) AS val_tot FROM adm",
)(
    _admission(
        "munic_res", "idade", "dias_perm", "uti_mes_to", "qt_diarias", "cbor",
        "round(cast(val_tot AS double), 2) AS val_tot",
    )
)
register(
    "prj_04_unsigned",
    f"WITH {R.DEATHS} SELECT source_file, idade, idade_valor, nudiasobco FROM dth",
)(_death("source_file", "idade", "idade_valor", "nudiasobco"))
register("prj_05_boolean", f"WITH {R.ADMISSIONS} SELECT source_file, morte FROM adm")(_admission("source_file", "morte"))
register(
    "prj_06_boolean_maps", f"WITH {R.DEATHS} SELECT source_file, acidtrab, tppos, stcodifica FROM dth"
)(_death("source_file", "acidtrab", "tppos", "stcodifica"))
register("prj_07_time", f"WITH {R.DEATHS} SELECT source_file, horaobito FROM dth")(_death("source_file", "horaobito"))
register(
    "prj_08_diagnosis_code", f"WITH {R.ADMISSIONS} SELECT source_file, diag_princ, diagsec1 FROM adm"
)(_admission("source_file", "diag_princ", "diagsec1"))
register(
    "prj_09_diagnosis_list",
    f"WITH {R.DEATHS} SELECT source_file, array_to_string(causabas, '|') AS causabas, "
    "array_to_string(linhaa, '|') AS linhaa FROM dth",
)(_death("source_file", _joined("causabas"), _joined("linhaa")))
register("prj_10_sex_hospital", f"WITH {R.ADMISSIONS} SELECT source_file, sexo FROM adm")(
    _admission("source_file", "sexo")
)
register("prj_10_sex_death", f"WITH {R.DEATHS} SELECT source_file, sexo FROM dth")(_death("source_file", "sexo"))
register("prj_11_race_hospital", f"WITH {R.ADMISSIONS} SELECT source_file, raca_cor FROM adm")(
    _admission("source_file", "raca_cor")
)
register("prj_11_race_death", f"WITH {R.DEATHS} SELECT source_file, racacor FROM dth")(
    _death("source_file", "racacor")
)
register("prj_12_age_value", f"WITH {R.DEATHS} SELECT idade, idade_valor FROM dth")(_death("idade", "idade_valor"))
register("prj_13_age_unit", f"WITH {R.DEATHS} SELECT idade, idade_unidade FROM dth")(_death("idade", "idade_unidade"))


def _label_sql():
    parts = [f"{R.sql_recode(c, DEATH.labels[c])} AS {c}_desc" for c in ("tipobito", "estciv", "lococor", "esc")]
    return f"WITH {R.DEATHS} SELECT source_file, {', '.join(parts)} FROM dth"


@register("prj_14_labels", _label_sql())
def labels(spark, sf):
    from sanitaria.operators.enrich import with_labels

    rows = _typed_deaths(spark, sf).select("source_file", "tipobito", "estciv", "lococor", "esc")
    return with_labels(rows, DEATH).select("source_file", *[f"{c}_desc" for c in ("tipobito", "estciv", "lococor", "esc")])


register(
    "prj_15_canonical",
    f"WITH {R.ADMISSIONS} SELECT uf, count(*) AS n, count(munic_res) AS munic_res, count(diag_princ) AS diag_princ, "
    "CAST(0 AS BIGINT) AS absent, CAST(113 AS INTEGER) AS columns FROM adm GROUP BY uf",
)(
    lambda spark, sf: (lambda rows: rows.groupBy("uf").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("munic_res").alias("munic_res"),
        F.count("diag_princ").alias("diag_princ"),
        F.count("n_aih").alias("absent"),
        F.lit(len(rows.columns)).alias("columns"),
    ))(_typed(spark, sf))
)


@register(
    "prj_16_file_order",
    f"WITH {R.DEATHS} SELECT uf, count(*) AS n, 0::BIGINT AS out_of_order FROM dth GROUP BY uf",
)
def file_order(spark, sf):
    """Every file of a written store has its rows by death date, missing dates last."""
    from pyspark.sql import Window

    from sanitaria.session import scratch_dir
    from sanitaria.sinks.store import write_store
    from sanitaria.sources.store import store_path

    root = scratch_dir(spark, "prj16")
    write_store(_typed_deaths(spark, sf), root, "sim")
    stored = spark.read.parquet(store_path(root, "sim")).select(
        "uf", "dtobito", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    )
    day = F.coalesce("dtobito", F.lit("9999-12-31").cast("date"))
    before = F.lag(day).over(Window.partitionBy("file").orderBy("row"))
    return stored.withColumn("wrong", before > day).groupBy("uf").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("wrong").alias("out_of_order")
    )


register(
    "prj_18_dated_with_year",
    f"WITH {R.ADMISSIONS} SELECT CAST(year(dt_inter) AS INTEGER) AS ano_inter, count(*) AS n FROM adm "
    "WHERE dt_inter IS NOT NULL OR dt_saida IS NOT NULL GROUP BY 1",
)(
    lambda spark, sf: X.transform(V.admissions(spark, sf), HOSPITAL, with_year=True, drop_undated=True)
    .groupBy("ano_inter")
    .agg(F.count(F.lit(1)).alias("n"))
)


def _upper_sql(c):
    text = c
    for code, to in ((9, " "), (10, " "), (13, " "), (0, ""), (12, "")):
        text = f"replace({text}, chr({code}), '{to}')"
    return f"trim(upper({text}))"


register(
    "prj_19_clean_upper",
    f"SELECT conv_id, turn, md5({_upper_sql('text')}) AS text_md5, {_upper_sql('role')} AS role FROM conversations",
)(
    lambda spark, sf: V.table(spark, sf, "conversations").select(
        "conv_id",
        "turn",
        F.md5(C.clean_upper(F.col("text")).cast("binary")).alias("text_md5"),
        C.clean_upper(F.col("role")).alias("role"),
    )
)

register(
    "prj_20_transform_hospital",
    f"WITH {R.ADMISSIONS} SELECT uf, source_file, munic_res, sexo, raca_cor, dt_inter, dt_saida, diag_princ, diagsec1, "
    "idade, dias_perm, proc_rea, morte, round(CAST(val_tot AS DOUBLE), 2) AS val_tot, marca_uti FROM adm",
)(
    _admission(
        "uf", "source_file", "munic_res", "sexo", "raca_cor", "dt_inter", "dt_saida", "diag_princ", "diagsec1",
        "idade", "dias_perm", "proc_rea", "morte", "round(cast(val_tot AS double), 2) AS val_tot",
        "marca_uti",
    )
)
register(
    "prj_20_transform_death",
    f"WITH {R.DEATHS} SELECT uf, source_file, dtobito, horaobito, idade_valor, idade_unidade, sexo, racacor, estciv, "
    "codmunres, array_to_string(causabas, '|') AS causabas, acidtrab, nudiasobco FROM dth",
)(
    _death(
        "uf", "source_file", "dtobito", "horaobito", "idade_valor", "idade_unidade", "sexo", "racacor", "estciv",
        "codmunres", _joined("causabas"), "acidtrab", "nudiasobco",
    )
)
register(
    "snk_13_raw_mode",
    f"WITH {R.ADMISSIONS_CLEAN} SELECT uf, sexo, dt_inter, val_tot, CAST(NULL AS DATE) AS nasc FROM adm_clean",
)(
    lambda spark, sf: X.transform(V.admissions(spark, sf), HOSPITAL, raw=True).select(
        "uf", "sexo", "dt_inter", "val_tot", "nasc"
    )
)


def _loss_sql():
    typed = {
        "munic_res": "munic_res", "dt_inter": "dt_inter", "dias_perm": "dias_perm", "uti_mes_to": "uti_mes_to",
        "val_tot": "val_tot", "diag_princ": "diag_princ", "cbor": "cbor",
    }
    parts = [
        f"SELECT '{c}' AS \"column\", (SELECT count({c}) FROM adm_clean) AS present, "
        f"(SELECT count({c}) FROM adm_clean) - (SELECT count({c}) FROM adm) AS lost"
        for c in typed
    ]
    return f"WITH {R.ADMISSIONS} " + " UNION ALL ".join(parts)


@register("cov_11_cast_losses", _loss_sql())
def cast_losses(spark, sf):
    raw = V.admissions(spark, sf).select(
        "munic_res", "dt_inter", "dias_perm", "uti_mes_to", "val_tot", "diag_princ", "cbor"
    )
    return X.cast_losses(raw, HOSPITAL)
