"""The query library over canonical admissions and deaths."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import registry as R
from checks import views as V
from checks.registry import register
from sanitaria.plans import death, explore, hospital


def _hospital(name, plan, sql):
    register(name, f"WITH {R.ADMISSIONS} {sql}")(lambda spark, sf: plan(R.admissions(spark, sf)))


def _death(name, plan, sql):
    register(name, f"WITH {R.DEATHS} {sql}")(lambda spark, sf: plan(R.deaths(spark, sf)))


_MONEY = "round(sum(CAST(val_tot AS DOUBLE)), 2)"
_YM = "CAST(year({0}) AS INTEGER) AS ano, CAST(month({0}) AS INTEGER) AS mes"
_BAND = """CASE WHEN {0} < 1 THEN '0-1 ano' WHEN {0} BETWEEN 1 AND 4 THEN '1-4 anos'
  WHEN {0} BETWEEN 5 AND 14 THEN '5-14 anos' WHEN {0} BETWEEN 15 AND 24 THEN '15-24 anos'
  WHEN {0} BETWEEN 25 AND 44 THEN '25-44 anos' WHEN {0} BETWEEN 45 AND 64 THEN '45-64 anos' ELSE '65+ anos' END"""

_hospital(
    "q_h1_admissions_by_state", hospital.admissions_by_state,
    f"SELECT uf, count(*) AS total, {_MONEY} AS valor_total FROM adm GROUP BY uf",
)
_hospital(
    "q_h2_monthly_series", hospital.monthly_series,
    f"SELECT {_YM.format('dt_inter')}, count(*) AS internacoes, {_MONEY} AS valor_total FROM adm "
    "WHERE dt_inter IS NOT NULL GROUP BY 1, 2",
)
_hospital(
    "q_h3_top_diagnoses", hospital.top_diagnoses,
    "SELECT diag_princ, count(*) AS total FROM adm WHERE diag_princ IS NOT NULL GROUP BY diag_princ "
    "ORDER BY total DESC, diag_princ LIMIT 10",
)
_hospital(
    "q_h4_top_procedures", hospital.top_procedures,
    f"SELECT proc_rea, count(*) AS total, {_MONEY} AS valor FROM adm WHERE proc_rea IS NOT NULL GROUP BY proc_rea "
    "ORDER BY total DESC, proc_rea LIMIT 10",
)
_hospital(
    "q_h5_by_sex", hospital.by_sex,
    "SELECT sexo, count(*) AS total, round(avg(dias_perm), 1) AS media_dias FROM adm WHERE sexo IS NOT NULL GROUP BY sexo",
)
_hospital(
    "q_h6_by_age", hospital.by_age,
    f"SELECT {_BAND.format('idade')} AS faixa_etaria, count(*) AS total FROM adm WHERE idade IS NOT NULL GROUP BY 1",
)
_hospital(
    "q_h7_stay_by_state", hospital.stay_by_state,
    "SELECT uf, count(*) AS internacoes, round(avg(dias_perm), 1) AS media_dias, max(dias_perm) AS max_dias FROM adm "
    "WHERE dias_perm IS NOT NULL GROUP BY uf",
)
_hospital(
    "q_h8_value_by_month", hospital.value_by_month,
    f"SELECT {_YM.format('dt_inter')}, {_MONEY} AS valor_total, count(*) AS internacoes FROM adm "
    "WHERE dt_inter IS NOT NULL GROUP BY 1, 2",
)
_hospital(
    "q_h9_respiratory_by_month", hospital.respiratory_by_month,
    """, daily AS (SELECT dt_inter AS data, count(diag_princ) AS total_cids FROM adm
         WHERE diag_princ LIKE 'J%' AND dt_inter >= DATE '2000-01-01' GROUP BY dt_inter),
       scored AS (SELECT data, total_cids,
         (total_cids - avg(total_cids) OVER ()) / nullif(stddev(total_cids) OVER (), 0) AS z FROM daily)
       SELECT CAST(date_trunc('month', data) AS DATE) AS mes, CAST(sum(total_cids) AS BIGINT) AS total_cids_mes
       FROM scored WHERE abs(z) <= 2.0 GROUP BY 1""",
)
_death("q_d1_deaths_by_state", death.deaths_by_state, "SELECT uf, count(*) AS total FROM dth GROUP BY uf")
_death(
    "q_d2_monthly_series", death.monthly_series,
    f"SELECT {_YM.format('dtobito')}, count(*) AS obitos FROM dth WHERE dtobito IS NOT NULL GROUP BY 1, 2",
)
register(
    "q_d3_top_causes",
    f"WITH {R.DEATHS}, top AS (SELECT causabas, count(*) AS total FROM dth WHERE causabas IS NOT NULL GROUP BY causabas "
    "ORDER BY total DESC, causabas LIMIT 10) SELECT array_to_string(causabas, '|') AS causabas, total FROM top",
)(
    lambda spark, sf: death.top_causes(R.deaths(spark, sf)).select(
        F.array_join("causabas", "|").alias("causabas"), "total"
    )
)
_death("q_d4_by_sex", death.by_sex, "SELECT sexo, count(*) AS total FROM dth WHERE sexo IS NOT NULL GROUP BY sexo")
_death(
    "q_d5_by_age", death.by_age,
    ", aged AS (SELECT CASE WHEN idade_unidade = 'anos' THEN CAST(idade_valor AS INTEGER) "
    "WHEN idade_unidade IN ('minutos', 'horas', 'meses') AND idade_valor IS NOT NULL THEN 0 END AS years FROM dth) "
    f"SELECT {_BAND.format('years')} AS faixa_etaria, count(*) AS total FROM aged WHERE years IS NOT NULL GROUP BY 1",
)
_death(
    "q_d6_by_place", death.by_place,
    "SELECT lococor, count(*) AS total FROM dth WHERE lococor IS NOT NULL GROUP BY lococor",
)
_death("q_d7_by_schooling", death.by_schooling, "SELECT esc, count(*) AS total FROM dth WHERE esc IS NOT NULL GROUP BY esc")
_death(
    "q_d8_by_race", death.by_race,
    "SELECT racacor, count(*) AS total FROM dth WHERE racacor IS NOT NULL GROUP BY racacor",
)
_hospital(
    "agg_03_monthly_trends", explore.monthly_trends,
    f"SELECT {_YM.format('dt_inter')}, count(*) AS total_internacoes, "
    f"round(avg(dias_perm), 2) AS media_dias_internacao, {_MONEY} AS valor_total, "
    "round(avg(CAST(val_tot AS DOUBLE)), 2) AS valor_medio FROM adm WHERE dt_inter IS NOT NULL GROUP BY 1, 2",
)
_hospital(
    "agg_05_demographics", explore.demographics,
    "SELECT sexo, CASE WHEN idade < 18 THEN '0-17' WHEN idade BETWEEN 18 AND 59 THEN '18-59' ELSE '60+' END "
    "AS faixa_etaria, count(*) AS total, round(avg(dias_perm), 2) AS media_dias, "
    "round(avg(CAST(val_tot AS DOUBLE)), 2) AS valor_medio FROM adm WHERE idade IS NOT NULL GROUP BY 1, 2",
)
_hospital(
    "agg_07_basic_totals", explore.basic_totals,
    "SELECT count(*) AS total_internacoes, count(DISTINCT munic_res) AS total_municipios, "
    "CAST(sum(qt_diarias) AS BIGINT) AS total_diarias, round(avg(CAST(val_tot AS DOUBLE)), 2) AS valor_medio, "
    "round(max(CAST(val_tot AS DOUBLE)), 2) AS valor_maximo FROM adm",
)
_hospital(
    "agg_08_intensive_care", explore.intensive_care,
    "SELECT sexo, CASE WHEN marca_uti = 1 THEN 'Com UTI' ELSE 'Sem UTI' END AS utilizou_uti, count(*) AS total_casos, "
    "round(avg(dias_perm), 2) AS media_dias, round(avg(CAST(val_uti AS DOUBLE)), 2) AS valor_medio_uti, "
    "round(avg(CAST(val_tot AS DOUBLE)), 2) AS valor_medio_total FROM adm WHERE sexo IS NOT NULL GROUP BY 1, 2",
)
_death(
    "agg_09_by_chapter", death.by_chapter,
    ", codes AS (SELECT unnest(causabas) AS code FROM dth WHERE causabas IS NOT NULL) "
    "SELECT left(code, 1) AS icd_chapter, count(*) AS deaths FROM codes GROUP BY 1 ORDER BY deaths DESC, 1 LIMIT 10",
)
_hospital(
    "agg_10_rows_per_file", explore.rows_per_file,
    "SELECT source_file, count(*) AS row_count FROM adm GROUP BY source_file",
)
_hospital("agg_10_rows_per_state", explore.rows_per_state, "SELECT uf, count(*) AS row_count FROM adm GROUP BY uf")
_hospital(
    "agg_10_file_totals", explore.file_totals,
    "SELECT count(*) AS row_count, count(DISTINCT source_file) AS source_files FROM adm",
)
_hospital(
    "win_02_top_procedures_per_month", explore.top_procedures_per_month,
    """, counts AS (SELECT CAST(month(dt_inter) AS INTEGER) AS mes, proc_rea, count(*) AS quantidade FROM adm
         WHERE proc_rea IS NOT NULL AND dt_inter IS NOT NULL GROUP BY 1, 2),
       ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY mes ORDER BY quantidade DESC, proc_rea) AS INTEGER)
         AS rank FROM counts) SELECT mes, proc_rea, quantidade, rank FROM ranked WHERE rank <= 3""",
)
_hospital(
    "srt_01_top_municipalities", explore.top_municipalities,
    "SELECT munic_res AS codigo_municipio, count(*) AS total_internacoes, round(avg(dias_perm), 2) AS media_dias, "
    f"{_MONEY} AS valor_total FROM adm WHERE munic_res IS NOT NULL GROUP BY munic_res "
    "ORDER BY total_internacoes DESC, munic_res LIMIT 10",
)


@register(
    "win_01_daily_outliers",
    """WITH daily AS (SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2),
         scored AS (SELECT *, (n - avg(n) OVER ()) / nullif(stddev(n) OVER (), 0) AS z FROM daily)
       SELECT CAST(date_trunc('month', day) AS DATE) AS month, CAST(sum(n) AS BIGINT) AS total FROM scored
       WHERE abs(z) <= 2.0 GROUP BY 1""",
)
def daily_outliers(spark, sf):
    """The outlier filter over the event stream table."""
    events = V.table(spark, sf, "events")
    daily = events.groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    spread = daily.agg(F.avg("n").alias("mean"), F.stddev("n").alias("deviation"))
    score = F.try_divide(F.col("n") - spread.select("mean").scalar(), spread.select("deviation").scalar())
    kept = daily.where(F.abs(score) <= 2.0)
    return kept.groupBy(F.trunc("day", "MM").alias("month")).agg(F.sum("n").alias("total"))
