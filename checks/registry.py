"""Registration of queries next to the SQL that checks them, and SQL pieces they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks import views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            CHECKS[name] = sql
        return query

    return keep


def sql_clean(c: str) -> str:
    text = c
    for code in (9, 10, 13, 0, 12):
        text = f"replace({text}, chr({code}), '')"
    return f"nullif(trim({text}), '')"


def sql_date(c: str, future: bool = False) -> str:
    def reading(guard: str, text: str, layout: str) -> str:
        day = f"CAST(try_strptime({text}, '{layout}') AS DATE)"
        limit = "" if future else f" AND {day} <= current_date"
        return f"CASE WHEN regexp_full_match({c}, '{guard}'){limit} THEN {day} END"

    return (
        f"coalesce({reading('[0-9]{8}', c, '%Y%m%d')}, {reading('[0-9]{8}', c, '%d%m%Y')}, "
        f"{reading('[0-9]{7}', chr(39) + '0' + chr(39) + ' || ' + c, '%d%m%Y')}, "
        f"{reading('[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}', c, '%Y-%m-%d')})"
    )


def sql_code(c: str) -> str:
    code = f"replace(upper({c}), '.', '')"
    return f"CASE WHEN regexp_full_match({code}, '[A-Z][0-9]{{2,3}}') THEN {code} END"


def sql_codes(c: str) -> str:
    kept = (
        f"list_filter(string_split(replace(upper(trim({c})), '/', '*'), '*'), "
        "lambda x: regexp_full_match(x, '[A-Z][0-9]{2,3}'))"
    )
    return f"CASE WHEN len({kept}) > 0 THEN {kept} END"


def sql_recode(c: str, mapping: dict[str, str], default: str = "NULL") -> str:
    cases = " ".join(f"WHEN '{code}' THEN '{label}'" for code, label in mapping.items())
    return f"CASE CAST({c} AS VARCHAR) {cases} ELSE {default} END"


def sql_flag(c: str, true: str, false: str) -> str:
    return f"CASE WHEN {c} IN ({true}) THEN TRUE WHEN {c} IN ({false}) THEN FALSE END"


SEX_HOSPITAL = {"0": "I", "1": "M", "3": "F"}
SEX_DEATH = {"M": "M", "1": "M", "F": "F", "2": "F", "I": "I", "0": "I", "9": "I"}
RACE_HOSPITAL = {"01": "Branca", "02": "Preta", "03": "Parda", "04": "Amarela", "05": "Indigena"}
RACE_DEATH = {"1": "Branca", "2": "Preta", "3": "Amarela", "4": "Parda", "5": "Indigena"}
AGE_UNIT = {"1": "minutos", "2": "horas", "3": "meses", "4": "anos", "5": "anos", "9": "ignorado"}

_ADMISSION_COLUMNS = (
    "uf source_file munic_res sexo raca_cor dt_inter dt_saida diag_princ diagsec1 idade dias_perm proc_rea morte "
    "val_tot val_uti marca_uti uti_mes_to qt_diarias cbor"
).split()
_DEATH_COLUMNS = (
    "uf source_file dtobito horaobito idade sexo racacor estciv esc lococor tipobito codmunres causabas linhaa "
    "acidtrab tppos stcodifica nudiasobco"
).split()

ADMISSIONS_RAW = f"adm_raw AS ({views.ADMISSIONS})"
DEATHS_RAW = f"dth_raw AS ({views.DEATHS})"
ADMISSIONS_CLEAN = (
    f"{ADMISSIONS_RAW}, adm_clean AS (SELECT "
    + ", ".join(f"{sql_clean(c)} AS {c}" for c in _ADMISSION_COLUMNS)
    + " FROM adm_raw)"
)
DEATHS_CLEAN = (
    f"{DEATHS_RAW}, dth_clean AS (SELECT "
    + ", ".join(f"{sql_clean(c)} AS {c}" for c in _DEATH_COLUMNS)
    + " FROM dth_raw)"
)
ADMISSIONS = f"""{ADMISSIONS_CLEAN}, adm AS (SELECT uf, source_file,
  TRY_CAST(munic_res AS INTEGER) AS munic_res,
  {sql_recode('sexo', SEX_HOSPITAL)} AS sexo,
  {sql_recode('raca_cor', RACE_HOSPITAL, "'Ignorado'")} AS raca_cor,
  {sql_date('dt_inter')} AS dt_inter, {sql_date('dt_saida')} AS dt_saida,
  {sql_code('diag_princ')} AS diag_princ, {sql_code('diagsec1')} AS diagsec1,
  TRY_CAST(idade AS TINYINT) AS idade, TRY_CAST(dias_perm AS SMALLINT) AS dias_perm, proc_rea,
  {sql_flag('morte', "'1','true','TRUE'", "'0','false','FALSE'")} AS morte,
  TRY_CAST(val_tot AS FLOAT) AS val_tot, TRY_CAST(val_uti AS FLOAT) AS val_uti,
  TRY_CAST(marca_uti AS TINYINT) AS marca_uti, TRY_CAST(uti_mes_to AS TINYINT) AS uti_mes_to,
  TRY_CAST(qt_diarias AS SMALLINT) AS qt_diarias, TRY_CAST(cbor AS SMALLINT) AS cbor
  FROM adm_clean)"""
_UNIT = "substring(idade, 1, 1)"
_NUMBER = "TRY_CAST(substring(idade, 2, 2) AS SMALLINT)"
SQL_AGE_VALUE = (
    f"CASE WHEN length(trim(idade)) < 3 OR {_UNIT} IN ('0', '9') THEN NULL "
    f"WHEN {_UNIT} = '5' THEN {_NUMBER} + 100 ELSE {_NUMBER} END"
)
SQL_AGE_UNIT = f"CASE WHEN length(trim(idade)) >= 3 THEN {sql_recode(_UNIT, AGE_UNIT)} END"
SQL_TIME = (
    "CASE WHEN regexp_full_match(horaobito, '([01][0-9]|2[0-3]):?[0-5][0-9]') "
    "THEN left(horaobito, 2) || ':' || right(horaobito, 2) || ':00' END"
)
DEATHS = f"""{DEATHS_CLEAN}, dth AS (SELECT uf, source_file,
  {sql_date('dtobito')} AS dtobito, {SQL_TIME} AS horaobito, idade,
  CAST({SQL_AGE_VALUE} AS SMALLINT) AS idade_valor, {SQL_AGE_UNIT} AS idade_unidade,
  {sql_recode('sexo', SEX_DEATH, "'I'")} AS sexo,
  {sql_recode('racacor', RACE_DEATH, "'Ignorado'")} AS racacor,
  TRY_CAST(estciv AS TINYINT) AS estciv, TRY_CAST(esc AS TINYINT) AS esc, TRY_CAST(lococor AS TINYINT) AS lococor,
  TRY_CAST(tipobito AS TINYINT) AS tipobito, TRY_CAST(codmunres AS INTEGER) AS codmunres,
  {sql_codes('causabas')} AS causabas, {sql_codes('linhaa')} AS linhaa,
  {sql_flag('acidtrab', "'1'", "'2'")} AS acidtrab, {sql_flag('tppos', "'1','S'", "'2','N'")} AS tppos,
  {sql_flag('stcodifica', "'S'", "'N'")} AS stcodifica,
  CAST(TRY_CAST(nudiasobco AS USMALLINT) AS INTEGER) AS nudiasobco
  FROM dth_clean)"""
MUNICIPALITIES = f"muni AS ({views.MUNICIPALITIES})"
FILES = f"""files AS (SELECT name, size_bytes, substr(name, 3, 2) AS uf,
  CAST(substr(name, 5, 2) AS INTEGER) + CASE WHEN CAST(substr(name, 5, 2) AS INTEGER) >= 92 THEN 1900 ELSE 2000 END
  AS year, CAST(substr(name, 7, 2) AS INTEGER) AS month FROM ({views.INVENTORY}))"""
DEATH_FILES = f"""files AS (SELECT name, size_bytes, substr(name, 3, 2) AS uf,
  CAST(substr(name, 5, 4) AS INTEGER) AS year, CAST(NULL AS INTEGER) AS month FROM ({views.DEATH_INVENTORY}))"""


_STORES: dict[tuple[str, str], tuple[str, set[str]]] = {}


def store(spark: SparkSession, sf_dir: str, *parts: str) -> str:
    """Folder of a store loaded from the derived raw rows, each part written once per application.

    The library queries run where users run them: over loaded, state-partitioned
    Parquet.  The load itself is registered as queries of its own.  ``parts`` are the systems and
    the municipality table that the caller reads; without any, all are there.
    """
    from sanitaria.operators.transform import transform
    from sanitaria.session import scratch_dir
    from sanitaria.sinks.store import write_store
    from sanitaria.sources.store import MUNICIPALITY_VIEW, municipality_path

    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORES:
        _STORES[key] = scratch_dir(spark, "store"), set()
    root, there = _STORES[key]
    raw = {"sihsus": views.admissions, "sim": views.deaths}
    for part in parts or (*raw, MUNICIPALITY_VIEW):
        if part in there:
            continue
        if part == MUNICIPALITY_VIEW:
            views.municipalities(spark, sf_dir).coalesce(1).write.mode("overwrite").parquet(municipality_path(root))
        else:
            typed = transform(raw[part](spark, sf_dir), part, fill=False)
            write_store(typed, root, part, mode="replace", rebalance=True, fill=True)
        there.add(part)
    return root


def admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "sihsus")


def deaths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "sim")


def narrow_admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored admissions under the columns their source has, for writers that ``fill`` in the others."""
    return admissions(spark, sf_dir).select(*_ADMISSION_COLUMNS)


def municipalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sanitaria.sources.store import MUNICIPALITY_VIEW, municipality_path

    return spark.read.parquet(municipality_path(store(spark, sf_dir, MUNICIPALITY_VIEW)))


def _stored(spark: SparkSession, sf_dir: str, system: str) -> DataFrame:
    from sanitaria.sources.store import scan_store

    return scan_store(spark, store(spark, sf_dir, system), system, filename=False)
