"""Health-record views derived from the given tables.

The tables hold no health records, so these views turn whole tables into rows
that look like raw source files: all text, several date layouts, dirty values,
unknown codes.  Each is one projection over one table.  The same text runs on
Spark and in the checking SQL, so both start from equal rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

STATES = "ACALAPAMBACEDFESGOMAMTMSMGPAPBPRPEPIRJRNRSRORRSCSPSETO"

_UF = f"substr('{STATES}', 1 + 2 * cast(o_custkey % 27 AS int), 2)"
# Dates move 20 years on (leap years stay leap years), into the years of the newer source files.
_YEAR = "cast(year(o_orderdate) + 20 AS varchar(4))"
_MONTH = "lpad(cast(month(o_orderdate) AS varchar(2)), 2, '0')"
_DAY = "lpad(cast(day(o_orderdate) AS varchar(2)), 2, '0')"
_CODE = "concat(chr(cast(65 + o_orderkey % 26 AS int)), lpad(cast(o_custkey % 100 AS varchar(3)), 2, '0')"
_AMOUNT = "cast(cast(o_totalprice AS decimal(18,2)) AS varchar(20))"

_DATES = f"""CASE
    WHEN o_orderkey % 50 = 7 THEN '00000000'
    WHEN o_orderkey % 4 = 0 THEN concat({_YEAR}, {_MONTH}, {_DAY})
    WHEN o_orderkey % 4 = 1 THEN concat({_DAY}, {_MONTH}, {_YEAR})
    WHEN o_orderkey % 4 = 2 THEN concat({_YEAR}, '-', {_MONTH}, '-', {_DAY})
    ELSE concat(cast(1 + day(o_orderdate) % 9 AS varchar(2)), {_MONTH}, {_YEAR}) END"""

ADMISSIONS = f"""SELECT
  {_UF} AS uf,
  concat('RD', {_UF}, substr({_YEAR}, 3, 2), {_MONTH}, '.dbc') AS source_file,
  CASE WHEN o_orderpriority = '5-LOW' THEN '999999' ELSE cast(100000 + o_custkey % 500 AS varchar(10)) END AS munic_res,
  concat(' ', cast(o_orderkey % 5 AS varchar(5)), chr(9)) AS sexo,
  concat('0', cast(o_orderkey % 7 AS varchar(5))) AS raca_cor,
  {_DATES} AS dt_inter,
  CASE WHEN o_orderkey % 100 = 7 THEN ' ' ELSE concat({_YEAR}, {_MONTH}, {_DAY}) END AS dt_saida,
  {_CODE}, CASE WHEN o_orderkey % 3 = 0 THEN '.1' WHEN o_orderkey % 41 = 0 THEN '99' ELSE '' END) AS diag_princ,
  CASE WHEN o_orderkey % 2 = 0 THEN lower({_CODE}, '.2')) ELSE '' END AS diagsec1,
  cast(o_custkey % 100 AS varchar(3)) AS idade,
  CASE WHEN o_orderkey % 89 = 0 THEN '3.7' WHEN o_orderkey % 83 = 0 THEN '1e2'
    ELSE lpad(cast(o_orderkey % 40 AS varchar(3)), 3, '0') END AS dias_perm,
  concat('P', lpad(cast(o_custkey % 60 AS varchar(3)), 3, '0')) AS proc_rea,
  cast(o_orderkey % 3 AS varchar(2)) AS morte,
  CASE WHEN o_orderkey % 97 = 0 THEN '1,5' ELSE {_AMOUNT} END AS val_tot,
  CASE WHEN o_orderkey % 4 = 1 THEN {_AMOUNT} ELSE '0' END AS val_uti,
  cast(o_orderkey % 4 AS varchar(2)) AS marca_uti,
  cast(o_orderkey % 400 AS varchar(3)) AS uti_mes_to,
  cast(o_orderkey % 30 AS varchar(3)) AS qt_diarias,
  cast(o_orderkey % 90000 AS varchar(6)) AS cbor
FROM orders"""

DEATHS = f"""SELECT
  {_UF} AS uf,
  concat('DO', {_UF}, {_YEAR}, '.dbc') AS source_file,
  {_DATES} AS dtobito,
  concat(lpad(cast(o_orderkey % 30 AS varchar(2)), 2, '0'), CASE WHEN o_orderkey % 2 = 0 THEN ':' ELSE '' END,
    lpad(cast(o_orderkey % 70 AS varchar(2)), 2, '0')) AS horaobito,
  CASE WHEN o_orderkey % 61 = 0 THEN '40'
    ELSE concat(cast(o_orderkey % 10 AS varchar(2)), lpad(cast(o_custkey % 100 AS varchar(3)), 2, '0')) END AS idade,
  substr('M1F29XI0', 1 + cast(o_orderkey % 8 AS int), 1) AS sexo,
  cast(o_orderkey % 7 AS varchar(2)) AS racacor,
  cast(o_orderkey % 7 AS varchar(2)) AS estciv,
  cast(o_custkey % 7 AS varchar(2)) AS esc,
  cast(o_custkey % 10 AS varchar(2)) AS lococor,
  cast(1 + o_orderkey % 2 AS varchar(2)) AS tipobito,
  CASE WHEN o_orderkey % 3 = 0 THEN cast(10 * (100000 + o_custkey % 500) + 3 AS varchar(10))
    ELSE cast(100000 + o_custkey % 500 AS varchar(10)) END AS codmunres,
  CASE WHEN o_orderkey % 53 = 0 THEN '*' ELSE concat('*', {_CODE}),
    CASE WHEN o_orderkey % 2 = 0 THEN '/b342*bad' ELSE '' END) END AS causabas,
  concat('*', {_CODE}, '.0')) AS linhaa,
  cast(o_orderkey % 4 AS varchar(2)) AS acidtrab,
  substr('SN12X', 1 + cast(o_orderkey % 5 AS int), 1) AS tppos,
  substr('SNX', 1 + cast(o_orderkey % 3 AS int), 1) AS stcodifica,
  cast(o_orderkey % 90000 AS varchar(6)) AS nudiasobco
FROM orders"""

# At most 500 rows whatever the size of customer; code 999999 of the admissions has no row here.
MUNICIPALITIES = f"""SELECT DISTINCT
  cast(100000 + c_custkey % 500 AS int) AS codigo_municipio_6_digitos,
  concat('Municipio ', cast(c_custkey % 500 AS varchar(5))) AS nome_municipio,
  substr('{STATES}', 1 + 2 * cast(c_custkey % 500 % 27 AS int), 2) AS sigla_uf,
  concat('Imediata ', cast(c_custkey % 500 % 50 AS varchar(5))) AS nome_regiao_geografica_imediata,
  concat('Intermediaria ', cast(c_custkey % 500 % 10 AS varchar(5))) AS nome_regiao_geografica_intermediaria
FROM customer"""

# The published list before it is tidied: accented headers, 7-digit codes, padded names.
MUNICIPALITY_LIST = """SELECT DISTINCT
  cast(CASE c_custkey % 4 WHEN 0 THEN 'São Paulo' WHEN 1 THEN 'Piauí' WHEN 2 THEN 'Acre' ELSE 'Atlantis' END
    AS varchar(30)) AS `Nome_UF`,
  concat('Intermediaria ', cast(c_custkey % 500 % 10 AS varchar(5))) AS `Nome Região Geográfica Intermediária`,
  concat('Imediata ', cast(c_custkey % 500 % 50 AS varchar(5))) AS `Nome Região Geográfica Imediata`,
  cast(10 * (100000 + c_custkey % 500) + c_custkey % 500 % 10 AS varchar(9)) AS `Código Município Completo`,
  concat(' Municipio ', cast(c_custkey % 500 AS varchar(5)), ' ') AS `Nome_Município`
FROM customer"""

# One row per source file, as a server listing would give it.
INVENTORY = f"""SELECT source_file AS name, cast(count(*) AS bigint) * 1000 AS size_bytes
FROM ({ADMISSIONS}) GROUP BY source_file"""
DEATH_INVENTORY = f"""SELECT source_file AS name, cast(count(*) AS bigint) * 1000 AS size_bytes
FROM ({DEATHS}) GROUP BY source_file"""


# Columns of a death source file; state and file name are not among them.
DEATH_FIELDS = [
    T.StructField(name, T.StringType())
    for name in (
        "dtobito horaobito idade sexo racacor estciv esc lococor tipobito codmunres causabas linhaa acidtrab tppos "
        "stcodifica nudiasobco"
    ).split()
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows that one task of costly work gets at most, so that it takes the same memory however long the table is.
DEALT_ROWS = 500_000


def dealt(df: DataFrame) -> DataFrame:
    """Narrow rows of one small file, dealt out before costly work on each; the file's footer says how many there are."""
    tasks = -(-df.count() // DEALT_ROWS)
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, tasks))


def _view(spark: SparkSession, sf_dir: str, text: str, source: str, costly: bool = False) -> DataFrame:
    rows = dealt(table(spark, sf_dir, source)) if costly else table(spark, sf_dir, source)
    return spark.sql(text.replace(f"FROM {source}", f"FROM {{{source}}}"), **{source: rows})


def admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, ADMISSIONS, "orders", costly=True)


def deaths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, DEATHS, "orders", costly=True)


def municipalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, MUNICIPALITIES, "customer")


def municipality_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, MUNICIPALITY_LIST, "customer")


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, INVENTORY, "orders")


def death_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, DEATH_INVENTORY, "orders")
