"""Filters, joins, questions, set operations and profiles over whole tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from checks import registry as R
from checks import views as V
from checks.registry import register
from sanitaria.operators import profile as P
from sanitaria.operators.ask import ask, preview, sample_rows
from sanitaria.operators.coverage import new_files
from sanitaria.operators.enrich import MUNICIPALITY_COLUMNS, with_loaded_municipality, with_municipality
from sanitaria.operators.predicates import date_range, where_rules
from sanitaria.operators.transform import transform
from sanitaria.plans.common import rows
from sanitaria.sinks.store import not_loaded
from sanitaria.sources.dimensions import build_municipalities, municipality_lookup
from sanitaria.sources.store import enriched

# -- filters -----------------------------------------------------------------


@register(
    "flt_01_predicates",
    f"WITH {R.ADMISSIONS} SELECT uf, count(*) AS n FROM adm WHERE diag_princ LIKE 'J%' AND dt_inter IS NOT NULL "
    "AND idade BETWEEN 5 AND 60 AND sexo IN ('M', 'F') AND val_tot >= 1000 AND abs(dias_perm - 20) <= 15 GROUP BY uf",
)
def predicates(spark, sf):
    adm = R.admissions(spark, sf)
    kept = adm.where(
        F.col("diag_princ").like("J%")
        & F.col("dt_inter").isNotNull()
        & F.col("idade").between(5, 60)
        & F.col("sexo").isin("M", "F")
        & (F.col("val_tot") >= 1000)
        & (F.abs(F.col("dias_perm") - 20) <= 15)
    )
    return kept.groupBy("uf").agg(rows().alias("n"))


register(
    "flt_02_date_range",
    f"WITH {R.ADMISSIONS} SELECT uf, count(*) AS n, min(dt_inter) AS first_day, max(dt_inter) AS last_day FROM adm "
    "WHERE dt_inter BETWEEN DATE '2016-03-01' AND DATE '2018-06-30' GROUP BY uf",
)(
    lambda spark, sf: R.admissions(spark, sf)
    .where(date_range("sihsus", date(2016, 3, 1), date(2018, 6, 30)))
    .groupBy("uf")
    .agg(rows().alias("n"), F.min("dt_inter").alias("first_day"), F.max("dt_inter").alias("last_day"))
)

RULES = {
    "combinator": "and",
    "rules": [
        {"field": "l_quantity", "operator": "between", "value": "10,40"},
        {
            "combinator": "or",
            "rules": [
                {"field": "l_returnflag", "operator": "in", "value": "A,R"},
                {"field": "l_shipdate", "operator": ">=", "value": "1998-01-01"},
                {"combinator": "and", "not": True, "rules": [{"field": "l_linestatus", "operator": "beginsWith", "value": "O"}]},
            ],
        },
        {"field": "l_discount", "operator": "!=", "value": "0.05"},
        {"field": "l_linestatus", "operator": "notNull"},
    ],
}
register(
    "flt_03_rule_groups",
    "SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem "
    "WHERE l_quantity BETWEEN 10 AND 40 AND (l_returnflag IN ('A', 'R') OR l_shipdate >= TIMESTAMP '1998-01-01' "
    "OR NOT (l_linestatus LIKE 'O%')) AND l_discount <> 0.05 AND l_linestatus IS NOT NULL GROUP BY 1, 2",
)(
    lambda spark, sf: where_rules(V.table(spark, sf, "lineitem"), RULES)
    .groupBy("l_returnflag", "l_linestatus")
    .agg(rows().alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))
)

# -- joins -------------------------------------------------------------------

_ENRICH = (
    "LEFT JOIN muni m ON {0} = m.codigo_municipio_6_digitos"
)
register(
    "joi_01_enrich_admissions",
    f"WITH {R.ADMISSIONS}, {R.MUNICIPALITIES} SELECT m.sigla_uf AS uf_res, m.nome_municipio AS municipio_res, "
    "m.nome_regiao_geografica_imediata AS rg_imediata_res, m.nome_regiao_geografica_intermediaria AS "
    f"rg_intermediaria_res, count(*) AS n FROM adm {_ENRICH.format('adm.munic_res')} GROUP BY 1, 2, 3, 4",
)(
    lambda spark, sf: with_municipality(R.admissions(spark, sf), R.municipalities(spark, sf), "munic_res")
    .groupBy(*MUNICIPALITY_COLUMNS)
    .agg(rows().alias("n"))
)
register(
    "joi_01_enrich_deaths",
    f"WITH {R.DEATHS}, {R.MUNICIPALITIES} SELECT m.sigla_uf AS uf_res, m.nome_regiao_geografica_imediata AS "
    "rg_imediata_res, CASE CAST(lococor AS VARCHAR) WHEN '1' THEN 'hospital' WHEN '2' THEN "
    "'outros estabelecimentos de saúde' WHEN '3' THEN 'domicílio' WHEN '4' THEN 'via pública' WHEN '5' THEN 'outros' "
    "WHEN '6' THEN 'aldeia indígena' WHEN '9' THEN 'ignorado' END AS lococor_desc, count(*) AS n FROM dth "
    + _ENRICH.format("CASE WHEN codmunres >= 1000000 THEN codmunres // 10 ELSE codmunres END")
    + " GROUP BY 1, 2, 3",
)(
    lambda spark, sf: enriched(R.deaths(spark, sf), "sim", R.municipalities(spark, sf))
    .groupBy("uf_res", "rg_imediata_res", "lococor_desc")
    .agg(rows().alias("n"))
)
_LIST = f"list AS ({V.MUNICIPALITY_LIST.replace('`', chr(34))})"
_LOOKUP = f"""{_LIST}, lookup AS (SELECT CAST(left("Código Município Completo", length("Código Município Completo") - 1)
  AS INTEGER) AS codigo_municipio, trim("Nome_Município") AS nome, "Nome_UF" AS uf,
  "Nome Região Geográfica Imediata" AS regiao_imediata, "Nome Região Geográfica Intermediária" AS regiao_intermediaria
  FROM list)"""


@register(
    "joi_02_loaded_dimension",
    f"WITH {R.ADMISSIONS}, {_LOOKUP} SELECT lookup.uf AS uf_res, lookup.regiao_imediata AS rg_imediata_res, "
    "count(*) AS n, count(DISTINCT lookup.nome) AS municipios FROM adm LEFT JOIN lookup ON adm.munic_res = "
    "lookup.codigo_municipio GROUP BY 1, 2",
)
def loaded_dimension(spark, sf):
    """Enrichment against the dimension table with full state names."""
    lookup = municipality_lookup(build_municipalities(V.municipality_list(spark, sf)))
    joined = with_loaded_municipality(R.admissions(spark, sf), lookup, "munic_res")
    return joined.groupBy("uf_res", "rg_imediata_res").agg(
        rows().alias("n"), F.countDistinct("municipio_res").alias("municipios")
    )


register(
    "joi_03_transform_with_municipality",
    f"WITH {R.ADMISSIONS}, {R.MUNICIPALITIES} SELECT adm.uf, m.sigla_uf AS uf_res, count(*) AS n FROM adm "
    f"{_ENRICH.format('adm.munic_res')} GROUP BY 1, 2",
)(
    lambda spark, sf: transform(
        V.admissions(spark, sf), "sihsus", municipalities=V.municipalities(spark, sf)
    )
    .groupBy("uf", "uf_res")
    .agg(rows().alias("n"))
)
register(
    "joi_04_not_loaded",
    f"WITH {R.ADMISSIONS}, loaded AS (SELECT DISTINCT upper(source_file) AS f FROM adm WHERE dt_inter < DATE '2016-01-01') "
    "SELECT uf, count(*) AS n FROM adm WHERE upper(source_file) NOT IN (SELECT f FROM loaded) GROUP BY uf",
)(
    lambda spark, sf: (lambda adm: not_loaded(
        adm, adm.where(F.col("dt_inter") < F.lit("2016-01-01").cast("date")).select("source_file")
    ))(R.admissions(spark, sf))
    .groupBy("uf")
    .agg(rows().alias("n"))
)


@register(
    "joi_05_cross_system",
    f"WITH {R.ADMISSIONS}, {R.DEATHS}, a AS (SELECT uf, CAST(year(dt_inter) AS INTEGER) AS ano, count(*) AS internacoes "
    "FROM adm WHERE dt_inter IS NOT NULL GROUP BY 1, 2), d AS (SELECT uf, CAST(year(dtobito) AS INTEGER) AS ano, "
    "count(*) AS obitos FROM dth WHERE dtobito IS NOT NULL AND tipobito = 2 GROUP BY 1, 2) "
    "SELECT uf, ano, internacoes, obitos FROM a FULL JOIN d USING (uf, ano)",
)
def cross_system(spark, sf):
    """Both systems as views of one session, joined after each was aggregated."""
    R.admissions(spark, sf).createOrReplaceTempView("check_sihsus")
    R.deaths(spark, sf).createOrReplaceTempView("check_sim")
    return spark.sql(
        """WITH a AS (SELECT uf, year(dt_inter) AS ano, count(*) AS internacoes FROM check_sihsus
             WHERE dt_inter IS NOT NULL GROUP BY 1, 2),
           d AS (SELECT uf, year(dtobito) AS ano, count(*) AS obitos FROM check_sim
             WHERE dtobito IS NOT NULL AND tipobito = 2 GROUP BY 1, 2)
           SELECT uf, ano, internacoes, obitos FROM a FULL JOIN d USING (uf, ano)"""
    )


# -- questions ---------------------------------------------------------------

register(
    "agg_01_ask_grouped",
    "SELECT l_returnflag, l_linestatus, count(l_orderkey) AS count_l_orderkey, "
    "count(DISTINCT l_suppkey) AS count_distinct_l_suppkey, round(sum(l_quantity), 2) AS sum_l_quantity, "
    "round(avg(l_discount), 6) AS avg_l_discount, min(l_tax) AS min_l_tax, max(l_extendedprice) AS max_l_extendedprice "
    "FROM lineitem WHERE l_quantity > 5 GROUP BY 1, 2",
)(
    lambda spark, sf: ask(
        V.table(spark, sf, "lineitem"),
        {
            "projections": [
                "l_returnflag", "l_linestatus", ("l_orderkey", "count"), ("l_suppkey", "count_distinct"),
                ("l_quantity", "sum"), ("l_discount", "avg"), ("l_tax", "min"), ("l_extendedprice", "max"),
            ],
            "group_by": ["l_returnflag", "l_linestatus"],
            "where": {"rules": [{"field": "l_quantity", "operator": ">", "value": 5}]},
            "order_by": ("sum_l_quantity", "DESC"),
        },
    ).withColumns({
        "sum_l_quantity": F.round("sum_l_quantity", 2), "avg_l_discount": F.round("avg_l_discount", 6),
    })
)
register(
    "agg_01_ask_distinct",
    "SELECT l_returnflag, count(DISTINCT l_orderkey) AS count_distinct_l_orderkey, count(DISTINCT l_partkey) AS "
    "count_distinct_l_partkey, count(DISTINCT l_extendedprice) AS count_distinct_l_extendedprice, "
    "count(DISTINCT l_shipdate) AS count_distinct_l_shipdate, max(l_tax) AS max_l_tax FROM lineitem GROUP BY 1",
)(
    lambda spark, sf: ask(
        V.table(spark, sf, "lineitem"),
        {
            "projections": [
                "l_returnflag", ("l_orderkey", "count_distinct"), ("l_partkey", "count_distinct"),
                ("l_extendedprice", "count_distinct"), ("l_shipdate", "count_distinct"), ("l_tax", "max"),
            ],
            "group_by": ["l_returnflag"],
        },
    )
)
register(
    "agg_01_ask_rows",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' "
    "ORDER BY o_totalprice DESC, o_orderkey LIMIT 25",
)(
    lambda spark, sf: ask(
        V.table(spark, sf, "orders"),
        {
            "projections": ["o_orderkey", "o_custkey", "o_totalprice"],
            "where": {"rules": [{"field": "o_orderstatus", "operator": "=", "value": "F"}]},
            "order_by": ("o_totalprice", "DESC"),
            "limit": 25,
        },
    )
)


@register(
    "srt_02_preview",
    f"WITH {R.ADMISSIONS} SELECT CAST(count(*) > 10000 AS BOOLEAN) AS truncated, "
    "CAST(least(count(*), 10000) AS BIGINT) AS row_count, CASE WHEN count(*) > 10000 THEN count(*) END AS total_rows "
    "FROM adm WHERE dt_inter IS NOT NULL",
)
def previewed(spark, sf):
    """Preview of a query: shown rows, whether it was cut, and the full count then."""
    R.admissions(spark, sf).where("dt_inter is not null").createOrReplaceTempView("check_preview")
    shown = preview(spark, "SELECT uf, dt_inter FROM check_preview")
    return spark.createDataFrame(
        [(shown.truncated, shown.row_count, shown.total_rows)], "truncated boolean, row_count bigint, total_rows bigint"
    )


@register("srt_04_sample", "SELECT least(count(*), 1000) AS n, least(count(*), 1000) AS different FROM orders")
def sampled(spark, sf):
    """A random sample has the size asked for and repeats no row."""
    sample = sample_rows(V.table(spark, sf, "orders"), 1000, seed=7)
    return sample.agg(rows().alias("n"), F.countDistinct("o_orderkey").alias("different"))


# -- set operations ----------------------------------------------------------

register(
    "set_01_union_by_name",
    "SELECT kind, count(*) AS n, count(acctbal) AS with_balance, count(segment) AS with_segment FROM ("
    "SELECT 'customer' AS kind, c_acctbal AS acctbal, c_mktsegment AS segment FROM customer UNION ALL "
    "SELECT 'supplier', s_acctbal, NULL FROM supplier) GROUP BY kind",
)(
    lambda spark, sf: V.table(spark, sf, "customer")
    .select(F.lit("customer").alias("kind"), F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"))
    .unionByName(
        V.table(spark, sf, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_acctbal").alias("acctbal")),
        allowMissingColumns=True,
    )
    .groupBy("kind")
    .agg(rows().alias("n"), F.count("acctbal").alias("with_balance"), F.count("segment").alias("with_segment"))
)
register(
    "set_02_new_files",
    f"WITH {R.FILES} SELECT upper(name) AS name FROM files EXCEPT SELECT upper(name) FROM files WHERE year < 2017",
)(
    lambda spark, sf: (lambda files: new_files(
        files, files.where("cast(substr(name, 5, 2) as int) < 17").select(F.lower("name").alias("name"))
    ))(V.inventory(spark, sf))
)

# -- profiles ----------------------------------------------------------------


def _stats_sql(with_views: str, table: str, columns: list[str], arrays: tuple[str, ...] = ()) -> str:
    parts = []
    for c in columns:
        empty = f"{c} IS NULL OR len({c}) = 0" if c in arrays else f"{c} IS NULL"
        null = f"round(100.0 * count(*) FILTER (WHERE {empty}) / count(*), 2)"
        parts.append(
            f"SELECT '{c}' AS \"column\", count(*) AS row_count, CAST({null} AS DOUBLE) AS null_pct, "
            f"CAST(round(100 - {null}, 2) AS DOUBLE) AS fill_pct, count(DISTINCT {c}) AS distinct_count FROM {table}"
        )
    return f"{with_views} " + " UNION ALL ".join(parts)


_EVENTS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
_ADM = ["uf", "munic_res", "sexo", "dt_inter", "diag_princ", "diagsec1", "idade", "uti_mes_to", "morte"]
_DTH = ["uf", "dtobito", "horaobito", "causabas", "linhaa", "acidtrab", "nudiasobco"]
register("prf_01_column_stats_events", _stats_sql("", "events", _EVENTS))(
    lambda spark, sf: P.column_stats(V.table(spark, sf, "events").select(*_EVENTS), exact=True)
)
register("prf_01_column_stats_admissions", _stats_sql(f"WITH {R.ADMISSIONS}", "adm", _ADM))(
    lambda spark, sf: P.column_stats(R.admissions(spark, sf).select(*_ADM), exact=True)
)
register("prf_02_column_stats_arrays", _stats_sql(f"WITH {R.DEATHS}", "dth", _DTH, ("causabas", "linhaa")))(
    lambda spark, sf: P.column_stats(R.deaths(spark, sf).select(*_DTH), exact=True)
)


@register(
    "prf_01_column_stats_approximate",
    _stats_sql(f"WITH {R.ADMISSIONS}", "adm", _ADM).replace(
        ") AS distinct_count", ") AS distinct_count, TRUE AS approximate_close"
    ),
)
def approximate_stats(spark, sf):
    """The default form: shares are exact, distinct counts within a twentieth of the exact ones on either side."""
    rows_ = R.admissions(spark, sf).select(*_ADM)
    exact = P.column_stats(rows_, exact=True).select("column", "distinct_count")
    stats = P.column_stats(rows_).withColumnRenamed("distinct_count", "approximate").join(exact, "column")
    return stats.select("*", _close("approximate", "distinct_count").alias("approximate_close")).drop("approximate")


def _close(found: str, exact: str):
    return F.abs(F.col(found) - F.col(exact)) <= F.col(exact) * 0.05 + 0.5


@register(
    "prf_05_enriched_stats",
    f"WITH {R.ADMISSIONS}, {R.MUNICIPALITIES}, f AS (SELECT CAST(round(100 - round(100.0 * count(*) FILTER (WHERE "
    "munic_res IS NULL) / count(*), 2), 2) AS DOUBLE) AS fill_pct FROM adm) "
    + " UNION ALL ".join(
        f"SELECT '{out}' AS \"column\", (SELECT fill_pct FROM f) AS fill_pct, TRUE AS fill_pct_approx, "
        f"count(DISTINCT {source}) AS distinct_count, TRUE AS distinct_count_approx FROM muni"
        for out, source in MUNICIPALITY_COLUMNS.items()
    ),
)
def stats_of_enriched(spark, sf):
    stats = P.column_stats(R.admissions(spark, sf).select("munic_res"))
    return P.enriched_stats(stats, R.municipalities(spark, sf), "munic_res")


def _summary_sql():
    parts = []
    for c, kind, number in (
        ("l_orderkey", "bigint", True), ("l_linenumber", "int", True),
        ("l_returnflag", "string", False), ("l_linestatus", "string", False),
    ):
        mean = f"round(avg({c}), 4)" if number else "CAST(NULL AS DOUBLE)"
        spread = f"round(stddev({c}), 4)" if number else "CAST(NULL AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS column_name, '{kind}' AS column_type, CAST(min({c}) AS VARCHAR) AS min, "
            f"CAST(max({c}) AS VARCHAR) AS max, {mean} AS avg, {spread} AS std, count(*) AS count, "
            f"CAST(round(100.0 * (count(*) - count({c})) / count(*), 2) AS DOUBLE) AS null_percentage FROM lineitem"
        )
    return " UNION ALL ".join(parts)


register("prf_06_summarize", _summary_sql())(
    lambda spark, sf: P.summarize(
        V.dealt(V.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"))
    ).select(
        "column_name", "column_type", "min", "max", F.round("avg", 4).alias("avg"), F.round("std", 4).alias("std"),
        "count", "null_percentage",
    )
)
register(
    "prf_06_summarize_quartiles",
    "SELECT 'l_linenumber' AS column_name, CAST(quantile_disc(l_linenumber, 0.25) AS DOUBLE) AS q25, "
    "CAST(quantile_disc(l_linenumber, 0.5) AS DOUBLE) AS q50, "
    "CAST(quantile_disc(l_linenumber, 0.75) AS DOUBLE) AS q75 FROM lineitem",
)(
    lambda spark, sf: P.summarize(V.dealt(V.table(spark, sf, "lineitem").select("l_linenumber"))).select(
        "column_name", "q25", "q50", "q75"
    )
)


_LINEITEM = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus "
    "l_shipdate"
).split()


@register(
    "prf_06_summarize_unique",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_count, TRUE AS unique_close FROM lineitem"
        for c in _LINEITEM
    ),
)
def summarized_unique(spark, sf):
    """The summary's approximate unique counts of all columns against exact ones."""
    table = V.table(spark, sf, "lineitem")
    exact = P.column_stats(table, exact=True).select(F.col("column").alias("column_name"), "distinct_count")
    found = P.summarize(table, quantiles=False).select("column_name", "approx_unique").join(exact, "column_name")
    return found.select("column_name", "distinct_count", _close("approx_unique", "distinct_count").alias("unique_close"))


register(
    "prf_09_schema_table",
    " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column_name, count(*) > 0 AS filled FROM lineitem"
        for i, c in enumerate(_LINEITEM)
    ),
)(
    lambda spark, sf: P.schema_table(V.table(spark, sf, "lineitem"))
    .join(P.column_stats(V.table(spark, sf, "lineitem")), F.col("column_name") == F.col("column"))
    .select("position", "column_name", (F.col("row_count") > 0).alias("filled"))
)


def _histogram_sql(with_views: str, table: str, c: str, value: str) -> str:
    return (
        f"{with_views} SELECT {value} AS {c}, count(*) AS count, "
        f"CAST(round(100.0 * count(*) / (SELECT count(*) FROM {table}), 1) AS DOUBLE) AS pct_population "
        f"FROM {table} GROUP BY 1"
    )


register(
    "prf_07_heavy_hitters",
    "SELECT o_custkey AS value, n AS count FROM (SELECT CAST(o_custkey AS VARCHAR) AS o_custkey, count(*) AS n "
    "FROM orders GROUP BY 1 ORDER BY n DESC, 1 LIMIT 25)",
)(lambda spark, sf: P.heavy_hitters(V.table(spark, sf, "orders"), "o_custkey", 25, tracked=200_000).drop("certain"))
register("prf_07_histogram_events", _histogram_sql("", "events", "event_type", "event_type"))(
    lambda spark, sf: P.histogram(V.table(spark, sf, "events"), "event_type")
)
register(
    "prf_07_histogram_float", _histogram_sql("", "lineitem", "l_discount", "CAST(l_discount AS DECIMAL(18,2))")
)(lambda spark, sf: P.histogram(V.table(spark, sf, "lineitem"), "l_discount"))
register("win_03_share_of_total", _histogram_sql(f"WITH {R.ADMISSIONS}", "adm", "raca_cor", "raca_cor"))(
    lambda spark, sf: P.histogram(R.admissions(spark, sf), "raca_cor")
)
register(
    "prf_09_table_stats",
    "SELECT 'lineitem' AS table_name, count(*) AS row_count, 11 AS column_count, "
    "'l_orderkey,l_partkey,l_suppkey,l_linenumber,l_quantity,l_extendedprice,l_discount,l_tax,l_returnflag,"
    "l_linestatus,l_shipdate' AS columns FROM lineitem",
)(lambda spark, sf: P.table_stats(V.table(spark, sf, "lineitem"), "lineitem"))

# -- municipality dimension --------------------------------------------------

register(
    "src_07_build_municipalities",
    f"""WITH {_LIST} SELECT "Nome_UF" AS nome_uf,
        "Nome Região Geográfica Imediata" AS nome_regiao_geografica_imediata,
        CAST("Código Município Completo" AS INTEGER) AS codigo_municipio_completo,
        trim("Nome_Município") AS nome_municipio,
        CASE "Nome_UF" WHEN 'São Paulo' THEN 'SP' WHEN 'Piauí' THEN 'PI' WHEN 'Acre' THEN 'AC' END AS sigla_uf,
        CAST(floor(CAST("Código Município Completo" AS INTEGER) / 10) AS INTEGER) AS codigo_municipio_6_digitos
        FROM list""",
)(
    lambda spark, sf: build_municipalities(
        V.municipality_list(spark, sf).withColumnsRenamed({"Código Município Completo": "Código Municipio Completo"})
    ).select(
        "nome_uf", "nome_regiao_geografica_imediata", "codigo_municipio_completo", "nome_municipio", "sigla_uf",
        "codigo_municipio_6_digitos",
    )
)
register("src_08_municipality_lookup", f"WITH {_LOOKUP} SELECT * FROM lookup")(
    lambda spark, sf: municipality_lookup(build_municipalities(V.municipality_list(spark, sf)))
)
