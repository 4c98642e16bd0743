"""File names, file selection and coverage over the listing of all source files."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from checks import registry as R
from checks import views as V
from checks.registry import register
from sanitaria.functions import filenames as N
from sanitaria.operators import coverage as K
from sanitaria.plans.common import rows
from sanitaria.sources.inventory import select_landing_files, with_period

_HOSPITAL_FILES = f"WITH {R.FILES}"
_DEATH_FILES = f"WITH {R.DEATH_FILES}"


def files(spark, sf):
    return with_period(V.inventory(spark, sf), "sihsus")


def death_files(spark, sf):
    return with_period(V.death_inventory(spark, sf), "sim")


def _parsed(source, parse):
    def query(spark, sf):
        return source(spark, sf).select("name", parse(F.col("name")).alias("p")).select("name", "p.*")

    return query


register(
    "src_11_hospital_names",
    f"{_HOSPITAL_FILES} SELECT name, uf, year, month, CAST(NULL AS VARCHAR) AS revision FROM files",
)(_parsed(V.inventory, N.hospital_period))
register(
    "src_12_death_names",
    f"{_DEATH_FILES} SELECT name, uf, year, month, 'CID10' AS revision FROM files",
)(_parsed(V.death_inventory, N.death_period))
register(
    "src_13_default_names",
    f"{_HOSPITAL_FILES} SELECT name, uf, CAST(substr(name, 5, 2) AS INTEGER) + CASE WHEN "
    "CAST(substr(name, 5, 2) AS INTEGER) < 50 THEN 2000 ELSE 1900 END AS year, month, CAST(NULL AS VARCHAR) AS revision "
    "FROM files",
)(_parsed(V.inventory, lambda name: N.default_period(name, "RD")))
register(
    "src_14_select_monthly",
    f"{_HOSPITAL_FILES} SELECT name, size_bytes, uf, year, month FROM files WHERE uf IN ('SP', 'RJ', 'MG', 'BA') "
    "AND make_date(year, month, 1) BETWEEN DATE '2015-06-15' AND DATE '2018-04-01'",
)(
    lambda spark, sf: select_landing_files(
        V.inventory(spark, sf), "sihsus", date(2015, 6, 15), date(2018, 4, 1), ["SP", "RJ", "MG", "BA"]
    )
)
register(
    "src_14_select_yearly",
    f"{_DEATH_FILES}, wanted AS (SELECT upper(name) AS w FROM files WHERE uf < 'PB') "
    "SELECT name, size_bytes, uf, year, month FROM files WHERE year BETWEEN 2015 AND 2018 AND upper(name) IN "
    "(SELECT w FROM wanted)",
)(
    lambda spark, sf: select_landing_files(
        V.death_inventory(spark, sf), "sim", date(2015, 6, 15), date(2018, 4, 1),
        only=death_files(spark, sf).where("uf < 'PB'").select(F.lower("name").alias("name")),
    )
)

_LABEL = "printf('%04d-%02d', year, coalesce(month, 1))"
_INDEX = "(year * 12 + month - 1)"
_SIZE = "CAST(sum(size_bytes) AS BIGINT)"
register(
    "cov_01_storage_stats",
    f"{_HOSPITAL_FILES} SELECT uf, count(*) AS files, {_SIZE} AS size_bytes FROM files GROUP BY uf",
)(lambda spark, sf: K.storage_stats(files(spark, sf)))
register(
    "cov_01_storage_totals",
    f"{_HOSPITAL_FILES} SELECT count(*) AS files, {_SIZE} AS size_bytes, count(DISTINCT uf) AS states FROM files",
)(lambda spark, sf: K.storage_totals(files(spark, sf)))
register(
    "cov_02_overview",
    f"{_HOSPITAL_FILES} SELECT 'sihsus' AS system, count(*) AS files, {_SIZE} AS size_bytes, "
    f"count(DISTINCT uf) AS states, min({_LABEL}) AS first_period, max({_LABEL}) AS last_period, "
    "(SELECT count(*) FROM orders) AS row_count FROM files",
)(lambda spark, sf: K.overview(files(spark, sf), "sihsus", R.admissions(spark, sf)).drop("last_updated"))
register(
    "cov_03_coverage_by_uf",
    f"{_HOSPITAL_FILES} SELECT uf, count(*) AS files, {_SIZE} AS size_bytes, min({_LABEL}) AS first_period, "
    f"max({_LABEL}) AS last_period, CAST(max({_INDEX}) - min({_INDEX}) + 1 - count(DISTINCT {_INDEX}) AS BIGINT) "
    "AS missing_periods FROM files GROUP BY uf",
)(lambda spark, sf: K.coverage_by_uf(files(spark, sf), "sihsus"))


def _gappy(spark, sf):
    """Only files of at least the mean size, so that every state has gaps at any scale."""
    known = files(spark, sf)
    return known.where(F.col("size_bytes") >= known.agg(F.avg("size_bytes")).scalar())


register(
    "cov_04_missing_months",
    f"{_HOSPITAL_FILES} SELECT uf, CAST(max({_INDEX}) - min({_INDEX}) + 1 - count(DISTINCT {_INDEX}) AS BIGINT) "
    "AS missing_periods FROM files WHERE size_bytes >= (SELECT avg(size_bytes) FROM files) GROUP BY uf",
)(lambda spark, sf: K.missing_periods(_gappy(spark, sf), "sihsus"))
register(
    "cov_04_missing_years",
    f"{_DEATH_FILES} SELECT uf, CAST(max(year) - min(year) + 1 - count(DISTINCT year) AS BIGINT) AS missing_periods "
    "FROM files GROUP BY uf",
)(lambda spark, sf: K.missing_periods(death_files(spark, sf), "sim"))
register(
    "cov_04_missing_month_list",
    f"{_HOSPITAL_FILES}, known AS (SELECT DISTINCT uf, {_INDEX} AS i FROM files WHERE size_bytes >= (SELECT avg(size_bytes) FROM files)), "
    "spans AS (SELECT uf, min(i) AS a, max(i) AS b FROM known GROUP BY uf), "
    "expected AS (SELECT uf, unnest(generate_series(a, b)) AS i FROM spans) "
    "SELECT uf, CAST(i // 12 AS INTEGER) AS year, CAST(i % 12 + 1 AS INTEGER) AS month FROM "
    "(SELECT uf, i FROM expected EXCEPT SELECT uf, i FROM known)",
)(lambda spark, sf: K.missing_period_list(_gappy(spark, sf), "sihsus"))
register(
    "cov_05_timeline",
    f"{_HOSPITAL_FILES} SELECT {_LABEL} AS period, count(*) AS files, {_SIZE} AS size_bytes FROM files GROUP BY 1",
)(lambda spark, sf: K.timeline(files(spark, sf)))
register(
    "cov_05_timeline_yearly",
    f"{_DEATH_FILES} SELECT {_LABEL} AS period, count(*) AS files, {_SIZE} AS size_bytes FROM files GROUP BY 1",
)(lambda spark, sf: K.timeline(death_files(spark, sf)))
register(
    "cov_07_update_summary",
    f"{_HOSPITAL_FILES} SELECT count(*) FILTER (WHERE year < 2017) AS processed_count, count(*) AS available_count, "
    "count(*) FILTER (WHERE year >= 2017) AS new_count, count(*) FILTER (WHERE year >= 2017) = 0 AS is_up_to_date "
    "FROM files",
)(
    lambda spark, sf: K.update_summary(
        V.inventory(spark, sf), files(spark, sf).where("year < 2017").select(F.lower("name").alias("name"))
    )
)
register(
    "cov_09_estimate_scope",
    f"{_HOSPITAL_FILES} SELECT count(*) AS file_count, {_SIZE} AS download_bytes, "
    "CAST(floor(sum(size_bytes) * 0.6) AS BIGINT) AS store_bytes, CAST(floor(sum(size_bytes) * 3.0) AS BIGINT) AS csv_bytes "
    "FROM files",
)(lambda spark, sf: K.estimate_scope(files(spark, sf)))
register(
    "cov_09_estimate_by_uf",
    f"{_HOSPITAL_FILES}, per AS (SELECT uf, count(*) AS file_count, {_SIZE} AS download_bytes, min({_LABEL}) AS "
    f"first_period, max({_LABEL}) AS last_period FROM files GROUP BY uf), t AS (SELECT sum(download_bytes) AS total FROM per) "
    "SELECT uf, file_count, download_bytes, first_period, last_period, CAST(floor(CAST(download_bytes AS DOUBLE) / "
    "(SELECT total FROM t) * floor((SELECT total FROM t) * 0.6)) AS BIGINT) AS store_bytes FROM per",
)(lambda spark, sf: K.estimate_by_uf(files(spark, sf)))
register(
    "cov_09_estimate_unsized",
    f"{_DEATH_FILES} SELECT count(*) AS file_count, CAST(count(*) * 5 * 1048576 AS BIGINT) AS download_bytes, "
    "CAST(floor(count(*) * 5 * 1048576 * 0.5) AS BIGINT) AS store_bytes FROM files",
)(lambda spark, sf: K.estimate_unsized(V.death_inventory(spark, sf), "sim"))
register(
    "src_12_yearly_periods",
    f"{_DEATH_FILES} SELECT year, count(*) AS n FROM files GROUP BY year",
)(lambda spark, sf: death_files(spark, sf).groupBy("year").agg(rows().alias("n")))
