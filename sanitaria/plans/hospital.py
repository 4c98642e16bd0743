"""Hospital admission queries over the ``sihsus`` view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sanitaria.plans.common import by_age_band, count_by, money, monthly, rows


def admissions_by_state(df: DataFrame) -> DataFrame:
    totals = df.groupBy("uf").agg(rows().alias("total"), money("val_tot").alias("valor_total"))
    return totals.orderBy(F.desc("total"), "uf")


def monthly_series(df: DataFrame) -> DataFrame:
    return monthly(df, "dt_inter", internacoes=rows(), valor_total=money("val_tot"))


def top_diagnoses(df: DataFrame, n: int = 10) -> DataFrame:
    return count_by(df, "diag_princ").limit(n)


def top_procedures(df: DataFrame, n: int = 10) -> DataFrame:
    return (
        df.where(F.col("proc_rea").isNotNull())
        .groupBy("proc_rea")
        .agg(rows().alias("total"), money("val_tot").alias("valor"))
        .orderBy(F.desc("total"), "proc_rea")
        .limit(n)
    )


def by_sex(df: DataFrame) -> DataFrame:
    return (
        df.where(F.col("sexo").isNotNull())
        .groupBy("sexo")
        .agg(rows().alias("total"), F.round(F.avg("dias_perm"), 1).alias("media_dias"))
        .orderBy(F.desc("total"), "sexo")
    )


def by_age(df: DataFrame) -> DataFrame:
    return by_age_band(df, F.col("idade"))


def stay_by_state(df: DataFrame) -> DataFrame:
    return (
        df.where(F.col("dias_perm").isNotNull())
        .groupBy("uf")
        .agg(
            rows().alias("internacoes"),
            F.round(F.avg("dias_perm"), 1).alias("media_dias"),
            F.max("dias_perm").alias("max_dias"),
        )
        .orderBy(F.desc("media_dias"), "uf")
    )


def value_by_month(df: DataFrame) -> DataFrame:
    return monthly(df, "dt_inter", valor_total=money("val_tot"), internacoes=rows())


def respiratory_by_month(df: DataFrame, since: str = "2000-01-01", limit: float = 2.0) -> DataFrame:
    """Admissions with a J code per month, without days whose count is an outlier.

    Mean and deviation of the daily counts reach the filter as one scalar
    subquery that reuses the daily aggregation, so no task sees all days in a
    window.  A zero deviation gives no score and drops the day.
    """
    daily = (
        df.where(F.col("diag_princ").like("J%") & (F.col("dt_inter") >= F.lit(since).cast("date")))
        .groupBy(F.col("dt_inter").alias("data"))
        .agg(F.count("diag_princ").alias("total_cids"))
    )
    spread = daily.agg(F.avg("total_cids").alias("mean"), F.stddev("total_cids").alias("deviation"))
    score = F.try_divide(
        F.col("total_cids") - spread.select("mean").scalar(), spread.select("deviation").scalar()
    )
    return (
        daily.where(F.abs(score) <= limit)
        .groupBy(F.trunc("data", "MM").alias("mes"))
        .agg(F.sum("total_cids").alias("total_cids_mes"))
        .orderBy("mes")
    )


TEMPLATES = {
    "admissions_by_state": admissions_by_state,
    "monthly_series": monthly_series,
    "top_diagnoses": top_diagnoses,
    "top_procedures": top_procedures,
    "by_sex": by_sex,
    "by_age": by_age,
    "stay_by_state": stay_by_state,
    "value_by_month": value_by_month,
    "respiratory_by_month": respiratory_by_month,
}
