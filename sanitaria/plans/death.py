"""Death certificate queries over the ``sim`` view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sanitaria.functions.columns import age_in_years
from sanitaria.plans.common import by_age_band, count_by, monthly, rows


def deaths_by_state(df: DataFrame) -> DataFrame:
    return df.groupBy("uf").agg(rows().alias("total")).orderBy(F.desc("total"), "uf")


def monthly_series(df: DataFrame) -> DataFrame:
    return monthly(df, "dtobito", obitos=rows())


def top_causes(df: DataFrame, n: int = 10) -> DataFrame:
    """Underlying causes, grouped by the whole list of codes."""
    return count_by(df, "causabas").limit(n)


def by_sex(df: DataFrame) -> DataFrame:
    return count_by(df, "sexo")


def by_age(df: DataFrame) -> DataFrame:
    """Age bands over the decoded age in years; unknown ages are left out."""
    return by_age_band(df, age_in_years(F.col("idade_valor"), F.col("idade_unidade")))


def by_place(df: DataFrame) -> DataFrame:
    return count_by(df, "lococor")


def by_schooling(df: DataFrame) -> DataFrame:
    return count_by(df, "esc")


def by_race(df: DataFrame) -> DataFrame:
    return count_by(df, "racacor")


def by_chapter(df: DataFrame, n: int = 10) -> DataFrame:
    """Deaths per diagnosis chapter: first letter of every underlying cause code."""
    codes = df.where(F.col("causabas").isNotNull()).select(F.explode("causabas").alias("code"))
    return (
        codes.groupBy(F.left("code", F.lit(1)).alias("icd_chapter"))
        .agg(rows().alias("deaths"))
        .orderBy(F.desc("deaths"), "icd_chapter")
        .limit(n)
    )


TEMPLATES = {
    "deaths_by_state": deaths_by_state,
    "monthly_series": monthly_series,
    "top_causes": top_causes,
    "by_sex": by_sex,
    "by_age": by_age,
    "by_place": by_place,
    "by_schooling": by_schooling,
    "by_race": by_race,
}
