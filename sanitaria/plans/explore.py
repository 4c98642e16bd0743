"""Exploratory queries over admissions, and counts per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sanitaria.plans.common import rows


def basic_totals(df: DataFrame) -> DataFrame:
    value = F.col("val_tot").cast("double")
    return df.agg(
        rows().alias("total_internacoes"),
        F.countDistinct("munic_res").alias("total_municipios"),
        F.sum("qt_diarias").alias("total_diarias"),
        F.round(F.avg(value), 2).alias("valor_medio"),
        F.round(F.max(value), 2).alias("valor_maximo"),
    )


def top_municipalities(df: DataFrame, n: int = 10) -> DataFrame:
    return (
        df.where(F.col("munic_res").isNotNull())
        .groupBy(F.col("munic_res").alias("codigo_municipio"))
        .agg(
            rows().alias("total_internacoes"),
            F.round(F.avg("dias_perm"), 2).alias("media_dias"),
            F.round(F.sum(F.col("val_tot").cast("double")), 2).alias("valor_total"),
        )
        .orderBy(F.desc("total_internacoes"), "codigo_municipio")
        .limit(n)
    )


def monthly_trends(df: DataFrame) -> DataFrame:
    value = F.col("val_tot").cast("double")
    return (
        df.where(F.col("dt_inter").isNotNull())
        .groupBy(F.year("dt_inter").alias("ano"), F.month("dt_inter").alias("mes"))
        .agg(
            rows().alias("total_internacoes"),
            F.round(F.avg("dias_perm"), 2).alias("media_dias_internacao"),
            F.round(F.sum(value), 2).alias("valor_total"),
            F.round(F.avg(value), 2).alias("valor_medio"),
        )
        .orderBy("ano", "mes")
    )


def demographics(df: DataFrame) -> DataFrame:
    """Sex by three age bands."""
    age = F.col("idade")
    band = F.when(age < 18, "0-17").when(age.between(18, 59), "18-59").otherwise("60+")
    return (
        df.where(age.isNotNull())
        .groupBy("sexo", band.alias("faixa_etaria"))
        .agg(
            rows().alias("total"),
            F.round(F.avg("dias_perm"), 2).alias("media_dias"),
            F.round(F.avg(F.col("val_tot").cast("double")), 2).alias("valor_medio"),
        )
        .orderBy(F.col("sexo").asc_nulls_last(), "faixa_etaria")
    )


def top_procedures_per_month(df: DataFrame, n: int = 3, year: int | None = None) -> DataFrame:
    """The ``n`` most frequent procedures of every calendar month.

    The window ranks counts per month and procedure, not rows; Spark prunes each
    group to ``n`` before its shuffle.
    """
    known = df.where(F.col("proc_rea").isNotNull() & F.col("dt_inter").isNotNull())
    if year is not None:
        known = known.where(F.year("dt_inter") == year)
    counts = known.groupBy(F.month("dt_inter").alias("mes"), "proc_rea").agg(rows().alias("quantidade"))
    rank = F.row_number().over(Window.partitionBy("mes").orderBy(F.desc("quantidade"), "proc_rea"))
    return counts.withColumn("rank", rank).where(F.col("rank") <= n).orderBy("mes", "rank")


def intensive_care(df: DataFrame) -> DataFrame:
    """Sex by use of intensive care: cases, mean stay and mean costs."""
    used = F.when(F.col("marca_uti") == 1, "Com UTI").otherwise("Sem UTI")
    return (
        df.where(F.col("sexo").isNotNull())
        .groupBy("sexo", used.alias("utilizou_uti"))
        .agg(
            rows().alias("total_casos"),
            F.round(F.avg("dias_perm"), 2).alias("media_dias"),
            F.round(F.avg(F.col("val_uti").cast("double")), 2).alias("valor_medio_uti"),
            F.round(F.avg(F.col("val_tot").cast("double")), 2).alias("valor_medio_total"),
        )
        .orderBy("sexo", "utilizou_uti")
    )


def state_year(df: DataFrame, uf: str, year: int) -> DataFrame:
    """Admissions of one state and year; the state prunes partitions."""
    day = F.col("dt_inter")
    inside = day.between(F.make_date(F.lit(year), F.lit(1), F.lit(1)), F.make_date(F.lit(year), F.lit(12), F.lit(31)))
    return (
        df.where((F.col("uf") == uf) & inside)
        .groupBy(F.year(day).alias("ano"), "uf")
        .agg(rows().alias("total"))
    )


def rows_per_file(df: DataFrame) -> DataFrame:
    return df.groupBy("source_file").agg(rows().alias("row_count")).orderBy("source_file")


def rows_per_state(df: DataFrame) -> DataFrame:
    return df.groupBy("uf").agg(rows().alias("row_count")).orderBy("uf")


def file_totals(df: DataFrame) -> DataFrame:
    """Rows and distinct source files; files are counted from per-file counts, so hot files do not matter."""
    per_file = df.groupBy("source_file").agg(rows().alias("n"))
    return per_file.agg(F.sum("n").alias("row_count"), F.count("source_file").alias("source_files"))
