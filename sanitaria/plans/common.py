"""Pieces the plans share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Lower age, upper age and label of the bands.
AGE_BANDS = (
    (1, 4, "1-4 anos"),
    (5, 14, "5-14 anos"),
    (15, 24, "15-24 anos"),
    (25, 44, "25-44 anos"),
    (45, 64, "45-64 anos"),
)
FIRST_BAND = "0-1 ano"
LAST_BAND = "65+ anos"


def rows() -> Column:
    return F.count(F.lit(1))


def money(name: str) -> Column:
    """Sum of a single-precision amount in double precision, to the cent."""
    return F.round(F.sum(F.col(name).cast("double")), 2)


def age_band(age: Column) -> Column:
    band = F.when(age < 1, FIRST_BAND)
    for low, high, label in AGE_BANDS:
        band = band.when(age.between(low, high), label)
    return band.otherwise(LAST_BAND)


def count_by(df: DataFrame, *keys: str, name: str = "total") -> DataFrame:
    """Rows per key, largest first, without missing keys."""
    present = df
    for key in keys:
        present = present.where(F.col(key).isNotNull())
    return present.groupBy(*keys).agg(rows().alias(name)).orderBy(F.desc(name), *[F.asc(k) for k in keys])


def by_age_band(df: DataFrame, age: Column) -> DataFrame:
    return (
        df.where(age.isNotNull())
        .groupBy(age_band(age).alias("faixa_etaria"))
        .agg(rows().alias("total"), F.min(age).alias("_youngest"))
        .orderBy("_youngest")
        .select("faixa_etaria", "total")
    )


def monthly(df: DataFrame, day: str, **measures: Column) -> DataFrame:
    """Measures per calendar month of a date column."""
    return (
        df.where(F.col(day).isNotNull())
        .groupBy(F.year(day).alias("ano"), F.month(day).alias("mes"))
        .agg(*[measure.alias(name) for name, measure in measures.items()])
        .orderBy("ano", "mes")
    )
