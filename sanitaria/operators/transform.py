"""Raw text rows to the canonical table of a system."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sanitaria.functions import columns as C
from sanitaria.operators.enrich import with_municipality
from sanitaria.systems import System, get_system

# Columns that hold sex and race codes.
SEX_COLUMNS = ("sexo",)
RACE_COLUMNS = ("raca_cor", "racacor")


def clean_columns(df: DataFrame, upper: bool = False) -> DataFrame:
    """Every column as clean text under its lower-case name.

    ``C.clean`` in its three steps, one projection each: every step uses its value several times and would
    otherwise compute all steps before it as often.
    """
    if upper:
        return df.select([C.clean_upper(C.quoted(name)).alias(name.lower()) for name in df.columns])
    rows = df
    for step in (C.visible, C.trim_spaces, C.not_empty):
        made = [step(C.quoted(name)) for name in rows.columns]
        rows = rows.select([c.alias(name.lower()) for c, name in zip([*map(C.apart, made[:1]), *made[1:]], rows.columns)])
    return rows


def typed_column(system: System, name: str) -> Column:
    """The typing rule of one cleaned column."""
    c, kind = C.quoted(name), system.fields[name]
    if name in SEX_COLUMNS:
        return C.recode(c, system.sex, system.sex_default)
    if name in RACE_COLUMNS:
        return C.recode(c, system.race, "Ignorado")
    if kind == "array<string>":
        return C.diagnosis_list(c)
    if name in system.code_columns:
        return C.diagnosis_code(c)
    if name in system.time_columns:
        return C.parse_time(c)
    if kind == "date":
        return C.parse_date(c)
    if kind == "boolean":
        return C.to_boolean(c, *system.booleans[name]) if name in system.booleans else C.to_boolean(c)
    if kind == "float":
        return C.to_float(c)
    if kind == "string":
        return c
    return C.to_integer(c, kind, system.unsigned_max.get(name))


def canonicalize(
    cleaned: DataFrame, system: str | System, raw: bool = False, keep: Sequence[str] = (), fill: bool = True
) -> DataFrame:
    """All columns of the system's schema, in order.

    Columns the source lacks become typed NULLs, columns the schema lacks are
    dropped, but for text columns in ``keep``.  ``raw`` keeps the clean text instead of typing it.  Without ``fill``
    columns the source lacks are left out, for ``write_store`` to add (``fill``) when rows have been moved and sorted.
    """
    spec = get_system(system)
    present = [name for name in spec.fields if name in cleaned.columns]
    kept = [T.StructField(name, T.StringType()) for name in keep]
    if raw:
        kinds = {name: T.StringType() for name in present}
        fields = [T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in spec.schema.fields]
        fields = fields if fill else [f for f in fields if f.name in present]
        return cleaned.select([C.quoted(name) for name in (*present, *keep)]).to(T.StructType([*fields, *kept]))
    columns = {name: typed_column(spec, name) for name in present}
    if spec.encoded_age in present:
        age = C.quoted(spec.encoded_age)
        columns[f"{spec.encoded_age}_valor"] = C.age_value(age)
        columns[f"{spec.encoded_age}_unidade"] = C.age_unit(age)
    for name in present[:1]:
        columns[name] = C.apart(columns[name])
    typed = cleaned.select([column.alias(name) for name, column in columns.items()] + [C.quoted(name) for name in keep])
    fields = [f for f in spec.schema.fields if fill or f.name in columns]
    return typed.to(T.StructType([*fields, *kept]))


def transform(
    df: DataFrame,
    system: str | System,
    *,
    raw: bool = False,
    upper: bool = False,
    with_year: bool = False,
    drop_undated: bool = False,
    municipalities: DataFrame | None = None,
    fill: bool = True,
) -> DataFrame:
    """Clean, type and decode raw rows into the canonical table; one projection, no shuffle.

    Every row is kept unless ``drop_undated`` asks to lose those with neither an
    admission nor a discharge date.  ``with_year`` adds ``ano_inter``;
    ``municipalities`` adds the residence columns right away; ``fill`` is that of ``canonicalize``.
    """
    spec = get_system(system)
    if (drop_undated or with_year) and not {"dt_inter", "dt_saida"} <= set(spec.fields):
        raise ValueError(f"{spec.name} has no admission and discharge dates")
    result = canonicalize(clean_columns(df, upper), spec, raw, fill=fill)
    if drop_undated:
        result = _without_undated(result)
    if with_year:
        result = result.withColumn("ano_inter", F.year(C.parse_date(F.col("dt_inter")) if raw else F.col("dt_inter")))
    if municipalities is not None and spec.residence:
        result = with_municipality(result, municipalities, spec.residence)
    return result


def _without_undated(typed: DataFrame) -> DataFrame:
    """Drops rows without any date and reports their number as the metric ``undated_rows``.

    The metric sits between typing and filter, which keeps the optimizer from
    copying the whole date parsing into the filter.
    """
    undated = F.col("dt_inter").isNull() & F.col("dt_saida").isNull()
    return typed.observe("dropped", F.count_if(undated).alias("undated_rows")).where(~undated)


def cast_losses(df: DataFrame, system: str | System) -> DataFrame:
    """Per typed column: values present in the raw rows that typing turned into NULL.

    One pass; the long result has one row per column both sides share.
    """
    spec = get_system(system)
    cleaned = clean_columns(df)
    names = [n for n in spec.fields if n in cleaned.columns]
    counts = [
        F.struct(
            F.lit(n).alias("column"),
            F.count(C.quoted(n)).alias("present"),
            F.count_if(C.quoted(n).isNotNull() & typed_column(spec, n).isNull()).alias("lost"),
        )
        for n in names
    ]
    return cleaned.agg(*[c.alias(f"c{i}") for i, c in enumerate(counts)]).select(
        F.inline(F.array(*[F.col(f"c{i}") for i in range(len(counts))]))
    )
