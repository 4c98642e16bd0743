"""Municipality columns and code labels on top of a canonical table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sanitaria.functions import columns as C
from sanitaria.systems import System, get_system

# Column added to the view, and the dimension column behind it.
MUNICIPALITY_COLUMNS = {
    "uf_res": "sigla_uf",
    "municipio_res": "nome_municipio",
    "rg_imediata_res": "nome_regiao_geografica_imediata",
    "rg_intermediaria_res": "nome_regiao_geografica_intermediaria",
}
DIMENSION_KEY = "codigo_municipio_6_digitos"

# The same columns out of the loaded dimension table, whose state is the full name.
LOADED_COLUMNS = {
    "municipio_res": "nome",
    "uf_res": "uf",
    "rg_imediata_res": "regiao_imediata",
    "rg_intermediaria_res": "regiao_intermediaria",
}
LOADED_KEY = "codigo_municipio"


def _join_dimension(
    df: DataFrame, dim: DataFrame, residence: str, key: str, columns: dict[str, str]
) -> DataFrame:
    side = dim.select(F.col(key).alias("_municipality"), *[F.col(src).alias(out) for out, src in columns.items()])
    code = C.six_digit_municipality(C.quoted(residence))
    return df.join(side, code == F.col("_municipality"), "left").drop("_municipality")


def with_municipality(df: DataFrame, dim: DataFrame | None, residence: str | None) -> DataFrame:
    """Left join on the residence code; without a dimension or a code column, ``df`` itself."""
    if dim is None or residence is None:
        return df
    return _join_dimension(df, dim, residence, DIMENSION_KEY, MUNICIPALITY_COLUMNS)


def with_loaded_municipality(df: DataFrame, dim: DataFrame | None, residence: str | None) -> DataFrame:
    """The same join against the loaded dimension table; an empty one leaves ``df`` as it is."""
    if dim is None or residence is None or dim.isEmpty():
        return df
    return _join_dimension(df, dim, residence, LOADED_KEY, LOADED_COLUMNS)


def with_labels(df: DataFrame, system: str | System) -> DataFrame:
    """``<column>_desc`` for every coded column that ``df`` has; unknown codes give NULL."""
    labels = get_system(system).labels
    present = [name for name in labels if name in df.columns]
    return df.withColumns({f"{name}_desc": C.recode(C.quoted(name), labels[name]) for name in present})
