"""Exact distinct counts of several columns at once, without a copy of every row for each of them in the shuffle.

Several ``count(DISTINCT ..)`` in one aggregate make the engine copy each whole row once per column and
group the copies.  Here whole numbers of a small type are marks in bitmaps of fixed size, taken in the same pass as
everything else, and other columns become ``(column, value)`` pairs that hold nothing but the value
and are made distinct within each task before they are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sanitaria.functions import columns as C


def has_bitmap(kind: T.DataType) -> bool:
    """Whether all values of a type fit into two bitmaps of 4 KB and one flag."""
    return isinstance(kind, (T.ByteType, T.ShortType))


def bitmap_count(name: str) -> Column:
    """Distinct values of a small whole-number column, as an aggregate of 8 KB of state.

    The bucket of 1 to 32,767 and that of 0 to -32,767 have a bitmap each; -32,768 is the only value outside them.
    """
    v = C.quoted(name).cast("long")
    marks = [
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(F.when(inside, v))))
        for inside in (v > 0, v.between(-32_767, 0))
    ]
    return marks[0] + marks[1] + F.coalesce(F.max((v == -32_768).cast("int")), F.lit(0))


def as_pair_value(name: str, kind: T.DataType) -> Column:
    """A value as text, equal for equal values only."""
    c = C.quoted(name)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(c == 0, F.lit("0")).otherwise(c.cast("string"))  # both zeros are one value
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("string")  # its text repeats an hour each autumn
    if isinstance(kind, T.BinaryType):
        return F.hex(c)
    if isinstance(kind, (T.ArrayType, T.StructType)):
        return F.when(c.isNotNull(), F.to_json(F.struct(c.alias("v")), {"ignoreNullFields": "false"}))
    return c.cast("string")


def distinct_pairs(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """``keys, _at, n``: distinct values that are not null of each of ``columns`` (by place) in each group of ``keys``.

    Groups in which a column has no value have no row for it.
    """
    values = F.array(*(as_pair_value(n, df.schema[n].dataType) for n in columns))
    groups = [f"_k{i}" for i in range(len(keys))]
    named = df.select(*(C.quoted(k).alias(g) for k, g in zip(keys, groups, strict=True)), F.posexplode(values).alias("_at", "_value"))
    pairs = named.where(F.col("_value").isNotNull()).distinct()
    counted = pairs.groupBy(*groups, "_at").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(*(F.col(g).alias(k) for k, g in zip(keys, groups, strict=True)), "_at", "n")


def with_distinct_counts(df: DataFrame, keys: Sequence[str], measures: Sequence[Column], distinct: dict[str, str]) -> DataFrame:
    """``df`` grouped by ``keys`` with ``measures`` and, under the names that ``distinct`` maps to columns, their distinct counts.

    One pass takes the measures and one the pairs; both meet on the keys, where null equals null.  Rows without keys
    need no pairs for small whole numbers.
    """
    small = {n: c for n, c in distinct.items() if not keys and has_bitmap(df.schema[c].dataType)}
    rest = {n: c for n, c in distinct.items() if n not in small}
    columns = list(dict.fromkeys(rest.values()))
    groups, others = ([f"{mark}{i}" for i in range(len(keys))] for mark in ("_group", "_other"))
    first = [*measures, *(bitmap_count(c).alias(n) for n, c in small.items())] or [F.lit(0).alias("_none")]
    plain = df.groupBy(*(C.quoted(k).alias(g) for k, g in zip(keys, groups, strict=True))).agg(*first)
    kept = [*plain.columns[len(keys) :], *rest]
    if rest:
        counts = [F.sum(F.when(F.col("_at") == i, F.col("n"))).alias(f"_n{i}") for i in range(len(columns))]
        pairs = distinct_pairs(df, columns, keys)
        found = pairs.groupBy(*(C.quoted(k).alias(o) for k, o in zip(keys, others, strict=True))).agg(*counts)
        if keys:
            same = [F.col(g).eqNullSafe(F.col(o)) for g, o in zip(groups, others, strict=True)]
            plain = plain.join(found, same, "left")
        else:  # one row each
            both = plain.unionByName(found, allowMissingColumns=True)
            plain = both.agg(*(F.first(C.quoted(c), ignorenulls=True).alias(c) for c in both.columns))
        plain = plain.withColumns({n: F.coalesce(f"_n{columns.index(c)}", F.lit(0)) for n, c in rest.items()})
    shown = [F.col(g).alias(k) for g, k in zip(groups, keys, strict=True)]
    return plain.select(*shown, *(C.quoted(c) for c in kept if c != "_none"))
