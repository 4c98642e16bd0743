"""Questions as data: projections, groups, filters and order without SQL text."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sanitaria.functions import columns as C
from sanitaria.operators.distinct import with_distinct_counts
from sanitaria.operators.predicates import rules_to_column

_AGGREGATES = {
    "count": F.count,
    "count_distinct": F.countDistinct,
    "sum": F.sum,
    "avg": F.avg,
    "min": F.min,
    "max": F.max,
}
DEFAULT_ROWS = 10_000
MAX_ROWS = 100_000


class QuestionError(ValueError):
    """The question cannot be asked; ``keys`` name the problems."""

    def __init__(self, keys: Sequence[str]):
        super().__init__(", ".join(keys))
        self.keys = list(keys)


@dataclass(frozen=True)
class Projection:
    column: str
    aggregation: str = "none"

    @property
    def name(self) -> str:
        return self.column if self.aggregation == "none" else f"{self.aggregation}_{self.column}"


@dataclass(frozen=True)
class Question:
    projections: Sequence[Projection]
    group_by: Sequence[str] = ()
    where: Mapping[str, Any] | None = None
    order_by: tuple[str, str] | None = None
    limit: int | None = None

    @staticmethod
    def of(spec: Mapping[str, Any]) -> Question:
        """From a plain dict; a projection is a column name or a ``(column, aggregation)`` pair."""
        made = [
            p if isinstance(p, Projection) else Projection(p) if isinstance(p, str) else Projection(*p)
            for p in spec.get("projections", ())
        ]
        return Question(
            made, tuple(spec.get("group_by", ())), spec.get("where"), spec.get("order_by"), spec.get("limit")
        )


@dataclass(frozen=True)
class Diagnosis:
    errors: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)


def allowed_aggregates(kind: T.DataType) -> list[str]:
    """Aggregations a column type offers: sums need numbers, extremes need an order."""
    names = ["count", "count_distinct"]
    if isinstance(kind, T.NumericType):
        names += ["sum", "avg"]
    if not isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.BooleanType)):
        names += ["min", "max"]
    return names


def diagnose(question: Question, schema: T.StructType) -> Diagnosis:
    """Problems that block the question, and hints that do not."""
    # The keys of problems, with the columns that they are about.
    errors: list[str] = []
    aggregated = [p for p in question.projections if p.aggregation != "none"]
    plain = [p.column for p in question.projections if p.aggregation == "none"]
    if not question.projections:
        errors.append("projections.empty")
    for name in {*(p.column for p in question.projections), *question.group_by}:
        if name not in schema.names:
            errors.append(f"column.unknown:{name}")
    if aggregated or question.group_by:
        errors += [f"projection.missingGroupBy:{c}" for c in plain if c not in question.group_by]
    taken = {p.column for p in aggregated}
    errors += [f"groupBy.conflictsWithAgg:{c}" for c in question.group_by if c in taken]
    for p in aggregated:
        if p.column in schema.names and p.aggregation not in allowed_aggregates(schema[p.column].dataType):
            errors.append(f"aggregation.notForType:{p.name}")
    hints = ["groupBy.noAggregation"] if question.group_by and not aggregated else []
    return Diagnosis(errors, hints)


def _ordering(name: str, direction: str) -> Column:
    c = C.quoted(name)
    return c.asc_nulls_last() if direction.upper() == "ASC" else c.desc_nulls_last()


def ask(df: DataFrame, spec: Question | Mapping[str, Any]) -> DataFrame:
    """Run a question; raises :class:`QuestionError` when it is not well formed.

    One distinct count is an aggregate like the others; several are taken from distinct ``(column, value)``
    pairs (:mod:`sanitaria.operators.distinct`).
    """
    question = spec if isinstance(spec, Question) else Question.of(spec)
    found = diagnose(question, df.schema)
    if found.errors:
        raise QuestionError(found.errors)

    rows = df.where(rules_to_column(question.where, df.schema)) if question.where else df
    names = [p.name for p in question.projections]
    aggregated = [p for p in question.projections if p.aggregation != "none"]
    aggregates = [_AGGREGATES[p.aggregation](C.quoted(p.column)).alias(p.name) for p in aggregated]
    distinct = {p.name: p.column for p in aggregated if p.aggregation == "count_distinct"}
    if len(distinct) > 1:
        others = [a for p, a in zip(aggregated, aggregates, strict=True) if p.name not in distinct]
        rows = with_distinct_counts(rows, question.group_by, others, distinct)
    elif question.group_by:
        keys = [C.quoted(c) for c in question.group_by]
        rows = rows.groupBy(*keys).agg(*aggregates) if aggregates else rows.select(*keys).distinct()
    elif aggregates:
        rows = rows.agg(*aggregates)
    if question.order_by:
        # Ties go by the columns that are shown, so that a limit cuts the same rows each time.
        others = [n for n in names if n != question.order_by[0] and not isinstance(rows.schema[n].dataType, T.MapType)]
        rows = rows.orderBy(_ordering(*question.order_by), *(C.quoted(n).asc_nulls_last() for n in others))
    rows = rows.select([C.quoted(n) for n in names])
    return rows.limit(int(question.limit)) if question.limit and question.limit > 0 else rows


@dataclass(frozen=True)
class Preview:
    columns: list[str]
    rows: list[list[Any]]
    row_count: int
    truncated: bool
    elapsed_ms: float
    limit_applied: int
    total_rows: int | None = None


def checked_limit(limit: int) -> int:
    """``limit`` if it is within 1 and ``MAX_ROWS``; no other one is cut to fit in silence."""
    if not 1 <= int(limit) <= MAX_ROWS:
        raise ValueError(f"limit must be between 1 and {MAX_ROWS}, not {limit}")
    return int(limit)


def preview(spark: SparkSession, query: str | DataFrame, limit: int = DEFAULT_ROWS) -> Preview:
    """The first rows of a query for display.

    One row more than shown is fetched, so a result of exactly ``limit`` rows is
    not called cut.  The full count runs only for a cut result.  More than ``MAX_ROWS`` rows
    are refused: they all come to the driver.
    """
    shown = checked_limit(limit)
    started = time.perf_counter()
    result = spark.sql(query) if isinstance(query, str) else query
    fetched = [list(row) for row in result.take(shown + 1)]
    cut = len(fetched) > shown
    rows = fetched[:shown]
    elapsed = (time.perf_counter() - started) * 1000
    return Preview(
        result.columns, rows, len(rows), cut, round(elapsed, 2), shown, result.count() if cut else None
    )


def sample_rows(df: DataFrame, n: int, seed: int | None = None) -> DataFrame:
    """``n`` random rows, or all if there are fewer: those with the smallest random keys.

    Every task keeps its ``n`` smallest keys and passes only these on.
    """
    return df.withColumn("_key", F.rand(seed)).orderBy("_key").limit(n).drop("_key")
