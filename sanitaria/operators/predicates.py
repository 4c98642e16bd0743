"""Filters: date range of a system and nested rule groups."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sanitaria.functions import columns as C
from sanitaria.systems import System, get_system


def date_range(system: str | System, start: date | str, end: date | str) -> Column:
    """Event date within ``[start, end]``, both included."""
    day = C.quoted(get_system(system).event_date)
    return day.between(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))


def _values(value: Any) -> list[Any]:
    if isinstance(value, str):
        return [item.strip() for item in value.split(",")]
    return list(value)


def _rule(rule: Mapping[str, Any], schema: T.StructType) -> Column:
    name, operator, value = rule["field"], rule["operator"], rule.get("value")
    if name not in schema.names:
        raise ValueError(f"unknown column in rule: {name}")
    c, kind = C.quoted(name), schema[name].dataType

    def typed(v: Any) -> Column:
        return F.lit(v).cast(kind)

    def text() -> Column:
        return c if isinstance(kind, T.StringType) else c.cast("string")

    match operator:
        case "=":
            return c == typed(value)
        case "!=":
            return c != typed(value)
        case "<":
            return c < typed(value)
        case "<=":
            return c <= typed(value)
        case ">":
            return c > typed(value)
        case ">=":
            return c >= typed(value)
        case "null":
            return c.isNull()
        case "notNull":
            return c.isNotNull()
        case "in":
            return c.isin(*[typed(v) for v in _values(value)])
        case "notIn":
            return ~c.isin(*[typed(v) for v in _values(value)])
        case "between" | "notBetween":
            low, high = _values(value)
            inside = c.between(typed(low), typed(high))
            return inside if operator == "between" else ~inside
        case "contains":
            return text().like(f"%{value}%")
        case "beginsWith":
            return text().like(f"{value}%")
        case "endsWith":
            return text().like(f"%{value}")
        case "doesNotContain":
            return ~text().like(f"%{value}%")
        case "doesNotBeginWith":
            return ~text().like(f"{value}%")
        case "doesNotEndWith":
            return ~text().like(f"%{value}")
    raise ValueError(f"unknown operator in rule: {operator}")


def rules_to_column(group: Mapping[str, Any], schema: T.StructType) -> Column:
    """A rule group ``{combinator, rules, not}`` as one condition; an empty group is true."""
    parts = [
        rules_to_column(item, schema) if "rules" in item else _rule(item, schema) for item in group.get("rules", [])
    ]
    if not parts:
        return F.lit(True)
    either = group.get("combinator", "and").lower() == "or"
    condition = reduce(lambda a, b: a | b if either else a & b, parts)
    return ~condition if group.get("not") else condition


def where_rules(df: DataFrame, group: Mapping[str, Any]) -> DataFrame:
    return df.where(rules_to_column(group, df.schema))
