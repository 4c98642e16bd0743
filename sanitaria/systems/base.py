"""What the engine has to know about a record system."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import types as T

_SPARK_TYPES = {
    "string": T.StringType(),
    "tinyint": T.ByteType(),
    "smallint": T.ShortType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "array<string>": T.ArrayType(T.StringType()),
}
NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float")


@dataclass(frozen=True)
class ViewSpec:
    """A view a system shows to its users; ``role`` is ``main`` or ``dim``."""

    name: str
    role: str
    label_pt: str | None = None
    label_en: str | None = None
    description: str | None = None


@dataclass(frozen=True)
class Window:
    """A source folder and the years whose files it holds."""

    folder: str
    first_year: int
    last_year: int


@dataclass(frozen=True)
class System:
    """One record system: its canonical columns and how raw values are read."""

    name: str
    title: str
    prefix: str
    fields: Mapping[str, str]
    event_date: str
    period: Callable[[Column], Column]
    residence: str | None = None
    yearly: bool = False
    windows: tuple[Window, ...] = ()
    unsigned_max: Mapping[str, int] = field(default_factory=dict)
    code_columns: frozenset[str] = frozenset()
    time_columns: frozenset[str] = frozenset()
    booleans: Mapping[str, tuple[tuple[str, ...], tuple[str, ...]]] = field(default_factory=dict)
    sex: Mapping[str, str] = field(default_factory=dict)
    sex_default: str | None = None
    race: Mapping[str, str] = field(default_factory=dict)
    labels: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    encoded_age: str | None = None
    order_by: str | None = None
    mean_file_mb: int = 20
    views: tuple[ViewSpec, ...] | None = None

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, _SPARK_TYPES[t]) for c, t in self.fields.items()])

    def columns_of(self, *types: str) -> list[str]:
        return [c for c, t in self.fields.items() if t in types]

    @property
    def numeric_columns(self) -> list[str]:
        return self.columns_of(*NUMERIC_TYPES)

    @property
    def date_columns(self) -> list[str]:
        return self.columns_of("date")


REGISTRY: dict[str, System] = {}


def register(system: System) -> System:
    REGISTRY[system.name.lower()] = system
    return system


def get_system(system: str | System) -> System:
    if isinstance(system, System):
        return system
    try:
        return REGISTRY[system.lower()]
    except KeyError:
        raise ValueError(f"unknown system {system!r}; registered: {sorted(REGISTRY)}") from None


def system_names() -> list[str]:
    return list(REGISTRY)


def parse_fields(text: str) -> dict[str, str]:
    """``name type`` pairs, comma separated, in schema order."""
    pairs = (item.split() for item in text.replace("\n", " ").split(",") if item.strip())
    return {name: kind for name, kind in pairs}
