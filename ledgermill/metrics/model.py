"""Declarations of semantic models and metrics. Expressions are Spark SQL over one table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column


@dataclass(frozen=True)
class Measure:
    """``agg`` is ``sum`` or ``count_distinct``."""

    name: str
    agg: str
    expr: str


@dataclass(frozen=True)
class SemanticModel:
    """A table with its keys, dimensions and measures.

    ``{today}`` in an expression stands for the evaluation date. ``unique_key`` tells that
    the primary entity identifies one row, so other models may join on it.
    """

    name: str
    primary: str
    entities: dict[str, str]
    dimensions: dict[str, str] = field(default_factory=dict)
    time_dimensions: dict[str, str] = field(default_factory=dict)
    measures: tuple[Measure, ...] = ()
    metric_time: str | None = None
    finest_grain: str = "day"
    unique_key: bool = True

    def measure(self, name: str) -> Measure:
        return next(m for m in self.measures if m.name == name)


@dataclass(frozen=True)
class Simple:
    name: str
    measure: str


@dataclass(frozen=True)
class Cumulative:
    """All-time running value of a measure."""

    name: str
    measure: str


@dataclass(frozen=True)
class Ratio:
    name: str
    numerator: str
    denominator: str


@dataclass(frozen=True)
class Input:
    """A metric used by a derived metric, taken ``offset_months`` earlier."""

    metric: str
    offset_months: int = 0


@dataclass(frozen=True)
class Derived:
    """``formula`` of the inputs, which come as columns in the order given."""

    name: str
    formula: Callable[..., Column]
    inputs: tuple[Input, ...]


Metric = Simple | Cumulative | Ratio | Derived
