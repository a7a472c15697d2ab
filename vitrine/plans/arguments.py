"""Typed, range-checked arguments of the catalog tools."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, fields


class BadArguments(ValueError):
    """Carries one message per broken rule."""

    def __init__(self, problems: list[str]):
        super().__init__("; ".join(problems))
        self.problems = problems


def _option(default, kind: type, low=None, high=None, choices=None, pattern=False):
    return field(default=default, metadata={"kind": kind, "low": low, "high": high, "choices": choices, "pattern": pattern})


@dataclass(frozen=True)
class _Arguments:
    @classmethod
    def read(cls, values: dict | None):
        """Build from a plain dict; unknown names and wrong types are refused, never converted."""
        values = dict(values or {})
        known = {f.name: f for f in fields(cls)}
        problems = [f"{name}: not an argument" for name in values if name not in known]
        for name, value in values.items():
            if name in known:
                problems += _problems(name, value, known[name])
        if problems:
            raise BadArguments(problems)
        return cls(**values)


def _problems(name: str, value, spec) -> list[str]:
    rule = spec.metadata
    if value is None:
        return [] if spec.default is None else [f"{name}: must not be null"]
    kind = rule["kind"]
    right = type(value) is kind or (kind is float and type(value) is int)
    if not right:
        return [f"{name}: expected {kind.__name__}"]
    found = []
    if rule["low"] is not None and value < rule["low"]:
        found.append(f"{name}: below {rule['low']}")
    if rule["high"] is not None and value > rule["high"]:
        found.append(f"{name}: above {rule['high']}")
    if rule["choices"] and value not in rule["choices"]:
        found.append(f"{name}: not one of {', '.join(rule['choices'])}")
    if rule["pattern"]:
        try:
            re.compile(value)
        except re.error as wrong:
            found.append(f"{name}: not a pattern: {wrong}")
    return found


@dataclass(frozen=True)
class TopProducts(_Arguments):
    limit: int = _option(10, int, 1, 50)
    category: str | None = _option(None, str)
    min_score: float | None = _option(None, float, 0.0, 1.0)


@dataclass(frozen=True)
class ClusterSummary(_Arguments):
    include_products: bool = _option(False, bool)


@dataclass(frozen=True)
class Anomalies(_Arguments):
    limit: int = _option(20, int, 1, 100)


@dataclass(frozen=True)
class AssociationRules(_Arguments):
    min_lift: float = _option(1.0, float, 0.0)
    limit: int = _option(10, int, 1, 100)


@dataclass(frozen=True)
class CatalogStats(_Arguments):
    group_by: str = _option("category", str, choices=("category", "shop_name", "source_platform"))


@dataclass(frozen=True)
class SearchProducts(_Arguments):
    query: str | None = _option(None, str, pattern=True)
    category: str | None = _option(None, str)
    min_price: float | None = _option(None, float, 0.0)
    max_price: float | None = _option(None, float, 0.0)
    min_rating: float | None = _option(None, float, 0.0, 5.0)
    in_stock_only: bool = _option(False, bool)
    limit: int = _option(20, int, 1, 200)


@dataclass(frozen=True)
class ShopRanking(_Arguments):
    limit: int = _option(10, int, 1, 100)
    sort_by: str = _option("composite_score", str, choices=("composite_score", "rating", "n_products"))
