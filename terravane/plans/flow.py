"""Flows: operators chained by name and keyword properties, as one lazy plan.

>>> Flow().add("round_field", column="length", digits=2).run(df)

Host behaviour around operators: a failure flow gives the error instead of
rows; names may be templated from attributes.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from importlib import import_module
from inspect import getmembers, isfunction

from pyspark.sql import DataFrame

MODULES = ("terravane.operators.fields", "terravane.operators.joins", "terravane.operators.aggregates", "terravane.operators.vertices", "terravane.operators.spatial", "terravane.operators.tiles", "terravane.operators.solids", "terravane.operators.network", "terravane.operators.images", "terravane.operators.export", "terravane.operators.validate", "terravane.functions.crs", "terravane.sources.readers")


def operators() -> dict[str, Callable]:
    """All public operators by name; names that two modules share are found as module.name alone."""
    out: dict[str, Callable] = {}
    seen: dict[str, int] = {}
    for m in MODULES:
        short = m.rsplit(".", 1)[-1]
        for name, f in getmembers(import_module(m), isfunction):
            if f.__module__ == m and not name.startswith("_"):
                out[f"{short}.{name}"] = f
                seen[name] = seen.get(name, 0) + 1
    for key, f in list(out.items()):
        if seen[key.split(".")[1]] == 1:
            out[key.split(".")[1]] = f
    return out


def template(text: str, attributes: dict[str, str]) -> str:
    """${name}, ${name:substringBefore('x')}, ${name:append('x')} and #{name}, filled in from attributes."""

    def fill(m: re.Match) -> str:
        name, *calls = re.split(r":(?=\w+\()", m[1])
        value = str(attributes.get(name, ""))
        for call in calls:
            f, arg = re.fullmatch(r"(\w+)\(\s*(?:'([^']*)'|\"([^\"]*)\"|)\s*\)", call).group(1, 2)
            value = {"substringBefore": lambda v, a: v.split(a)[0], "substringAfter": lambda v, a: v.partition(a)[2], "append": lambda v, a: v + a, "prepend": lambda v, a: a + v, "toLower": lambda v, a: v.lower(), "toUpper": lambda v, a: v.upper(), "trim": lambda v, a: v.strip()}[f](value, arg or "")
        return value

    return re.sub(r"[$#]\{([^}]*)\}", fill, text)


class Flow:
    def __init__(self, attributes: dict[str, str] | None = None):
        self.attributes = dict(attributes or {})
        self.steps: list[tuple[Callable, tuple, dict]] = []

    def add(self, operator: str | Callable, *more: DataFrame, **properties) -> Flow:
        """operator(df, *more, **properties); texts among the properties are templates."""
        self.steps.append((operators()[operator] if isinstance(operator, str) else operator, more, properties))
        return self

    def update_attributes(self, **values: str) -> Flow:
        self.attributes.update({k: template(v, self.attributes) for k, v in values.items()})
        return self

    def run(self, df: DataFrame) -> DataFrame:
        for f, more, properties in self.steps:
            df = f(df, *more, **{k: template(v, self.attributes) if isinstance(v, str) else v for k, v in properties.items()})
        return df
