"""Which rows get the second pass, and which carry something from it."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossa.functions.text import strip
from glossa.schema_spec import FieldSpec


def _truthy(c: Column, f: FieldSpec) -> Column:
    if f.kind == "bool":
        return c
    if isinstance(f.data_type, T.StringType):
        return c != ""
    if isinstance(f.data_type, T.NumericType):
        return c != 0
    if isinstance(f.data_type, (T.ArrayType, T.MapType)):
        return F.size(c) > 0
    return F.lit(True)


def _equals(c: Column, f: FieldSpec, expected: Any) -> Column:
    numeric = isinstance(f.data_type, (T.NumericType, T.BooleanType))
    if f.kind == "enum":
        return F.upper(c) == str(expected).upper()
    if isinstance(expected, bool):
        return _truthy(c, f) == F.lit(expected)
    if isinstance(expected, (int, float)) and numeric:
        return c.cast("double") == F.lit(float(expected))
    if isinstance(expected, str) and isinstance(f.data_type, T.StringType):
        return c == expected
    return F.lit(False)


def field_rules(analysis: Column, spec: tuple[FieldSpec, ...], rules: dict[str, Any]) -> Column:
    """True where every rule holds. Null never holds, nor does a field the layout lacks."""
    known = {f.name: f for f in spec}
    checks = []
    for name, expected in rules.items():
        if name not in known:
            return F.lit(False)
        field = analysis.getField(name)
        held = field.isNotNull() & _equals(field, known[name], expected)
        checks.append(F.coalesce(held, F.lit(False)))
    return reduce(lambda a, b: a & b, checks, F.lit(True))


def annotation_gate(
    analysis: Column,
    spec: tuple[FieldSpec, ...],
    enabled: bool = True,
    criteria: Callable[[Column], Column] | None = None,
    rules: dict[str, Any] | None = None,
) -> Column:
    """Own criteria, else field rules, else every row; never a row without an analysis."""
    if not enabled:
        return F.lit(False)
    if criteria is not None:
        chosen = F.coalesce(criteria(analysis).cast("boolean"), F.lit(False))
    elif rules:
        chosen = field_rules(analysis, spec, rules)
    else:
        chosen = F.lit(True)
    return analysis.isNotNull() & chosen


def has_payload(columns: list[str]) -> Column:
    """True where a ``*_json`` or ``*_error`` annotation column is neither null nor blank."""
    keys = [c for c in columns if c.endswith(("_json", "_error"))]
    filled = [F.coalesce(strip(F.col(c).cast("string")) != "", F.lit(False)) for c in keys]
    return reduce(lambda a, b: a | b, filled, F.lit(False))
