"""Own annotation columns.

An annotation builder is a function of keyword Columns ``reply, row, analysis, key,
media, called`` that returns ``{column name: Column}``. Plain Column code is best; for
logic that needs Python, ``row_hook`` wraps a per-row function.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossa.functions.cells import json_text

# Fixed value: start of the error text of a failed hook.
HOOK_ERROR = "Annotation materialise error: "


def row_hook(
    fn: Callable[[dict | None, dict, dict | None, str, str | None], dict[str, Any]],
    schema: T.StructType,
) -> Callable[..., dict[str, Column]]:
    """Wrap ``fn(reply, row, analysis, key, media) -> dict`` as an annotation builder.

    Runs in Arrow batches, on called rows only. A row whose call raises gets blanks and
    the reason in every ``*_error`` column.
    """
    names = schema.fieldNames()
    start = HOOK_ERROR

    @F.pandas_udf(schema)
    def run(reply, row, analysis, key, media, called):
        import json

        import pandas as pd

        def one(values):
            parsed = [json.loads(v) if isinstance(v, str) else None for v in values[:3]]
            blank = dict.fromkeys(names)
            if not values[5]:
                return blank
            try:
                made = fn(*parsed, values[3], values[4])
                return {n: made.get(n) for n in names}
            except Exception as exc:
                failed = {n: f"{start}{exc}" for n in names if n.endswith("_error")}
                return blank | failed

        rows = zip(reply, row, analysis, key, media, called)
        return pd.DataFrame([one(v) for v in rows], columns=names)

    def columns(reply, row, analysis, key, media, called) -> dict[str, Column]:
        def as_json(c: Column) -> Column:
            # Rows that were not called send nothing to Python.
            return F.when(called & c.isNotNull(), json_text(c))

        made = run(as_json(reply), as_json(row), as_json(analysis), key, media, called)
        return {n: made.getField(n) for n in names}

    # The names are known without building the expression.
    columns.names = names
    return columns
