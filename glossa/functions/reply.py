"""From the text of a reply to typed columns.

The text is parsed once into a variant; every field is then a path into it. The
parser stops after the first complete value, so the text is wrapped in an array
that ends in a marker: the marker is found again only where the text is exactly
one JSON value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from glossa.schema_spec import FieldSpec, literal

# Messages of replies that hold no object.
EMPTY_REPLY = "Empty response from Gemini"
NOT_AN_OBJECT = "Unexpected response JSON structure"
BAD_JSON = "Invalid JSON in reply"

_MARKER = "end of reply 5f0c"
_ROOT = "$[0]"

# JSON text of values that count as false, besides zeros.
_FALSE_TEXTS = ["false", '""', "[]", "{}"]
_ZERO = r"^-?0+(\.0*)?([eE][+-]?\d+)?$"


def reply_text(candidates: Column) -> Column:
    """Concatenated non-empty part texts of ``array<array<string>>``, null where there is none."""
    parts = F.filter(
        F.flatten(F.filter(candidates, lambda c: c.isNotNull())),
        lambda p: p.isNotNull() & (p != ""),
    )
    return F.when(F.size(parts) > 0, F.array_join(parts, ""))


def parse_reply_json(text: Column) -> Column:
    """The reply as a variant, null where the text is not exactly one JSON value."""
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(f', "{_MARKER}"]')))


def _is_single(parsed: Column) -> Column:
    marker = F.try_variant_get(parsed, "$[1]", "string") == _MARKER
    return F.coalesce(marker, F.lit(False))


def _reply_case(text: Column, parsed: Column, empty: str, bad: str, other: str) -> Column:
    is_object = F.startswith(F.ltrim(text, F.lit(" \t\r\n")), F.lit("{"))
    return (
        F.when(F.coalesce(text, F.lit("")) == "", empty)
        .when(~_is_single(parsed), bad)
        .when(~is_object, other)
    )


def reply_status(text: Column, parsed: Column) -> Column:
    """``ok``, ``empty``, ``bad_json`` or ``not_object``; ``parsed`` is ``parse_reply_json(text)``."""
    return _reply_case(text, parsed, "empty", "bad_json", "not_object").otherwise("ok")


def reply_error(text: Column, parsed: Column) -> Column:
    """Error message of a reply without an object, null for one with."""
    return _reply_case(text, parsed, EMPTY_REPLY, BAD_JSON, NOT_AN_OBJECT)


def enum_value(raw: Column, values: tuple[str, ...]) -> Column:
    """Upper-cased match, else exact match, else the first declared value."""
    if not values:
        return raw
    upper = F.upper(raw)
    return (
        F.when(upper.isin(*values), upper)
        .when(raw.isin(*values), raw)
        .when(raw.isNotNull(), F.lit(values[0]))
    )


def enum_fell_back(raw: Column, values: tuple[str, ...]) -> Column:
    """True where ``enum_value`` had to take the first declared value."""
    return raw.isNotNull() & ~F.upper(raw).isin(*values) & ~raw.isin(*values)


def truth_value(json_text: Column) -> Column:
    """Truthiness of a JSON value given as JSON text; null for JSON null."""
    falsy = json_text.isin(*_FALSE_TEXTS) | F.rlike(json_text, F.lit(_ZERO))
    return F.when(json_text.isNotNull() & (json_text != "null"), ~falsy)


def _field(parsed: Column, path: str, f: FieldSpec) -> Column:
    at = f"{path}.{f.name}"
    text = F.try_variant_get(parsed, at, "string")
    if f.kind == "enum":
        value = enum_value(text, f.values)
    elif f.kind == "string":
        value = text
    elif f.kind == "bool":
        value = truth_value(F.to_json(F.try_variant_get(parsed, at, "variant")))
    elif f.kind == "struct":
        is_object = F.startswith(F.to_json(F.try_variant_get(parsed, at, "variant")), F.lit("{"))
        value = F.when(is_object, _object(parsed, at, f.fields))
    else:
        value = F.try_variant_get(parsed, at, f.data_type.simpleString())
    if f.default is None:
        return value
    return F.when(text.isNull(), literal(f.default, f.data_type)).otherwise(value)


def _object(parsed: Column, path: str, spec: tuple[FieldSpec, ...]) -> Column:
    return F.struct(*[_field(parsed, path, f).alias(f.name) for f in spec])


def reply_struct(parsed: Column, spec: tuple[FieldSpec, ...]) -> Column:
    """Struct with one typed field per ``spec`` entry.

    Absent and null fields take their default, unknown keys are dropped, and a value
    of the wrong shape becomes null.
    """
    return _object(parsed, _ROOT, spec)
