"""Read a dataclass as the typed layout of a reply."""

from __future__ import annotations

import dataclasses
import json
import types as pytypes
from dataclasses import dataclass
from enum import Enum
from typing import Any, Union, get_args, get_origin, get_type_hints

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SCALARS: dict[Any, T.DataType] = {
    str: T.StringType(),
    bool: T.BooleanType(),
    int: T.LongType(),
    float: T.DoubleType(),
}


@dataclass(frozen=True)
class FieldSpec:
    """One reply field. ``kind`` is enum, bool, string, struct or value."""

    name: str
    kind: str
    data_type: T.DataType
    default: Any = None
    values: tuple[str, ...] = ()
    fields: tuple[FieldSpec, ...] = ()


def _unwrap(hint: Any) -> Any:
    """The inner type of ``Optional[X]`` or ``X | None``."""
    if get_origin(hint) in (Union, pytypes.UnionType):
        inner = [a for a in get_args(hint) if a is not type(None)]
        return inner[0] if len(inner) == 1 else hint
    return hint


def _data_type(hint: Any) -> T.DataType:
    hint = _unwrap(hint)
    if hint in _SCALARS:
        return _SCALARS[hint]
    if isinstance(hint, type) and dataclasses.is_dataclass(hint):
        return struct_type(schema_spec(hint))
    if isinstance(hint, type) and issubclass(hint, Enum):
        return T.StringType()
    args = get_args(hint)
    if get_origin(hint) in (list, tuple, set):
        return T.ArrayType(_data_type(args[0]) if args else T.StringType())
    if get_origin(hint) is dict:
        return T.MapType(T.StringType(), _data_type(args[1]) if len(args) > 1 else T.StringType())
    if hint in (list, tuple, set):
        return T.ArrayType(T.StringType())
    if hint is dict:
        return T.MapType(T.StringType(), T.StringType())
    return T.StringType()


def _plain(value: Any) -> Any:
    """A default as plain data: enum members by value, dataclasses as dicts."""
    if isinstance(value, Enum):
        return _plain(value.value)
    if dataclasses.is_dataclass(value) and not isinstance(value, type):
        return {f.name: _plain(getattr(value, f.name)) for f in dataclasses.fields(value)}
    if isinstance(value, (list, tuple, set)):
        return [_plain(v) for v in value]
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    return value


def _default(f: dataclasses.Field) -> Any:
    if f.default is not dataclasses.MISSING:
        return _plain(f.default)
    if f.default_factory is not dataclasses.MISSING:
        return _plain(f.default_factory())
    return None


def schema_spec(cls: type) -> tuple[FieldSpec, ...]:
    hints = get_type_hints(cls)
    out = []
    for f in dataclasses.fields(cls):
        hint = _unwrap(hints.get(f.name, str))
        common = {"name": f.name, "data_type": _data_type(hint), "default": _default(f)}
        if isinstance(hint, type) and dataclasses.is_dataclass(hint):
            out.append(FieldSpec(kind="struct", fields=schema_spec(hint), **common))
        elif isinstance(hint, type) and issubclass(hint, Enum):
            values = tuple(str(_plain(m)) for m in hint)
            out.append(FieldSpec(kind="enum", values=values, **common))
        elif hint is bool:
            out.append(FieldSpec(kind="bool", **common))
        elif hint is str:
            out.append(FieldSpec(kind="string", **common))
        else:
            out.append(FieldSpec(kind="value", **common))
    return tuple(out)


_JSON_TYPES = {
    T.StringType(): "string", T.BooleanType(): "boolean", T.LongType(): "integer", T.DoubleType(): "number",
}


def _json_schema(data_type: T.DataType) -> dict[str, Any]:
    if isinstance(data_type, T.StructType):
        return {"type": "object", "properties": {f.name: _json_schema(f.dataType) for f in data_type}}
    if isinstance(data_type, T.ArrayType):
        return {"type": "array", "items": _json_schema(data_type.elementType)}
    if isinstance(data_type, T.MapType):
        return {"type": "object", "additionalProperties": _json_schema(data_type.valueType)}
    return {"type": _JSON_TYPES[data_type]}


def _object_schema(cls: type) -> dict[str, Any]:
    hints, properties, required = get_type_hints(cls), {}, []
    for f, spec in zip(dataclasses.fields(cls), schema_spec(cls)):
        hint = _unwrap(hints.get(f.name, str))
        made = _object_schema(hint) if spec.kind == "struct" else _json_schema(spec.data_type)
        if spec.values:
            made["enum"] = list(spec.values)
        if "description" in f.metadata:
            made["description"] = f.metadata["description"]
        if hint is not hints.get(f.name, str):
            made["nullable"] = True
        if f.default is dataclasses.MISSING and f.default_factory is dataclasses.MISSING:
            required.append(f.name)
        properties[f.name] = made
    return {"type": "object", "properties": properties, "required": required}


def response_schema(cls: type) -> str:
    """JSON schema of a reply, with the fields' ``metadata["description"]``, for a client to pass on."""
    return json.dumps(_object_schema(cls), ensure_ascii=False)


def struct_type(spec: tuple[FieldSpec, ...]) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.data_type) for f in spec])


def literal(value: Any, data_type: T.DataType) -> Column:
    """Plain data as a Column of the given type."""
    if value is None:
        return F.lit(None).cast(data_type)
    if isinstance(data_type, T.StructType):
        parts = [literal(value.get(f.name), f.dataType).alias(f.name) for f in data_type]
        return F.struct(*parts)
    if isinstance(data_type, T.ArrayType):
        return F.array(*[literal(v, data_type.elementType) for v in value]).cast(data_type)
    if isinstance(data_type, T.MapType):
        flat = [x for k, v in value.items() for x in (F.lit(k), literal(v, data_type.valueType))]
        return F.create_map(*flat).cast(data_type)
    return F.lit(value).cast(data_type)
