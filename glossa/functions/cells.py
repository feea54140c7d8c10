"""Values as text: JSON columns and cells of text sinks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def json_text(struct: Column) -> Column:
    """Compact JSON with null fields kept."""
    return F.to_json(struct, {"ignoreNullFields": "false"})


def _float_text(c: Column) -> Column:
    """Shortest text of a double, plain between 1e-4 and 1e16, else like ``1e+16``."""
    text = c.cast("string")
    digits = F.regexp_replace(F.regexp_extract(text, r"^(-?[\d.]+)E", 1), r"\.0$", "")
    exponent = F.regexp_extract(text, r"E(-?\d+)$", 1)
    power = F.when(exponent != "", exponent.cast("int"))
    sign = F.when(power < 0, "-").otherwise("+")
    scientific = F.concat(digits, F.lit("e"), sign, F.lpad(F.abs(power).cast("string"), 2, "0"))
    plain = F.regexp_replace(text.try_cast("decimal(38,20)").cast("string"), r"(\.\d+?)0+$", "$1")
    return (
        F.when(F.isnan(c), "")
        .when(c == float("inf"), "inf")
        .when(c == float("-inf"), "-inf")
        .when(power.isNull(), text)
        .when((power >= -4) & (power < 16), plain)
        .otherwise(scientific)
    )


def _timestamp_text(c: Column) -> Column:
    whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(c, "SSSSSS")
    return F.when(micros == "000000", whole).otherwise(F.concat(whole, F.lit("."), micros))


def cell_text(
    c: Column, data_type: T.DataType, words: tuple[str, str] = ("TRUE", "FALSE")
) -> Column:
    """Text of a cell: ``''`` for null and NaN, ``TRUE``/``FALSE``, ISO timestamps."""
    if isinstance(data_type, T.BooleanType):
        text = F.when(c, words[0]).when(~c, words[1])
    elif isinstance(data_type, (T.DoubleType, T.FloatType)):
        text = _float_text(c.cast("double"))
    elif isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        text = _timestamp_text(c)
    elif isinstance(data_type, (T.StructType, T.ArrayType, T.MapType)):
        text = json_text(c)
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit(""))
