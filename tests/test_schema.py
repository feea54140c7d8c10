"""Dataclass layouts and what replies become under them."""

from __future__ import annotations

from dataclasses import dataclass, field
from enum import Enum
from typing import Optional

import pytest
from pyspark.sql import functions as F

from glossa.operators import results
from glossa.operators.gate import annotation_gate
from glossa.schema_spec import schema_spec, struct_type


class Level(Enum):
    UP = "UP"
    DOWN = "DOWN"


@dataclass
class Inner:
    name: str
    level: Level = Level.DOWN


@dataclass
class Outer:
    level: Level
    text: Optional[str]
    pipe: str | None
    n: int
    x: float
    flag: bool
    inner: Inner
    many: list[Inner]
    counts: dict[str, int]
    lang: str = "und"
    kept: Inner = field(default_factory=lambda: Inner("d"))
    words: list[str] = field(default_factory=lambda: ["w"])
    opt_level: Level | None = None


SPEC = schema_spec(Outer)


def test_layout():
    assert struct_type(SPEC).simpleString() == (
        "struct<level:string,text:string,pipe:string,n:bigint,x:double,flag:boolean,"
        "inner:struct<name:string,level:string>,many:array<struct<name:string,level:string>>,"
        "counts:map<string,bigint>,lang:string,kept:struct<name:string,level:string>,words:array<string>,"
        "opt_level:string>"
    )
    kinds = {f.name: f.kind for f in SPEC}
    assert kinds["pipe"] == "string" and kinds["opt_level"] == "enum" and kinds["many"] == "value"


def parse(spark, text):
    df = spark.createDataFrame([(text,)], "resp string")
    return results.with_analysis(df, SPEC).first().analysis


def test_full_reply(spark):
    a = parse(spark, """{"level":"up","text":5,"pipe":true,"n":7,"x":2,"flag":"false","inner":{"name":"i","level":"bad"},
        "many":[{"name":"m"}],"counts":{"a":1},"lang":"de","kept":{"name":null},"words":[],"extra":1,"opt_level":"x"}""")
    assert (a.level, a.text, a.pipe, a.n, a.x, a.flag, a.lang, a.words) == ("UP", "5", "true", 7, 2.0, True, "de", [])
    assert a.inner.asDict() == {"name": "i", "level": "UP"}
    assert a.kept.asDict() == {"name": None, "level": "DOWN"}
    assert a.many[0].name == "m" and a.counts == {"a": 1} and a.opt_level == "UP"


def test_empty_reply_takes_defaults(spark):
    a = parse(spark, '{"lang":null}')
    assert (a.level, a.text, a.n, a.flag, a.inner, a.many) == (None,) * 6
    assert (a.lang, a.words, a.kept.name, a.kept.level) == ("und", ["w"], "d", "DOWN")


def test_wrong_shapes_become_null(spark):
    a = parse(spark, '{"n":"many","x":[1],"inner":"text","many":5,"counts":[1]}')
    assert (a.n, a.x, a.inner, a.many, a.counts) == (None,) * 5


def test_no_reply_no_analysis(spark):
    assert parse(spark, None) is None


def test_full_json_keeps_nulls(spark):
    df = results.with_analysis(spark.createDataFrame([('{"name":"é"}',)], "resp string"), schema_spec(Inner))
    from glossa.functions.cells import json_text

    assert df.select(json_text(F.col("analysis"))).first()[0] == '{"name":"é","level":"DOWN"}'


@pytest.mark.parametrize(
    ("rules", "passes"),
    [
        ({"level": "up"}, True), ({"level": "DOWN"}, False), ({"flag": True}, True), ({"flag": False}, False),
        ({"n": 7}, True), ({"n": 7.0}, True), ({"n": "7"}, False), ({"text": "t"}, True), ({"text": True}, True),
        ({"pipe": "x"}, False), ({"absent": 1}, False), ({"words": True}, False), ({"level": "UP", "n": 8}, False),
        ({"inner": True}, True), ({"flag": 1}, True),
    ],
)
def test_field_rules(spark, rules, passes):
    text = '{"level":"UP","text":"t","n":7,"flag":1,"words":[],"inner":{}}'
    df = results.with_analysis(spark.createDataFrame([(text,), (None,)], "resp string"), SPEC)
    got = df.select(annotation_gate(F.col("analysis"), SPEC, rules=rules)).collect()
    assert [r[0] for r in got] == [passes, False]
