import json

import pytest
from pyspark.sql import functions as F

from ticketlake.functions.labels import (TAG_CLASSIFIED, accepted_fields, append_tag, close_payload, gate,
                                         taxonomy)
from ticketlake.operators.triage import parse_response


@pytest.mark.parametrize("resp,expected", [
    ({"resolution": "bug_fix"}, "pass"),
    ({"resolution": "bug_fix", "confidence": None}, "error"),
    ({"resolution": "bug_fix", "confidence": "0.9"}, "error"),
    ({"resolution": "bug_fix", "confidence": 0.79}, "low"),
    ({"resolution": "bug_fix", "confidence": 0.8}, "pass"),
    ({"resolution": "bug_fix", "confidence": 1}, "pass"),
    ({"resolution": "bug_fix", "confidence": True}, "pass"),
    ({"resolution_confidence": 0.9, "category_confidence": 0.5}, "low"),
    ({"resolution_confidence": 0.5, "confidence": 0.99}, "low"),
])
def test_gate(spark, resp, expected):
    df = spark.createDataFrame([(json.dumps(resp),)], "r string").select(parse_response(F.col("r")).alias("v"))
    assert gate(df, F.col("v")).first()["gate"] == expected


def test_parse_response_rejects(spark):
    df = spark.createDataFrame([("not json",), ("{}",), ("[1]",), ("",), (None,)], "r string")
    assert all(r.v is None for r in df.select(parse_response(F.col("r")).alias("v")).collect())


@pytest.mark.parametrize("resp,expected", [
    ({"resolution": "bug_fix", "confidence": 0.9}, [("resolution", "big_fix")]),
    ({"category": "langgraph_platform", "category_confidence": 0.9}, [("category", "langgraph_langgraph_platform")]),
    ({"category": "x"}, []),
    ({"resolution": "a", "resolution_confidence": 0.9, "category": "b", "category_confidence": 0.7},
     [("resolution", "a")]),
])
def test_accepted_fields(spark, resp, expected):
    df = spark.createDataFrame([(json.dumps(resp),)], "r string").select(parse_response(F.col("r")).alias("v"))
    got = accepted_fields(df, F.col("v")).first()["custom_fields"]
    assert [(x.slug, x.value) for x in got] == expected


def test_tags(spark):
    df = spark.createDataFrame([(None,), ([],), (["auto-classified"],), (["x", "x"],)], "t array<string>")
    got = [r.t for r in df.select(append_tag(F.col("t"), TAG_CLASSIFIED).alias("t")).collect()]
    assert got == [["auto-classified"], ["auto-classified"], ["auto-classified"], ["x", "x", "auto-classified"]]
    p = df.select(close_payload(F.col("t")).alias("p")).first()["p"]
    assert json.loads(p) == {"state": "closed", "tags": ["auto-closed"]}


def test_taxonomy(spark):
    t = taxonomy(spark)
    assert t.where("field = 'resolution'").count() == 6 and t.where("field = 'category'").count() == 26
