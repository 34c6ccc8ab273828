import pytest
from pyspark.sql import functions as F

from ticketlake.functions.jsonx import json_array, json_ts, json_value, parse, unwrap

DOC = ('{"s": "x", "n": null, "o": {"a": 1}, "arr": [1, 2], "num": 1.50, "i": 7, "b": true, '
       '"e": "", "brace": "{not json}"}')


def one(spark, expr):
    return spark.createDataFrame([(DOC,)], "t string").select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize("path,expected", [
    ("$.s", "x"), ("$.n", None), ("$.o", None), ("$.arr", None), ("$.num", "1.5"), ("$.i", "7"),
    ("$.b", "true"), ("$.e", ""), ("$.brace", "{not json}"), ("$.missing", None), ("$.o.a", "1"),
    ("$.arr[1]", "2"),
])
def test_json_value_rules(spark, path, expected):
    assert one(spark, json_value(parse(F.col("t")), path)) == expected


def test_malformed_and_sql_null(spark):
    df = spark.createDataFrame([("{bad",), (None,), ('{"a":1,"a":2}',)], "t string")
    got = [r["v"] for r in df.select(json_value(parse(F.col("t")), "$.a").alias("v")).collect()]
    assert got == [None, None, "2"]   # of a repeated key the last value holds


def test_json_array(spark):
    n = one(spark, F.size(json_array(parse(F.col("t")), "$.arr")))
    assert n == 2
    assert one(spark, json_array(parse(F.col("t")), "$.s")) is None


@pytest.mark.parametrize("text,expected", [
    ("2024-01-01T10:00:00Z", "2024-01-01 10:00:00"),
    ("2024-01-01T10:00:00.250Z", "2024-01-01 10:00:00.25"),
    ("2024-01-01T10:00:00+05:00", "2024-01-01 05:00:00"),
    ("2024-01-01", "2024-01-01 00:00:00"),
])
def test_json_ts_formats(spark, text, expected):
    df = spark.createDataFrame([(f'{{"t": "{text}"}}',)], "j string")
    got = df.select(json_ts(parse(F.col("j")), "$.t").cast("string").alias("v")).first()["v"]
    assert got == expected


def test_json_ts_malformed(spark):
    df = spark.createDataFrame([('{"t": "not a time"}',)], "j string")
    assert df.select(json_ts(parse(F.col("j")), "$.t", strict=False).alias("v")).first()["v"] is None
    with pytest.raises(Exception):
        df.select(json_ts(parse(F.col("j")), "$.t").alias("v")).collect()


def test_unwrap(spark):
    df = spark.createDataFrame([('{"data": {"id": "1"}}',), ('{"id": "2"}',)], "j string")
    got = [r["v"] for r in df.select(json_value(unwrap(parse(F.col("j"))), "$.id").alias("v")).collect()]
    assert got == ["1", "2"]
