import re

import pytest
from pyspark.sql import functions as F

from ticketlake.functions.text import ENTITIES, conversation_line, strip_html


def py_strip(s):
    """The J8 rules restated in plain Python (the behaviour to match)."""
    if not s:
        return ""
    t = re.sub(r"<[^>]+>", "", s)
    for a, b in ENTITIES:
        t = t.replace(a, b)
    t = re.sub(r"\s+", " ", t)
    return t.strip()


EDGES = ["<>", "a &amp;lt; b", "<p\nclass='x'>tag across newline</p>", "<<b>>", "x y", "a\x1cb\x1fc",
         "a\u0085b", "a　b", "zero​width", "emoji 😀 <i>ok</i>", "&AMP; &Lt; kept", "&nbsp;&nbsp;x",
         "  lead and trail  ", "&#39;q&#39; &quot;dq&quot; &gt;", "", None, "<script>var a=1;</script>body"]


@pytest.mark.parametrize("s", EDGES)
def test_strip_html_edges(spark, s):
    got = spark.createDataFrame([(s,)], "h string").select(strip_html("h").alias("t")).first()["t"]
    assert got == py_strip(s)


def test_strip_html_pages(spark, sf):
    rows = spark.read.parquet(f"{sf}/pages.parquet").select("html", strip_html("html").alias("t")).collect()
    assert rows and all(r["t"] == py_strip(r["html"]) for r in rows)


def test_conversation_line(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00Z", "a@x", "<b>hi</b>", "Support"),
                                ("t", "c@y", "yo", "Customer"), (None, None, None, "Customer")],
                               "ts string, author string, body string, team string")
    got = [r["l"] for r in df.select(conversation_line("ts", "author", "body", F.col("team")).alias("l")).collect()]
    assert got == ["[2024-01-01T00:00:00Z] a@x(Support): hi", "[t] c@y: yo", "[None] None: "]
    plain = df.select(conversation_line("ts", "author", "body").alias("l")).first()["l"]
    assert plain == "[2024-01-01T00:00:00Z] a@x: hi"
