"""Running totals, rank cuts and flush numbers against loops."""

import random

import pytest
from pyspark.sql import functions as F

from ticketlake.operators.running import first_rows, flush_numbers, flushes, running_total
from ticketlake.sources.pages import cap_records


def test_running_total(spark):
    r = random.Random(1)
    rows = [(run, p, r.randrange(9)) for run in ("a", "b", None) for p in r.sample(range(200), 60 if run == "a" else 7)]
    df = spark.createDataFrame(rows, "run string, page long, n long")
    want = {(run, p): sum(n for q, o, n in rows if q == run and o < p) for run, p, _ in rows}
    assert {(x.run, x.page): x.before for x in running_total(df, ["run"], ["page"], "n").collect()} == want
    all_ = {(x.run, x.page): x.before for x in running_total(df.where("run = 'a'"), [], ["page"], "n").collect()}
    assert all_ == {k: v for k, v in want.items() if k[0] == "a"}
    assert running_total(df.where("false"), ["run"], ["page"], "n").count() == 0


@pytest.mark.parametrize("n", [0, 1, 37, 150, 151, 400, 999])
def test_first_rows(spark, n):
    r = random.Random(n)
    rows = [(r.randrange(5), i, "x" * 3) for i in range(400)]
    df = spark.createDataFrame(rows, "a long, b long, c string").repartition(7)
    got = first_rows(df, [F.col("a").desc(), F.col("b").asc()], n)
    assert sorted(tuple(x) for x in got.collect()) == sorted(sorted(rows, key=lambda x: (-x[0], x[1]))[:n])


def test_one_hot_order_value_and_empty_input(spark):
    df = spark.range(300).select(F.lit(1).alias("a"), F.col("id").alias("b"))
    assert sorted(x.b for x in first_rows(df, [F.col("a"), F.col("b")], 120).collect()) == list(range(120))
    assert first_rows(df.where("false"), [F.col("a")], 5).count() == 0


def _items(spark, runs=("r0", "r1")):
    return spark.createDataFrame([(run, p, i, f"{run}-{p}-{i}") for run in runs for p in range(12) for i in range(3 + p % 4) if (p + i) % 5],
                                 "run_id string, page_no long, pos long, item string")


@pytest.mark.parametrize("n", [None, 0, 1, 2, 20, 41, 10_000])
def test_cap_records(spark, n):
    items = _items(spark).repartition(5)
    order = sorted((x.run_id, x.page_no, x.pos) for x in items.collect())
    got = cap_records(items, n)
    assert sorted((x.run_id, x.page_no, x.pos) for x in got.collect()) == (order[:n] if n else order)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "TakeOrdered" not in plan and "Sort" not in plan


@pytest.mark.parametrize("size", [1, 2, 7, 10, 500])
def test_flush_numbers(spark, size):
    items = _items(spark).repartition(5)
    want = {}
    for run in ("r0", "r1"):
        own = sorted((x.run_id, x.page_no, x.pos) for x in items.collect() if x.run_id == run)
        want |= {place: i // size for i, place in enumerate(own)}
    got = {(x.run_id, x.page_no, x.pos): x.flush_no for x in flush_numbers(items, size, "run_id", ["page_no"]).collect()}
    assert got == want
    assert flushes(items, size, "run_id").first().flushes == sum(1 + max(v for k, v in want.items() if k[0] == run) for run in ("r0", "r1"))
