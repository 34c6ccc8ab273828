"""The response log: answers are asked for once, failed runs are resumed."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from ticketlake.operators.scorer import answered, score_logged
from ticketlake.session import scratch_path


def _requests(spark, n=40):
    return spark.range(n).select(F.col("id").cast("string").alias("issue_id"), F.lit("s").alias("system"),
                                 F.concat(F.lit("text "), (F.col("id") % 25).cast("string")).alias("user"))


def test_a_failed_run_asks_only_what_is_missing(spark):
    asked, log = tempfile.mkdtemp(prefix="asked-"), scratch_path(spark, "responses")

    def scorer(fail):
        def score(batch):
            for text in batch["user"]:
                if fail and text.endswith("7"):
                    raise SystemExit(3)                     # the worker dies: no error to catch
                with open(os.path.join(asked, f"{text}-{os.getpid()}-{os.urandom(4).hex()}"), "w"):
                    pass
            return batch["user"].str.upper()
        return score

    with pytest.raises(Exception):
        score_logged(_requests(spark), scorer(True), log, slices=6)
    first = {r.digest for r in answered(spark, log).collect()}
    before = sorted(os.listdir(asked))
    got = {r.issue_id: r.response for r in score_logged(_requests(spark), scorer(False), log, slices=6).collect()}
    assert got == {str(i): f"TEXT {i % 25}" for i in range(40)}
    assert answered(spark, log).count() == 25
    later = [x for x in os.listdir(asked) if x not in before]
    assert len(later) == 25 - len(first)                    # what the log holds is not asked again
    score_logged(_requests(spark), scorer(True), log, slices=6)     # nothing left to ask: nothing can fail


def test_failing_requests_stay_open(spark):
    log = scratch_path(spark, "responses")

    def picky(batch):
        if batch["user"].str.endswith("3").any():
            raise ValueError("no")
        return batch["user"].str.len().astype(str)

    got = {r.issue_id: r.response for r in score_logged(_requests(spark), picky, log).collect()}
    assert got["3"] is None and got["13"] is None and got["28"] is None and got["4"] == "6" and len(got) == 40
    got = {r.issue_id: r.response for r in score_logged(_requests(spark), lambda b: b["user"].str.len().astype(str), log).collect()}
    assert got["3"] == "6" and None not in got.values()
    assert score_logged(_requests(spark, 0), picky, log).count() == 0
