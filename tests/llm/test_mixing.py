import os

import pytest
from pyspark.sql import functions as F

from vericorpus.llm import mixing

pytestmark = pytest.mark.skipif(not os.path.exists(mixing.VOCABULARY), reason="no vocabulary files here")


def test_sources(spark):
    names = ["Audit_Notes", " forum", "audit-notes", "FORUM ", None, "Audit  Notes"]
    got = [r["s"] for r in spark.createDataFrame([(n,) for n in names], "source string").select(mixing.canonical_source("source").alias("s")).collect()]
    assert got == ["audit_notes", "forum", "audit_notes", "forum", None, "audit_notes"]


@pytest.fixture(scope="module")
def made(spark):
    rows = [(k, " ".join(f"word{k}" for _ in range(40)), ["big", "Big", "mid", "small"][0 if k < 120 else 1 if k < 180 else 2 if k < 230 else 3]) for k in range(240)]
    rows += [(0, rows[0][1], "big"), (500, None, "mid"), (501, "", "small"), (None, "x y z", "small"), (502, "stray text", None), (503, "stray", "unknown")]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string, source string").selectExpr("*", "9 as tokens", "'k' as key")
    targets = spark.createDataFrame([("big", 0.4, 1), ("mid", 0.3, 2), ("small", 0.2, 3), ("absent", 0.1, 5)], "source string, target_share double, max_repeats int")
    mixed, report = mixing.mix(documents, targets, block=16)
    return documents, targets, mixed.cache(), {r["source"]: r for r in report.collect()}


def test_shares_and_repeats(made):
    _, _, mixed, report = made
    assert {s for s, r in report.items() if r["missed"]} == {"small", "absent"}
    assert all(r["repeats"] is None or r["repeats"] <= r["max_repeats"] for r in report.values())
    assert abs(sum(r["actual_share"] for r in report.values()) - 1) < 1e-5
    full = {s: r["mixed_tokens"] / r["target_share"] for s, r in report.items() if not r["missed"]}
    assert max(full.values()) / min(full.values()) < 1.02
    assert report["absent"]["mixed_tokens"] == 0


def test_blocks_hold_each_token_once_a_pass(made):
    documents, _, mixed, report = made
    spans = mixed.groupBy("source", "doc_id", "repeat").agg(F.sum(F.col("to_token") - F.col("from_token")).alias("n"), F.min("from_token").alias("a"), F.max("to_token").alias("b"))
    assert spans.where("n <> b - a").count() == 0
    sizes = mixed.groupBy("slot").agg(F.sum(F.col("to_token") - F.col("from_token")).alias("n"), F.countDistinct("source").alias("s"))
    assert sizes.where("s > 1").count() == 0 and sizes.where("n <> 16").count() == 0
    tokens = {r["doc_id"]: r["tokens"] for r in mixing.token_counts(documents).collect()}
    first = mixed.where("repeat = 0 and source = 'small'").groupBy("doc_id").agg(F.sum(F.col("to_token") - F.col("from_token")).alias("n")).collect()
    assert all(r["n"] == tokens[r["doc_id"]] for r in first) and len(first) == 10


def test_the_schedule_is_even(made):
    _, _, mixed, _ = made
    slots = sorted({(r["slot"], r["source"]) for r in mixed.select("slot", "source").collect()})
    half = [s for k, s in slots if k < 100]
    assert abs(half.count("big") - 40) <= 2 and abs(half.count("mid") - 30) <= 2


def test_empty_tables(spark, made):
    documents, targets, _, _ = made
    mixed, report = mixing.mix(documents.where("false"), targets)
    assert mixed.count() == 0 and report.count() == 4
    mixed, report = mixing.mix(documents, targets.where("false"))
    assert mixed.count() == 0 and report.count() == 0


def test_chunks_give_the_same_ranks(spark, made):
    documents, targets, _, _ = made
    sized = mixing.plan(mixing.token_counts(documents), targets, 16)
    a, b = ({tuple(r) for r in mixing.schedule(sized, 16, chunk).collect()} for chunk in (1 << 16, 7))
    assert a == b
