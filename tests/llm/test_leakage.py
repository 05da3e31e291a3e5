import random

import numpy as np
import pytest

from vericorpus.llm import leakage


def brute(documents, items, least):
    out = {}
    for d, text in documents:
        for i, item in items:
            if d is None or i is None or text is None or item is None:
                continue
            a, b = leakage.words_of(text), leakage.words_of(item)
            best = 0
            for x in range(len(a)):
                for y in range(len(b)):
                    n = 0
                    while x + n < len(a) and y + n < len(b) and a[x + n] == b[y + n]:
                        n += 1
                    best = max(best, n)
            if best >= least:
                out[d, i] = best
    return out


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(9)
    words = ["alpha", "Beta", "γάμμα", "дельта", "12", "x1", "straße", "zeta"]
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.randrange(3, 25)))) for k in range(8)] + [(8, ""), (9, None), (None, "alpha " * 9), (10, "alpha " * 12), (0, None)]
    documents = []
    for k in range(60):
        text = " ".join(rng.choice([*words, "other", "more"]) for _ in range(rng.randrange(0, 30)))
        if k % 3 == 0:
            own = [i for i in items if i[1] and i[0] is not None][k % 8][1].split()
            a = rng.randrange(len(own))
            text += " ... " + rng.choice([", ", "\n", " -- "]).join(own[a:]).upper() + "! " + text
        documents.append((k, text))
    return documents + [(100, None), (101, ""), (None, items[0][1]), (102, "ALPHA—alpha " * 10)], items


@pytest.mark.parametrize("block", [400_000, 20])
@pytest.mark.parametrize("least", [5, 12])
def test_against_all_positions(spark, tables, least, block):
    documents, items = tables
    frame = spark.createDataFrame(documents + documents[:5], "doc_id bigint, text string").selectExpr("*", "1 as words", "2 as item_id").repartition(3)
    asked = spark.createDataFrame(items + items[:2], "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]): r["words"] for r in leakage.leaks(frame, asked, least, block).collect()}
    assert got == brute(documents, items, least)


def test_clean_documents(spark, tables):
    documents, items = tables
    frame, asked = spark.createDataFrame(documents, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    bad = {d for d, _ in brute(documents, items, 12)}
    kept = [r["doc_id"] for r in leakage.without_leaks(frame, asked).collect()]
    assert sorted(map(str, kept)) == sorted(str(d) for d, _ in documents if d not in bad)
    assert leakage.leaks(frame, asked.where("false")).count() == 0 and leakage.leaks(frame.where("false"), asked).count() == 0


def test_places_of_matches(spark):
    item = " ".join(f"w{k}" for k in range(20))
    frame = spark.createDataFrame([(1, "a b " + " ".join(f"W{k}" for k in range(3, 18)) + " c")], "doc_id bigint, text string")
    row = leakage.leaks(frame, spark.createDataFrame([(7, item)], "item_id bigint, text string")).first()
    assert tuple(row) == (1, 7, 15, 2, 3)


def test_ranks_order_suffixes():
    rng = np.random.default_rng(3)
    codes = rng.integers(1, 4, 300)
    at = np.arange(280)
    for depth in (1, 5, 12, 16):
        ranks = leakage._ranks(codes, at, depth)
        keys = [tuple(codes[k : k + depth]) for k in at]
        order = {k: n for n, k in enumerate(sorted(set(keys)))}
        assert [order[k] for k in keys] == ranks.tolist()
