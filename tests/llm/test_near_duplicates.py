import random
import re

import numpy as np
import pytest

from vericorpus.llm import near_duplicates as nd


def sets(texts, words=5):
    out = {}
    for key, text in texts:
        w = re.findall(r"[A-Za-z0-9_]+", text or "")
        s = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)}
        if s and key is not None:
            out[key] = s
    return out


def brute(texts, threshold=0.7):
    s = sets(texts)
    keys = sorted(s)
    return {(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if len(s[a] & s[b]) >= threshold * len(s[a] | s[b])}


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(400)]
    rows, key = [], 0
    for family in range(12):
        size = rng.choice([6, 12, 40, 97, 110, 150, 420])
        base = [rng.choice(vocabulary) for _ in range(size)]
        for _ in range(rng.randrange(1, 6)):
            own = list(base)
            for _ in range(rng.randrange(0, max(2, size // 14))):
                at = rng.randrange(len(own))
                own[at : at + 1] = rng.choice([[], [rng.choice(vocabulary)], [rng.choice(vocabulary)] * 2])
            rows.append((key, " ".join(own)))
            key += 1
    boilerplate = " ".join(f"b{k}" for k in range(30))
    rows += [(key + k, boilerplate + " " + " ".join(rng.choice(vocabulary) for _ in range(8))) for k in range(20)]
    key += 20
    rows += [(key, rows[0][1]), (key + 1, rows[0][1].replace(" ", "\n")), (key + 2, ""), (key + 3, None), (key + 4, "one two three four"), (key + 5, "one two three four"), (None, rows[0][1])]
    return rows


@pytest.mark.parametrize("most", [256, 2])
def test_all_pairs(spark, texts, most):
    frame = spark.createDataFrame(texts + texts[:9], "id bigint, text string").selectExpr("*", "1 as key", "2 as class_id")
    links, classes = nd.near_duplicate_links(frame, most_in_a_group=most)
    pairs = [tuple(r) for r in nd.expand_links(links, classes, frame).collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == brute(texts)


def test_a_crowd_of_texts_of_one_shingle(spark):
    crowd = [(k, "pragma solidity" + " " * (k + 1) + "^0.8.20;") for k in range(300)]
    more = [(k, f"pragma{' ' * (k - 299)}solidity ^0.8.20; uint") for k in range(300, 303)]
    frame = spark.createDataFrame(crowd + more, "id bigint, text string")
    links, classes = nd.near_duplicate_links(frame)
    pairs = [tuple(r) for r in nd.expand_links(links, classes, frame).collect()]
    assert len(pairs) == len(set(pairs)) == 300 * 299 // 2 + 3
    assert set(pairs) == brute(crowd + more)


@pytest.mark.parametrize("size", [257])
def test_a_crowd_of_variants(spark, size):
    rng = random.Random(size)
    base = [f"v{k}" for k in range(120)]
    rows = []
    for k in range(size):
        own = list(base)
        own[rng.randrange(120)] = f"n{k % 90}"
        if k % 5 == 0:  # some far from the rest, but near to each other
            own[:30] = [f"far{x}" for x in range(30)]
        rows.append((k, " ".join(own)))
    frame = spark.createDataFrame(rows, "id bigint, text string")
    links, classes = nd.near_duplicate_links(frame, most_in_a_group=64)
    got = {tuple(r) for r in nd.expand_links(links, classes, frame).collect()}
    assert got == brute(rows)


def test_common_counts():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 9000, n).astype(np.uint64)) for n in (1, 5, 400, 6000, 30, 8000)]
    for left, right in ((sets, sets), (sets[:2], sets[2:]), (sets[:1], sets[1:2])):
        assert nd.common_counts(left, right).tolist() == [[len(set(x.tolist()) & set(y.tolist())) for y in right] for x in left]


def components(pairs):
    at = {}

    def root(x):
        while at.setdefault(x, x) != x:
            x = at[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        at[max(a, b)] = min(a, b)
    return {(x, root(x)) for x in list(at)}


def test_groups(spark, texts):
    frame = spark.createDataFrame(texts, "id bigint, text string")
    links, classes = nd.near_duplicate_links(frame)
    assert {tuple(r) for r in nd.groups(links, nd.linked_copies(classes, frame)).collect()} == components(brute(texts))
    path = spark.createDataFrame([(k, k + 1) for k in range(1, 60)] + [(100, 70), (70, 90)], "id_a bigint, id_b bigint")
    none = spark.createDataFrame([], "id bigint, class_id bigint")
    assert {tuple(r) for r in nd.groups(path, none).collect()} == {(k, 1) for k in range(1, 61)} | {(70, 70), (90, 70), (100, 70)}
    assert nd.groups(path.limit(0), none).count() == 0


def test_empty_table(spark):
    frame = spark.createDataFrame([], "id bigint, text string")
    links, classes = nd.near_duplicate_links(frame)
    assert links.count() == 0 and classes.count() == 0 and nd.expand_links(links, classes, frame).count() == 0


def test_one_differing_shingle_changes_at_most_one_key():
    rng = np.random.default_rng(4)
    for size in (5, 90, 150, 1500):
        own = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        band = next(nd._roles(len(own), 0.7))[0]
        more = np.append(own, rng.integers(0, 2**63, 7).astype(np.uint64))
        a, b = set(nd._keys(own, band).tolist()), set(nd._keys(more, band).tolist())
        assert len(a - b) <= 7 and len(b - a) <= 7


def test_sketch_distance_is_a_lower_bound():
    rng = np.random.default_rng(4)
    pool = rng.integers(0, 2**63, 900).astype(np.uint64)
    for n, m in ((20, 30), (300, 310), (40, 600)):
        x, y = rng.choice(pool, n, False), rng.choice(pool, m, False)
        made = []
        for own in (x, y):
            bits = 1 << max(6, int(2 * len(own) - 1).bit_length())
            made.append(np.packbits((np.bincount((own % np.uint64(bits)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)).tobytes())
        assert nd.sketch_distance(*made) <= len(set(x.tolist()) ^ set(y.tolist()))


def test_words_are_ascii_and_keep_case():
    owner, shingle = nd.shingle_sets(["a b c d e", "A b c d e", "aéb c d e f", "a b c d e f", "", "x" * 100_000 + " b c d e"])
    counts = np.bincount(owner, minlength=6).tolist()
    assert counts == [1, 1, 2, 2, 0, 1]
    assert shingle[owner == 0][0] in shingle[owner == 3] and shingle[owner == 0][0] != shingle[owner == 1][0]


def test_long_texts_are_worked_in_parts():
    rng = random.Random(6)
    for _ in range(20):
        text = "".join(rng.choice(["ab", "c", " ", "; ", "é", "longword_1", "\n"]) for _ in range(rng.randrange(0, 400)))
        whole = nd.shingle_sets([text])[1]
        for limit in (7, 40, 200):
            assert nd.long_set(text, 5, limit).tolist() == whole.tolist()
            assert [s.tolist() for _, s in nd.text_sets([text, "a b c d e", text], 5, limit)] == [whole.tolist(), nd.shingle_sets(["a b c d e"])[1].tolist(), whole.tolist()]
    assert len(nd.long_set("x" * 3_000_000 + " b c d e")) == 1
