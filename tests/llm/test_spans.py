import random

import pytest

from vericorpus.llm import spans


def brute(items, span):
    """Shared characters by all windows of exactly ``span`` characters."""
    owners = {}
    for kind, _, owner, text in items:
        for s in range(len(text or "") - span + 1):
            owners.setdefault(text[s : s + span], set()).add((kind, owner))
    out = {}
    for kind, item, _, text in items:
        end, n, runs = -1, 0, 0
        for s in range(len(text or "") - span + 1):
            if len(owners[text[s : s + span]]) > 1:
                runs += s > end
                n += s + span - max(s, end)
                end = s + span
        if n:
            out[kind, item] = (n, runs)
    return out


@pytest.fixture(scope="module")
def items():
    rng = random.Random(7)
    letters = "abcdeé文\n"
    make = lambda n: "".join(rng.choice(letters) for _ in range(n))
    base, other = make(300), make(200)
    rows = [("file", 0, "r0", base), ("file", 1, "r0", base), ("file", 2, "r1", make(30) + base[50:200] + make(40)), ("snapshot", 0, "h", base[:120] + make(50) + base[120:180])]
    rows += [("file", 10 + k, f"s{k}", make(20) + other[k * 5 : k * 5 + 60] + make(20)) for k in range(12)]
    rows += [("file", 40, "p", "ab" * 100), ("file", 41, "q", "ba" * 90), ("file", 42, "t", "ab" * 19), ("snapshot", 9, None, "zz" + base[250:300]), ("snapshot", 10, None, "yy" + base[250:300])]
    rows += [("file", 50, "u", ""), ("file", 51, "v", None), ("file", 52, "w", "short")]
    rows += [("snapshot", 60 + k, "h2", other) for k in range(3)]
    return rows


@pytest.mark.parametrize("most", [1024, 1])
@pytest.mark.parametrize("limit", [None, 70])
def test_against_all_windows(spark, items, most, limit, monkeypatch):
    if limit:  # long texts in parts
        whole = spans._window_rows
        monkeypatch.setattr(spans, "_window_rows", lambda span: whole(span, limit))
    frame = spark.createDataFrame(items + items[:4], "item_kind string, item_id int, owner string, text string").selectExpr("*", "'x' as signature", "1 as first")
    expected = brute([(k, i, o or "", t) for k, i, o, t in items], 40)
    got = {(r["item_kind"], r["item_id"]): (r["shared_chars"], r["passages"]) for r in spans.shared_spans(frame, 40, most).collect()}
    assert got == expected


def test_empty_tables_and_lost_ids(spark):
    schema = "item_kind string, item_id bigint, owner string, text string"
    assert spans.shared_spans(spark.createDataFrame([], schema)).count() == 0
    text = "".join(chr(97 + (k * k) % 23) for k in range(500))
    rows = [("file", None, "a", text), ("file", 1, "b", text)]
    assert [r["item_id"] for r in spans.shared_spans(spark.createDataFrame(rows, schema)).collect()] == [1]


def test_a_copy_without_an_id_hides_nothing(spark):
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    common, mine = word(60), word(30)
    own = mine + "!" + common + "!" + word(30)
    rows = [("file", None, "a", own), ("file", 5, "a", own), ("file", 6, "b", word(50) + "?" + common + "?" + word(20)), ("file", None, "c", word(9) + "." + common)]
    got = spans.shared_spans(spark.createDataFrame(rows, "item_kind string, item_id bigint, owner string, text string"), 40).collect()
    assert {(r["item_id"], r["shared_chars"]) for r in got} == {(5, 60), (6, 60)}


def test_exactly_at_the_limit(spark):
    rng = random.Random(5)
    text = "".join(rng.choice("abcdefgh") for _ in range(400))
    near = text[:399]
    rows = [("file", 1, "a", "x" + text + "x"), ("file", 2, "b", "y" + text + "y"), ("file", 3, "c", "z" + near + "z")]
    got = spans.shared_spans(spark.createDataFrame(rows, "item_kind string, item_id bigint, owner string, text string")).collect()
    assert {(r["item_id"], r["shared_chars"]) for r in got} == {(1, 400), (2, 400)}


def test_compact_windows_cut_all_starts():
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab\n") for _ in range(n)) for n in (40, 41, 100, 333)]
    which, _, _, first, starts = spans.compact_windows(texts, 40)
    for k, text in enumerate(texts):
        own = sorted((int(f), int(n)) for w, f, n in zip(which, first, starts) if w == k)
        assert own[0][0] == 0 and sum(n for _, n in own) == len(text) - 39
        assert all(a + n == b for (a, n), (b, _) in zip(own, own[1:]))
