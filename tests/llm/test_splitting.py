import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vericorpus.llm import splitting


def check(text, most, overlap):
    pieces = splitting.cuts(text, most, overlap)
    if len(text) <= most:
        assert pieces == ([(0, len(text), 0.0)] if text else [])
        return pieces
    assert pieces[0][0] == 0 and pieces[-1][1] == len(text)
    for (_, e, _), (s, _, _) in zip(pieces, pieces[1:]):
        assert s == e - overlap
    assert all(0 < e - s <= most for s, e, _ in pieces)
    return pieces


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab {};\n", max_size=600), st.integers(20, 120), st.integers(0, 9))
def test_pieces_cover_the_text(text, most, overlap):
    check(text, most, overlap)


def best(text, most, overlap):
    """The least cost over all choices of candidate positions, by plain recursion."""
    at, price = splitting.boundaries(text, most - overlap)
    n = len(text)
    spots = [(int(a), p) for a, p in zip(at, price) if overlap < a < n] + [(n, 0.0)]
    target = (n - overlap) / -(-(n - overlap) // (most - overlap))
    seen = {}

    def cost(k):
        if k not in seen:
            end, p = spots[k]
            own = [p + 1 + ((end - overlap - target) / target) ** 2] if end <= most else []
            own += [cost(j) + p + 1 + ((end - spots[j][0] - target) / target) ** 2 for j in range(k) if end - spots[j][0] <= most - overlap]
            seen[k] = min(own, default=float("inf"))
        return seen[k]

    return cost(len(spots) - 1)


def test_the_programme_finds_the_least_cost():
    rng = random.Random(3)
    for _ in range(60):
        text = "".join(rng.choice(["rule a {\n", "  x;\n", "}\n", "\n", "long token;", " "]) for _ in range(rng.randrange(20, 60)))
        most, overlap = 60, 10
        if len(text) <= most:
            continue
        pieces = check(text, most, overlap)
        target = (len(text) - overlap) / -(-(len(text) - overlap) // (most - overlap))
        ends = [e for _, e, _ in pieces]
        total = sum(p for _, _, p in pieces) + len(ends) + ((ends[0] - overlap - target) / target) ** 2 + sum(((b - a - target) / target) ** 2 for a, b in zip(ends, ends[1:]))
        assert abs(total - best(text, most, overlap)) < 1e-9


def test_cuts_stand_at_block_ends():
    block = "rule r {\n" + "    assert x;\n" * 20 + "}\n\n"
    text = block * 40
    pieces = splitting.cuts(text, 1000, 50)
    assert all(text[:e].endswith(("}\n", "}\n\n")) for _, e, _ in pieces[:-1])


def test_very_long_lines_and_texts():
    check("x" * 50_000, 6000, 200)
    check("a;" * 300_000, 6000, 200)
    check("line of text\n" * 60_000, 6000, 200)


def test_operator(spark):
    rows = [("file", 1, "x\n" * 4000, "c"), ("file", 1, "x\n" * 4000, "c"), ("file", 2, "é" * 6001, None), ("spec", 2, "y" * 6000, ""), ("spec", 3, None, "z"), (None, None, "q" * 7000, "z")]
    items = spark.createDataFrame(rows, "item_kind string, item_id bigint, text string, piece string")
    pieces = splitting.split_oversized(items).distinct()
    got = {(r["item_kind"], r["item_id"], r["item_cut"]) for r in pieces.collect()}
    assert got == {("file", 1, "natural"), ("file", 2, "forced"), (None, None, "forced")}
    texts = {r["text"] for r in pieces.where("item_id = 2").collect()}
    assert max(map(len, texts)) <= 6000
    assert splitting.split_oversized(items.where("false")).count() == 0


def test_null_and_empty_lists(spark):
    records = spark.createDataFrame(
        [("r", None, []), ("s", [("x" * 7000, None, 5)], None)],
        "id string, contracts array<struct<clean_source:string,relative_path:string,file_id:bigint>>, specs array<struct<relative_path:string,text:string,spec_id:bigint>>",
    )
    items = splitting.splittable_items(records)
    assert splitting.split_oversized(items).select("item_kind", "item_id").distinct().collect() == [("file", 5)]
    assert items.where(F.col("item_kind") == "spec").count() == 0
