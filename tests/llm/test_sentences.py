import itertools

import numpy as np
import pytest

from vericorpus.llm import sentences as se

# texts with | at every sentence end; the model is trained on all of them
MARKED = """# Notes on the pool v1.2|

Mr. Prover, as the team calls it, rejected rule No. 43 again.| The net fee went from 1,207.1 to 2,409.9 units.| Is it fair?| Nobody answered...|

They moved to VaultTax Inc.| The frame followed a week later.| msg.sender must own the pair.| "Stop."| "Not before the market is raw."|

The log says: "Why is it payable?"| (The fluid case is handled in FreshEdge.)| Names such as Fetch! or Go? confuse the parser.| Wait... the bid was silver all along?!|

- first item on the list|
- second item. It goes on|
3. third item on the list|

95. attempt: the phase timed out after 8.8 s.| Run it twice, e.g. with 0 or 1.|

Das gilt z. B. für jeden Wert, d. h. auch hier.| Am 3. März wurde Nr. 44 geprüft.| „Der Wert ist leer“, meldet das Werkzeug.| Er schrieb: „Ist der Wert sicher?“| Das ist falsch!|

¿Quién lo posee? preguntó el equipo de EE. UU. ayer.| El Sr. Candado rechazó la regla n.º 31.| Lo dijo: «No cierre la puerta».| ¡No lo toque!|

Pourquoi cela échoue-t-il ?| L'auteur demande : « Qui possède la clé ? »| On le voit p. ex. ici, cf. p. 48.| C'est faux !|

审计员问：“谁拥有它？”|合约的值每轮偏移0.24。|这样安全吗？！|这一步很慢……|日志写道：“值为空。”|

担当者は「安全か？」と尋ねた。|本当に安全なのか？！|まだ分からない……|規則では値が必要である。|

لماذا يفشل هذا؟| يقول السجل: «فارغ.»| غيّر الإصدار v1.3 الطريقة!|

डॉ. ताला इसे रोकता है।| यह गलत है!| लॉग कहता है, “खाली है।”|"""

THAI = ["ค่าสูงสุดเพิ่มจาก 4.65 เป็น 9.90", "กฎข้อ 3 ต้องแก้ไขก่อนเรียก mintBucket", "เราทดสอบซ้ำ 36 ครั้งแล้วได้ผลเดิม", "สัญญา LargeProof คลาดเคลื่อน 2.56 ต่อรอบ"]


def marked(text):
    ends, plain = [], ""
    for part in text.split("|"):
        plain += part
        ends.append(len(plain))
    return plain.rstrip(), sorted({e for e in ends if e <= len(plain.rstrip())})


def thai(order):
    blocks, ends, at = [], [], 0
    for line in order:
        for k in line:
            at += len(THAI[k])
            ends.append(at)
            at += 1
        at += 1
        blocks.append(" ".join(THAI[k] for k in line))
    return "\n\n".join(blocks), ends


@pytest.fixture(scope="module")
def model(spark):
    texts = [marked(MARKED)[0]] * 3 + [thai([[k % 4, (k + 1 + k // 4) % 4, (k + 2) % 4], [(k + 3) % 4], [k % 4, (k + 3) % 4]])[0] for k in range(40)]
    texts += [f"{a} reads the pool.\n\n{b} reads the pool." for a in ("The team", "Der Test", "El equipo", "They") for b in ("The pool", "Is it")] * 4
    return se.train(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))


def test_many_languages(model):
    text, expected = marked(MARKED)
    got = se.sentence_ends(text, model)
    wrong = {text[max(0, e - 30) : e] for e in set(got) ^ set(expected)}
    assert len(wrong) <= 0.1 * len(expected), wrong  # on so small a corpus a few stay open


def test_a_script_without_periods(model):
    right = total = 0
    for order in ([[0, 1, 2, 3]], [[3, 2], [1, 0, 2]], [[2, 0, 1]]):
        text, ends = thai(order)
        got = se.sentence_ends(text, model)
        right += len(set(got) & set(ends))
        total += len(set(got) | set(ends))
    assert right / total > 0.9


def test_units(model):
    text = "# Head one. Two\ntext one\ngoes on\n```sol\ncode. Here.\n```\nafter\n\n* a\n* b\n\n\n   \nlast line  "
    assert [text[a:b].strip() for a, b, _ in se.units(text)] == ["# Head one. Two", "text one\ngoes on", "after", "* a", "* b", "last line"]
    assert se.sentence_ends(text, model)[-1] == len(text.rstrip())
    open_fence = "before\n```\nnever. Closed."
    assert se.sentence_ends(open_fence, model) == [6]
    assert se.sentence_ends("", model) == [] and se.sentence_ends(" \n\n", model) == []


def test_operator(spark, model):
    rows = [(1, "One. Two."), (1, "One. Two."), (2, None), (3, ""), (None, "x."), (4, "é" * 10 + "! Next one."), (5, ("A long line here. " * 20_000))]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'x' as end_pos")
    got = {}
    for r in se.sentences(frame, model).collect():
        got.setdefault(r["doc_id"], []).append(r["end_pos"])
    assert sorted(got[1]) == [4, 9] and sorted(got[4]) == [11, 21] and len(got[5]) == 20_000 and set(got) == {1, 4, 5}
    empty = se.sentences(frame.where("false"))
    assert empty.count() == 0


def test_posteriors_are_those_of_all_ways_to_cut():
    rng = np.random.default_rng(5)
    for _ in range(30):
        n = int(rng.integers(1, 9))
        block, kind = np.sort(rng.integers(0, 3, n)), rng.choice([0, 0, 0, 20], n)
        position = np.cumsum(rng.integers(1, 6, n))
        size, unary = rng.integers(0, 6, n), rng.normal(0, 2, n)
        total, hits = 0.0, np.zeros(n)
        for bits in itertools.product((0, 1), repeat=n):
            b = np.array(bits)
            tied = (block[1:] == block[:-1]) & (kind[1:] == 0) & (kind[:-1] == 0) & (np.diff(position) <= size[1:])
            w = np.exp((b * unary).sum() - 3.0 * (b[1:] * b[:-1] * tied).sum())
            total, hits = total + w, hits + w * b
        assert np.allclose(se.posteriors(block, position, kind, size, unary), hits / total)
    assert len(se.posteriors(*(np.empty(0, int) for _ in range(4)), np.empty(0))) == 0


def test_the_model_counts_every_type(spark):
    words = [f"alpha{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(200)]
    rows = [(k, f"The rule {w} holds. Nobody doubts {w}.") for k, w in enumerate(words)]
    m = se.train(spark.createDataFrame(rows, "doc_id bigint, text string"), 1)
    assert sum(m.left[se._slot(f"{w}."), 3] >= 1 and m.bare[se._slot(f"{w}."), 0] >= 1 for w in words) == 200
    pair = se._pair(np.array([se._slot("holds.")]), np.array([se._slot("Nobody")]))
    assert m.pair[pair, 0] == 200


def test_abbreviations_are_learnt(spark):
    names = ["Berg", "Stone", "Field", "Rivera", "Okoye", "Lund"]
    rows = [(k, f"We met Hptm. {names[k % 6]} on the way. The talk was short. The {names[(k + 1) % 6]} house is old.\n\nThe way was long. The talk went on.") for k in range(60)]
    m = se.train(spark.createDataFrame(rows, "doc_id bigint, text string"))
    text = "The house saw Hptm. Lund. The talk was short."
    assert se.sentence_ends(text, m) == [25, 45]


def test_long_texts_take_linear_time(model):
    import time

    for text in ("字" * 300_000 + "。" + "字" * 300_000, "「字。」" * 100_000, "ค่า " * 100_000, "a." * 200_000, "x. " * 100_000):
        began = time.time()
        assert se.sentence_ends(text, model)[-1] == len(text.rstrip())
        assert time.time() - began < 20
