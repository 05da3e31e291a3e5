"""Sentence boundaries across languages and scripts (problem 8).

Method: a hidden-event n-gram language model. Between the tokens of a block stands a hidden
event, boundary or none. The model holds how likely each class of punctuation (the stop, what closes it, the case of what
follows) is a boundary, how likely a token is to be followed by one, which tokens begin a sentence (and follow its first), and
which follow a token without one. It is trained on the corpus itself by expectation maximisation: block ends are boundaries that
everyone can see, so two rates start the training: how often a token type begins blocks, and how often one ends them. A type that
stands before many open gaps and never ends a block is an abbreviation, and one that small letters often follow goes on; no list
of abbreviations is kept. Classes of punctuation begin with weak odds and are estimated anew in each round like everything else.
Forward-backward posteriors of each round are the counts of the next, and those of the last round decide. In scripts that separate
sentences by spaces alone every space is open, and the n-grams decide by themselves.

A type is known by a hash of ``SLOT_BITS`` bits, so the model is a table of bounded size however large the corpus is, and all
counts enter it: texts are parsed once into gaps of numbers, each round adds them up in numpy and as Spark aggregations by slot, and the
table (at most ``4 * 2**SLOT_BITS`` short rows, fewer as far as slots are empty) goes through the driver to every task. Two types of one slot are
counted as one, which below some millions of types is rare.

Units: a heading line and a list item are one unit each; fenced code belongs to none; a blank line ends a unit, a
single line break does not. Cases: null and blank texts have no sentence; documents without an id are left out; rows delivered
twice count once; an empty table gives an empty result; further columns are ignored; a very long text is worked block by block, in linear time.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vericorpus.session import staged

#: Rounds of training, and the least frequency from which a type is evidence.
ROUNDS, LEAST_COUNT = 2, 3
#: Gaps that the first odds of a class count as.
WEIGHT = 10
#: Bits of a slot of the model's tables.
SLOT_BITS = 20

_FENCE = re.compile(r"^\s{0,3}(`{3,}|~{3,})")
_HEADING = re.compile(r"^\s{0,3}#{1,6}(\s|$)")
_ITEM = re.compile(r"^\s*(?:[-*+•]|\d{1,3}[.)])\s+\S")
_BULLET = re.compile(r"^\s*[-*+•]\s+\S")

_TERMINAL = ".!?…。！？．؟۔।॥‼⁇⁈⁉"
_CLOSING = "\"'’”»›)\\]}」』）】》〉"
_WIDE = "。！？…"  # terminals that need no blank after them
_HAN = "぀-ヿ㐀-䶿一-鿿가-힯　-〿＀-￯"
_SPACED = re.compile("[฀-๿຀-໿က-႟ក-៿]")  # scripts with spaces but without periods
_STOP = re.compile(rf"([{_TERMINAL}]+)(?:\s?»|[{_CLOSING}])*")
_WORD = re.compile(r"\S+")
_LETTER = re.compile(r"[^\W\d_]")
_OPENING = "\"'“„«‘([{¿¡「『（【《‹*_   "

_TAIL = _CLOSING.replace("\\", "") + ",;:"
_INTEGER = re.compile(r"[-+]?\d{1,4}")
_IDENTIFIER = re.compile(r"[a-z\d][A-Z]|[\w][._/(:][\w(]|_")
_HAN_ONE, _LATIN = re.compile(f"[{_HAN}]"), re.compile(r"[A-Za-z0-9_.]+")
_UNIT, _NUMBER_BEFORE = re.compile(r"[^\W\d_]|min|sec|ms|km|kg"), re.compile(r"\d[.,]?\d*\s$")
_INITIALS = re.compile(r"[^\W\d_]|([^\W\d_]\.)+[^\W\d_]")
_SMALL_NUMBER = re.compile(r"\d{1,4}")
_TYPES: dict[str, str] = {}


def token_type(token: str) -> str:
    """A token's type in the model: numbers and identifiers by their shape, other words as they stand."""
    known = _TYPES.get(token)
    if known is None:
        if len(_TYPES) > 100_000:
            _TYPES.clear()
        known = _TYPES[token] = _type_of(token)
    return known


def _type_of(token: str) -> str:
    bare = token.strip(_OPENING).rstrip(_TAIL)
    stop = bare[-1:] if bare[-1:] in _TERMINAL else ""
    core = bare.rstrip(_TERMINAL)
    if not core:
        return f"{token[:1]}|{stop}"
    if _INTEGER.fullmatch(core):
        return f"<int>{stop}"
    if core[0].isdigit() or core[0] in "+-" and core[1:2].isdigit():
        return f"<num>{stop}"
    if _IDENTIFIER.search(core) and not _INITIALS.fullmatch(core):
        return ("<Name>" if core[0].isupper() else "<ident>") + stop
    return core[:24] + stop


def units(text: str):
    """The blocks of a text as (start, end, kind): prose, or unit for headings and list items."""
    position, fence, block = 0, None, []

    def close():
        if not block:
            return
        listed = [bool(_ITEM.match(line)) for _, _, line in block]
        whole = sum(listed) >= 2 and listed[0] or listed[0] and len(block) == 1 and (bool(_BULLET.match(block[0][2])) or block[0][2].rstrip()[-1:] not in _TERMINAL)
        if whole:
            item = None
            for (a, b, line), is_item in zip(block, listed):
                if is_item or item is None:
                    if item:
                        yield (*item, "unit")
                    item = (a, b)
                else:
                    item = (item[0], b)
            yield (*item, "unit")
        else:
            cut = next((k for k in range(1, len(block)) if all(listed[k:]) and len(block) - k >= 2), len(block))
            yield block[0][0], block[cut - 1][1], "prose"
            for a, b, _ in block[cut:]:
                yield a, b, "unit"

    for line in text.split("\n"):
        start, end = position, position + len(line)
        position = end + 1
        mark = _FENCE.match(line)
        if fence:
            if mark and mark.group(1)[0] == fence[0] and len(mark.group(1)) >= len(fence) and line.strip() == mark.group(1):
                fence = None
            continue
        if mark or not line.strip() or _HEADING.match(line):
            yield from close()
            block = []
            if mark:
                fence = mark.group(1)
            elif line.strip():
                yield start, end, "unit"
            continue
        block.append((start, end, line))
    yield from close()


#: Cases of what follows a gap.
_CASES = ("none", "upper", "lower", "ident", "digit")
#: Kinds of a gap by its stop: a blank in a spaced script, a wide stop, ! or ? and the like, several stops, and single periods.
_KINDS = ("blank", "wide", "wide quoted", "wide told", "strong", "several", "quoted", "period", "short", "number", "unit", "initials")
#: The log odds from which training starts, by kind and case; weak, since each round estimates them anew.
_FIRST = {
    "blank": (0, 0, 0, 0, 0), "wide": (3, 3, 3, 3, 3), "wide quoted": (-1,) * 5, "wide told": (1.5,) * 5, "strong": (3, 3, -3, 2, 3), "several": (3, 3, -3, 1, 3),
    "quoted": (3, 3, -3, 2, 3), "period": (3, 3, 2, 3, 2), "short": (1, 1.5, 1, 2, 1), "number": (2, 1.5, -3, 1.5, -0.5), "unit": (2, 3, -2, 2, 2), "initials": (-1, -1, -2, -1, -1),
}
_START = np.array([x for kind in _KINDS for x in _FIRST[kind]], np.float64)
_BLANK_CLASSES, _SMALL = len(_CASES), _CASES.index("lower")
_SLOTS = 1 << SLOT_BITS
_CLASS = {kind: k * len(_CASES) for k, kind in enumerate(_KINDS)}
_IDS: dict[str, int] = {}
_RIGHT: dict[str, tuple[int, int]] = {}
_TWO_OF_HAN = re.compile(r"(?:[A-Za-z0-9_.]+|\S){0,2}")
_QUOTES = re.compile("[„‚“‘\"「『《（]")


def _slot(name: str) -> int:
    """The slot of a type; the empty type has none (-1)."""
    known = _IDS.get(name)
    if known is None:
        if len(_IDS) > 200_000:
            _IDS.clear()
        known = _IDS[name] = crc32(name.encode("utf-8", "surrogatepass")) & (_SLOTS - 1) if name else -1
    return known


def _kept(cache: dict, key: str, make):
    """A value of a cache that starts again when it is large."""
    known = cache.get(key)
    if known is None:
        if len(cache) > 200_000:
            cache.clear()
        known = cache[key] = make(key)
    return known


def _type_slot(token: str) -> int:
    return _slot(token_type(token))


_SECOND: dict[str, int] = {}
_LEFT: dict[str, tuple[int, int]] = {}
_STOPS: dict[str, tuple[bool, str]] = {}
_WORD_KINDS: dict[str, str] = {}


def _left_of(token: str) -> tuple[int, int]:
    """Slot and length of a token's type before a gap; a blank before the token marks a spaced script."""
    name = " " + token_type(token[1:]) if token[0] == " " else token_type(token)
    return _slot(name), len(name)


def _stop_of(stop: str) -> tuple[bool, str]:
    """Whether a stop is wide, and its kind where that is settled by itself."""
    return any(c in _WIDE for c in stop), "strong" if any(c in "!?。！？؟।॥۔" for c in stop) else "several" if len(stop) > 1 or stop == "…" else ""


def _word_kind(word: str) -> str:
    """The kind of a single period by the word before it: a unit only behind a number."""
    if _UNIT.fullmatch(word) and word.islower():
        return "unit " + ("initials" if _INITIALS.fullmatch(word) else "short")
    return "initials" if _INITIALS.fullmatch(word) else "number" if _SMALL_NUMBER.fullmatch(word) else "short" if len(word) <= 3 else "period"


def _right_of(token: str) -> tuple[int, int]:
    """Slot and case of a token that follows a gap (no script without spaces)."""
    known = _RIGHT.get(token)
    if known is None:
        if len(_RIGHT) > 200_000:
            _RIGHT.clear()
        body = token.lstrip(_OPENING) or token
        kind, case = token_type(token), "digit" if body[0].isdigit() else "none"
        letter = _LETTER.search(body)
        if letter and case != "digit":
            c = letter.group(0)
            case = "upper" if c.isupper() else "lower" if c.islower() else "none"
            if case == "lower" and (kind.startswith("<ident>") or _INITIALS.fullmatch(body.rstrip(_TAIL).rstrip(_TERMINAL)) and "." in body[:-1]):
                case = "ident"
        known = _RIGHT[token] = (_slot(kind), _CASES.index(case))
    return known


class _Words:
    """The words of a block, found once. In a spaced script types are counted by themselves, since identifiers and numbers stand differently there."""

    def __init__(self, text: str, start: int, end: int):
        self.text, self.spaced = text, bool(_SPACED.search(text, start, end))
        spans = [m.span() for m in _WORD.finditer(text, start, end)]
        self.starts, self.ends = [a for a, _ in spans], [b for _, b in spans]

    def before(self, at: int) -> str:
        """The token that ends at ``at`` (of a longer one its last 60 characters)."""
        k = bisect_left(self.starts, at) - 1
        return self.text[max(self.starts[k], at - 60) : at] if k >= 0 else ""

    def after(self, at: int) -> tuple[int, int, int]:
        """Slots of the token that follows and of the next one, and the case of the first."""
        k = bisect_right(self.ends, at)
        if k == len(self.ends):
            return _slot("</s>"), -1, 0
        text, a, b = self.text, max(at, self.starts[k]), self.ends[k]
        if b - a <= 60 and not self.spaced and (token := text[a:b]).isascii():
            kind, case = _RIGHT.get(token) or _right_of(token)
            if k + 1 == len(self.ends):
                return kind, _slot("</s>"), case
            second = text[self.starts[k + 1] : self.ends[k + 1]][:60]
            return kind, _SECOND.get(second) or _kept(_SECOND, second, _type_slot), case
        first = text[a]
        if _HAN_ONE.match(first) or not first.isascii() or b - a > 60:
            m = next((i for i in range(a, b) if text[i] not in _OPENING), a)
            if _HAN_ONE.match(first) or _HAN_ONE.match(text[m]):
                opened = first if first in _OPENING or not first.isalnum() else ""
                return _slot(opened + _LATIN.sub("A", _TWO_OF_HAN.match(text, a + len(opened), b).group(0))), -1, 0
        token = text[a:b]
        if not token.isascii() and _HAN_ONE.search(token):
            body = token.lstrip(_OPENING)
            m = _LATIN.match(body)
            return _slot(("<num>" if body[0].isdigit() else "A") + (body[m.end() : m.end() + 2] if m else body[:2])), -1, 0
        if self.spaced:
            after = self.text[self.starts[k + 1] : self.ends[k + 1]][:60] if k + 1 < len(self.ends) else ""
            return _slot(" " + token_type(token)), _slot(" " + token_type(after)) if after else _slot("</s>"), _right_of(token)[1]
        kind, case = _right_of(token)
        return kind, _slot(token_type(text[self.starts[k + 1] : self.ends[k + 1]][:60])) if k + 1 < len(self.ends) else _slot("</s>"), case


def gaps(text: str, start: int, end: int, words: _Words, over: int) -> list[tuple]:
    """The open gaps of a prose block: (end position, class, slots of left, right and second right type, coupled with the next)."""
    spaced = words.spaced
    places: dict[int, tuple[int, int]] = {}
    quotes: dict[str, list[int]] | None = None

    def last(marks: str, before: int) -> int:
        """The last of some quotation marks before a position."""
        nonlocal quotes
        if quotes is None:  # one pass over the block, whatever its length
            quotes = {}
            for m in _QUOTES.finditer(text, start, end):
                quotes.setdefault(m.group(0), []).append(m.start())
        return max((own[k - 1] for q in marks if (own := quotes.get(q)) and (k := bisect_left(own, before))), default=-1)

    for m in _STOP.finditer(text, start, end):
        a, b = m.start(), m.end()
        if text[b : b + 1] in ("“", "‘") and b < end and last("„" if text[b] == "“" else "‚", b) > last(text[b], b):
            b += len(re.match(rf"[“‘{_CLOSING}]+", text[b:end]).group(0))  # it closes a quotation that began low
        stop = m.group(1)
        after = text[b : b + 1] if b < end else ""
        if after and not after.isspace():
            han = bool(_HAN_ONE.match(after))
            if stop[-1] == "." or not han and not (stop[-1] in _WIDE and (len(stop) > 1 or stop != "…")):
                continue
        if b < over:
            places[b] = (a, len(stop))
    if spaced:
        for left in words.ends[:-1]:
            if left not in places and left < over:
                places[left] = (-1, 0)
    out = []
    for b in sorted(places):
        a, size = places[b]
        right, second, case = words.after(b)
        token = words.before(b)
        left, size_of_left = _kept(_LEFT, " " + token if spaced else token, _left_of) if token else (-1, 0)
        if a < 0:
            out.append((b, 0, left, right, second, size_of_left))
            continue
        stop = text[a : a + size]
        closed = b > a + size
        wide, kind = _kept(_STOPS, stop, _stop_of)
        if wide and _HAN_ONE.search(text[max(start, a - 1) : a] + text[b : b + 1]):
            # a quotation that a colon brings in ends its sentence, another one most often goes on
            opened = last("“「『‘《（", a) if closed else -1
            kind = "wide" if not closed else "wide told" if opened > start and text[opened - 1] in "：:" else "wide quoted"
            left = _slot(stop + (text[a + size : b] if closed else ""))
        elif not kind and closed:
            kind = "quoted"
        elif not kind:
            word = token[: len(token) - (b - a)].lstrip(_OPENING)
            kind = _kept(_WORD_KINDS, word.lower() if not _UNIT.fullmatch(word) else word, _word_kind)
            if kind.startswith("unit"):
                kind = "unit" if _NUMBER_BEFORE.search(text[max(start, a - len(word) - 24) : a - len(word)]) else kind[5:]
        out.append((b, _CLASS[kind] + case, left, right, second, 0))
    return out


def _trimmed(text: str, start: int, end: int) -> int:
    return start + len(text[start:end].rstrip())


def parsed(text: str):
    """The blocks of a text: (prose, end, right, second, last, gaps); right and second begin the block, last ends it (slots)."""
    for start, end, kind in units(text):
        stop = _trimmed(text, start, end)
        if kind != "prose":
            yield False, stop, -1, -1, -1, []
            continue
        words = _Words(text, start, end)
        right, second, _ = words.after(start)
        last = words.before(stop)
        yield True, stop, right, second, _slot((" " if words.spaced else "") + token_type(last)) if last else -1, gaps(text, start, end, words, stop)


#: Counts of the model by table: of left types (gaps, those before small letters, ends of blocks, ends), of right types (all, begun
#: blocks, begun sentences), of pairs of both and of the first two tokens (all, boundaries), of words that stand without a stop
#: (by the type they have with a period), and of classes (all, boundaries).
_TABLES = {"left": 4, "right": 3, "pair": 2, "two": 2, "bare": 1, "class": 2}


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The slot of a pair of slots."""
    mixed = (a.astype(np.int64) * 0x9E3779B1 + b.astype(np.int64) * 0x85EBCA77) & 0xFFFFFFFF
    return ((mixed ^ (mixed >> 15)) * 0x2C1B3C6D >> 8) & (_SLOTS - 1)


class Model:
    """The counts of a round, dense by slot."""

    def __init__(self, rows: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.rows = rows
        for name, width in _TABLES.items():
            held = np.zeros((len(_START) if name == "class" else _SLOTS, width), np.float32)
            slots, values = rows.get(name, (np.empty(0, np.int64), np.empty((0, width))))
            held[slots] = values
            setattr(self, {"class": "kinds"}.get(name, name), held)
        own = self.kinds.sum(0)
        blocks = self.right[:, 1].sum()
        #: The share of boundaries that end a block.
        self.rate = float(np.clip(blocks / max(1.0, blocks + own[1]), 0.05, 0.3))
        lower = np.arange(len(_START)) % len(_CASES) == _SMALL
        stops = np.arange(len(_START)) >= _BLANK_CLASSES
        #: The share of boundaries behind a stop that a small letter follows.
        self.low = float(np.clip(self.kinds[lower & stops, 1].sum() / max(1.0, self.kinds[stops, 1].sum()), 0.002, 0.05))

    def __reduce__(self):
        return Model, (self.rows,)

    def first_guess(self, right: np.ndarray, less: np.ndarray) -> np.ndarray:
        """Log odds of a boundary by how often the right type begins blocks; ``less`` of its occurrences are left out if others are left."""
        n, block = self.right[right, 0], self.right[right, 1]
        n = np.where(n - less >= LEAST_COUNT, n - less, n)
        s = np.clip(block / np.maximum(n, 1) / self.rate, 0.03, 0.97)
        # a few occurrences that begin no block say little against a type
        return np.where(n < LEAST_COUNT, 0.0, np.maximum(np.log(s / (1 - s)), n * np.log((1 - self.rate) / 0.99)))

    def ends_blocks(self, left: np.ndarray) -> np.ndarray:
        """Log odds that a type can end sentences, by the blocks it ends: one that stands before many gaps and never ends a block cannot."""
        n, final = self.left[left, 0], self.left[left, 2]
        return np.clip(final * np.log(self.rate / 0.004) + n * np.log((1 - self.rate) / 0.996), -8.0, 2.0)

    def is_a_word(self, left: np.ndarray) -> np.ndarray:
        """Log odds for a type that also stands without its period, as no abbreviation does."""
        return np.clip(4 * np.log((self.bare[left, 0] + 0.5) / (0.1 * self.left[left, 0] + 0.5)), 0.0, 8.0)

    def goes_on(self, left: np.ndarray) -> np.ndarray:
        """Log odds that a type stands inside sentences, by how often a small letter follows."""
        n, low = self.left[left, 0], self.left[left, 1]
        return np.clip(low * np.log(0.4 / self.low) + (n - low) * np.log(0.6 / (1 - self.low)), -6.0, 6.0)


def _logit(hits: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Smoothed log odds of hits among n, at most 3.5 either way."""
    hits = np.maximum(hits, 0)
    n = np.maximum(n, hits)
    return np.where(n >= LEAST_COUNT, np.clip(np.log((hits + 0.5) / (n - hits + 0.5)), -3.5, 3.5), 0.0)


def unary_odds(kind: np.ndarray, left: np.ndarray, right: np.ndarray, second: np.ndarray, model: Model | None, first: bool) -> np.ndarray:
    """Log odds of a boundary at each gap, neighbouring gaps aside."""
    if model is None:
        return _START[kind]
    seen, ended = model.kinds[kind, 0], model.kinds[kind, 1]
    # the first odds count as some gaps already seen
    begin = WEIGHT / (1 + np.exp(-_START[kind]))
    prior = np.clip(np.log((ended + begin) / (seen + WEIGHT - ended - begin)), _START[kind] - 1, 7.0)
    prior = np.where(kind < _BLANK_CLASSES, 0.0, prior)
    group, case = kind // len(_CASES), kind % len(_CASES)
    low, upper, stopped = case == _SMALL, case == _CASES.index("upper"), group >= _KINDS.index("period")
    # what a token does is estimated beside other neighbours (leaving the pair out), or a pair that always stands together would confirm what was first believed
    both = model.pair[_pair(left, right)]
    right_odds, left_odds = model.first_guess(right, both[:, 0]), 0.0
    if not first:
        two = model.two[_pair(right, second)]
        left_odds = _logit(model.left[left, 3] - both[:, 1], model.left[left, 0] + model.left[left, 2] - both[:, 0])
        right_odds = right_odds + _logit(model.right[right, 2] - both[:, 1], model.right[right, 0] - both[:, 0])
        right_odds += np.where(second >= 0, np.clip(np.log((two[:, 1] + 0.5) / (two[:, 0] - two[:, 1] + 0.5)), -1.0, 1.0), 0.0)
    # behind a single period the token before decides with what follows; of a small letter only the token before can tell
    ends = model.ends_blocks(left)
    ends = np.where(upper, np.clip(np.maximum(ends, -5.0) + model.is_a_word(left), -5.0, 2.0), ends)
    number = group == _KINDS.index("number")
    period = prior + np.where(low, -np.maximum(model.goes_on(left) - model.is_a_word(left), -6.0), np.where(number, 0.0, ends) + np.clip(right_odds, np.where(number, -6.0, -2.5), 6.0))
    other = prior + np.clip(left_odds + right_odds, -1.5, 1.5)
    return np.where(group == 0, np.clip(left_odds + right_odds, -8.0, 8.0), np.where(stopped, period, other))


def posteriors(block: np.ndarray, position: np.ndarray, kind: np.ndarray, size: np.ndarray, unary: np.ndarray) -> np.ndarray:
    """Forward-backward over the gaps of blocks laid end to end: the probability of a boundary at each.

    Neighbouring blanks are coupled: a sentence of a single token between two gaps is unlikely. All chains are worked at once, step by step.
    """
    n = len(unary)
    if not n:
        return unary
    tied = np.zeros(n, bool)  # with the gap before
    tied[1:] = (block[1:] == block[:-1]) & (kind[1:] < _BLANK_CLASSES) & (kind[:-1] < _BLANK_CLASSES) & (position[1:] - position[:-1] <= size[1:])
    ahead, behind = unary.astype(np.float64).copy(), np.zeros(n)
    start = np.flatnonzero(~tied)
    length = np.diff(np.append(start, n))
    order = np.argsort(-length, kind="stable")
    start, length = start[order], length[order]
    near, far = np.exp(-3.0), 1.0
    for k in range(1, int(length[0])):
        at = start[: np.searchsorted(-length, -k, "left")] + k
        before = np.exp(np.clip(ahead[at - 1], -60, 60))
        ahead[at] += np.log((far + before * near) / (far + before))
    for k in range(1, int(length[0])):
        m = np.searchsorted(-length, -k, "left")
        at = start[:m] + length[:m] - 1 - k
        after = np.exp(np.clip(behind[at + 1] + unary[at + 1], -60, 60))
        behind[at] = np.log((far + after * near) / (far + after))
    return 1 / (1 + np.exp(-np.clip(ahead + behind, -60, 60)))


_BLOCKS = "doc_id bigint, prose boolean, end_pos bigint, right int, second int, last int, ends array<bigint>, classes array<tinyint>, lefts array<int>, rights array<int>, seconds array<int>, sizes array<int>"
_HEAD = (pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
_GAP = (pa.int64(), pa.int8(), pa.int32(), pa.int32(), pa.int32(), pa.int32())


def _block_rows(batches):
    for batch in batches:
        head, gap_columns, counts, bare = [[] for _ in _HEAD], [[] for _ in _GAP], [0], Counter()
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for *own, found in parsed(text):
                for column, value in zip(head, (doc, *own)):
                    column.append(value)
                for column, values in zip(gap_columns, zip(*found)):
                    column.extend(values)
                counts.append(counts[-1] + len(found))
            bare.update(text.split())
        # one row more for the words without a stop: their slots and counts
        told = [(0, 0, _slot(token_type(w + ".")), n, 0, 0) for w, n in bare.items() if w[-1].isalpha()]
        for column, value in zip(head, (None, False, -1, -1, -1, -1)):
            column.append(value)
        for column, values in zip(gap_columns, zip(*told)):
            column.extend(values)
        counts.append(counts[-1] + len(told))
        offsets = pa.array(counts, pa.int32())
        columns = [pa.array(c, k) for c, k in zip(head, _HEAD)] + [pa.ListArray.from_arrays(offsets, pa.array(c, k)) for c, k in zip(gap_columns, _GAP)]
        yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _BLOCKS.split(", ")])


def parsed_blocks(documents: DataFrame) -> DataFrame:
    """The blocks of all documents with their open gaps: texts are read once, and training and decision work on this."""
    texts = documents.where("text is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return texts.mapInArrow(_block_rows, _BLOCKS)


def _gaps_of(batch):
    """The gaps of a batch laid end to end: block, position, class, left, right, second, size."""
    lists = [batch.column(k) for k in range(6, 12)]
    block = np.repeat(np.arange(batch.num_rows), lists[0].value_lengths().to_numpy(zero_copy_only=False))
    return (block, *(x.flatten().to_numpy(zero_copy_only=False) for x in lists))


def _decided(batch, model: Model | None, first: bool):
    block, position, kind, left, right, second, size = _gaps_of(batch)
    kind, left, right, second = (x.astype(np.int64) for x in (kind, left, right, second))
    p = posteriors(block, position, kind, size, unary_odds(kind, left, right, second, model, first))
    return block, position, kind, left, right, second, p


def _sums(name: str, slots: np.ndarray, *values: np.ndarray):
    """Sums of some values by slot, as rows of the model's tables."""
    slots, inverse = np.unique(slots, return_inverse=True)
    sums = [np.bincount(inverse, v, len(slots)).astype(np.float64) for v in values]
    sums += [np.zeros(len(slots))] * (4 - len(sums))
    return pa.RecordBatch.from_arrays([pa.array([name] * len(slots), pa.string()), pa.array(slots, pa.int32()), *(pa.array(x) for x in sums)], names=["name", "slot", "a", "b", "c", "d"])


def _count_rows(model: Model | None, first: bool):
    """The expected counts of blocks of prose, added up a batch at a time."""

    def run(batches):
        for batch in batches:
            words = pa.compute.equal(batch.column(2), -1)
            slots, n = (batch.filter(words).column(c).flatten().to_numpy(zero_copy_only=False) for c in (8, 9))
            yield _sums("bare", slots.astype(np.int64), n)
            batch = batch.filter(pa.compute.invert(words))
            prose = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            right0, second0, last = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64)[prose] for k in (3, 4, 5))
            _, _, kind, left, right, second, p = _decided(batch, model, first)
            one, none = np.ones(len(p)), np.zeros(len(p))
            low = (kind % len(_CASES) == _SMALL) & (kind >= _BLANK_CLASSES)
            last = last[last >= 0]
            yield _sums("left", np.concatenate((left, last)), *(np.concatenate(x) for x in ((one, 0.0 * last), (low, 0.0 * last), (none, 1.0 + 0 * last), (p, 1.0 + 0 * last))))
            begun = np.ones(len(right0))
            yield _sums("right", np.concatenate((right, right0)), np.concatenate((one, begun)), np.concatenate((none, begun)), np.concatenate((p, begun)))
            yield _sums("pair", _pair(left, right), one, p)
            known, known0 = second >= 0, second0 >= 0
            yield _sums("two", np.concatenate((_pair(right[known], second[known]), _pair(right0[known0], second0[known0]))), np.concatenate((one[known], begun[known0])), np.concatenate((p[known], begun[known0])))
            yield _sums("class", kind, one, p)

    return run


def _round(blocks: DataFrame, model: Model | None, first: bool) -> Model:
    counts = blocks.mapInArrow(_count_rows(model, first), "name string, slot int, a double, b double, c double, d double")
    counts = staged(counts.groupBy("name", "slot").agg(*(F.sum(c).alias(c) for c in "abcd")), "counts")
    own = {}
    for name, width in _TABLES.items():  # at most 2**SLOT_BITS rows each
        rows = counts.where(F.col("name") == name).select("slot", *"abcd"[:width]).toArrow()
        own[name] = (rows.column(0).to_numpy().astype(np.int64), np.stack([rows.column(k + 1).to_numpy() for k in range(width)], 1))
    return Model(own)


def train_on_blocks(blocks: DataFrame, rounds: int = ROUNDS) -> Model:
    model = _round(blocks, None, True)
    for k in range(rounds):
        model = _round(blocks, model, k == 0)
    return model


def train(documents: DataFrame, rounds: int = ROUNDS) -> Model:
    """The model after ``rounds`` rounds of expectation maximisation over all documents."""
    return train_on_blocks(staged(parsed_blocks(documents), "blocks"), rounds)


def _end_rows(model: Model | None):
    def run(batches):
        for batch in batches:
            batch = batch.filter(pa.compute.greater_equal(batch.column(2), 0))
            doc, end = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 2))
            block, position, *_, p = _decided(batch, model, False)
            cut = p > 0.5
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate((doc[block[cut]], doc)), pa.int64()), pa.array(np.concatenate((position[cut], end)), pa.int64())], names=["doc_id", "end_pos"])

    return run


def sentence_ends(text: str, model: Model | None) -> list[int]:
    """End positions of a text's sentences."""
    rows = pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([text])], names=["doc_id", "text"])
    return sorted({e for found in _end_rows(model)(_block_rows([rows])) for e in found.column(1).to_pylist()})


def sentences(documents: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per sentence: doc_id and end_pos, the number of characters through the sentence's last one.

    ``documents`` has doc_id bigint and text string. Without a model one is trained on the documents first.
    """
    blocks = parsed_blocks(documents.where("doc_id is not null"))
    if model is None:
        blocks = staged(blocks, "blocks")
        model = train_on_blocks(blocks)
    return blocks.mapInArrow(_end_rows(model), "doc_id bigint, end_pos bigint").distinct()
