"""Evaluation texts that leak into training texts (problem 6).

Method: suffix arrays. The documents of a shard (a block of an Arrow batch) are laid
end to end as word numbers; the sorted ranks of their suffixes, by prefix doubling to
the least reported length, are the shard's suffix array. Every suffix of
every evaluation text is looked up in it by binary search; each hit is then
followed to the end of its verbatim match, so the longest match and its places are
known. Only positions that begin a long enough run of words of the evaluation
texts can match, so only they enter the array.

The evaluation texts are a stated query set: they go to all shards in blocks of at most
``BLOCK_WORDS`` words, whatever their number.

Cases: null texts hold and leak nothing; documents and items without an id are left
out; a row delivered twice counts once; an item shorter than the least length leaks
nowhere; empty tables give an empty result; further columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vericorpus.llm._hashing import blocks

#: Least number of consecutive words of an item in a document.
LEAST_WORDS = 12

#: Words of evaluation texts that are sent to the shards at a time; bounds what a task holds.
BLOCK_WORDS = 400_000

#: A word: a maximal run of letters or digits of any script.
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    """The words of a text, case folded."""
    return [w.casefold() for w in _WORD.findall(text)]


class Items:
    """Evaluation texts as word numbers (from 1; 0 is any other word), each text ending in a 0."""

    def __init__(self, items: list[tuple[int, list[str]]]):
        self.number: dict[str, int] = {}
        codes, owner, place = [], [], []
        for item, words in items:
            codes += [self.number.setdefault(w, len(self.number) + 1) for w in words] + [0]
            owner += [item] * (len(words) + 1)
            place += range(len(words) + 1)
        self.codes, self.owner, self.place = np.array(codes, np.int64), np.array(owner, np.int64), np.array(place, np.int64)


def _run_lengths(codes: np.ndarray) -> np.ndarray:
    """How many numbers other than 0 stand from each position on."""
    n = len(codes)
    zero = np.where(codes == 0, np.arange(n), n)
    return np.minimum.accumulate(zero[::-1])[::-1] - np.arange(n)


def _ranks(codes: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """The rank of the ``depth`` numbers from each position ``at`` on, by prefix doubling."""
    padded = np.concatenate((codes, np.zeros(2 * depth, np.int64)))
    rank, width = padded, 1
    while width * 2 <= depth:
        pair = rank[:-width] * (int(rank.max()) + 1) + rank[width:]
        rank = np.concatenate((np.unique(pair, return_inverse=True)[1], np.zeros(width, np.int64)))
        width *= 2
    rest = depth - width
    pair = rank[at] * (int(rank.max()) + 1) + rank[at + rest]
    return np.unique(pair, return_inverse=True)[1]


def shard_matches(docs: np.ndarray, codes: np.ndarray, place: np.ndarray, items: Items, least: int) -> tuple[np.ndarray, ...]:
    """Longest matches of a shard: doc, item, words, word position in the document and in the item.

    ``docs``, ``codes`` and ``place`` give for each position the document, the word number and the word's place.
    """
    none = tuple(np.empty(0, np.int64) for _ in range(5))
    own = np.flatnonzero(_run_lengths(codes) >= least)
    asked = np.flatnonzero(_run_lengths(items.codes) >= least)
    if not len(own) or not len(asked):
        return none
    # keep the shard's long runs only, then rank shard and items together so that ranks compare
    inside = np.zeros(len(codes) + least, bool)
    for k in range(least):
        inside[own + k] = True
    near = np.flatnonzero(inside[: len(codes)])
    breaks = np.concatenate(([False], np.diff(near) > 1))
    packed = np.insert(codes[near], np.flatnonzero(breaks), 0)
    spot = np.arange(len(near)) + np.cumsum(breaks)
    where = spot[np.searchsorted(near, own)]
    both = np.concatenate((packed, [0], items.codes))
    shift = len(packed) + 1
    rank = _ranks(both, np.concatenate((where, asked + shift)), least)
    shard, query = rank[: len(where)], rank[len(where) :]
    array = np.argsort(shard, kind="stable")  # the suffix array, to the depth that decides
    low, high = np.searchsorted(shard[array], query, "left"), np.searchsorted(shard[array], query, "right")
    count = high - low
    if not count.sum():
        return none
    q = np.repeat(np.arange(len(asked)), count)
    hit = array[np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)]
    at, to = own[hit], asked[q]
    # a match that goes on from the word before is part of a longer one
    starts = (at == 0) | (to == 0) | (codes[np.maximum(at - 1, 0)] == 0) | (codes[np.maximum(at - 1, 0)] != items.codes[np.maximum(to - 1, 0)])
    at, to = at[starts], to[starts]
    length = np.full(len(at), least)
    live = np.arange(len(at))
    text = np.concatenate((codes, [0]))
    while len(live):
        i, j = np.minimum(at[live] + length[live], len(codes)), to[live] + length[live]
        live = live[(text[i] == items.codes[np.minimum(j, len(items.codes) - 1)]) & (text[i] > 0)]
        length[live] += 1
    return docs[at], items.owner[to], length, place[at], items.place[to]


_MATCHES = "doc_id bigint, item_id bigint, words int, doc_word bigint, item_word bigint"


def _match_rows(items: Items, least: int):
    def run(batches):
        number = items.number
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in blocks([len(t) for t in texts]):
                docs, codes, place = [], [], []
                for doc, text in zip(ids[a:b], texts[a:b]):
                    found = [number.get(w, 0) for w in words_of(text)]
                    docs.append(np.full(len(found) + 1, doc, np.int64))
                    codes.append(np.array([*found, 0], np.int64))
                    place.append(np.arange(len(found) + 1))
                columns = shard_matches(np.concatenate(docs), np.concatenate(codes), np.concatenate(place), items, least)
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c).cast(k) for c, k in zip(columns, kinds)], names=["doc_id", "item_id", "words", "doc_word", "item_word"])

    return run


def _item_blocks(items: DataFrame, block_words: int):
    """The evaluation texts in blocks that a task can hold, read from the driver a block at a time."""
    block, size = [], 0
    for row in items.where("item_id is not null and text is not null").select(F.col("item_id").cast("bigint"), "text").distinct().toLocalIterator():
        words = words_of(row[1])
        if block and size + len(words) > block_words:
            yield block
            block, size = [], 0
        block.append((row[0], words))
        size += len(words)
    if block:
        yield block


def leaks(documents: DataFrame, items: DataFrame, least: int = LEAST_WORDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Each document and item with a passage in common: doc_id, item_id, words (of the longest one), doc_word, item_word.

    ``documents`` has doc_id bigint and text string, ``items`` item_id bigint and text string. A passage is at least
    ``least`` consecutive words; case and whatever stands between words do not matter.
    """
    texts = documents.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = None
    for block in _item_blocks(items, block_words):
        part = texts.mapInArrow(_match_rows(Items(block), least), _MATCHES)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = documents.sparkSession.createDataFrame([], _MATCHES)
    longest = F.max(F.struct("words", (-F.col("doc_word")).alias("d"), (-F.col("item_word")).alias("i")))
    return found.groupBy("doc_id", "item_id").agg(longest.alias("m")).select("doc_id", "item_id", F.col("m.words").alias("words"), (-F.col("m.d")).alias("doc_word"), (-F.col("m.i")).alias("item_word"))


def without_leaks(documents: DataFrame, items: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """The documents that hold no passage of an item."""
    return documents.join(leaks(documents, items, least).select("doc_id").distinct(), "doc_id", "left_anti")
