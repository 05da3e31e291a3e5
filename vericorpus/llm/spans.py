"""Long exact spans shared between items of different owners (problem 3).

Method: compact windows. The tokens of a text are its overlapping character
grams of ``GRAM`` characters, each with a hash. For every run of ``WIDTH``
consecutive tokens (exactly ``SPAN`` characters) the token of least hash is the
root of the run's Cartesian tree; the starts that share a root form one compact
window ``(first, root, last)``. The windows of a text cut its starts into
disjoint stretches, about ``2 / WIDTH`` of them a character, and are found with
a sliding minimum in numpy rather than by building trees.

Equal passages have equal minima under *any* hash function, so for verbatim
passages one hash function already gives complete recall, and more would only
find the same passages again. A passage of at least ``SPAN`` characters shared by
two items therefore lies in a window of each with the same signature (the root's
hash) and at the same distance from the root. The join on signatures leaves few
windows; those whose whole regions are equal are settled at once, and the rest
are compared window by window (the verification), in groups of bounded size or,
above that bound, by an aggregation that Spark can split.

Cases: null texts and texts below ``SPAN`` characters give no row; a row
delivered twice counts once (equal owner); items without an id are compared but
not reported; an empty table gives an empty result; further columns of the
input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vericorpus.llm._hashing import BLOCK_CHARS, Rolling, blocks, code_points, sliding_minimum
from vericorpus.session import staged

#: Least length of a reported passage, in characters.
SPAN = 400

#: What the kind of an item without an id ends with inside.
UNNAMED = "\u0000?"

_WINDOWS = "item_kind string, item_id bigint, owner bigint, signature bigint, region bigint, first int, starts int"
#: Bits of a sliding key that hold the position inside a block; the rest is the hash.
_POSITION_BITS = 24


def compact_windows(texts: list[str], span: int) -> tuple[np.ndarray, ...]:
    """The compact windows of texts of at least ``span`` characters.

    Returns arrays: text index, signature, hash of the whole region, first start, number of starts.
    """
    gram = span // 2 + 1
    width = span - gram + 1
    codes, offsets = code_points(texts)
    rolling = Rolling(codes)
    grams = rolling.fixed(gram)
    bits = max(_POSITION_BITS, int(len(grams)).bit_length())
    low = np.uint64((1 << bits) - 1)
    least = sliding_minimum((grams & ~low) | np.arange(len(grams), dtype=np.uint64), width)
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))[: len(least)]
    at = np.flatnonzero(np.arange(len(least)) + span <= offsets[owner + 1])
    least, owner = least[at], owner[at]
    new = np.flatnonzero(np.concatenate(([True], (least[1:] != least[:-1]) | (owner[1:] != owner[:-1]))))
    first, last = at[new], at[np.concatenate((new[1:] - 1, [len(at) - 1]))]
    root = (least[new] & low).astype(np.int64)
    return owner[new], grams[root], rolling.slices(first, last + span), first - offsets[owner[new]], last - first + 1


def text_parts(texts: list[str], span: int, limit: int = BLOCK_CHARS) -> tuple[list[int], list[int], list[str]]:
    """Texts longer than ``limit`` in parts that share ``span - 1`` characters, so that every start lies in one part.

    Returns for each part the text's index, the part's place in it and the part itself. A window that is cut by
    a part's end becomes two; its region then differs from an uncut copy's, and the verification settles both.
    """
    which, at, parts = [], [], []
    for k, text in enumerate(texts):
        for a in range(0, max(1, len(text) - span + 1), limit):
            which.append(k)
            at.append(a)
            parts.append(text if len(text) <= limit else text[a : a + limit + span - 1])
    return which, at, parts


def _window_rows(span: int, limit: int = BLOCK_CHARS):
    def run(batches):
        for batch in batches:
            kinds, ids, owners, texts = (batch.column(k).to_pylist() for k in range(4))
            source, place, texts = text_parts(texts, span, limit)
            source, place = np.array(source, np.int64), np.array(place, np.int64)
            for a, b in blocks([len(t) for t in texts]):
                which, signature, region, first, starts = compact_windows(texts[a:b], span)
                first, which = first + place[which + a], source[which + a]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(kinds, pa.string()).take(pa.array(which)),
                        pa.array(ids, pa.int64()).take(pa.array(which)),
                        pa.array(owners, pa.int64()).take(pa.array(which)),
                        pa.array(signature.view(np.int64)),
                        pa.array(region.view(np.int64)),
                        pa.array(first.astype(np.int32)),
                        pa.array(starts.astype(np.int32)),
                    ],
                    names=["item_kind", "item_id", "owner", "signature", "region", "first", "starts"],
                )

    return run


def _context_rows(span: int):
    """Cuts the regions asked for out of a text."""

    def run(batches):
        for batch in batches:
            texts, asked = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows = [(x["signature"], x["region"], x["low"], x["high"], t[x["first"] : x["first"] + x["starts"] - 1 + span]) for t, xs in zip(texts, asked) for x in xs]
            columns = list(zip(*rows)) or [[]] * 5
            kinds = [pa.int64()] * 4 + [pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["signature", "region", "low", "high", "context"])

    return run


def _runs(signature, region, low, high, contexts, span):
    """Runs of starts whose window stands in another owner's region of the same signature."""
    parts = []
    for a, b in blocks([len(c) for c in contexts]):
        codes, offsets = code_points(contexts[a:b])
        hashes = Rolling(codes, 1).fixed(span)
        which = np.repeat(np.arange(b - a), np.diff(offsets))[: len(hashes)]
        ok = np.arange(len(hashes)) + span <= offsets[which + 1]
        at = np.flatnonzero(ok)
        parts.append((hashes[at], which[at] + a, at - offsets[which[at]]))
    hashes, which, start = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((hashes, signature[which]))
    h, s = hashes[order], signature[which][order]
    new = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (s[1:] != s[:-1]))))
    shared = np.minimum.reduceat(low[which][order], new) != np.maximum.reduceat(high[which][order], new)
    flag = np.zeros(len(h), bool)
    flag[order] = np.repeat(shared, np.diff(np.concatenate((new, [len(h)]))))
    which, start = which[flag], start[flag]
    if not len(which):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    new = np.flatnonzero(np.concatenate(([True], (which[1:] != which[:-1]) | (start[1:] != start[:-1] + 1))))
    end = start[np.concatenate((new[1:] - 1, [len(start) - 1]))]
    return which[new], start[new], end - start[new] + 1


def _verified_rows(span: int):
    """Input sorted by signature; a group that goes on in the next batch is held over."""

    def emit(batch):
        n = batch.num_rows
        if not n:
            return None
        signature, region, low, high = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
        which, start, length = _runs(signature, region, low, high, batch.column(4).to_pylist(), span)
        return pa.RecordBatch.from_arrays(
            [pa.array(signature[which]), pa.array(region[which]), pa.array(start.astype(np.int32)), pa.array(length.astype(np.int32))], names=["signature", "region", "offset", "starts"]
        )

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            key = whole.column(0).to_numpy()
            cut = int(np.searchsorted(key != key[-1], False)) if key[0] == key[-1] else int(np.flatnonzero(key != key[-1])[-1]) + 1
            for piece in whole.slice(0, cut).to_batches():
                yield emit(piece)
            held = (whole.slice(cut).combine_chunks().to_batches() or [None])[0]
        if held is not None and held.num_rows:
            yield emit(held)

    return run


def _start_rows(span: int):
    """One row per start of a region, for signatures too frequent to be compared in one task."""

    def run(batches):
        for batch in batches:
            signature, region, low, high = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
            contexts = batch.column(4).to_pylist()
            for a, b in blocks([len(c) for c in contexts], 200_000):
                codes, offsets = code_points(contexts[a:b])
                hashes = Rolling(codes, 1).fixed(span)
                which = np.repeat(np.arange(b - a), np.diff(offsets))[: len(hashes)]
                at = np.flatnonzero(np.arange(len(hashes)) + span <= offsets[which + 1])
                w = which[at] + a
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signature[w]), pa.array(region[w]), pa.array(low[w]), pa.array(high[w]), pa.array((at - offsets[which[at]]).astype(np.int32)), pa.array(hashes[at].view(np.int64))],
                    names=["signature", "region", "low", "high", "offset", "window"],
                )

    return run


def shared_spans(items: DataFrame, span: int = SPAN, most_in_a_group: int = 1024) -> DataFrame:
    """How many characters of each item lie in passages that another owner's item holds verbatim.

    ``items`` has item_kind string, item_id bigint, owner string and text string; items of one kind
    and owner are not compared with each other, items of two kinds always are. A signature with more
    than ``most_in_a_group`` different regions is verified by an aggregation over single starts in place of one
    task; the result is the same. Returns item_kind, item_id, n_chars of the passages' union (shared_chars) and
    the number of disjoint passages (passages), for items that have any.
    """
    # items without an id get a kind and a number of their own, so that their texts can be found again
    named = F.col("item_id").isNotNull()
    items = items.where(F.char_length("text") >= span).select(
        F.when(named, F.col("item_kind")).otherwise(F.concat(F.coalesce("item_kind", F.lit("")), F.lit(UNNAMED))).alias("item_kind"),
        F.when(named, F.col("item_id").cast("bigint")).otherwise(F.xxhash64("text")).alias("item_id"),
        F.xxhash64("item_kind", F.coalesce(F.col("owner"), F.lit(""))).alias("owner"), "text",
    )
    windows = staged(items.mapInArrow(_window_rows(span), _WINDOWS), "windows")

    several = windows.groupBy("signature").agg(F.min("owner").alias("low"), F.max("owner").alias("high")).where("low <> high").select("signature")
    found = staged(windows.join(several, "signature", "left_semi"), "candidates")
    regions = found.groupBy("signature", "region").agg(
        F.min("owner").alias("low"), F.max("owner").alias("high"), F.min(F.struct("item_kind", "item_id", "first", "starts")).alias("model")
    )
    regions = staged(regions, "regions")
    whole = regions.where("low <> high").select("signature", "region", F.lit(0).alias("offset"), F.lit(None).cast("int").alias("run"))

    # regions of one owner: compare their windows with all regions of the signature
    open_ones = regions.groupBy("signature").agg(F.count("*").alias("regions"), F.max(F.col("low") == F.col("high")).alias("open")).where("open and regions > 1")
    asked = (
        regions.join(open_ones.select("signature", "regions"), "signature")
        .groupBy("model.item_kind", "model.item_id")
        .agg(F.collect_list(F.struct("signature", "region", "low", "high", "regions", "model.first", "model.starts")).alias("asked"))
    )
    texts = items.select("item_kind", "item_id", "text")
    contexts = texts.join(asked, ["item_kind", "item_id"]).select("text", "asked")
    small = F.filter("asked", lambda x: x["regions"] <= most_in_a_group)
    large = F.filter("asked", lambda x: x["regions"] > most_in_a_group)
    schema = "signature bigint, region bigint, low bigint, high bigint, context string"
    verified = (
        contexts.select("text", small.alias("asked")).where("size(asked) > 0").mapInArrow(_context_rows(span), schema)
        .repartition("signature").sortWithinPartitions("signature")
        .mapInArrow(_verified_rows(span), "signature bigint, region bigint, offset int, starts int")
        .select("signature", "region", "offset", F.col("starts").alias("run"))
    )
    starts = (
        contexts.select("text", large.alias("asked")).where("size(asked) > 0").mapInArrow(_context_rows(span), schema)
        .mapInArrow(_start_rows(span), "signature bigint, region bigint, low bigint, high bigint, offset int, window bigint")
    )
    equal = starts.groupBy("signature", "window").agg(F.min("low").alias("l"), F.max("high").alias("h")).where("l <> h").select("signature", "window")
    frequent = starts.join(equal, ["signature", "window"], "left_semi").select("signature", "region", "offset", F.lit(1).alias("run"))

    settled = whole.unionByName(verified).unionByName(frequent).distinct()
    passages = (
        found.where(~F.endswith(F.col("item_kind"), F.lit(UNNAMED)))
        .join(settled, ["signature", "region"])
        .select("item_kind", "item_id", (F.col("first") + F.col("offset")).alias("a"), (F.col("first") + F.col("offset") + F.coalesce("run", "starts") - 1 + span).alias("b"))
        .groupBy("item_kind", "item_id")
        .agg(F.array_sort(F.collect_set(F.struct("a", "b"))).alias("passages"))
    )
    zero = F.struct(F.lit(0).cast("bigint").alias("chars"), F.lit(-1).alias("end"), F.lit(0).alias("n"))
    union = F.aggregate(
        "passages",
        zero,
        lambda acc, p: F.struct(
            (acc["chars"] + F.greatest(F.lit(0), p["b"] - F.greatest(p["a"], acc["end"]))).cast("bigint").alias("chars"),
            F.greatest(acc["end"], p["b"]).alias("end"),
            (acc["n"] + (p["a"] > acc["end"]).cast("int")).alias("n"),
        ),
    )
    return passages.select("item_kind", "item_id", union.alias("u")).select("item_kind", "item_id", F.col("u.chars").alias("shared_chars"), F.col("u.n").alias("passages"))


def span_items(records: DataFrame, error_history: DataFrame) -> DataFrame:
    """The items of problem 3: contract files (owner: the repository) and snapshots (owner: the contract)."""
    from vericorpus.sources.tables import contract_files

    files = contract_files(records).select(F.lit("file").alias("item_kind"), F.col("file_id").alias("item_id"), F.col("record_id").alias("owner"), F.col("clean_source").alias("text"))
    snapshots = error_history.select(F.lit("snapshot").alias("item_kind"), F.col("history_id").alias("item_id"), F.col("contract_hash").alias("owner"), F.col("spec_snapshot").alias("text"))
    return files.unionByName(snapshots)
