"""Near-duplicate texts: all links of similarity ``THRESHOLD`` or more (problem 4).

Method: parity-sketch join. A text's set of shingles (hashes of five consecutive
words) is dealt into the parts of its size band; the XOR of the hashes in a part is
the part's parity sketch, and the sketches that are not empty, in the order of their parts, are
the set's keys. One differing shingle changes one part, so:

* similarity ``t`` bounds the symmetric difference ``d`` of a set and any partner by ``(1 - t) / t * size``; at most
  ``d`` keys of a set are missing in the partner, and of the first ``d + slack`` keys of both the same ``slack`` at least are
  common (the least common ones). Only those keys leave the scan;
* keys that one set alone has are counted out, which drops every set with fewer than ``slack`` common keys (most
  of a corpus); of the rest only the rarest ``common - slack + 1`` keys need to meet, so boilerplate is not joined on;
* sets are first put into tight clusters (equal least hashes, then a small Hamming distance of the bit sketches to the
  cluster's head). Keys are joined between clusters, not sets, so a family of thousands of variants is one member
  of each of its keys. A pair of clusters is given up if the Hamming distance of the heads' sketches less the reach of both
  clusters (triangle inequality) is above the largest ``d`` that any two of their members may have;
* what is left is verified on the shingles in blocks of sets: a set is sent once to each block it meets, and all pairs of a
  block are counted at once.

Clusters only group the work: every pair of sets with a common key is in a pair of clusters (or in one), so no link depends on them.
Keys of many clusters meet in blocks of bounded size. Sets of two bands meet in the lower band, where the larger set deals its
shingles a second time. Texts that are equal, and texts of equal shingle sets, are
represented by one of them; the result has links between representatives and the
members of each, and ``groups`` their connected components.

Cases: null texts and texts of fewer than five words have no links (equal texts of
at least five words are linked through their class); rows delivered twice count once;
rows without an id are left out; an empty table gives empty results; further
columns of the input are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vericorpus.llm._hashing import BLOCK_CHARS, Rolling, blocks, mix
from vericorpus.session import staged

#: Words in a shingle, and the least similarity of a link.
SHINGLE, THRESHOLD = 5, 0.7

#: Upper end of the first size band, and the ratio of the bands' ends.
FIRST_BAND, BAND_RATIO = 100, 4
#: Share of a set's size by which the keys that leave the scan exceed those that may differ: more of them drop more sets, fewer of them are less to shuffle.
SLACK = 0.15
#: Clusters: rounds of equal least hashes, and the share of its size in which a set's sketch may differ from its head's.
ROUNDS, TIGHT = 3, 0.1
#: Sets, and shingles (about), in a block of a cluster; clusters of one key that meet in one task.
BLOCK_SETS, BLOCK_SHINGLES = 256, 1 << 18

_EPS = 1e-9
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), 95, *range(97, 123)]] = True
_WEIGHTS = np.array([pow(0x9E3779B97F4A7C15, k + 2, 1 << 64) | 1 for k in range(64)], np.uint64)
#: Hash bits of a key; fewer bits make the shuffle smaller and false meetings (which the verification removes) more frequent.
KEY_BITS = 48
_KEY_MASK = np.uint64((1 << KEY_BITS) - 1)


def shingle_sets(texts: list[str], words: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text as (text index, hash), sorted.

    A word is a maximal run of ASCII letters, digits and underscores, case kept.
    """
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    ends = np.cumsum(np.fromiter((len(r) + 1 for r in raw), np.int64, len(raw)))
    symbols = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    edges = np.flatnonzero(np.diff(np.concatenate(([False], _WORD[symbols], [False])).astype(np.int8)))
    starts, stops = edges[::2], edges[1::2]
    n = len(starts) - words + 1
    if n < 1:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    word = Rolling(symbols).slices(starts, stops)
    owner = np.searchsorted(ends, starts, "right")
    total = np.zeros(n, np.uint64)
    for k in range(words):
        total += word[k : k + n] * _WEIGHTS[k]
    inside = owner[:n] == owner[words - 1 :]
    total, owner = mix(total)[inside], owner[:n][inside]
    order = np.lexsort((total, owner))
    total, owner = total[order], owner[order]
    new = np.ones(len(total), bool)
    new[1:] = (total[1:] != total[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], total[new]


_WORDS = re.compile(r"[A-Za-z0-9_]+")


def long_set(text: str, words: int = SHINGLE, limit: int = BLOCK_CHARS) -> np.ndarray:
    """The sorted distinct shingles of one text, worked part by part; parts end between words and share ``words - 1`` of them."""
    found, a = [], 0
    while a < len(text):
        b = min(len(text), a + limit)
        while b < len(text) and text[b].isascii() and (text[b].isalnum() or text[b] == "_"):
            b += 1
        found.append(np.unique(shingle_sets([text[a:b]], words)[1]))
        starts = [m.start() for m in _WORDS.finditer(text, a, b)]
        last = starts[-(words - 1)] if len(starts) >= words else a
        if b == len(text):
            break
        if last > a:
            a = last
        else:  # fewer words than a shingle has in so long a part: take more at a time
            limit *= 2
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.uint64)


def text_sets(texts: list[str], words: int = SHINGLE, limit: int = BLOCK_CHARS):
    """(index, sorted distinct shingles) of each text."""
    for a, b in blocks([len(t) for t in texts], limit):
        if b - a == 1 and len(texts[a]) > limit:
            yield a, long_set(texts[a], words, limit)
            continue
        owner, shingle = shingle_sets(texts[a:b], words)
        bounds = np.searchsorted(owner, np.arange(b - a + 1))
        for k in range(b - a):
            yield a + k, shingle[bounds[k] : bounds[k + 1]]


def band_end(band: int) -> int:
    return FIRST_BAND * BAND_RATIO**band


def band_parts(band: int) -> int:
    """Parts of a band: so many that the largest set of it, dealt at random, fills more of them than its differences can
    touch (0.63 against 0.43 of its size, far beyond chance), and in the first band so many that shingles hardly share one."""
    return 1 << 20 if band == 0 else band_end(band)


def _keys(shingles: np.ndarray, band: int) -> np.ndarray:
    """The parity sketches of the parts that are not empty, in the order of the parts, with part and band hashed in."""
    part = (mix(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)) % np.uint64(band_parts(band))).astype(np.int64)
    order = np.argsort(part, kind="stable")
    part, token = part[order], mix(shingles[order] + np.uint64(band))
    new = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
    parity = np.bitwise_xor.reduceat(token, new)
    return mix(parity + (part[new].astype(np.uint64) << np.uint64(8)) + np.uint64(band)) & _KEY_MASK


def _roles(size: int, threshold: float):
    """The bands in which a set of this size meets partners: (band, most differing shingles)."""
    band = 0
    while size >= band_end(band):
        band += 1
    yield band, int(size * (1 - threshold) / threshold + _EPS)
    if band and size * threshold < band_end(band - 1) - _EPS:
        yield band - 1, int((1 - threshold) / (1 + threshold) * (size + band_end(band - 1) - 1) + _EPS)


def leading_keys(own: np.ndarray, band: int, most: int, slack: float = SLACK) -> tuple[np.ndarray, int]:
    """The first keys of a set in a band, and how many of them any partner has at least."""
    keys = _keys(own, band)
    sure = max(1, min(len(keys) - most, int(slack * len(own)), (1 << 24) - 1))
    return keys[: most + sure], sure


def _key_rows(words: int, threshold: float):
    def run(batches):
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), []
            for k, own in text_sets(batch.column(1).to_pylist(), words):
                for band, most in _roles(len(own), threshold) if len(own) else ():
                    keys, sure = leading_keys(own, band, most)
                    rows.append((ids[k], (band << 24) + sure, keys.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.list_(pa.int64()))],
                names=["id", "role", "keys"],
            )

    return run


_SETS = "id bigint, size int, sketch binary, shingles binary, least array<bigint>"


def _set_rows(words: int):
    """Size, bit sketch (a power of two of bits, about two a shingle), shingles and least hashes of each text."""

    def run(batches):
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), []
            for k, own in text_sets(batch.column(1).to_pylist(), words):
                if len(own):
                    bits = 1 << max(6, int(2 * len(own) - 1).bit_length())
                    odd = (np.bincount((own % np.uint64(bits)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)
                    least = [int(mix(own + _WEIGHTS[j]).min().view(np.int64)) for j in range(ROUNDS)]
                    rows.append((ids[k], len(own), np.packbits(odd).tobytes(), own.tobytes(), least))
            columns = list(zip(*rows)) or [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=[x.split()[0] for x in _SETS.split(", ")])

    return run


def sketch_distance(x: bytes, y: bytes) -> int:
    """Hamming distance of two bit sketches; the longer one is folded (XOR of its halves) to the shorter one's bits."""
    p, q = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    p, q = (p, q) if len(p) <= len(q) else (q, p)
    while len(q) > len(p):
        q = q[: len(q) // 2] ^ q[len(q) // 2 :]
    return int(np.bitwise_count(p ^ q).sum())


def _distance_rows(batches):
    """The distance of the two sketches that are the last columns, in their place."""
    for batch in batches:
        x, y = (batch.column(k).to_pylist() for k in (-2, -1))
        distance = pa.array([sketch_distance(p, q) for p, q in zip(x, y)], pa.int32())
        yield pa.RecordBatch.from_arrays([*batch.columns[:-2], distance], names=[*batch.schema.names[:-2], "distance"])


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each set of one list has in common with each of another (both sorted and distinct)."""
    if len(left) * len(right) <= 4:
        return np.array([[len(np.intersect1d(x, y, assume_unique=True)) for y in right] for x in left], np.int64)
    own = np.concatenate([*left, *right])
    row = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in (*left, *right)])
    order = np.argsort(own, kind="stable")
    own, row = own[order], row[order]
    new = np.concatenate(([True], own[1:] != own[:-1]))
    column = np.cumsum(new) - 1
    several = np.bincount(column)[column] > 1  # a shingle of one set alone is common to none
    column, row = column[several], row[several]
    out = np.zeros((len(left), len(right)), np.float64)
    at = 0
    while at < len(column):  # some thousand shingles at a time
        end = int(np.searchsorted(column, column[at] + 4096))
        held = np.zeros((len(left) + len(right), 4096), np.float32)
        held[row[at:end], column[at:end] - column[at]] = 1
        out += held[: len(left)] @ held[len(left) :].T
        at = end
    return out.astype(np.int64)


def block_links(ids: list, sides: list, sets: list, threshold: float) -> list[tuple[int, int, float]]:
    """Links of one block: between its sides, or among all if there is one side only."""
    own = {}
    for i, side, x in zip(ids, sides, sets):
        own.setdefault(side, {})[i] = x  # rows delivered twice count once
    one, two = own.get(0, {}), own.get(1)
    left, right = list(one), list(one if two is None else two)
    x = [np.frombuffer(one[i], np.uint64) for i in left]
    y = x if two is None else [np.frombuffer(two[i], np.uint64) for i in right]
    if not x or not y or two is None and len(x) < 2:
        return []
    both = common_counts(x, y)
    either = np.array([len(p) for p in x])[:, None] + np.array([len(p) for p in y])[None, :] - both
    similarity = both / either
    keep = similarity >= threshold
    if two is None:
        keep &= np.triu(np.ones(keep.shape, bool), 1)
    return [(min(left[i], right[j]), max(left[i], right[j]), float(similarity[i, j])) for i, j in np.argwhere(keep)]


def _block_rows(threshold: float):
    """Rows (block, side, id, shingles) sorted by block; a block that goes on in the next batch is held over."""

    def run(batches):
        at, ids, sides, sets, found = None, [], [], [], []

        def batch_of(found):
            columns = list(zip(*found)) or [[]] * 3
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()))], names=["id_a", "id_b", "similarity"])

        for batch in batches:
            for block, side, i, shingles in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if block != at:
                    found += block_links(ids, sides, sets, threshold)
                    at, ids, sides, sets = block, [], [], []
                    if len(found) > 50_000:
                        yield batch_of(found)
                        found = []
                ids.append(i)
                sides.append(side)
                sets.append(shingles)
        yield batch_of(found + block_links(ids, sides, sets, threshold))

    return run


def text_classes(texts: DataFrame) -> DataFrame:
    """``(id, class_id)`` of each text: texts that are equal share the least id of theirs."""
    prints = texts.select("id", F.xxhash64("text").alias("x"), F.xxhash64("text", F.lit(1)).alias("y"), F.char_length("text").alias("n")).distinct()
    heads = prints.groupBy("x", "y", "n").agg(F.min("id").alias("class_id"))
    return staged(prints.join(heads, ["x", "y", "n"]).select("id", "class_id"), "classes")


def set_classes(sets: DataFrame) -> DataFrame:
    """``(id, class_id)`` of each set of shingles: equal sets share the least id of theirs."""
    prints = sets.select("id", F.xxhash64("shingles").alias("x"), F.xxhash64("shingles", F.lit(1)).alias("y"), "size").distinct()
    heads = prints.groupBy("x", "y", "size").agg(F.min("id").alias("class_id"))
    return staged(prints.join(heads, ["x", "y", "size"]).select("id", "class_id"), "same")


def clusters_of(small: DataFrame, tight: float = TIGHT) -> DataFrame:
    """``(id, cluster)``: sets in tight clusters, the head's id naming each. ``small`` has id, size, sketch and least.

    A round puts heads of one least hash under the least id of theirs if their sketches are near; three rounds of other hashes follow each other.
    """
    out = staged(small.select("id", F.col("id").alias("cluster")), "clusters")
    for j in range(ROUNDS):
        heads = small.join(out.select(F.col("cluster").alias("id")).distinct(), "id", "left_semi").select("id", "size", "sketch", F.col("least")[j].alias("least"))
        first = heads.groupBy("least").agg(F.min("id").alias("head"), F.count("*").alias("n")).where("n > 1").select("least", "head")
        moved = heads.join(first, "least").where("id <> head").join(small.select(F.col("id").alias("head"), F.col("sketch").alias("other")), "head").select("id", "head", "size", "sketch", "other")
        moved = moved.mapInArrow(_distance_rows, "id bigint, head bigint, size int, distance int").where(F.col("distance") <= tight * F.col("size")).select(F.col("id").alias("cluster"), "head")
        out = staged(out.join(moved, "cluster", "left").select("id", F.coalesce("head", "cluster").alias("cluster")), "clusters")
    return out


def _numbers(n) -> F.Column:
    return F.explode(F.sequence(F.lit(0), n - 1))


def met_clusters(rows: DataFrame, most_in_a_group: int) -> DataFrame:
    """Pairs ``(cluster_a < cluster_b)`` with a key in common; ``rows`` has key and cluster.

    A key of many clusters is met in blocks: each pair of blocks is a group of its own, so no group is larger than two of them.
    """
    rows = staged(rows.distinct(), "rows")
    crowds = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key", F.ceil(F.col("n") / most_in_a_group).cast("int").alias("blocks"))
    own = rows.join(crowds, "key").withColumn("block", F.pmod(F.xxhash64("cluster"), F.col("blocks")).cast("int")).select("key", "cluster", "block", _numbers(F.col("blocks")).alias("other"))
    own = own.select("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "cluster", "block")
    a, b = (own.select("key", "low", "high", F.col("cluster").alias(f"cluster_{s}"), F.col("block").alias(f"block_{s}")) for s in "ab")
    met = a.join(b, ["key", "low", "high"]).where("cluster_a < cluster_b and (low = high or block_a <> block_b)")
    return met.select("cluster_a", "cluster_b").distinct()


def near_duplicate_links(texts: DataFrame, threshold: float = THRESHOLD, words: int = SHINGLE, most_in_a_group: int = BLOCK_SETS) -> tuple[DataFrame, DataFrame]:
    """Links (id_a < id_b, similarity) between class representatives, and the classes (id, class_id).

    ``texts`` has id bigint and text string. Every pair of representatives whose shingle sets have at least
    ``threshold`` of their union in common is in the links, and no other.
    """
    texts = texts.where("id is not null and text is not null").select(F.col("id").cast("bigint").alias("id"), "text")
    classes = text_classes(texts)
    copies = staged(classes.where("id <> class_id").select("id"), "copies")
    heads = texts.join(copies, "id", "left_anti")

    keys = heads.mapInArrow(_key_rows(words, threshold), "id bigint, role int, keys array<bigint>").select("id", "role", F.explode("keys").alias("key"))
    # counted before the shuffle; a row delivered twice counts as two and is found out by the verification
    common = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    # an entry is one number: the magnitude of the key's frequency above the key, so that sorting puts rare keys first
    entry = F.shiftleft(F.floor(F.log2("n")), KEY_BITS) + F.col("key")
    key_of = lambda e: e.bitwiseAND(F.lit((1 << KEY_BITS) - 1))
    sure = F.col("role") % (1 << 24)
    lists = (
        keys.join(common.hint("shuffle_hash"), "key")
        .groupBy("id", "role").agg(F.collect_set(entry).alias("entries"))
        .where(F.size("entries") >= sure)
        .select("id", F.slice(F.array_sort("entries"), 1, F.size("entries") - sure + 1).alias("entries"))
    )
    lists = staged(lists, "prefixes")

    left = staged(lists.select("id").distinct(), "left")
    sets = staged(heads.join(left, "id", "left_semi").mapInArrow(_set_rows(words), _SETS), "sets")
    same = set_classes(sets)
    alone = same.where("id = class_id").select("id")
    small = staged(sets.select("id", "size", "sketch", "least").distinct().join(alone, "id", "left_semi"), "sketches")
    clusters = clusters_of(small)

    rows = lists.select("id", F.explode(F.transform("entries", key_of)).alias("key")).join(clusters, "id").select("key", "cluster")
    met = met_clusters(rows, most_in_a_group)

    head = small.select(F.col("id").alias("cluster"), F.col("sketch").alias("other"))
    members = small.select("id", "size", "sketch").join(clusters, "id").join(head, "cluster").select("id", "cluster", "size", "sketch", "other")
    members = staged(members.mapInArrow(_distance_rows, "id bigint, cluster bigint, size int, distance int"), "members")
    blocks = F.greatest(F.ceil(F.count("*") / most_in_a_group), F.ceil(F.sum("size") / BLOCK_SHINGLES)).cast("int")
    info = staged(
        members.groupBy("cluster").agg(F.count("*").alias("n"), blocks.alias("blocks"), F.min("size").alias("low"), F.max("size").alias("high"), F.max("distance").alias("reach")).join(head, "cluster"), "info"
    )
    one, two = (info.select(F.col("cluster").alias(f"cluster_{s}"), *(F.col(c).alias(f"{c}_{s}") for c in ("blocks", "low", "high", "reach", "other"))) for s in "ab")
    spare = F.col("reach_a") + F.col("reach_b") + (1 - threshold) / (1 + threshold) * (F.col("high_a") + F.col("high_b")) + _EPS
    between = (
        met.join(one, "cluster_a").join(two, "cluster_b")
        .where((F.col("high_a") >= threshold * F.col("low_b") - _EPS) & (F.col("high_b") >= threshold * F.col("low_a") - _EPS))
        .select("cluster_a", "cluster_b", "blocks_a", "blocks_b", spare.alias("spare"), "other_a", "other_b")
        .mapInArrow(_distance_rows, "cluster_a bigint, cluster_b bigint, blocks_a int, blocks_b int, spare double, distance int")
        .where("distance <= spare").select("cluster_a", "cluster_b", "blocks_a", "blocks_b")
    )
    within = info.where("n > 1").select(F.col("cluster").alias("cluster_a"), F.col("cluster").alias("cluster_b"), F.col("blocks").alias("blocks_a"), F.col("blocks").alias("blocks_b"))
    grid = between.unionByName(within).withColumn("i", _numbers(F.col("blocks_a"))).withColumn("j", _numbers(F.col("blocks_b"))).where("cluster_a <> cluster_b or i <= j")
    grid = staged(grid.withColumn("block", F.monotonically_increasing_id()), "grid")
    placed = members.join(info.select("cluster", "blocks"), "cluster").select("id", "cluster", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("part"))
    side_a = grid.join(placed, (F.col("cluster") == F.col("cluster_a")) & (F.col("part") == F.col("i"))).select("block", F.lit(0).alias("side"), "id")
    side_b = grid.where("cluster_a <> cluster_b or i <> j").join(placed, (F.col("cluster") == F.col("cluster_b")) & (F.col("part") == F.col("j"))).select("block", F.lit(1).alias("side"), "id")
    meetings = staged(side_a.unionByName(side_b), "meetings")
    links = (
        meetings.join(sets.select("id", "shingles"), "id").select("block", "side", "id", "shingles")
        .repartition("block").sortWithinPartitions("block")
        .mapInArrow(_block_rows(threshold), "id_a bigint, id_b bigint, similarity double")
    )
    further = same.select(F.col("id").alias("class_id"), F.col("class_id").alias("set_class"))
    classes = classes.join(further, "class_id", "left").select("id", F.coalesce("set_class", "class_id").alias("class_id"))
    return staged(links, "links"), staged(classes, "set-classes")


def groups(links: DataFrame, classes: DataFrame) -> DataFrame:
    """(id, group_id) of every text that is linked or has a copy: connected components, named by their least id.

    Stars are contracted in turn (to the least neighbour of all, then of the lesser ones) until nothing changes; each round is a few
    joins and aggregations over the edges that are left, and only a count and a sum go to the driver.
    """
    edges = staged(links.select("id_a", "id_b").unionByName(classes.where("id <> class_id").select(F.col("class_id").alias("id_a"), F.col("id").alias("id_b"))).distinct(), "edges")
    before = None
    while True:
        both = edges.select(F.col("id_a").alias("u"), F.col("id_b").alias("v")).unionByName(edges.select(F.col("id_b").alias("u"), F.col("id_a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), "m").unionByName(small.select("u", "m")).where("u <> m").distinct()
        edges = staged(small.select(F.col("m").alias("id_a"), F.col("u").alias("id_b")), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("id_a", "id_b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("id_b").alias("id"), F.col("id_a").alias("group_id")).unionByName(edges.select(F.col("id_a").alias("id"), F.col("id_a").alias("group_id"))).distinct()
        before = now


def linked_copies(classes: DataFrame, texts: DataFrame, words: int = SHINGLE) -> DataFrame:
    """The classes of several texts whose texts have a shingle at all, which only their own texts are read for (words are counted in the JVM)."""
    copied = staged(classes.where("id <> class_id").select(F.col("class_id").alias("id")).distinct(), "copied")
    worded = texts.join(copied, "id", "left_semi").where(F.regexp_count("text", F.lit("[A-Za-z0-9_]+")) >= words).select(F.col("id").alias("class_id")).distinct()
    return classes.join(worded, "class_id", "left_semi").select("id", "class_id")


def expand_links(links: DataFrame, classes: DataFrame, texts: DataFrame, words: int = SHINGLE) -> DataFrame:
    """All pairs (id_a < id_b) of linked texts: between the members of linked classes and within classes."""
    mine, yours = (classes.select(F.col("class_id").alias(f"id_{s}"), F.col("id").alias(s)) for s in "ab")
    between = links.select("id_a", "id_b").join(mine, "id_a").join(yours, "id_b").select("a", "b")
    inner = linked_copies(classes, texts, words)
    within = inner.select("class_id", F.col("id").alias("a")).join(inner.select("class_id", F.col("id").alias("b")), "class_id").where("a < b").select("a", "b")
    return between.select(F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b")).unionByName(within.select(F.col("a").alias("id_a"), F.col("b").alias("id_b")))


def solidity_texts(records: DataFrame) -> DataFrame:
    """The Solidity files of ``records.contracts`` as (id, text)."""
    from vericorpus.sources.tables import contract_files

    return contract_files(records).where(F.lower("relative_path").endswith(".sol")).select(F.col("file_id").alias("id"), F.col("clean_source").alias("text"))
