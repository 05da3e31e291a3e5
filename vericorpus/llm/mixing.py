"""Mixing sources to target weights (problem 7).

Method: a low-discrepancy schedule. Slot ``k`` of the mix has the golden-ratio point
``frac((k + 0.5) * phi)``; the cumulative weights map it to a source, and its rank among the
slots of that source is the number of the block it takes. The blocks of a
source are its documents in shuffled order, laid end to end and cut into pieces of ``BLOCK``
tokens; a small source begins again in another order, at most ``max_repeats`` times.

Ranks and positions are running sums over groups that may hold a third of all rows,
so both are taken in two steps: sums of chunks of bounded size first, then positions inside a chunk.

Cases: null text has no tokens; a null source belongs to no target; spellings that
differ in case, blanks or joining signs are one source; documents without an id are left out;
a row delivered twice counts once; a target without documents misses its share;
empty tables give empty results; further columns are ignored.
"""

from __future__ import annotations

import base64

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: A public byte-level vocabulary, and the pattern by which its texts are cut first.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Tokens in a block, slots in a chunk of the schedule, and documents (about) in a chunk of a source.
BLOCK, CHUNK, BUCKETS = 512, 1 << 16, 4096
PHI = 0.6180339887498949


def canonical_source(source) -> F.Column:
    """A source's name without variants of case, blanks and joining signs."""
    return F.regexp_replace(F.regexp_replace(F.lower(source), r"[^\p{L}\p{N}]+", "_"), "^_+|_+$", "")


def _token_rows(vocabulary: str, pattern: str):
    def run(batches):
        import tiktoken

        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            counts = [len(encoding.encode_ordinary(t)) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(counts, pa.int64())], names=[*batch.schema.names[:-1], "tokens"])

    return run


def token_counts(documents: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """(doc_id, source, tokens) of each document, the source by its canonical name."""
    own = documents.where("doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), canonical_source("source").alias("source"), "text")
    counted = own.mapInArrow(_token_rows(vocabulary, pattern), "doc_id bigint, source string, tokens bigint")
    return counted.groupBy("doc_id").agg(F.max_by("source", "tokens").alias("source"), F.max("tokens").alias("tokens"))


def plan(counts: DataFrame, targets: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per target source: its share, tokens, and the slots it wants and can fill.

    Returns source (as the target spells it), key, target_share, max_repeats, tokens, all_tokens, slots (blocks that the
    share asks for), filled (blocks it has, repeats included, at most slots) and missed (it has less than its share even at the cap).
    """
    own = counts.groupBy("source").agg(F.sum("tokens").alias("tokens"))
    everything = own.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("all_tokens"))
    wanted = targets.where("source is not null").select("source", canonical_source("source").alias("key"), F.coalesce("target_share", F.lit(0.0)).alias("target_share"), F.coalesce("max_repeats", F.lit(1)).alias("max_repeats")).dropDuplicates(["key"])
    sized = wanted.join(own.withColumnRenamed("source", "key"), "key", "left").crossJoin(F.broadcast(everything)).withColumn("tokens", F.coalesce("tokens", F.lit(0)))
    return (
        sized.withColumn("slots", F.round(F.col("target_share") * F.col("all_tokens") / block).cast("bigint"))
        .withColumn("filled", F.least("slots", F.floor(F.col("max_repeats") * F.col("tokens") / block)))
        .withColumn("missed", F.col("max_repeats") * F.col("tokens") < F.col("target_share") * F.col("all_tokens"))
    )


def schedule(sized: DataFrame, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """(slot, key, number): which block of which source stands at each slot of the mix, exhausted sources' slots left out."""
    spark = sized.sparkSession
    # targets are few by their meaning: a weight a row
    rows = sorted((r["key"], r["target_share"], r["filled"], r["all_tokens"]) for r in sized.select("key", "target_share", "filled", "all_tokens").collect())
    total = sum(r[1] for r in rows)
    if not rows or not total:
        return spark.createDataFrame([], "slot bigint, key string, number bigint")
    length = int(round(total * rows[0][3] / block))
    slots = spark.range(length).select(F.col("id").alias("slot"), ((F.col("id") + 0.5) * PHI % 1.0 * total).alias("x"), F.floor(F.col("id") / chunk).alias("chunk"))
    reach, key = 0.0, F.lit(None).cast("string")
    bounds = []
    for name, share, filled, _ in rows:
        bounds.append((reach, reach + share, name, filled))
        reach += share
    for low, high, name, _ in reversed(bounds):
        key = F.when((F.col("x") >= low) & (F.col("x") < high), F.lit(name)).otherwise(key)
    slots = slots.withColumn("key", F.coalesce(key, F.lit(rows[-1][0]))).drop("x")
    counts = slots.groupBy("key", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("key").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("key", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = slots.join(counts, ["key", "chunk"]).withColumn("number", F.col("before") + F.row_number().over(Window.partitionBy("key", "chunk").orderBy("slot")) - 1)
    filled = F.lit(0).cast("bigint")
    for _, _, name, most in bounds:
        filled = F.when(F.col("key") == name, F.lit(most)).otherwise(filled)
    return ranked.where(F.col("number") < filled).select("slot", "key", "number")


def mixed_blocks(counts: DataFrame, sized: DataFrame, block: int = BLOCK, buckets: int = BUCKETS) -> DataFrame:
    """(key, number, doc_id, repeat, from_token, to_token): what each block of each source holds."""
    need = sized.where("filled > 0").select("key", F.col("tokens").alias("own"), "filled")
    docs = counts.where("tokens > 0").withColumnRenamed("source", "key").join(need, "key")
    passes = F.ceil(F.col("filled") * block / F.col("own")).cast("int")
    docs = docs.select("key", "own", "filled", "doc_id", "tokens", F.explode(F.sequence(F.lit(0), passes - 1)).alias("repeat"))
    docs = docs.withColumn("order", F.xxhash64("doc_id", "repeat")).withColumn("bucket", F.pmod("order", F.lit(buckets)))
    sums = docs.groupBy("key", "repeat", "bucket").agg(F.sum("tokens").alias("n"))
    before = Window.partitionBy("key", "repeat").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("key", "repeat", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("key", "repeat", "bucket").orderBy("order", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = docs.join(sums, ["key", "repeat", "bucket"]).withColumn("start", F.col("repeat") * F.col("own") + F.col("before") + F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    end = F.col("start") + F.col("tokens")
    first, last = F.floor(F.col("start") / block), F.floor((end - 1) / block)
    cut = placed.withColumn("number", F.explode(F.sequence(first, last))).where("number < filled")
    return cut.select(
        "key", "number", "doc_id", "repeat",
        F.greatest(F.lit(0), F.col("number") * block - F.col("start")).alias("from_token"),
        F.least("tokens", (F.col("number") + 1) * block - F.col("start")).alias("to_token"),
    )


def mix(documents: DataFrame, targets: DataFrame, block: int = BLOCK, vocabulary: str = VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """The mix (slot, source, doc_id, repeat, from_token, to_token) and the report of the shares reached."""
    from vericorpus.session import staged

    counts = staged(token_counts(documents, vocabulary), "tokens")
    sized = staged(plan(counts, targets, block), "plan")
    names = sized.select("key", "source")
    mixed = schedule(sized, block).join(mixed_blocks(counts, sized, block), ["key", "number"]).join(names, "key")
    reached = mixed.groupBy("key").agg(F.sum(F.col("to_token") - F.col("from_token")).alias("mixed_tokens"))
    everything = reached.agg(F.sum("mixed_tokens").alias("mix"))
    report = (
        sized.join(reached, "key", "left").crossJoin(F.broadcast(everything))
        .select(
            "source", "target_share", "max_repeats", "tokens", F.coalesce("mixed_tokens", F.lit(0)).alias("mixed_tokens"),
            F.round(F.coalesce("mixed_tokens", F.lit(0)) / F.when(F.col("tokens") > 0, F.col("tokens")), 6).alias("repeats"),
            F.round(F.coalesce("mixed_tokens", F.lit(0)) / F.col("mix"), 6).alias("actual_share"), "missed",
        )
    )
    return mixed.select("slot", "source", "doc_id", "repeat", "from_token", "to_token"), report
