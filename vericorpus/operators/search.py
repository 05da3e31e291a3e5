"""Vector search: exact top-k of stated queries with a similarity floor.

The queries are a stated set that goes to the vectors in blocks of bounded size; each batch of vectors keeps its own best k per
query (a matrix product in numpy), so what is shuffled is k rows per query and batch and never a product of tables.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vericorpus.functions.solidity import spec_chunk
from vericorpus.functions.text import col

TOP_K, FLOOR = 3, 0.75
#: Queries in a block.
BLOCK = 2048

_HITS = "query_id bigint, vec_id bigint, score double"


def score(distance) -> Column:
    """The score of a squared Euclidean distance: the cosine for unit vectors."""
    return 1 - col(distance) / 2


def _best_rows(ids: np.ndarray, vectors: np.ndarray, k: int, skip_self: bool):
    norms = (vectors**2).sum(1)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column(0).to_numpy(zero_copy_only=False)
            lists = batch.column(1)
            matrix = np.asarray(lists.flatten(), np.float64).reshape(len(own), -1)
            scores = 1 - np.maximum(norms[:, None] + (matrix**2).sum(1)[None, :] - 2 * vectors @ matrix.T, 0) / 2
            if skip_self:
                scores[ids[:, None] == own[None, :]] = -np.inf
            # by score, then by id: the order of the result
            order = np.lexsort((np.broadcast_to(own, scores.shape), -np.round(scores, 9)), axis=1)[:, :k]
            best = np.take_along_axis(scores, order, 1)
            keep = np.isfinite(best).ravel()
            columns = (np.repeat(ids, order.shape[1])[keep], own[order].ravel()[keep], best.ravel()[keep])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = TOP_K, skip_self: bool = False, block: int = BLOCK) -> DataFrame:
    """The k nearest vectors of each query: query_id, rank, vec_id, score.

    Both have vec_id bigint and embedding array<float>. k = 0 means the default. Null vectors are left out; ties go by vec_id.
    """
    k = k or TOP_K
    rows = vectors.where("vec_id is not null and embedding is not null").select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    found, part = None, []

    def search(part):
        ids = np.array([r[0] for r in part], np.int64)
        return rows.mapInArrow(_best_rows(ids, np.array([r[1] for r in part], np.float64), k, skip_self), _HITS)

    for row in queries.where("vec_id is not null and embedding is not null").select("vec_id", "embedding").toLocalIterator():
        part.append(row)
        if len(part) == block:
            found = search(part) if found is None else found.unionByName(search(part))
            part = []
    if part or found is None:
        more = search(part) if part else vectors.sparkSession.createDataFrame([], _HITS)
        found = more if found is None else found.unionByName(more)
    order = Window.partitionBy("query_id").orderBy(F.round("score", 9).desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def above_floor(hits: DataFrame, floor: float = FLOOR) -> DataFrame:
    """Hits whose score reaches the floor; applied behind the limit, so fewer than k may stay."""
    return hits.where(F.col("score") >= floor)


def dropped_below(hits: DataFrame, floor: float = FLOOR) -> DataFrame:
    """How many hits a floor drops, by query."""
    return hits.groupBy("query_id").agg(F.count_if(F.col("score") < floor).alias("dropped"), F.count("*").alias("hits"))


def hit_struct(document, score_column, meta) -> Column:
    """A retrieval hit; entries of the metadata map take the place of fields of the same name."""
    meta = col(meta)
    return F.struct(
        F.coalesce(meta["document"], spec_chunk(document)).alias("document"), meta["contract_name"].alias("contract_name"), meta["spec_filename"].alias("spec_filename"),
        F.coalesce(meta["score"].cast("double"), col(score_column)).alias("score"), meta.alias("meta"),
    )
