"""Evaluation of retrieval and of verifier runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vericorpus.functions.text import any_of, col

# Parts of messages that tell of the environment, not of the specification.
ENVIRONMENT = ("solc not found", "solidity executable", "certorarun is not installed", "certorakey", "connection refused", "no --solc path given")


def hit_cases(pairs: DataFrame, retrieved: DataFrame) -> DataFrame:
    """(pair_id, hit, retrieved_pair_ids): whether a pair is among its own retrieved ids, those in order of rank.

    ``pairs`` has id, ``retrieved`` query_id, rank and pair_id; rows that come twice count once.
    """
    ids = retrieved.select("query_id", "rank", "pair_id").distinct().groupBy("query_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "pair_id"))), lambda r: r["pair_id"]).alias("ids"))
    joined = pairs.select(F.col("id").alias("pair_id")).where("pair_id is not null").distinct().join(ids, F.col("pair_id") == F.col("query_id"), "left")
    empty = F.array().cast("array<string>")
    return joined.select("pair_id", F.exists(F.coalesce("ids", empty), lambda x: x.eqNullSafe(F.col("pair_id"))).alias("hit"), F.coalesce("ids", empty).alias("retrieved_pair_ids"))


def rate(rows: DataFrame, test: Column, hits: str, name: str) -> DataFrame:
    """Hits, total and their ratio, 0.0 over no rows."""
    n = F.count_if(test)
    return rows.agg(n.alias(hits), F.count("*").alias("total"), F.coalesce(n / F.nullif(F.count("*"), F.lit(0)), F.lit(0.0)).alias(name))


def hit_rate(cases: DataFrame) -> DataFrame:
    return rate(cases, F.col("hit"), "hits", "hit_rate")


def pass_rate(results: DataFrame) -> DataFrame:
    return rate(results, F.lower("status") == "passed", "passed", "pass_rate")


def delivered_once(results: DataFrame) -> DataFrame:
    """One row per run and attempt, the last finished."""
    last = Window.partitionBy("run_id", "attempt").orderBy(F.col("finished_at").desc_nulls_last(), F.col("output").desc_nulls_last())
    return results.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")


def last_status(results: DataFrame) -> DataFrame:
    """(run_id, attempt, status) of each run's last attempt."""
    return results.groupBy("run_id").agg(F.max("attempt").alias("attempt"), F.lower(F.max_by("status", "attempt")).alias("status"))


def exit_code(status) -> Column:
    status = F.lower(col(status))
    return F.when(status.isin("passed", "skipped"), 0).when(status == "unverified", 2).otherwise(1)


def environment_error(output) -> Column:
    return F.coalesce(any_of(F.lower(col(output)), ENVIRONMENT), F.lit(False))


def report_text(output, most: int = 2000) -> Column:
    """The end of an output."""
    return F.right(col(output), F.lit(most))


def pair_paths(records: DataFrame) -> DataFrame:
    """(id, contract_path, spec_path): the last contract and the first specification of a pair; null where there is none."""
    return records.select(
        "id", F.try_element_at("contracts", F.lit(-1))["relative_path"].alias("contract_path"), F.try_element_at("specs", F.lit(1))["relative_path"].alias("spec_path")
    )


def joined_sources(contracts) -> Column:
    """All sources of a pair with line feeds between them."""
    return F.array_join(F.transform(col(contracts), lambda c: c["clean_source"]), "\n")


def first_records(dataset: DataFrame, limit: int) -> DataFrame:
    """The first records by their place (pos) in the dataset."""
    if limit < 0:
        raise ValueError("a negative limit has no meaning")
    return dataset.where(F.col("pos") < limit)
