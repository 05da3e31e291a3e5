"""Error history: canonical error keys, append, read-back by latest rows, change and recurrence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vericorpus.functions.text import col, strip

SCHEMA = "contract_hash string, run_id string, attempt int, spec_snapshot string, errors array<string>, created_at timestamp"
#: Rows of a contract that are read back.
LATEST = 50

# Fixed value: the text of one error whatever the variable.
UNDECLARED = "variable has not been declared — declare all variables (e.g. env e; inside rules, ghost uint256 name; before the methods block) before use"


def error_key(message, strict_parity: bool = False) -> Column:
    """The canonical key of an error message. The order of the steps is part of the meaning.

    ``strict_parity`` removes line numbers before the prefix that begins with one, so that prefix stays in the key.
    """
    text = F.lower(strip(message))
    line = lambda t: F.regexp_replace(t, r"\bline \d+\b", "")
    prefix = lambda t: F.regexp_replace(t, r"^line \d+\s+`[^`]*`\s*->\s*(?:error:\s*)?", "")
    text = prefix(line(text)) if strict_parity else line(prefix(text))
    text = F.regexp_replace(text, r'^\s*could not type expression "[^"]*",\s*message:\s*', "")
    text = F.regexp_replace(text, r"variable\s+`\w+`\s+has not been declared", UNDECLARED)
    text = F.regexp_replace(text, r"\b(rule|invariant|definition|hook|ghost)\s+`\w+`", "$1")
    text = F.regexp_replace(text, r"`[^`]*`", "…")
    text = F.regexp_replace(text, r"^error:\s*", "")
    return F.regexp_replace(F.regexp_replace(text, r"\s+", " "), r"^[ .;:-]+|[ .;:-]+$", "")


def distinct_keys(errors, strict_parity: bool = False) -> Column:
    """The keys of a row's errors, empty ones dropped, the first of each kept in order."""
    keys = F.transform(F.filter(col(errors), lambda e: e.isNotNull()), lambda e: error_key(e, strict_parity))
    return F.array_distinct(F.filter(F.coalesce(keys, F.array().cast("array<string>")), lambda k: k != ""))


def ensure_history(spark: SparkSession, path: str) -> None:
    """The history table at a path, created empty if it is not there."""
    spark.createDataFrame([], SCHEMA).write.mode("ignore").parquet(path)


def append_history(rows: DataFrame, path: str, strict_parity: bool = False) -> None:
    """Appends attempts with their errors as keys; a missing time is now."""
    rows.select(
        "contract_hash", "run_id", F.col("attempt").cast("int").alias("attempt"), "spec_snapshot", distinct_keys("errors", strict_parity).alias("errors"),
        F.coalesce("created_at", F.current_timestamp()).alias("created_at"),
    ).write.mode("append").parquet(path)


def delivered_once(history: DataFrame) -> DataFrame:
    """One row per history_id, the last delivered."""
    last = Window.partitionBy("history_id").orderBy(F.col("ingested_at").desc_nulls_last())
    return history.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")


def known_errors(history: DataFrame, latest: int = LATEST) -> DataFrame:
    """(contract_hash, ord, error): every distinct error of a contract's latest rows, newest first.

    ``history`` has contract_hash, run_id, attempt, errors (keys) and created_at. Ties in time go by run and attempt. The limit of rows
    is pushed below the shuffle, so a contract with a large share of all rows costs no more than another.
    """
    newest = Window.partitionBy("contract_hash").orderBy(F.col("created_at").desc_nulls_last(), F.col("run_id").desc_nulls_last(), F.col("attempt").desc_nulls_last())
    kept = history.select("contract_hash", "run_id", "attempt", "errors", "created_at").withColumn("rank", F.row_number().over(newest)).where(F.col("rank") <= latest)
    lists = kept.groupBy("contract_hash").agg(F.array_sort(F.collect_list(F.struct("rank", "errors"))).alias("rows"))
    errors = F.array_distinct(F.flatten(F.transform("rows", lambda r: F.coalesce(r["errors"], F.array().cast("array<string>")))))
    return lists.select("contract_hash", F.posexplode(errors).alias("ord", "error"))


def changes(history: DataFrame) -> DataFrame:
    """Each attempt with whether its specification is the one of the attempt before (unchanged)."""
    order = Window.partitionBy("contract_hash", "run_id").orderBy("attempt", "history_id")
    digest = F.sha2("spec_snapshot", 256)
    return history.withColumn("digest", digest).withColumn("unchanged", F.coalesce(F.col("digest") == F.lag("digest").over(order), F.lit(False)))


def recurring(history: DataFrame) -> DataFrame:
    """(contract_hash, run_id, attempt, error, recurring): each error key of an attempt, and whether an earlier attempt of the run had it."""
    rows = history.select("contract_hash", "run_id", "attempt", F.explode("errors").alias("error")).groupBy("contract_hash", "run_id", "attempt", "error").agg(F.count("*").alias("n")).drop("n")
    first = Window.partitionBy("contract_hash", "run_id", "error")
    return rows.withColumn("recurring", F.col("attempt") > F.min("attempt").over(first))
