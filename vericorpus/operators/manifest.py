"""Checksums: manifests of files and their comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def entries(files: DataFrame, content: str = "content") -> DataFrame:
    """(path, checksum, size) of files (path, content), files whose name begins with a dot left out."""
    return files.where(~F.regexp_extract("path", r"([^/]*)$", 1).startswith(".")).select(
        "path", F.sha2(F.col(content).cast("binary"), 256).alias("checksum"), F.octet_length(content).cast("bigint").alias("size")
    )


def totals(manifest: DataFrame) -> DataFrame:
    return manifest.agg(F.count("*").alias("file_count"), F.coalesce(F.sum("size"), F.lit(0)).alias("total_size"))


def manifest(files: DataFrame, version: str, content: str = "content") -> DataFrame:
    """One row: version, files (sorted by path), total_size and file_count. For releases, whose files are few."""
    rows = entries(files, content)
    return rows.agg(
        F.lit(version).alias("version"), F.array_sort(F.collect_list(F.struct("path", "checksum", "size"))).alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("total_size"), F.count("*").alias("file_count")
    )


def compared(expected: DataFrame, files: DataFrame, content: str = "content") -> DataFrame:
    """(path, status): ok, mismatch, missing or extra of each path; a mismatch is reported, not dropped."""
    found = entries(files, content).select("path", F.col("checksum").alias("actual"))
    both = expected.select("path", "checksum").join(found, "path", "full")
    return both.select(
        "path",
        F.when(F.col("actual").isNull(), "missing").when(F.col("checksum").isNull(), "extra").when(F.lower("checksum") == F.col("actual"), "ok").otherwise("mismatch").alias("status"),
    )
