"""Table scans: one parquet file or folder per table under a directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """The parquet table ``name`` of ``directory``."""
    return spark.read.parquet(f"{directory}/{name}.parquet")


#: Bytes of files up to which a table is spread.
SMALL = 16 << 20


def spread_small(df: DataFrame) -> DataFrame:
    """A table of at most ``SMALL`` bytes of files dealt to all cores, any other as it is laid out.

    A file of one row group cannot be split, so all work on a small table would be one task. What is shuffled is bounded by
    ``SMALL`` whatever the cluster's size; the rows are the same either way.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if size <= SMALL else df


def contract_files(records: DataFrame) -> DataFrame:
    """One row per element of ``records.contracts``: record_id, file_id, relative_path, clean_source.

    Rows delivered twice come out twice; operators deduplicate on ``file_id`` after they have
    reduced each text, so that no text is shuffled for it. Null or empty arrays give no row.
    """
    element = F.explode("contracts").alias("element")
    return records.select(F.col("id").alias("record_id"), element).select(
        "record_id",
        F.col("element.file_id").alias("file_id"),
        F.col("element.relative_path").alias("relative_path"),
        F.col("element.clean_source").alias("clean_source"),
    )


def spec_texts(records: DataFrame) -> DataFrame:
    """One row per element of ``records.specs``: record_id, spec_id, relative_path, text."""
    element = F.explode("specs").alias("element")
    return records.select(F.col("id").alias("record_id"), element).select(
        "record_id",
        F.col("element.spec_id").alias("spec_id"),
        F.col("element.relative_path").alias("relative_path"),
        F.col("element.text").alias("text"),
    )
