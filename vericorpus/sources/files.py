"""File sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD = "array<struct<id:string,label:string,contract_name:string,contracts:array<struct<clean_source:string,relative_path:string>>,specs:array<struct<relative_path:string>>>>"


def source_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of whole files; bytes that are not UTF-8 become U+FFFD."""
    return spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def binary_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of files as bytes."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")


def dataset(spark: SparkSession, path: str, schema: str = RECORD) -> DataFrame:
    """The records of a JSON array in one file, with their place in it (pos)."""
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", schema).alias("records"))
    return whole.select(F.posexplode("records").alias("pos", "record")).select("pos", "record.*")


def index(spark: SparkSession, path: str) -> DataFrame:
    """An existing vector index; raises where there is none."""
    return spark.read.schema("vec_id bigint, embedding array<float>, label int").parquet(path)


def write_specs(specs: DataFrame, path: str) -> None:
    """Specifications, a folder per attempt."""
    specs.write.mode("append").partitionBy("attempt").parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """A report as JSON, one object a row."""
    report.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)
