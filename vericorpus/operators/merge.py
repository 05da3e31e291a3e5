"""Merging draft fragments: named blocks and declarations, the first of a name wins."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vericorpus.functions.text import col, pieces, strip

_NAMED = r"\b(?:rule|invariant)\s+\w+"
CROSS_CUTTING = "__cross_cutting__"


def named_blocks(text) -> Column:
    """(name, block) of every rule and invariant of a text without its methods blocks; what stands before them is dropped."""
    bare = strip(F.regexp_replace(col(text), r"(?s)methods\s*\{[^}]*\}", ""))
    blocks = F.filter(F.transform(pieces(bare, _NAMED), strip), lambda p: p.rlike(r"(?s)^(rule|invariant)\s+\w+"))
    return F.transform(blocks, lambda p: F.struct(F.regexp_extract(p, r"^(?:rule|invariant)\s+(\w+)", 1).alias("name"), p.alias("block")))


_OPENERS = re.compile(r"\b(ghost|hook|definition|using|import|init_state)\b", re.ASCII)
_COMMENTS = re.compile(r"/\*.*?\*/|//[^\n]*", re.S)
_RULES = re.compile(r"\b(?:rule|invariant)\s+\w+", re.ASCII)


def top_declarations(text: str | None) -> list[str]:
    """Declarations before the first rule or invariant: a keyword with a statement or a braced block; prose is none.

    A keyword that neither ; nor { follows on its line is prose. The first declaration of a key wins.
    """
    if not text:
        return []
    first = _RULES.search(text)
    body = _COMMENTS.sub("", text[: first.start()] if first else text)
    out: dict[str, str] = {}
    for m in _OPENERS.finditer(body):
        depth, opened, end = 0, False, len(body)
        for k in range(m.end(), len(body)):
            c = body[k]
            depth += (c == "{") - (c == "}")
            opened |= c == "{"
            if c == "}" and depth == 0 or c == ";" and depth == 0:
                end = k + 1
                break
            if c == "\n" and depth == 0 and not opened:
                end = k
                break
        declaration = body[m.start() : end].strip()
        key = re.split(r"[{;]", declaration)[0].strip()
        if key and (declaration.endswith(";") or "{" in declaration):
            out.setdefault(key, declaration)
    return list(out.values())


def _declaration_rows(batches):
    for batch in batches:
        lists = pa.array([top_declarations(t) for t in batch.column(batch.num_columns - 1).to_pylist()], pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists], names=[*batch.schema.names[:-1], "declarations"])


def fragment_rules(fragments: DataFrame) -> DataFrame:
    """The rules that stay when the fragments of a project are merged: project_id, place, name, block.

    ``fragments`` has project_id, ord int and text; those of functions come in their order, the cross-cutting one has the largest ord.
    """
    rows = fragments.select("project_id", "ord", F.posexplode(named_blocks("text")).alias("pos", "b")).select("project_id", "ord", "pos", "b.*")
    first = Window.partitionBy("project_id", "name").orderBy("ord", "pos")
    kept = rows.withColumn("n", F.row_number().over(first)).where("n = 1").drop("n")
    return kept.select("project_id", F.struct("ord", "pos").alias("place"), "name", "block")


def fragment_declarations(fragments: DataFrame) -> DataFrame:
    """The top-level declarations of merged fragments: project_id, place, key, declaration."""
    found = fragments.select("project_id", F.col("ord").cast("int").alias("ord"), "text").mapInArrow(_declaration_rows, "project_id string, ord int, declarations array<string>")
    rows = found.select("project_id", "ord", F.posexplode("declarations").alias("pos", "declaration"))
    rows = rows.withColumn("key", strip(F.regexp_extract("declaration", r"(?s)^([^{]*)", 1))).where("key <> ''")
    first = Window.partitionBy("project_id", "key").orderBy("ord", "pos")
    kept = rows.withColumn("n", F.row_number().over(first)).where("n = 1")
    return kept.select("project_id", F.struct("ord", "pos").alias("place"), "key", "declaration")


def merged(fragments: DataFrame, projects: DataFrame) -> DataFrame:
    """One specification a project: methods block, declarations, rules, parted by blank lines.

    ``projects`` has project_id and methods. A project's parts are bounded by its own drafts, so they are collected per project.
    """
    rules = fragment_rules(fragments).select("project_id", F.lit(1).alias("part"), "place", F.col("block").alias("text"))
    declared = fragment_declarations(fragments).select("project_id", F.lit(0).alias("part"), "place", F.col("declaration").alias("text"))
    parts = rules.unionByName(declared).groupBy("project_id").agg(F.array_sort(F.collect_list(F.struct("part", "place", "text"))).alias("parts"))
    text = F.array_join(F.transform(F.coalesce("parts", F.array().cast("array<struct<part:int,place:struct<ord:int,pos:int>,text:string>>")), lambda p: p["text"]), "\n\n")
    return projects.join(parts, "project_id", "left").select("project_id", F.concat("methods", F.lit("\n\n"), text).alias("spec"))
