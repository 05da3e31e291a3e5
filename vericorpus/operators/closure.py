"""Import graphs: resolution of import paths and the closure from an entry file."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vericorpus.functions import solidity
from vericorpus.functions.text import normal_path, parent, strip
from vericorpus.session import staged


def remappings(text: DataFrame) -> DataFrame:
    """(project_id, ord, prefix, target) of remapping files (project_id, text).

    A comment ends a line, a line without = says nothing, a prefix that comes again keeps its place and takes the last target.
    """
    rows = text.select("project_id", F.posexplode(F.split("text", "\\R")).alias("ord", "line"))
    rows = rows.select("project_id", "ord", strip(F.regexp_replace("line", "#.*", "")).alias("line")).where(F.contains("line", F.lit("=")))
    parts = F.split("line", "=", 2)
    rows = rows.select("project_id", "ord", strip(parts[0]).alias("prefix"), strip(parts[1]).alias("target")).where("prefix <> ''")
    return rows.groupBy("project_id", "prefix").agg(F.min("ord").alias("ord"), F.max_by("target", "ord").alias("target")).select("project_id", "ord", "prefix", "target")


def import_edges(files: DataFrame, mapping: DataFrame | None = None) -> DataFrame:
    """(project_id, src, ord, import_path, dst): each import with the file it means, dst null where there is none.

    ``files`` has project_id, path and text; a path that begins with . is relative to its file, others go through the first
    mapping in file order whose prefix they begin with. Paths are compared in normal form.
    """
    own = files.select("project_id", normal_path("path").alias("src"), F.posexplode(solidity.imports("text")).alias("ord", "import_path")).distinct()
    relative = own.where(F.col("import_path").startswith(".")).withColumn("candidate", normal_path(F.concat(parent("src"), F.lit("/"), F.col("import_path"))))
    other = own.where(~F.col("import_path").startswith("."))
    if mapping is None:
        other = other.withColumn("candidate", F.lit(None).cast("string"))
    else:
        # the mappings of a project are a short list: they travel with its imports
        lists = mapping.groupBy("project_id").agg(F.array_sort(F.collect_list(F.struct("ord", "prefix", "target"))).alias("maps"))
        hit = F.try_element_at(F.filter("maps", lambda m: F.col("import_path").startswith(m["prefix"])), F.lit(1))
        other = other.join(lists, "project_id", "left").withColumn("hit", hit)
        rest = F.substring(F.col("import_path"), F.length("hit.prefix") + 1, F.length("import_path"))
        other = other.withColumn("candidate", normal_path(F.concat(F.col("hit.target"), F.lit("/"), rest))).drop("maps", "hit")
    known = files.select("project_id", normal_path("path").alias("candidate")).distinct().withColumn("dst", F.col("candidate"))
    return relative.unionByName(other).join(known, ["project_id", "candidate"], "left").select("project_id", "src", "ord", "import_path", "dst")


def import_closure(edges: DataFrame, entries: DataFrame, most_rounds: int = 64, max_depth: int | None = None) -> DataFrame:
    """(project_id, entry, path, depth): every file reached from each entry, with the least number of steps.

    ``max_depth`` ends the search early; without it a graph deeper than ``most_rounds`` is an error.

    A frontier join per round against what was reached before; cycles end by the anti-join. Each round is written to the shared
    folder, so lineage stays short and a lost executor costs no earlier round.
    """
    steps = staged(edges.where("dst is not null").select("project_id", F.col("src").alias("path"), F.col("dst").alias("next")).distinct(), "edges")
    frontier = staged(entries.select("project_id", F.col("path").alias("entry"), "path", F.lit(0).alias("depth")).distinct(), "reached")
    reached = frontier
    for depth in range(1, (max_depth or most_rounds) + 1):
        ahead = frontier.join(steps, ["project_id", "path"]).select("project_id", "entry", F.col("next").alias("path"), F.lit(depth).alias("depth")).distinct()
        frontier = staged(ahead.join(reached.select("project_id", "entry", "path"), ["project_id", "entry", "path"], "left_anti"), "reached")
        if frontier.isEmpty():
            return reached
        reached = reached.unionByName(frontier)
    if max_depth:
        return reached
    raise ValueError(f"more than {most_rounds} steps from an entry")


def missing_imports(edges: DataFrame, reached: DataFrame) -> DataFrame:
    """(project_id, entry, missing): the sorted distinct imports of reached files that mean no file."""
    lost = edges.where("dst is null").select("project_id", F.col("src").alias("path"), "import_path")
    found = reached.select("project_id", "entry", "path").join(lost, ["project_id", "path"]).groupBy("project_id", "entry").agg(F.array_sort(F.collect_set("import_path")).alias("missing"))
    return found


def project_text(reached: DataFrame, files: DataFrame) -> DataFrame:
    """(project_id, entry, sources, source_text): the reached files in one text, each under its path.

    The order is by distance from the entry and then by path: stable, where a stack's order would depend on the traversal.
    """
    texts = files.select("project_id", normal_path("path").alias("path"), "text").dropDuplicates(["project_id", "path"])
    parts = reached.join(texts, ["project_id", "path"]).groupBy("project_id", "entry").agg(F.array_sort(F.collect_list(F.struct("depth", "path", "text"))).alias("parts"))
    return parts.select(
        "project_id", "entry", F.transform("parts", lambda p: p["path"]).alias("sources"),
        F.array_join(F.transform("parts", lambda p: F.concat(F.lit("// SOURCE: "), p["path"], F.lit("\n"), p["text"])), "\n\n").alias("source_text"),
    )


def entry_files(records: DataFrame) -> DataFrame:
    """(project_id, path) of each record's entry contract, the last of its files."""
    last = F.try_element_at("contracts", F.lit(-1))["relative_path"]
    return records.select(F.col("id").alias("project_id"), normal_path(last).alias("path")).where("path is not null and project_id is not null").distinct()


def first_wins(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first in order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
