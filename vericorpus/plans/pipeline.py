"""The whole way as plans over tables: what is prepared for drafting, assembled from drafts, fed back, and evaluated."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vericorpus.functions import responses, solidity
from vericorpus.operators import closure, evaluation, history, lint, logs, merge, rewrite


def prepared(files: DataFrame, entries: DataFrame, mapping: DataFrame | None = None, known: DataFrame | None = None) -> DataFrame:
    """One row per project: what drafting starts from.

    ``files`` (project_id, path, text), ``entries`` (project_id, path) and, where there are some, remappings and known errors
    (contract_hash, ord, error). Returns project_id, entry, sources, source_text, missing, contract_name, profile, contract_hash,
    methods, draft_names and known_errors.
    """
    edges = closure.import_edges(files, mapping)
    reached = closure.import_closure(edges, entries)
    texts = closure.project_text(reached, files)
    own = files.select("project_id", closure.normal_path("path").alias("entry"), F.col("text").alias("entry_text")).dropDuplicates(["project_id", "entry"])
    stem = F.regexp_replace(F.regexp_replace("entry", "^.*/", ""), r"\.[^.]*$", "")
    rows = (
        texts.join(own, ["project_id", "entry"], "left")
        .join(closure.missing_imports(edges, reached), ["project_id", "entry"], "left")
        .withColumn("contract_name", solidity.contract_name("entry_text", stem))
        .withColumn("profile", solidity.profile("source_text", "contract_name"))
        .withColumn("contract_hash", solidity.content_hash("source_text"))
        .withColumn("methods", solidity.methods_block("source_text"))
        .withColumn("draft_names", solidity.draftable_names("source_text"))
        .drop("entry_text")
    )
    if known is None:
        return rows.withColumn("known_errors", F.array().cast("array<string>"))
    lists = known.groupBy("contract_hash").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "error"))), lambda e: e["error"]).alias("known_errors"))
    return rows.join(lists, "contract_hash", "left").withColumn("known_errors", F.coalesce("known_errors", F.array().cast("array<string>")))


def prompts(projects: DataFrame, hits: str | None = None) -> DataFrame:
    """(project_id, ord, function_name, prompt): a prompt per function, then the one across functions.

    ``projects`` as ``prepared`` gives it; ``hits`` names a column with retrieved hits. A project without functions gets only the last.
    """
    found = F.col(hits) if hits else F.array().cast("array<struct<contract_name:string,spec_filename:string,score:double,document:string>>")
    names = F.concat(F.col("draft_names"), F.array(F.lit(merge.CROSS_CUTTING)))
    rows = projects.select("project_id", "methods", "known_errors", "draft_names", found.alias("hits"), F.posexplode(names).alias("ord", "function_name"))
    across = F.concat(
        F.lit("FUNCTIONS: "), F.array_join("draft_names", ", "), F.lit("\n\nMETHODS:\n"), F.col("methods"), F.lit("\n\nREFERENCES:\n"), responses.reference_block("hits"),
        F.when(F.size("known_errors") > 0, F.concat(F.lit("\n\nKNOWN ERRORS:\n"), responses.known_error_block("known_errors", 10))).otherwise(F.lit("")),
    )
    prompt = F.when(F.col("function_name") == merge.CROSS_CUTTING, across).otherwise(responses.function_prompt("function_name", "methods", "hits", "known_errors"))
    return rows.select("project_id", "ord", "function_name", prompt.alias("prompt"))


def assembled(drafts: DataFrame, projects: DataFrame) -> DataFrame:
    """(project_id, spec, findings): drafts (project_id, ord, function_name, text) merged, rewritten and checked.

    ``projects`` has project_id, methods and source_text.
    """
    fragments = drafts.select("project_id", "ord", responses.spec_of_response("text").alias("text"))
    specs = merge.merged(fragments, projects.select("project_id", "methods")).join(projects.select("project_id", "methods", F.col("source_text").alias("contract")), "project_id")
    return lint.findings(rewrite.cleaned(specs)).select("project_id", "spec", "findings")


def feedback(runs: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """(run_id, attempt, ord, sub, text, recurring): enriched lines of runs (run_id, attempt, output, spec).

    ``seen`` (run_id, error) are canonical keys of earlier attempts; a line whose key is among them is recurring.
    """
    lines = logs.enriched(runs.select("run_id", "attempt", "output", "spec")).withColumn("error", history.error_key("text"))
    if seen is None:
        return lines.withColumn("recurring", F.lit(False)).drop("error")
    marks = seen.select("run_id", "error").distinct().withColumn("recurring", F.lit(True))
    return lines.join(marks, ["run_id", "error"], "left").withColumn("recurring", F.coalesce("recurring", F.lit(False))).drop("error")


def open_runs(results: DataFrame, most_attempts: int = 3) -> DataFrame:
    """(run_id, attempt, status): runs that have another attempt ahead: not passed, no fault of the environment, attempts left."""
    last = evaluation.delivered_once(results).groupBy("run_id").agg(F.max_by(F.struct("attempt", "status", "output"), "attempt").alias("r")).select("run_id", "r.*")
    return last.where(F.lower(F.coalesce("status", F.lit(""))) != "passed").where(~evaluation.environment_error("output")).where(F.col("attempt") + 1 < most_attempts).select("run_id", "attempt", F.lower("status").alias("status"))


def report(pairs: DataFrame, retrieved: DataFrame, results: DataFrame | None = None, top_k: int = 3) -> DataFrame:
    """One row: top_k, hits, total and hit_rate, and with results passed and pass_rate."""
    hits = evaluation.hit_rate(evaluation.hit_cases(pairs, retrieved.where(F.col("rank") <= top_k))).select(F.lit(top_k).alias("top_k"), "*")
    if results is None:
        return hits
    runs = evaluation.pass_rate(results).select("passed", F.col("total").alias("runs"), "pass_rate")
    return hits.crossJoin(F.broadcast(runs))  # one row each
