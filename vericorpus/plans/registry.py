"""The registered queries over the core operators, each with SQL that gives the same rows.

Every query runs over its whole tables. The SQL states the result in its own way where it can (other engines'
patterns have no look-around, so texts are marked and cut instead).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vericorpus.functions import responses, solidity
from vericorpus.functions.text import normal_path
from vericorpus.operators import closure, evaluation, history, lint, logs, manifest, merge, rewrite, search
from vericorpus.sources import files
from vericorpus.sources.tables import contract_files, spec_texts, spread_small, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


# --- pieces of SQL ------------------------------------------------------------------------------

_STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
_SCORE = "round(1 - power(list_distance(v.embedding::DOUBLE[], q.embedding::DOUBLE[]), 2) / 2, 9)"
_HITS = f"""
    SELECT q.vec_id AS query_id, v.vec_id, v.label, {_SCORE} AS score,
           row_number() OVER (PARTITION BY q.vec_id ORDER BY {_SCORE} DESC, v.vec_id) AS rank
    FROM embeddings v, embeddings q WHERE {{0}}
"""
_FILES = """
    SELECT DISTINCT c.file_id, c.relative_path, c.clean_source AS text
    FROM (SELECT unnest(contracts) AS c FROM records) WHERE c.clean_source IS NOT NULL
"""
_SPECS = """
    SELECT DISTINCT s.spec_id, s.text AS spec, coalesce(contract, '') AS contract
    FROM (SELECT unnest(specs) AS s, contracts[-1].clean_source AS contract FROM records) WHERE s.text IS NOT NULL
"""
_HISTORY = "SELECT * FROM error_history QUALIFY row_number() OVER (PARTITION BY history_id ORDER BY ingested_at DESC NULLS LAST) = 1"
_RUNS = "SELECT * FROM validation_results QUALIFY row_number() OVER (PARTITION BY run_id, attempt ORDER BY finished_at DESC NULLS LAST, output DESC NULLS LAST) = 1"


def _key(x: str) -> str:
    """SQL of an error's canonical key."""
    out = f"lower({_STRIP.format(x)})"
    for pattern, text in (
        (r"^line \d+\s+`[^`]*`\s*->\s*(?:error:\s*)?", ""),
        (r"\bline \d+\b", ""),
        (r'^\s*could not type expression "[^"]*",\s*message:\s*', ""),
        (r"variable\s+`\w+`\s+has not been declared", history.UNDECLARED),
        (r"\b(rule|invariant|definition|hook|ghost)\s+`\w+`", r"\1"),
        (r"`[^`]*`", "…"),
        (r"^error:\s*", ""),
        (r"\s+", " "),
        (r"^[ .;:-]+|[ .;:-]+$", ""),
    ):
        out = f"regexp_replace({out}, '{pattern}', '{text}', 'g')"
    return out


# --- vector search ------------------------------------------------------------------------------


def _stated(vectors: DataFrame) -> DataFrame:
    return vectors.where("vec_id % 50 = 0")


def _top_of_first(spark: SparkSession, d: str, k: int, floor: float) -> DataFrame:
    vectors = table(spark, d, "embeddings")
    hits = search.above_floor(search.nearest(vectors, vectors.where("vec_id = 0"), k), floor)
    return hits.join(vectors.select("vec_id", "label"), "vec_id").select("vec_id", "label", "rank", F.round("score", 6).alias("score"))


@query(f"SELECT vec_id, label, rank, round(score, 6) AS score FROM ({_HITS.format('q.vec_id = 0')}) WHERE rank <= 3 AND score >= 0.75")
def k_topk_floor075(spark: SparkSession, d: str) -> DataFrame:
    return _top_of_first(spark, d, 3, 0.75)


@query(f"SELECT vec_id, label, rank, round(score, 6) AS score FROM ({_HITS.format('q.vec_id = 0')}) WHERE rank <= 10 AND score >= 0.3")
def k_topk_floor030(spark: SparkSession, d: str) -> DataFrame:
    return _top_of_first(spark, d, 10, 0.3)


@query(f"SELECT query_id, rank, vec_id, round(score, 6) AS score FROM ({_HITS.format('q.vec_id % 50 = 0')}) WHERE rank <= 3")
def k_batch_topk(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "embeddings")
    return search.nearest(vectors, _stated(vectors)).withColumn("score", F.round("score", 6))


@query(f"SELECT query_id, count(*) FILTER (score < 0.3) AS dropped, count(*) AS hits FROM ({_HITS.format('q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id')}) WHERE rank <= 3 GROUP BY 1")
def a_floor_dropped(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "embeddings")
    return search.dropped_below(search.nearest(vectors, _stated(vectors), skip_self=True), 0.3)


@query(
    f"""SELECT count(*) FILTER (hit) AS hits, count(*) AS total, coalesce(count(*) FILTER (hit) / nullif(count(*), 0), 0.0) AS hit_rate
        FROM (SELECT query_id, bool_or(vec_id = query_id AND score >= 0.75) AS hit FROM ({_HITS.format('q.vec_id % 50 = 0')}) WHERE rank <= 3 GROUP BY 1)"""
)
def a_self_retrieval(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "embeddings")
    hits = search.nearest(vectors, _stated(vectors))
    return evaluation.hit_rate(hits.groupBy("query_id").agg(F.max((F.col("vec_id") == F.col("query_id")) & (F.col("score") >= search.FLOOR)).alias("hit")))


_CASES = """
    SELECT p.id AS pair_id, coalesce(bool_or(r.pair_id = p.id), false) AS hit, count(r.rank) AS retrieved
    FROM (SELECT DISTINCT id FROM records WHERE id IS NOT NULL) p LEFT JOIN (SELECT DISTINCT query_id, rank, pair_id FROM retrieval_results) r ON r.query_id = p.id GROUP BY 1
"""


@query(_CASES)
def a_hit_cases(spark: SparkSession, d: str) -> DataFrame:
    cases = evaluation.hit_cases(table(spark, d, "records"), table(spark, d, "retrieval_results"))
    return cases.select("pair_id", "hit", F.size("retrieved_pair_ids").cast("bigint").alias("retrieved"))


@query(f"SELECT count(*) FILTER (hit) AS hits, count(*) AS total, coalesce(count(*) FILTER (hit) / nullif(count(*), 0), 0.0) AS hit_rate FROM ({_CASES})")
def a_hit_rate(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.hit_rate(evaluation.hit_cases(table(spark, d, "records"), table(spark, d, "retrieval_results")))


# --- error history ------------------------------------------------------------------------------


def _history(spark: SparkSession, d: str) -> DataFrame:
    return history.delivered_once(table(spark, d, "error_history"))


_KEYED = f"""
    SELECT contract_hash, run_id, attempt, created_at, e.ord, {_key('e.error')} AS error
    FROM ({_HISTORY}) h, LATERAL (SELECT unnest(h.errors) AS error, generate_subscripts(h.errors, 1) AS ord) e WHERE e.error IS NOT NULL
"""


@query(
    f"""WITH newest AS (SELECT *, row_number() OVER (PARTITION BY contract_hash ORDER BY created_at DESC NULLS LAST, run_id DESC NULLS LAST, attempt DESC NULLS LAST) AS rank FROM ({_HISTORY})),
             errors AS (SELECT contract_hash, rank, e.ord, {_key('e.error')} AS error
                        FROM newest n, LATERAL (SELECT unnest(n.errors) AS error, generate_subscripts(n.errors, 1) AS ord) e WHERE rank <= 50 AND e.error IS NOT NULL),
             firsts AS (SELECT contract_hash, error, rank, ord FROM errors WHERE error <> '' QUALIFY row_number() OVER (PARTITION BY contract_hash, error ORDER BY rank, ord) = 1)
        SELECT contract_hash, row_number() OVER (PARTITION BY contract_hash ORDER BY rank, ord) - 1 AS ord, error FROM firsts"""
)
def h_known_errors(spark: SparkSession, d: str) -> DataFrame:
    rows = _history(spark, d).withColumn("errors", history.distinct_keys("errors"))
    return history.known_errors(rows).withColumn("ord", F.col("ord").cast("bigint"))


@query(f"SELECT error, count(*) AS n, count(DISTINCT contract_hash) AS contracts FROM ({_KEYED}) WHERE error <> '' GROUP BY 1")
def n_error_keys(spark: SparkSession, d: str) -> DataFrame:
    keys = F.filter(F.transform(F.filter("errors", lambda e: e.isNotNull()), lambda e: history.error_key(e)), lambda k: k != "")
    rows = _history(spark, d).select("contract_hash", F.explode(keys).alias("error"))
    return rows.groupBy("error").agg(F.count("*").alias("n"), F.countDistinct("contract_hash").alias("contracts"))


@query(
    f"""SELECT history_id, coalesce(digest = lag(digest) OVER (PARTITION BY contract_hash, run_id ORDER BY attempt, history_id), false) AS unchanged
        FROM (SELECT *, sha256(spec_snapshot) AS digest FROM ({_HISTORY}))"""
)
def v_change(spark: SparkSession, d: str) -> DataFrame:
    return history.changes(_history(spark, d)).select("history_id", "unchanged")


@query(
    f"""SELECT contract_hash, run_id, attempt, error, attempt > min(attempt) OVER (PARTITION BY contract_hash, run_id, error) AS recurring
        FROM (SELECT DISTINCT contract_hash, run_id, attempt, error FROM ({_KEYED}) WHERE error <> '')"""
)
def v_recurring(spark: SparkSession, d: str) -> DataFrame:
    return history.recurring(_history(spark, d).withColumn("errors", history.distinct_keys("errors")))


# --- verifier runs ------------------------------------------------------------------------------


def _runs(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.delivered_once(table(spark, d, "validation_results"))


@query(f"SELECT count(*) FILTER (lower(status) = 'passed') AS passed, count(*) AS total, count(*) FILTER (lower(status) = 'passed') / count(*) AS pass_rate FROM ({_RUNS})")
def v_pass_rate(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.pass_rate(_runs(spark, d))


@query(
    f"""SELECT CASE WHEN lower(status) IN ('passed', 'skipped') THEN 0 WHEN lower(status) = 'unverified' THEN 2 ELSE 1 END AS exit_code,
               coalesce(regexp_matches(lower(output), '{"|".join(evaluation.ENVIRONMENT)}'), false) AS environment, count(*) AS n FROM ({_RUNS}) GROUP BY ALL"""
)
def v_exit_codes(spark: SparkSession, d: str) -> DataFrame:
    rows = _runs(spark, d).select(evaluation.exit_code("status").alias("exit_code"), evaluation.environment_error("output").alias("environment"))
    return rows.groupBy("exit_code", "environment").agg(F.count("*").alias("n"))


@query(f"SELECT run_id, max(attempt) AS attempt, lower(arg_max(status, attempt)) AS status FROM ({_RUNS}) GROUP BY 1")
def v_last_status(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.last_status(_runs(spark, d))


@query("SELECT doc_id, md5(right(text, 2000)) AS tail FROM documents")
def x_report_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.md5(evaluation.report_text("text")).alias("tail"))


def _logs(spark: SparkSession, d: str) -> DataFrame:
    """Runs with the verifier's located form of their messages, beside the specification they ran on."""
    output = F.regexp_replace("output", r"(?m)^Error: line (\d+):", "Error in spec file (run.spec:$1):")
    runs = _runs(spark, d).select("run_id", "attempt", output.alias("output"))
    specs = closure.first_wins(_history(spark, d), ["run_id", "attempt"], ["history_id"]).select("run_id", "attempt", F.col("spec_snapshot").alias("spec"))
    return runs.join(specs, ["run_id", "attempt"], "left")


_SUGGESTED = "CASE " + " ".join(f"WHEN contains(message, '{part}') THEN '  Suggestion: {text}'" for part, text in logs.SUGGESTIONS) + " END"


@query(
    rf"""WITH runs AS (SELECT run_id, attempt, regexp_replace(output, '(?m)^Error: line (\d+):', 'Error in spec file (run.spec:\1):', 'g') AS output FROM ({_RUNS}) WHERE output IS NOT NULL),
              specs AS (SELECT run_id, attempt, spec_snapshot FROM ({_HISTORY}) QUALIFY row_number() OVER (PARTITION BY run_id, attempt ORDER BY history_id) = 1),
              raw AS (SELECT r.run_id, r.attempt, coalesce(string_split_regex(s.spec_snapshot, '\r\n|\n|\r'), []) AS code,
                             list_filter(string_split_regex(r.output, '\r\n|\n|\r'), lambda x: regexp_replace(x, '\s+', '', 'g') <> '') AS lines
                      FROM runs r LEFT JOIN specs s USING (run_id, attempt)),
              rows AS (SELECT run_id, attempt, code, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS ord FROM raw),
              parts AS (SELECT *, {_STRIP.format('line')} AS bare, try_cast(regexp_extract(line, 'Error in spec file \([^:]+:(\d+)(?::\d+)?\):\s*(.*)', 1) AS INT) AS n,
                               regexp_extract(line, 'Error in spec file \([^:]+:(\d+)(?::\d+)?\):\s*(.*)', 2) AS message FROM rows),
              kinds AS (SELECT *, CASE WHEN n IS NOT NULL THEN 'located' WHEN contains(bare, 'Syntax error:') OR contains(bare, 'TypeError:') OR contains(bare, 'Undefined') THEN 'passed'
                                       WHEN contains(bare, 'Variable `') AND contains(bare, 'has not been declared') THEN 'named' END AS kind FROM parts),
              marked AS (SELECT *, max(kind IS NOT NULL) OVER (PARTITION BY run_id, attempt) AS any_found FROM kinds)
         SELECT run_id, attempt, ord, sub, text FROM (
           SELECT run_id, attempt, ord, 0 AS sub, 'Line ' || n || ' `' || coalesce({_STRIP.format('code[n]')}, '') || '` -> Error: ' || message AS text FROM marked WHERE kind = 'located'
           UNION ALL SELECT run_id, attempt, ord, 1, {_SUGGESTED} FROM marked WHERE kind = 'located'
           UNION ALL SELECT run_id, attempt, ord, 0, bare FROM marked WHERE kind IN ('passed', 'named')
           UNION ALL SELECT run_id, attempt, ord, 0, line FROM marked WHERE NOT any_found AND NOT starts_with(line, 'WARNING') AND NOT starts_with(line, 'Compiling')
         ) WHERE text IS NOT NULL"""
)
def e_enrich(spark: SparkSession, d: str) -> DataFrame:
    return logs.enriched(_logs(spark, d))


# --- contracts ----------------------------------------------------------------------------------


def _files(spark: SparkSession, d: str) -> DataFrame:
    return contract_files(spread_small(table(spark, d, "records"))).where("clean_source is not null").select("file_id", "relative_path", F.col("clean_source").alias("text"))


def _named_sql(values: dict) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN {' OR '.join(f'''contains(lower(text), '{w}')''' for w in words)} THEN '{name}' END" for name, words in values.items()) + "], lambda x: x IS NOT NULL)"


_SIGNATURES = rf"""list_transform(list_zip(regexp_extract_all(text, '\bfunction\s+([A-Za-z_]\w*)\s*\(([^)]*)\)', 1), regexp_extract_all(text, '\bfunction\s+([A-Za-z_]\w*)\s*\(([^)]*)\)', 2)),
    lambda p: p[1] || '(' || {_STRIP.format("regexp_replace(p[2], '\\s+', ' ', 'g')")} || ')')"""


@query(
    f"""SELECT file_id, array_to_string(features, ',') AS features, len(signatures) AS n_signatures,
               md5('SOLIDITY CONTRACT: ' || coalesce(relative_path, 'TargetContract') || chr(10) || 'FEATURES: ' || CASE WHEN len(features) > 0 THEN array_to_string(features, ', ') ELSE 'none detected' END
                   || chr(10) || 'FUNCTIONS: ' || CASE WHEN len(signatures) > 0 THEN array_to_string(signatures[1:40], ', ') ELSE 'none detected' END) AS profile
        FROM (SELECT *, {_named_sql(solidity.FEATURES)} AS features, {_SIGNATURES} AS signatures FROM ({_FILES}))"""
)
def p_profile(spark: SparkSession, d: str) -> DataFrame:
    return _files(spark, d).select(
        "file_id", F.array_join(solidity.features("text"), ",").alias("features"), F.size(solidity.signatures("text")).cast("bigint").alias("n_signatures"), F.md5(solidity.profile("text", "relative_path")).alias("profile")
    ).distinct()


_STATE = rf"""list_distinct(list_filter(list_transform(list_filter(list_transform(string_split_regex(text, '\r\n|\n|\r'), lambda x: {_STRIP.format('x')}),
    lambda x: x <> '' AND NOT starts_with(x, '//') AND NOT regexp_matches(x, 'function |modifier |constructor|event |struct ') AND regexp_matches(x, 'uint|int|address|bool|bytes|string|mapping')),
    lambda x: regexp_extract(x, '([A-Za-z_][A-Za-z0-9_]*)\s*(?:=|;)', 1)), lambda n: n <> ''))"""


def _family_sql() -> str:
    return "CASE " + " ".join(f"WHEN {' OR '.join(f'''contains(lower(text), '{w}')''' for w in words)} THEN '{name}'" for name, words in solidity.FAMILIES.items()) + " ELSE 'generic' END"


@query(
    rf"""SELECT file_id, {_family_sql()} AS family, array_to_string({_named_sql(solidity.RISKS)}, ',') AS risks,
                array_to_string(regexp_extract_all(text, '\bfunction\s+([A-Za-z_][A-Za-z0-9_]*)\s*\(', 1), ',') AS functions,
                array_to_string(regexp_extract_all(text, '\bmodifier\s+([A-Za-z_][A-Za-z0-9_]*)\s*\(', 1), ',') AS modifiers,
                array_to_string(list_sort({_STATE}), ',') AS variables FROM ({_FILES})"""
)
def p_analysis(spark: SparkSession, d: str) -> DataFrame:
    return _files(spark, d).select(
        "file_id", solidity.family("text").alias("family"), F.array_join(solidity.risk_signals("text"), ",").alias("risks"), F.array_join(solidity.function_names("text"), ",").alias("functions"),
        F.array_join(solidity.modifier_names("text"), ",").alias("modifiers"), F.array_join(F.array_sort(solidity.state_variables("text")), ",").alias("variables"),
    ).distinct()


def _all(pattern: str, group: int) -> str:
    return f"regexp_extract_all(text, '{pattern}', {group})"


def _zip(pattern: str, groups: int) -> str:
    """Structs f1, f2, ... of the groups of all matches."""
    lists = ", ".join(_all(pattern, g) for g in range(1, groups + 1))
    fields = ", ".join(f"f{g}: p[{g}]" for g in range(1, groups + 1))
    return f"list_transform(list_zip({lists}), lambda p: {{{fields}}})"


_B = r"(uint\d*|int\d*|address|bool|bytes\d*|string)"
_TYPES = rf"""array_to_string(list_transform(list_filter(list_transform(string_split({{0}}, ','), lambda a: {_STRIP.format(r"regexp_replace(a, '\b(memory|storage|calldata)\b', '', 'g')")}), lambda a: a <> ''), lambda a: string_split_regex(a, '\s+')[1]), ',')"""


def _declarations_sql(strict: bool) -> str:
    getter = rf"\b{_B}\s+public\s+(?:constant\s+)?(\w+)" if strict else rf"\b{_B}\s+public\s+(?:(?:constant|immutable|override)\s+)*(\w+)"
    custom = r"\b([A-Za-z_][A-Za-z0-9_]*(?:\s*\[\s*\d*\s*\])*)\s+public\s+(?:constant\s+)?(\w+)\s*[=;]"
    mapping = r"mapping\s*\(([^()]*?)\s*=>\s*(?:mapping\s*\(([^()]*?)\s*=>\s*([^()]*?)\)|([^()]*?))\)\s+public\s+(\w+)"
    called = r"function\s+(\w+)\s*\(([^)]*)\)\s+(?:external|public)\b" + ("()" if strict else r"[^{;]*?(?:returns\s*\(([^)]*)\)|[{;])")
    s = _STRIP.format
    unnested = "SELECT file_id, {pass} AS pass, generate_subscripts(m, 1) AS pos, unnest(m) AS m FROM (SELECT file_id, {zip} AS m FROM files)"
    return rf"""
        WITH files AS ({_FILES}),
             entries AS (
               SELECT file_id, pass, pos, m.f2 AS name, '    function ' || m.f2 || '() external returns (' || m.f1 || ') envfree;' AS text FROM ({unnested.format(**{'pass': 1, 'zip': _zip(getter, 2)})})
               UNION ALL SELECT file_id, pass, pos, m.f2, '    function ' || m.f2 || '() external returns (' || {s('m.f1')} || ') envfree;' FROM ({unnested.format(**{'pass': 2, 'zip': _zip(custom, 2)})})
               UNION ALL SELECT file_id, pass, pos, m.f5, '    function ' || m.f5 || '(' || {s('m.f1')} || CASE WHEN m.f2 <> '' THEN ',' || {s('m.f2')} ELSE '' END || ') external returns ('
                         || {s("CASE WHEN m.f2 <> '' THEN m.f3 ELSE m.f4 END")} || ') envfree;' FROM ({unnested.format(**{'pass': 3, 'zip': _zip(mapping, 5)})})
               UNION ALL SELECT file_id, pass, pos, m.f1, '    function ' || m.f1 || '(' || {_TYPES.format('m.f2')} || ') external'
                         || CASE WHEN {s('m.f3')} <> '' THEN ' returns (' || string_split_regex({s('m.f3')}, '\s+')[1] || ')' ELSE '' END || ';' FROM ({unnested.format(**{'pass': 4, 'zip': _zip(called, 3)})})),
             kept AS (SELECT * FROM entries QUALIFY row_number() OVER (PARTITION BY file_id, name ORDER BY pass, pos) = 1)
        SELECT file_id, row_number() OVER (PARTITION BY file_id ORDER BY pass, pos) - 1 AS ord, name, text FROM kept"""


def _declared(spark: SparkSession, d: str, strict: bool) -> DataFrame:
    rows = _files(spark, d).select("file_id", F.posexplode(solidity.declarations("text", strict)).alias("ord", "e"))
    return rows.select("file_id", F.col("ord").cast("bigint").alias("ord"), "e.name", "e.text").distinct()


@query(_declarations_sql(False))
def p_methods_block(spark: SparkSession, d: str) -> DataFrame:
    return _declared(spark, d, False)


@query(_declarations_sql(True))
def p_methods_block_parity(spark: SparkSession, d: str) -> DataFrame:
    return _declared(spark, d, True)


_MAPPED = r"\bmapping\s*\([^()]*(?:\([^()]*(?:\([^()]*\)[^()]*)*\)[^()]*)*\)\s+public\s+(?:constant\s+)?(\w+)"


@query(
    rf"""SELECT file_id, name, kind FROM (
           SELECT file_id, unnest({_all(_MAPPED, 1)}) AS name, 'mapping' AS kind FROM ({_FILES})
           UNION SELECT file_id, name, 'variable' FROM (
             SELECT file_id, unnest(list_distinct({_all(rf'\b{_B}\s+public\s+(?:constant\s+)?(\w+)', 2)} || {_all(r'\b([A-Za-z_][A-Za-z0-9_]*(?:\s*\[\s*\d*\s*\])*)\s+public\s+(?:constant\s+)?(\w+)\s*[=;]', 2)})) AS name, {_all(_MAPPED, 1)} AS mapped
             FROM ({_FILES})) WHERE NOT list_contains(mapped, name))"""
)
def p_public_declarations(spark: SparkSession, d: str) -> DataFrame:
    return _files(spark, d).select("file_id", F.explode(solidity.public_declarations("text")).alias("d")).select("file_id", "d.name", "d.kind").distinct()


_STEM = r"regexp_replace(regexp_replace(replace(coalesce(relative_path, ''), '\', '/'), '^.*/', ''), '\.[^.]*$', '')"


@query(
    rf"""WITH files AS (SELECT file_id, {_STEM} AS stem, string_split(regexp_replace(text, '(\b(?:abstract\s+)?contract\s+[A-Za-z_]\w*)', chr(1) || '\1', 'g'), chr(1)) AS parts FROM ({_FILES})),
              found AS (SELECT file_id, stem, generate_subscripts(parts, 1) AS pos, unnest(parts) AS part FROM files),
              names AS (SELECT file_id, stem, pos, length(part) AS span, regexp_extract(part, '^(?:abstract\s+)?contract\s+([A-Za-z_]\w*)', 1) AS name FROM found WHERE regexp_matches(part, '^(?:abstract\s+)?contract\s+[A-Za-z_]\w*'))
         SELECT f.file_id, coalesce(max(n.name) FILTER (n.name = f.stem), arg_max(n.name, n.span * 100000 - n.pos), f.stem) AS contract_name
         FROM files f LEFT JOIN names n ON n.file_id = f.file_id GROUP BY f.file_id, f.stem"""
)
def p_contract_name(spark: SparkSession, d: str) -> DataFrame:
    stem = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.coalesce("relative_path", F.lit("")), r"\\", "/"), "^.*/", ""), r"\.[^.]*$", "")
    return _files(spark, d).select("file_id", solidity.contract_name("text", stem).alias("contract_name")).distinct()


@query(rf"SELECT file_id, array_to_string({_all(r'function\s+(\w+)\s*\([^)]*\)\s+(?:external|public)', 1)}, ',') AS names FROM ({_FILES})")
def p_draft_names(spark: SparkSession, d: str) -> DataFrame:
    return _files(spark, d).select("file_id", F.array_join(solidity.draftable_names("text"), ",").alias("names")).distinct()


@query("SELECT DISTINCT id, contracts[-1].relative_path AS contract_path, specs[1].relative_path AS spec_path FROM records")
def p_pair_paths(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.pair_paths(table(spark, d, "records")).distinct()


@query("SELECT DISTINCT id, sha256(array_to_string(list_filter(list_transform(contracts, lambda c: c.clean_source), lambda s: s IS NOT NULL), chr(10))) AS contract_hash FROM records")
def p_joined_sources(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "records").select("id", solidity.content_hash(evaluation.joined_sources("contracts")).alias("contract_hash")).distinct()


# --- responses ----------------------------------------------------------------------------------

_ANCHORED = rf"""{_STRIP.format(r"coalesce(nullif(regexp_extract(spec, '(?s)\b(?:methods\s*\{|import\s|using\s).*', 0), ''), spec)")}"""


@query(f"SELECT spec_id, md5({_ANCHORED}) AS spec FROM ({_SPECS})")
def p_cvl_extract(spark: SparkSession, d: str) -> DataFrame:
    """Specifications found again in responses that wrap them in reasoning, prose and a fence."""
    response = F.concat(F.lit("<think>methods { }\n</think>Here it is:\n```cvl\n"), F.col("text"), F.lit("\n```\nusing it helps"))
    return spec_texts(table(spark, d, "records")).where("text is not null").select("spec_id", F.md5(responses.spec_of_response(response)).alias("spec")).distinct()


@query(f"SELECT doc_id, md5({_STRIP.format('text')}) AS overview, md5({_STRIP.format('source')}) AS specification FROM documents WHERE text IS NOT NULL AND source IS NOT NULL")
def p_sections(spark: SparkSession, d: str) -> DataFrame:
    content = F.concat(F.lit("intro SECTION 1:"), F.col("text"), F.lit("SECTION 2:"), F.col("source"))
    parts = table(spark, d, "documents").where("text is not null and source is not null").select("doc_id", responses.property_sections(content).alias("s"))
    return parts.select("doc_id", F.md5("s.overview").alias("overview"), F.md5("s.specification").alias("specification"))


@query(f"SELECT spec_id, md5({_STRIP.format('spec')}) AS chunk FROM ({_SPECS}) WHERE {_STRIP.format('spec')} <> ''")
def p_index_chunk(spark: SparkSession, d: str) -> DataFrame:
    """The round trip of index documents."""
    document = solidity.index_document(F.lit("SOLIDITY CONTRACT: X"), F.col("text"))
    rows = spec_texts(table(spark, d, "records")).where("text is not null").select("spec_id", solidity.spec_chunk(document).alias("chunk"))
    return rows.where("chunk <> ''").select("spec_id", F.md5("chunk").alias("chunk")).distinct()


@query(rf"SELECT file_id, {_family_sql()} AS family, CASE {' '.join(f"WHEN {_family_sql()} = '{name}' THEN '{'|'.join(hints)}'" for name, hints in solidity.HINTS.items())} END AS hints FROM ({_FILES})")
def p_hints(spark: SparkSession, d: str) -> DataFrame:
    return _files(spark, d).select("file_id", solidity.family("text").alias("family"), F.array_join(solidity.property_hints("text"), "|").alias("hints")).distinct()


@query(
    rf"""SELECT doc_id, md5(CASE doc_id % 4 WHEN 0 THEN replace(text, '```', '') WHEN 1 THEN ' ' || replace(text, '```', '') WHEN 2 THEN {_STRIP.format("replace(text, '```', '')")} ELSE '' END) AS section
         FROM documents WHERE text IS NOT NULL"""
)
def p_section(spark: SparkSession, d: str) -> DataFrame:
    """Responses without the marker, with an open section, with a closed one between others, and with an empty one."""
    plain = F.replace("text", F.lit("```"), F.lit(""))
    made = (
        F.when(F.col("doc_id") % 4 == 0, plain).when(F.col("doc_id") % 4 == 1, F.concat(F.lit("first ```cvl "), plain))
        .when(F.col("doc_id") % 4 == 2, F.concat(F.lit("first ```cvl\n\n"), plain, F.lit(" \n```\n and ```cvl second```"))).otherwise(F.concat(F.lit("```cvl```"), plain))
    )
    return table(spark, d, "documents").where("text is not null").select("doc_id", F.md5(responses.section(made)).alias("section"))


_KNOWN_SQL = SQL["h_known_errors"]


@query(f"SELECT contract_hash, md5('- ' || string_agg(error, chr(10) || '- ' ORDER BY ord)) AS block FROM ({_KNOWN_SQL}) WHERE ord < 20 GROUP BY 1")
def p_known_error_block(spark: SparkSession, d: str) -> DataFrame:
    """The first twenty known errors of each contract as they stand in a full prompt."""
    known = h_known_errors(spark, d).where("ord < 20").groupBy("contract_hash").agg(F.array_sort(F.collect_list(F.struct("ord", "error"))).alias("errors"))
    return known.select("contract_hash", F.md5(responses.known_error_block(F.col("errors")["error"])).alias("block"))


# --- checks and rewrites of specifications ------------------------------------------------------


def _specs(spark: SparkSession, d: str) -> DataFrame:
    records = spread_small(table(spark, d, "records"))
    rows = records.select(F.try_element_at("contracts", F.lit(-1))["clean_source"].alias("contract"), F.explode("specs").alias("s"))
    return rows.select(F.col("s.spec_id").alias("spec_id"), F.col("s.text").alias("spec"), F.coalesce("contract", F.lit("")).alias("contract")).where("spec is not null")


def _rows_sql(category: str, values: str) -> str:
    """A category's count per specification from a list of findings."""
    return f"SELECT spec_id, '{category}' AS category, len({values}) AS n FROM parts"


def _lines_sql(category: str, test: str) -> str:
    return _rows_sql(category, f"list_filter(lines, lambda x: {test})")


def _names_sql(category: str, names: str, test: str) -> str:
    return _rows_sql(category, f"list_filter({names}, lambda n: {test})")


_BARE = r"\b(?:block\.timestamp|msg\.sender|msg\.value)\b"
_LINT_SQL = rf"""
    WITH specs AS ({_SPECS}),
         blocks AS (SELECT *, nullif(regexp_extract(spec, 'methods\s*\{{', 0), '') AS head, nullif(regexp_extract(spec, 'methods\s*\{{[^{{}}]*\}}', 0), '') AS block,
                           string_split(regexp_replace(spec, '(\binvariant\s+\w+\s*\([^)]*\))', chr(1) || '\1', 'g'), chr(1)) AS cuts FROM specs),
         parts AS (SELECT spec_id, spec, contract, string_split_regex(spec, '\r\n|\n|\r') AS lines, regexp_extract(block, '^methods\s*\{{([^{{}}]*)\}}$', 1) AS methods,
                          CASE WHEN head IS NULL THEN spec ELSE substring(spec, instr(spec, head) + length(head)) END AS rest,
                          list_zip(regexp_extract_all(spec, '(?s)\brule\s+(\w+)\s*\(([^)]*)\)\s*(\{{.*?\n\}})', 2), regexp_extract_all(spec, '(?s)\brule\s+(\w+)\s*\(([^)]*)\)\s*(\{{.*?\n\}})', 3)) AS rules,
                          list_transform(range(2, len(cuts) + 1), lambda k: regexp_replace(regexp_replace(array_to_string(cuts[k:], ''), '^invariant\s+\w+\s*\([^)]*\)\s*', ''), '(?s)\n(?:rule|invariant)\s.*$', '')) AS invariants,
                          regexp_extract_all(contract, 'mapping\s*\([^)]+\)\s+public\s+(\w+)', 1) AS mapped,
                          regexp_extract_all(contract, '(?:uint\d*|int\d*|address|bool|bytes\d*|string)\s+public\s+(\w+)', 1) AS variables,
                          list_distinct(regexp_extract_all(contract, '{_MAPPED}', 1) || regexp_extract_all(contract, '\b{_B}\s+public\s+(?:constant\s+)?(\w+)', 2)
                                        || regexp_extract_all(contract, '\b([A-Za-z_][A-Za-z0-9_]*(?:\s*\[\s*\d*\s*\])*)\s+public\s+(?:constant\s+)?(\w+)\s*[=;]', 2)) AS public
                   FROM blocks),
         counts AS (
           SELECT spec_id, 'missing_methods' AS category, CASE WHEN methods IS NULL THEN 1 ELSE 0 END AS n FROM parts
           UNION ALL SELECT spec_id, 'keyword_leak', list_sum(list_transform(string_split_regex(methods, '\r\n|\n|\r'), lambda x: len(list_filter(['view', 'pure', 'payable', 'nonpayable'], lambda w: regexp_matches(x, '\b' || w || '\b'))))) FROM parts
           UNION ALL {_names_sql('missing_getter', 'public', r"methods IS NOT NULL AND regexp_matches(rest, '\b' || n || '\b') AND NOT regexp_matches(methods, 'function\s+' || n || '\s*\(')")}
           UNION ALL {_rows_sql('forbidden_sum', r"regexp_extract_all(spec, '\bsum\s*\(\s*(\w+)\s*\)', 1)")}
           UNION ALL SELECT spec_id, 'invariant_shape', list_sum(list_transform(invariants, lambda b: regexp_matches(b, '(?i)\b(?:old|@old)\b')::INT + regexp_matches(b, '(?i)\bbefore\b')::INT + regexp_matches(b, '(?i)\bafter\b')::INT)) FROM parts
           UNION ALL {_rows_sql('undeclared_env', r"list_filter(rules, lambda r: regexp_matches(r[2], '\be\.') AND NOT regexp_matches(r[1], '\benv\s+e\b') AND NOT regexp_matches(r[2], '\benv\s+e\b'))")}
           UNION ALL {_names_sql('mapping_syntax', 'mapped', r"regexp_matches(rest, '\b' || n || '\s*\[')")}
           UNION ALL {_names_sql('uncalled_getter', 'variables', r"regexp_matches(regexp_replace(rest, '\b' || n || '\s*\(', '', 'g'), '\b' || n || '\b')")}
           UNION ALL {_lines_sql('invalid_require', r'''regexp_matches(x, '\brequire\b.*,\s*"[^"]*"')''')}
           UNION ALL {_lines_sql('invalid_require_invariant', r"regexp_matches(x, '\brequireInvariant\s+.*(?:!=|==|>|<|>=|<=|&&|\|\||\be\.)')")}
           UNION ALL {_lines_sql('bare_solidity_env', rf"regexp_matches(regexp_replace(x, 'e\.(block\.timestamp|msg\.sender|msg\.value)\b', chr(1), 'g'), '{_BARE}')")}
           UNION ALL {_lines_sql('invariant_brace_body', r"regexp_matches(x, '\binvariant\s+\w+\s*\([^)]*\)\s*\{')")}
           UNION ALL {_rows_sql('env_in_invariant', r"list_filter(invariants, lambda b: regexp_matches(b, '\be\.(?:msg|block|tx)\.'))")}
           UNION ALL SELECT spec_id, 'undeclared_ghost', len(list_filter(list_distinct(regexp_extract_all(spec, '\b(ghost\w+)\b', 1)), lambda g: NOT list_contains(
                              list_transform(regexp_extract_all(spec, '(?s)\bghost\s+([^;]*)', 1), lambda t: regexp_extract(t, '(?s)([A-Za-z_]\w*)[^A-Za-z_]*$', 1)), g))) FROM parts
           UNION ALL {_lines_sql('deprecated_sinvoke', r"regexp_matches(x, '\b(sinvoke|invoke)\b')")}
           UNION ALL {_names_sql('envfree_with_env', r"list_distinct(regexp_extract_all(methods, 'function\s+(\w+)\s*\([^)]*\)[^;]*\benvfree\b', 1))", r"regexp_matches(rest, '\b' || n || '\s*\(\s*e\s*[,)]')")}
           UNION ALL {_lines_sql('require_parens', r"regexp_matches(x, '\brequire\s*\(') AND NOT regexp_matches(x, '\brequireInvariant\b')")}
           UNION ALL {_lines_sql('missing_semicolon', rf"regexp_matches({_STRIP.format('x')}, '^(assert|require)\s+') AND NOT regexp_matches({_STRIP.format('x')}, '[;{{]$')")})
"""


@query(_LINT_SQL + " SELECT spec_id, category, n FROM counts WHERE n > 0")
def l_findings(spark: SparkSession, d: str) -> DataFrame:
    found = lint.exploded(_specs(spark, d)).select("spec_id", "ord", "category").distinct()  # rows delivered twice, when they are small
    return found.groupBy("spec_id", "category").agg(F.count("*").alias("n"))


@query(_LINT_SQL + " SELECT category, sum(n)::BIGINT AS findings, count(*) AS specs FROM counts WHERE n > 0 GROUP BY 1")
def l_summary(spark: SparkSession, d: str) -> DataFrame:
    return l_findings(spark, d).groupBy("category").agg(F.sum("n").alias("findings"), F.count("*").alias("specs"))


_PROBE_HEAD = "methods {\n    function leakProbe() external view;\n    function freeProbe(uint256) external envfree;\n}\n\n"
_PROBE_TAIL = """
invariant probeShape() old(probeTotal()) == 0 && before;

invariant probeEnv(address a) e.msg.sender == a;

invariant probeBraces() { probeTotal() == 0 }

rule probeRule(address a) {
    sinvoke drop();
    require probeMap[a] > 0, "text";
    requireInvariant probeTotal() > 0;
    require(a != 0);
    assert msg.sender == a
    assert e.block.timestamp > probeTotal;
    assert ghostProbe == sum(probeMap);
    freeProbe(e, 1);
}
"""
_PROBE_CONTRACT = "\ncontract Probe { uint256 public probeTotal; mapping(address => uint256) public probeMap; }"


def _probed(spark: SparkSession, d: str) -> DataFrame:
    """Every specification with an instance of each mistake behind it; a third of them without a methods block."""
    spec = F.when(F.col("spec_id") % 3 == 0, F.replace("spec", F.lit("methods"), F.lit("thods"))).otherwise(F.concat(F.lit(_PROBE_HEAD), "spec"))
    return _specs(spark, d).select("spec_id", F.concat(spec, F.lit(_PROBE_TAIL)).alias("spec"), F.concat("contract", F.lit(_PROBE_CONTRACT)).alias("contract"))


def _named_findings(check: int, category: str, names: str, test: str, message: str) -> str:
    return f"SELECT spec_id, {check} AS check_id, '{category}' AS category, unnest(list_transform(list_filter({names}, lambda n: {test}), lambda n: {{message: {message}, line: NULL::INT}})) AS f FROM parts"


def _line_findings(check: int, category: str, test: str, message: str, lines: str = "lines") -> str:
    return f"SELECT spec_id, {check} AS check_id, '{category}' AS category, unnest(list_transform(list_filter(list_transform(range(1, len({lines}) + 1), lambda i: {{x: {lines}[i], n: i}}), lambda s: {test.format('s.x')}), lambda s: {{message: '{message}: ' || {_STRIP.format('s.x')}, line: s.n::INT}})) AS f FROM parts"


_SPEC_OF = rf"SELECT spec_id, CASE WHEN spec_id % 3 = 0 THEN replace(spec, 'methods', 'thods') ELSE '{_PROBE_HEAD}' || spec END || '{_PROBE_TAIL}' AS spec, contract || '{_PROBE_CONTRACT}' AS contract FROM ({_SPECS})"
_FIRED_SQL = (
    _LINT_SQL[: _LINT_SQL.index("         counts AS (")].replace(f"WITH specs AS ({_SPECS})", f"WITH specs AS ({_SPEC_OF})").rstrip().rstrip(",")
    + rf""",
         shown AS (SELECT *, regexp_extract_all(spec, '\binvariant\s+(\w+)\s*\([^)]*\)', 1) AS invariant_names, regexp_extract_all(spec, '(?s)\brule\s+(\w+)\s*\(([^)]*)\)\s*(\{{.*?\n\}})', 1) AS rule_names,
                          list_transform(regexp_extract_all(contract, '{_MAPPED}', 1), lambda n: {{name: n, kind: 'mapping'}})
                          || list_transform(list_filter(list_distinct(regexp_extract_all(contract, '\b{_B}\s+public\s+(?:constant\s+)?(\w+)', 2) || regexp_extract_all(contract, '\b([A-Za-z_][A-Za-z0-9_]*(?:\s*\[\s*\d*\s*\])*)\s+public\s+(?:constant\s+)?(\w+)\s*[=;]', 2)),
                                                        lambda n: NOT list_contains(regexp_extract_all(contract, '{_MAPPED}', 1), n)), lambda n: {{name: n, kind: 'variable'}}) AS declared,
                          string_split_regex(methods, '\r\n|\n|\r') AS method_lines FROM parts_of),
         parts AS (SELECT * FROM shown),
         found AS (
           SELECT spec_id, 1 AS check_id, 'missing_methods' AS category, {{message: 'no closed methods block', line: NULL::INT}} AS f FROM parts WHERE methods IS NULL
           UNION ALL {" UNION ALL ".join(_line_findings(1, 'keyword_leak', rf"regexp_matches({{0}}, '\b{w}\b')", f"contract keyword `{w}` in methods block", "method_lines") for w in ('view', 'pure', 'payable', 'nonpayable'))}
           UNION ALL {_named_findings(2, 'missing_getter', 'declared', r"methods IS NOT NULL AND regexp_matches(rest, '\b' || n.name || '\b') AND NOT regexp_matches(methods, 'function\s+' || n.name || '\s*\(')", "'public ' || n.kind || ' `' || n.name || '` is used but has no getter in the methods block'")}
           UNION ALL {_named_findings(3, 'forbidden_sum', r"regexp_extract_all(spec, '\bsum\s*\(\s*(\w+)\s*\)', 1)", 'true', "'`sum(' || n || ')`: there is no sum, keep a ghost in a hook'")}
           UNION ALL {" UNION ALL ".join(_named_findings(4, 'invariant_shape', 'list_zip(invariant_names, invariants)', f"regexp_matches(n[2], '{p}')", f"'invariant `' || n[1] || '` contains {w}: use a rule'") for w, p in (('old', r'(?i)\b(?:old|@old)\b'), ('before', r'(?i)\bbefore\b'), ('after', r'(?i)\bafter\b')))}
           UNION ALL {_named_findings(5, 'undeclared_env', 'list_zip(rule_names, rules)', r"regexp_matches(n[2][2], '\be\.') AND NOT regexp_matches(n[2][1], '\benv\s+e\b') AND NOT regexp_matches(n[2][2], '\benv\s+e\b')", "'rule `' || n[1] || '` uses e. without env e'")}
           UNION ALL {_named_findings(6, 'mapping_syntax', 'mapped', r"regexp_matches(rest, '\b' || n || '\s*\[')", "'mapping `' || n || '` is indexed; call it'")}
           UNION ALL {_named_findings(7, 'uncalled_getter', 'variables', r"regexp_matches(regexp_replace(rest, '\b' || n || '\s*\(', '', 'g'), '\b' || n || '\b')", "'getter `' || n || '` is used as a variable; call it'")}
           UNION ALL {_line_findings(8, 'invalid_require', r"""regexp_matches({0}, '\brequire\b.*,\s*"[^"]*"')""", 'require takes no message')}
           UNION ALL {_line_findings(9, 'invalid_require_invariant', r"regexp_matches({0}, '\brequireInvariant\s+.*(?:!=|==|>|<|>=|<=|&&|\|\||\be\.)')", 'requireInvariant takes a call of an invariant')}
           UNION ALL {_line_findings(10, 'bare_solidity_env', r"regexp_matches(regexp_replace({0}, 'e\.(block\.timestamp|msg\.sender|msg\.value)\b', chr(1), 'g'), '" + _BARE + "')", 'environment without e.')}
           UNION ALL {_line_findings(11, 'invariant_brace_body', r"regexp_matches({0}, '\binvariant\s+\w+\s*\([^)]*\)\s*\{{')", "an invariant''s body has no braces")}
           UNION ALL {_named_findings(12, 'env_in_invariant', 'list_zip(invariant_names, invariants)', r"regexp_matches(n[2], '\be\.(?:msg|block|tx)\.')", "'invariant `' || n[1] || '` uses the environment'")}
           UNION ALL {_named_findings(13, 'undeclared_ghost', r"list_distinct(regexp_extract_all(spec, '\b(ghost\w+)\b', 1))", r"NOT list_contains(list_transform(regexp_extract_all(spec, '(?s)\bghost\s+([^;]*)', 1), lambda t: regexp_extract(t, '(?s)([A-Za-z_]\w*)[^A-Za-z_]*$', 1)), n)", "'ghost `' || n || '` is not declared'")}
           UNION ALL {_line_findings(14, 'deprecated_sinvoke', r"regexp_matches({0}, '\b(sinvoke|invoke)\b')", 'call functions without sinvoke or invoke')}
           UNION ALL {_named_findings(15, 'envfree_with_env', r"list_distinct(regexp_extract_all(methods, 'function\s+(\w+)\s*\([^)]*\)[^;]*\benvfree\b', 1))", r"regexp_matches(rest, '\b' || n || '\s*\(\s*e\s*[,)]')", "'envfree function `' || n || '` is called with e'")}
           UNION ALL {_line_findings(16, 'require_parens', r"regexp_matches({0}, '\brequire\s*\(') AND NOT regexp_matches({0}, '\brequireInvariant\b')", 'require takes no parentheses')}
           UNION ALL {_line_findings(17, 'missing_semicolon', rf"regexp_matches({_STRIP.format('{0}')}, '^(assert|require)\s+') AND NOT regexp_matches({_STRIP.format('{0}')}, '[;{{{{]$')", 'no semicolon')})
    """
).replace("         parts AS (SELECT spec_id, spec", "         parts_of AS (SELECT spec_id, spec", 1)


@query(_FIRED_SQL + " SELECT spec_id, check_id, category, f.message AS message, f.line AS line FROM found")
def l_fired(spark: SparkSession, d: str) -> DataFrame:
    """All 17 checks on specifications with every mistake in them: check, message and line of each finding."""
    found = lint.exploded(_probed(spark, d)).select("spec_id", "ord", "check_id", "category", "message", "line").distinct()
    return found.drop("ord")


@query(_FIRED_SQL + " SELECT spec_id, '- [' || category || '] ' || f.message || CASE WHEN coalesce(f.line, 0) > 0 THEN ' (line ' || f.line || ')' ELSE '' END AS text FROM found")
def l_formatted(spark: SparkSession, d: str) -> DataFrame:
    """The findings of the same specifications as the lines of their report."""
    found = lint.findings(_probed(spark, d)).select("spec_id", F.posexplode(F.split(lint.formatted("findings"), "\n- \\[")).alias("n", "text")).distinct()
    return found.select("spec_id", F.when(F.col("n") == 0, F.col("text")).otherwise(F.concat(F.lit("- ["), "text")).alias("text"))


def _env_sql(x: str) -> str:
    for k, name in enumerate(("block.timestamp", "msg.sender", "msg.value")):
        dotted = name.replace(".", r"\.")
        x = rf"replace(regexp_replace(regexp_replace({x}, 'e\.{dotted}\b', chr({k + 2}), 'g'), '\b{dotted}\b', 'e.{name}', 'g'), chr({k + 2}), 'e.{name}')"
    return x


_STEPS_SQL = {
    "invocations": r"regexp_replace(regexp_replace(spec, '\bsinvoke\s+', '', 'g'), '\binvoke\s+', '', 'g')",
    "mutability": r"regexp_replace(spec, '\b(payable|view|pure|nonpayable)\b\s*', '', 'g')",
    "requires": r"regexp_replace(spec, '\brequireInvariant\s+([^;()]*?(?:!=|==|>|<|>=|<=|&&|\|\||\be\.)[^;]*);', 'require \1;', 'g')",
    "env": r"array_to_string(list_transform(string_split(regexp_replace(spec, '(\n(?:rule|invariant)\s)', chr(1) || '\1', 'g'), chr(1)), lambda p: CASE WHEN regexp_matches(p, '^\ninvariant\s') THEN p ELSE " + _env_sql("p") + " END), '')",
    "hooks": r"regexp_replace(regexp_replace(spec, '\bhook\s+(Sstore|Sload)\s+((?:[A-Za-z_]\w*\s+)*?)([A-Za-z_]\w*(?:\s*\[[^\]]*\]\s*)*(?:\.[A-Za-z_]\w*)*)\s*\(\s*(KEY[^()]*?)\s*\)', 'hook \1 \2\3[\4]', 'g'), '\b(hook\s+(?:Sstore|Sload)\s+[^\n{]*?)\s+STORAGE\s*(\{)', '\1 \2', 'g')",
    "zero_address": r"regexp_replace(spec, '\baddress\s*\(\s*0\s*\)', '0x0', 'g')",
    "invariants": r"regexp_replace(regexp_replace(spec, '(invariant\s+\w+\s*\([^)]*\))\s*\{\s*([^}]+?)[\s;]*\}', '\1' || chr(10) || '    \2;', 'g'), '(invariant\s+\w+\s*\([^)]*\)\s*\n[ \t]+[^\n]+[^;\s\n])([ \t]*\n)', '\1;\2', 'g')",
}


@query(" UNION ALL ".join(f"SELECT spec_id, '{name}' AS step, md5({sql}) AS spec FROM ({_SPECS})" for name, sql in _STEPS_SQL.items()))
def r_steps(spark: SparkSession, d: str) -> DataFrame:
    """Each rewrite by itself on every specification."""
    steps = [(name, step) for name, step in rewrite.STEPS if name in _STEPS_SQL]
    made = F.array(*(F.struct(F.lit(name).alias("step"), F.md5(step(F.col("spec"), F.col("contract"), F.lit("methods {\n\n}"))).alias("spec")) for name, step in steps))
    return _specs(spark, d).select("spec_id", F.explode(made).alias("r")).select("spec_id", "r.step", "r.spec").distinct()


_STEP_METHODS = "methods {\n    function drop() external;\n    function pay(uint256) external;\n    function freeProbe(uint256) external envfree;\n}"
_STEP_TAIL = """
rule moreRule(address a) {
    env e;
    drop( ); pay( 1 ); pay( e, 2); pay(e); freeProbe(3); freeProbe( e , 4); freeProbe( e );
    assert wrap(pay(a)) == probeMap[a] + probeTotal + probeMap [ a + 1 ];
}

rule bareRule(uint256 x)  {
    assert e.msg.value > ghostB + ghostA && a != address( 0 );
}
"""


def _stepped(spark: SparkSession, d: str) -> DataFrame:
    """The specifications of ``_probed`` with calls, indexes and variables behind them that the other steps change."""
    return _probed(spark, d).withColumn("spec", F.concat("spec", F.lit(_STEP_TAIL)))


_STEPPED_SQL = f"SELECT spec_id, spec || '{_STEP_TAIL}' AS spec, contract FROM ({_SPEC_OF})"
_BLOCK = r"regexp_extract(spec, 'methods\s*\{[^{}]*\}', 0)"
_AFTER_BLOCK = f"substring(spec, instr(spec, {_BLOCK}) + length({_BLOCK}))"
_UNTIL_BLOCK = f"substring(spec, 1, instr(spec, {_BLOCK}) + length({_BLOCK}) - 1)"
_MAPS = r"regexp_extract_all(contract, 'mapping\s*\([^)]+\)\s+public\s+(\w+)', 1)"
_VARS = r"regexp_extract_all(contract, '(?:uint\d*|int\d*|address|bool|bytes\d*|string)\s+public\s+(\w+)', 1)"
_FREE = rf"list_distinct(regexp_extract_all({_BLOCK}, 'function\s+(\w+)\s*\([^)]*\)[^;]*\benvfree\b', 1))"
_RULES_CUT = r"string_split(regexp_replace(spec, '(?s)(\brule\s+\w+\s*\([^)]*\))(\s*)(\{.*?\n\})', chr(1) || '\1' || chr(2) || '\2' || chr(2) || '\3' || chr(1), 'g'), chr(1))"


def _any_of(names: str) -> str:
    return f"'(' || array_to_string({names}, '|') || ')'"


def _rules_sql(changed: str) -> str:
    """Every rule, cut into r[1] (head), r[2] (blanks) and r[3] (body), changed."""
    return f"array_to_string(list_transform({_RULES_CUT}, lambda p: list_transform([string_split(p, chr(2))], lambda r: CASE WHEN len(r) = 3 THEN {changed} ELSE p END)[1]), '')"


_CALLS = r"string_split(regexp_replace(r[3], '(\w+\s*\([^()]*\))', chr(3) || '\1' || chr(3), 'g'), chr(3))"
_GIVEN = _STRIP.format(r"regexp_extract(c, '(?s)\((.*)\)$', 1)")
_MORE_SQL = {
    "methods": f"CASE WHEN {_BLOCK} = '' THEN '{_STEP_METHODS}' || chr(10) || chr(10) || spec ELSE substring(spec, 1, instr(spec, {_BLOCK}) - 1) || '{_STEP_METHODS}' || {_AFTER_BLOCK} END",
    "mappings": rf"regexp_replace(spec, '\b' || {_any_of(_MAPS)} || '\s*\[([^\]]+)\]', '\1(\2)', 'g')",
    "getters": rf"CASE WHEN {_BLOCK} = '' THEN spec ELSE {_UNTIL_BLOCK} || replace(regexp_replace(regexp_replace({_AFTER_BLOCK}, '\b' || {_any_of(_VARS)} || '(\s*\()', '\1__called\2', 'g'), '\b' || {_any_of(_VARS)} || '\b', '\1()', 'g'), '__called', '') END",
    "env_declarations": _rules_sql(r"CASE WHEN regexp_matches(r[3], '\be\.') AND NOT regexp_matches(r[1] || r[3], '\benv\s+e\b') THEN r[1] || ' {' || chr(10) || '    env e;' || chr(10) || substring(r[3], 2) ELSE r[1] || r[2] || r[3] END"),
    "ghosts": r"""list_transform([list_sort(list_filter(list_distinct(regexp_extract_all(spec, '\b(ghost\w+)\b', 1)), lambda g: NOT list_contains(regexp_extract_all(spec, '\bghost\s+\S+\s+(\w+)\s*[;{]', 1), g)))],
        lambda m: CASE WHEN len(m) = 0 THEN spec ELSE list_transform([greatest(1, instr(spec, coalesce(nullif(regexp_extract(spec, '\bmethods\s*\{', 0), ''), chr(7))))],
            lambda pl: substring(spec, 1, pl - 1) || array_to_string(list_transform(m, lambda g: 'ghost uint256 ' || g || ';'), chr(10)) || chr(10) || chr(10) || substring(spec, pl))[1] END)[1]""",
    "env_arguments_dropped": rf"CASE WHEN {_BLOCK} = '' OR len({_FREE}) = 0 THEN spec ELSE {_UNTIL_BLOCK} || regexp_replace(regexp_replace({_AFTER_BLOCK}, '\b' || {_any_of(_FREE)} || '\s*\(\s*e\s*,\s*', '\1(', 'g'), '\b' || {_any_of(_FREE)} || '\s*\(\s*e\s*\)', '\1()', 'g') END",
    "env_arguments": _rules_sql(
        rf"""CASE WHEN NOT regexp_matches(r[3], '\benv\s+e\s*;') THEN r[1] || r[2] || r[3] ELSE r[1] || array_to_string(list_transform({_CALLS}, lambda c:
             CASE WHEN NOT regexp_matches(c, '^(drop|pay)\s*\([^()]*\)$') OR {_GIVEN} = 'e' OR starts_with({_GIVEN}, 'e,') OR starts_with({_GIVEN}, 'env ') THEN c
                  ELSE regexp_extract(c, '^\w+', 0) || '(e' || CASE WHEN {_GIVEN} = '' THEN '' ELSE ', ' || {_GIVEN} END || ')' END), '') END"""
    ),
}


@query(" UNION ALL ".join(f"SELECT spec_id, '{name}' AS step, md5({sql}) AS spec FROM ({_STEPPED_SQL})" for name, sql in _MORE_SQL.items()))
def r_more_steps(spark: SparkSession, d: str) -> DataFrame:
    """The steps that need names of the contract, rules or the methods block, each by itself."""
    steps = [(name, step) for name, step in rewrite.STEPS if name in _MORE_SQL]
    made = F.array(*(F.struct(F.lit(name).alias("step"), F.md5(step(F.col("spec"), F.col("contract"), F.lit(_STEP_METHODS))).alias("spec")) for name, step in steps))
    return _stepped(spark, d).select("spec_id", F.explode(made).alias("r")).select("spec_id", "r.step", "r.spec").distinct()


def _chain_sql() -> str:
    """All steps in order, a table each."""
    tables, last = [f"s AS MATERIALIZED ({_STEPPED_SQL})"], "s"
    for k, (name, _) in enumerate(rewrite.STEPS):
        tables.append(f"s{k} AS MATERIALIZED (SELECT spec_id, contract, {({**_STEPS_SQL, **_MORE_SQL})[name]} AS spec FROM {last})")
        last = f"s{k}"
    return "WITH " + ", ".join(tables) + f" SELECT spec_id, md5(spec) AS spec FROM {last}"


@query(_chain_sql())
def r_cleaned(spark: SparkSession, d: str) -> DataFrame:
    """The whole pipeline in its order."""
    specs = _stepped(spark, d).withColumn("methods", F.lit(_STEP_METHODS))
    return rewrite.cleaned(specs).select("spec_id", F.md5("spec").alias("spec")).distinct()


# --- merging ------------------------------------------------------------------------------------


def _fragments(spark: SparkSession, d: str) -> DataFrame:
    """A record's specifications taken as the fragments of one project."""
    rows = spread_small(table(spark, d, "records")).select(F.col("id").alias("project_id"), F.posexplode("specs").alias("ord", "s"))
    return rows.select("project_id", "ord", F.col("s.text").alias("text")).where("project_id is not null and text is not null").distinct()


@query(
    rf"""WITH fragments AS (SELECT DISTINCT id AS project_id, s.ord, s.spec.text AS text FROM records r, LATERAL (SELECT generate_subscripts(r.specs, 1) - 1 AS ord, unnest(r.specs) AS spec) s WHERE s.spec.text IS NOT NULL),
              cut AS (SELECT project_id, ord, list_filter(list_transform(string_split(regexp_replace(regexp_replace(text, '(?s)methods\s*\{{[^}}]*\}}', '', 'g'), '(\b(?:rule|invariant)\s+\w+)', chr(1) || '\1', 'g'), chr(1)),
                             lambda p: {_STRIP.format('p')}), lambda p: regexp_matches(p, '^(rule|invariant)\s+\w+')) AS blocks FROM fragments),
              rows AS (SELECT project_id, ord, generate_subscripts(blocks, 1) - 1 AS pos, unnest(blocks) AS block FROM cut)
         SELECT project_id, ord, pos, regexp_extract(block, '^(?:rule|invariant)\s+(\w+)', 1) AS name, md5(block) AS block FROM rows
         QUALIFY row_number() OVER (PARTITION BY project_id, regexp_extract(block, '^(?:rule|invariant)\s+(\w+)', 1) ORDER BY ord, pos) = 1"""
)
def t_merge(spark: SparkSession, d: str) -> DataFrame:
    rules = merge.fragment_rules(_fragments(spark, d))
    return rules.select("project_id", "place.ord", "place.pos", "name", F.md5("block").alias("block"))


@query()
def t_merged_specs(spark: SparkSession, d: str) -> DataFrame:
    records = table(spark, d, "records").where("id is not null")
    projects = records.select(F.col("id").alias("project_id"), solidity.methods_block(F.coalesce(F.try_element_at("contracts", F.lit(-1))["clean_source"], F.lit(""))).alias("methods")).distinct()
    return merge.merged(_fragments(spark, d), projects).select("project_id", F.md5("spec").alias("spec"))


# --- graphs -------------------------------------------------------------------------------------


def _projects(spark: SparkSession, d: str) -> DataFrame:
    files = contract_files(table(spark, d, "records")).where("relative_path is not null and clean_source is not null")
    return files.select(F.col("record_id").alias("project_id"), F.col("relative_path").alias("path"), F.col("clean_source").alias("text"))


def _normal_sql(x: str) -> str:
    x = rf"regexp_replace(replace({x}, '\', '/'), '/(\./)+', '/', 'g')"
    x = rf"regexp_replace(regexp_replace({x}, '^(\./)+', ''), '/+', '/', 'g')"
    for _ in range(6):
        x = rf"regexp_replace({x}, '(^|/)([^/.][^/]*)/\.\.(/|$)', '\1')"
    return rf"regexp_replace(regexp_replace({x}, '^(\.\./)+', ''), '^/', '')"


_EDGES = rf"""
    WITH files AS (SELECT DISTINCT id AS project_id, {_normal_sql('c.relative_path')} AS path, c.clean_source AS text FROM (SELECT id, unnest(contracts) AS c FROM records)
                   WHERE c.relative_path IS NOT NULL AND c.clean_source IS NOT NULL),
         imports AS (SELECT project_id, path AS src, generate_subscripts(found, 1) - 1 AS ord, unnest(found) AS import_path
                     FROM (SELECT *, regexp_extract_all(text, '\bimport\s+(?:[^;]*?\s+from\s+)?["'']([^"'']+)["'']\s*;', 1) AS found FROM files)),
         candidates AS (SELECT *, CASE WHEN starts_with(import_path, '.') THEN {_normal_sql("regexp_replace(src, '/?[^/]*$', '') || '/' || import_path")} END AS candidate FROM imports),
         edges AS (SELECT DISTINCT c.project_id, c.src, c.ord, c.import_path, f.path AS dst FROM candidates c LEFT JOIN (SELECT DISTINCT project_id, path FROM files) f ON f.project_id = c.project_id AND f.path = c.candidate)
"""


@query(_EDGES + " SELECT * FROM edges")
def g_edges(spark: SparkSession, d: str) -> DataFrame:
    return closure.import_edges(_projects(spark, d))


@query(
    _EDGES.rsplit(",\n         candidates", 1)[0]
    + rf""",
         bare AS (SELECT DISTINCT project_id, regexp_extract(import_path, '^[^/]*/', 0) AS prefix, import_path FROM imports WHERE NOT starts_with(import_path, '.') AND contains(import_path, '/') AND project_id IS NOT NULL),
         added AS (SELECT DISTINCT project_id, 'deps/' || length(prefix) || '/' || substring(import_path, length(prefix) + 1) AS path FROM bare WHERE length(import_path) % 3 > 0),
         candidates AS (SELECT i.*, CASE WHEN starts_with(i.import_path, '.') THEN {_normal_sql("regexp_replace(src, '/?[^/]*$', '') || '/' || i.import_path")}
                                         WHEN b.prefix IS NOT NULL THEN {_normal_sql("'deps/' || length(b.prefix) || '/' || substring(i.import_path, length(b.prefix) + 1)")} END AS candidate
                        FROM imports i LEFT JOIN bare b ON b.project_id = i.project_id AND b.import_path = i.import_path)
         SELECT DISTINCT c.project_id, c.src, c.ord, c.import_path, f.path AS dst FROM candidates c
         LEFT JOIN (SELECT DISTINCT project_id, path FROM files UNION SELECT project_id, {_normal_sql('path')} FROM added) f ON f.project_id = c.project_id AND f.path = c.candidate"""
)
def g_edges_mapped(spark: SparkSession, d: str) -> DataFrame:
    """Imports through remapping files: each project's own list sends the first step of its bare imports to a folder, where two thirds of them are."""
    files = _projects(spark, d)
    bare = closure.import_edges(files).where(~F.col("import_path").startswith(".") & F.contains("import_path", F.lit("/"))).where("project_id is not null")
    prefix = F.regexp_extract("import_path", "^[^/]*/", 0)
    target = F.concat(F.lit("deps/"), F.length(prefix))
    lines = bare.groupBy("project_id").agg(F.array_sort(F.collect_set(F.concat(prefix, F.lit(" = "), target, F.lit("  # by the first step")))).alias("lines"))
    mapping = closure.remappings(lines.select("project_id", F.concat(F.lit("# remappings\nno mapping\n"), F.array_join("lines", "\n")).alias("text")))
    added = bare.where(F.length("import_path") % 3 > 0).select("project_id", F.concat(target, F.lit("/"), F.expr("substring(import_path, length(regexp_extract(import_path, '^[^/]*/', 0)) + 1)")).alias("path"), F.lit("").alias("text"))
    return closure.import_edges(files.unionByName(added.distinct()), mapping)


_REACHED = (
    _EDGES.replace("WITH files", "WITH RECURSIVE files")
    + rf""", entries AS (SELECT DISTINCT id AS project_id, {_normal_sql('contracts[-1].relative_path')} AS path FROM records WHERE id IS NOT NULL AND contracts[-1].relative_path IS NOT NULL),
         walk AS (SELECT project_id, path AS entry, path FROM entries UNION SELECT w.project_id, w.entry, e.dst FROM walk w JOIN edges e ON e.project_id = w.project_id AND e.src = w.path WHERE e.dst IS NOT NULL)
"""
)


@query(_REACHED + " SELECT * FROM walk")
def g_closure(spark: SparkSession, d: str) -> DataFrame:
    reached = closure.import_closure(closure.import_edges(_projects(spark, d)), closure.entry_files(table(spark, d, "records")))
    return reached.select("project_id", "entry", "path")


@query(_REACHED + " SELECT w.project_id, w.entry, array_to_string(list_sort(list(DISTINCT e.import_path)), ',') AS missing FROM walk w JOIN edges e ON e.project_id = w.project_id AND e.src = w.path WHERE e.dst IS NULL GROUP BY ALL")
def g_missing(spark: SparkSession, d: str) -> DataFrame:
    edges = closure.import_edges(_projects(spark, d))
    reached = closure.import_closure(edges, closure.entry_files(table(spark, d, "records")))
    return closure.missing_imports(edges, reached).withColumn("missing", F.array_join("missing", ","))


_TEXT_SQL = _REACHED + """,
         steps AS (SELECT project_id, path AS entry, path, 0 AS depth FROM entries
                   UNION SELECT w.project_id, w.entry, e.dst, w.depth + 1 FROM steps w JOIN edges e ON e.project_id = w.project_id AND e.src = w.path WHERE e.dst IS NOT NULL AND w.depth < 12),
         nearest AS (SELECT project_id, entry, path, min(depth) AS depth FROM steps GROUP BY ALL),
         sources AS (SELECT project_id, path, any_value(text) AS text FROM files GROUP BY ALL)
    SELECT n.project_id, n.entry, count(*)::INT AS files, sha256(string_agg('// SOURCE: ' || n.path || chr(10) || s.text, chr(10) || chr(10) ORDER BY n.depth, n.path)) AS contract_hash
    FROM nearest n JOIN sources s USING (project_id, path) GROUP BY 1, 2
"""


@query(_TEXT_SQL)
def g_project_text(spark: SparkSession, d: str) -> DataFrame:
    files = _projects(spark, d)
    reached = closure.import_closure(closure.import_edges(files), closure.entry_files(table(spark, d, "records")))
    return closure.project_text(reached, files).select("project_id", "entry", F.size("sources").alias("files"), solidity.content_hash("source_text").alias("contract_hash"))


@query(
    """WITH RECURSIVE graph AS (SELECT DISTINCT query_id AS src, pair_id AS dst FROM retrieval_results WHERE pair_id IS NOT NULL AND query_id IS NOT NULL),
            stated AS (SELECT DISTINCT src FROM graph WHERE try_cast(regexp_extract(src, '([0-9]+)$', 1) AS BIGINT) % 50 = 0),
            walk AS (SELECT src AS entry, src AS path, 0 AS depth FROM stated UNION SELECT w.entry, g.dst, w.depth + 1 FROM walk w JOIN graph g ON g.src = w.path WHERE w.depth < 3)
       SELECT entry, path, min(depth) AS depth FROM walk GROUP BY 1, 2"""
)
def g_reach(spark: SparkSession, d: str) -> DataFrame:
    """What is at most three steps of retrieval away from the stated pairs (ids divisible by 50), cycles included."""
    graph = table(spark, d, "retrieval_results").where("pair_id is not null and query_id is not null")
    edges = graph.select(F.lit("").alias("project_id"), F.col("query_id").alias("src"), F.col("pair_id").alias("dst"))
    stated = graph.where(F.regexp_extract("query_id", "([0-9]+)$", 1).try_cast("bigint") % 50 == 0).select(F.lit("").alias("project_id"), F.col("query_id").alias("path"))
    return closure.import_closure(edges, stated, max_depth=3).select("entry", "path", "depth")


# --- manifests ----------------------------------------------------------------------------------


@query("SELECT path, sha256(text) AS checksum, strlen(text) AS size FROM contract_sources WHERE NOT regexp_matches(path, '(^|/)\\.[^/]*$')")
def s_manifest(spark: SparkSession, d: str) -> DataFrame:
    return manifest.entries(table(spark, d, "contract_sources"), "text")


@query("SELECT count(*) AS file_count, coalesce(sum(strlen(text)), 0)::BIGINT AS total_size FROM documents")
def s_totals(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "documents").select(F.concat(F.lit("doc/"), F.col("doc_id")).alias("path"), "text")
    return manifest.totals(manifest.entries(files, "text"))


@query("SELECT path, CASE WHEN length(path) % 3 = 0 THEN 'mismatch' WHEN length(path) % 3 = 1 THEN 'extra' ELSE 'ok' END AS status FROM contract_sources UNION ALL SELECT 'lost/' || path, 'missing' FROM contract_sources")
def s_checksum_status(spark: SparkSession, d: str) -> DataFrame:
    """Files against a manifest in which some entries are wrong, some are not there and some have no file."""
    files = table(spark, d, "contract_sources")
    right = manifest.entries(files, "text")
    expected = right.where(F.length("path") % 3 != 1).withColumn("checksum", F.when(F.length("path") % 3 == 0, F.reverse("checksum")).otherwise(F.upper("checksum")))
    lost = right.select(F.concat(F.lit("lost/"), F.col("path")).alias("path"), "checksum")
    return manifest.compared(expected.select("path", "checksum").unionByName(lost), files, "text")


@query(f"SELECT DISTINCT id, {_normal_sql('contracts[-1].relative_path')} AS path FROM records WHERE contracts[-1].relative_path IS NOT NULL")
def g_normal_paths(spark: SparkSession, d: str) -> DataFrame:
    path = F.try_element_at("contracts", F.lit(-1))["relative_path"]
    return table(spark, d, "records").select("id", path.alias("raw")).where("raw is not null").select("id", normal_path("raw").alias("path")).distinct()


# --- sources and sinks --------------------------------------------------------------------------


def _folder(spark: SparkSession, label: str) -> str:
    """A new place in the shared folder, deleted with the staged tables."""
    from vericorpus import session

    path = f"{session.shared_folder(spark)}/vericorpus-{label}-{uuid.uuid4().hex}"
    session._STAGED.append(path)
    return path


@query("SELECT md5(path) AS name, md5(text || chr(10)) AS text FROM contract_sources WHERE path IS NOT NULL AND text IS NOT NULL")
def s_source_files(spark: SparkSession, d: str) -> DataFrame:
    """Sources written as files, one a folder, and read back whole."""
    path = _folder(spark, "sources")
    rows = table(spark, d, "contract_sources").where("path is not null and text is not null")
    rows.select(F.md5("path").alias("name"), "text").write.partitionBy("name").text(path)
    return files.source_files(spark, path).select(F.regexp_extract("path", "name=([0-9a-f]+)/", 1).alias("name"), F.md5("text").alias("text"))


@query("SELECT pos, path, md5(text) AS text FROM (SELECT row_number() OVER (ORDER BY path) - 1 AS pos, path, text FROM contract_sources) WHERE pos < 5")
def s_dataset(spark: SparkSession, d: str) -> DataFrame:
    """A dataset file of JSON records and the first five of them."""
    path = _folder(spark, "dataset")
    rows = table(spark, d, "contract_sources").select(F.struct("path", "text").alias("r")).agg(F.to_json(F.array_sort(F.collect_list("r"))).alias("value"))
    rows.coalesce(1).write.text(path)
    read = files.dataset(spark, path, "array<struct<path:string,text:string>>")
    return evaluation.first_records(read, 5).select(F.col("pos").cast("bigint").alias("pos"), "path", F.md5("text").alias("text"))


@query(f"SELECT attempt, history_id, md5(spec_snapshot) AS spec FROM ({_HISTORY}) WHERE attempt IS NOT NULL")
def s_spec_files(spark: SparkSession, d: str) -> DataFrame:
    """Snapshots written a folder per attempt, in two runs, and read back."""
    path = _folder(spark, "specs")
    rows = _history(spark, d).where("attempt is not null").select("attempt", "history_id", "spec_snapshot")
    for half in (0, 1):
        files.write_specs(rows.where(F.pmod("history_id", F.lit(2)) == half), path)
    return spark.read.parquet(path).select(F.col("attempt").cast("int").alias("attempt"), "history_id", F.md5("spec_snapshot").alias("spec"))


@query(
    f"""SELECT h.contract_hash, h.run_id, h.attempt, md5(h.spec_snapshot) AS spec, count(DISTINCT k.error) FILTER (k.error <> '') AS errors
        FROM (SELECT *, row_number() OVER () AS row FROM ({_HISTORY})) h LEFT JOIN LATERAL (SELECT {_key('e.error')} AS error FROM (SELECT unnest(h.errors) AS error) e WHERE e.error IS NOT NULL) k ON true
        GROUP BY h.row, 1, 2, 3, 4"""
)
def s_history_appended(spark: SparkSession, d: str) -> DataFrame:
    """The history made new, appended to in two runs with canonical errors, and read back; no time is missing."""
    path = _folder(spark, "history")
    history.ensure_history(spark, path)
    rows = _history(spark, d)
    for half in (0, 1):
        history.append_history(rows.where(F.pmod("history_id", F.lit(2)) == half), path)
    history.ensure_history(spark, path)
    return spark.read.parquet(path).where("created_at is not null").select("contract_hash", "run_id", "attempt", F.md5("spec_snapshot").alias("spec"), F.size("errors").cast("bigint").alias("errors"))


# --- the whole way ------------------------------------------------------------------------------


@query()
def z_prepared(spark: SparkSession, d: str) -> DataFrame:
    """Every record as a project, from its files to what drafting starts from; its parts have SQL of their own above."""
    from vericorpus.plans import pipeline

    rows = pipeline.prepared(_projects(spark, d), closure.entry_files(table(spark, d, "records")))
    return rows.select("project_id", "entry", "contract_name", "contract_hash", F.md5("profile").alias("profile"), F.md5("methods").alias("methods"), F.size("draft_names").alias("functions"))


@query(
    f"""SELECT 3 AS top_k, h.hits, h.total, h.hit_rate, r.passed, r.total AS runs, r.pass_rate FROM
        (SELECT count(*) FILTER (hit) AS hits, count(*) AS total, coalesce(count(*) FILTER (hit) / nullif(count(*), 0), 0.0) AS hit_rate FROM ({_CASES})) h,
        (SELECT count(*) FILTER (lower(status) = 'passed') AS passed, count(*) AS total, count(*) FILTER (lower(status) = 'passed') / count(*) AS pass_rate FROM ({_RUNS})) r"""
)
def z_report(spark: SparkSession, d: str) -> DataFrame:
    from vericorpus.plans import pipeline

    return pipeline.report(table(spark, d, "records"), table(spark, d, "retrieval_results"), _runs(spark, d))
