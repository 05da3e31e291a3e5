"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vericorpus.llm import handwritten, leakage, licenses, mixing, near_duplicates, sentences, spans, splitting
from vericorpus.sources.tables import contract_files, table


def _not_handwritten(spark: SparkSession, d: str) -> DataFrame:
    return handwritten.not_handwritten(contract_files(table(spark, d, "records")), table(spark, d, "packages"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _not_handwritten(spark, d).select("file_id")


def p1_kinds(spark: SparkSession, d: str) -> DataFrame:
    return _not_handwritten(spark, d)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    pieces = splitting.split_oversized(splitting.splittable_items(table(spark, d, "records")))
    return pieces.where("piece = 1").select("item_kind", "item_id", F.col("item_cut").alias("cut")).distinct()


def p2_pieces(spark: SparkSession, d: str) -> DataFrame:
    pieces = splitting.split_oversized(splitting.splittable_items(table(spark, d, "records")))
    return pieces.select("item_kind", "item_id", "piece", "start_pos", "end_pos", "cut", F.md5("text").alias("text_md5")).distinct()


def _shared(spark: SparkSession, d: str) -> DataFrame:
    return spans.shared_spans(spans.span_items(table(spark, d, "records"), table(spark, d, "error_history")))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _shared(spark, d).select("item_kind", "item_id")


def p3_shared(spark: SparkSession, d: str) -> DataFrame:
    return _shared(spark, d)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    texts = near_duplicates.solidity_texts(table(spark, d, "records"))
    links, classes = near_duplicates.near_duplicate_links(texts)
    pairs = near_duplicates.expand_links(links, classes, texts)
    return pairs.select(F.col("id_a").alias("file_id_a"), F.col("id_b").alias("file_id_b"))


def p4_groups(spark: SparkSession, d: str) -> DataFrame:
    texts = near_duplicates.solidity_texts(table(spark, d, "records"))
    links, classes = near_duplicates.near_duplicate_links(texts)
    return near_duplicates.groups(links, near_duplicates.linked_copies(classes, texts)).select(F.col("id").alias("file_id"), "group_id")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return licenses.licenses(table(spark, d, "records"), table(spark, d, "license_ids"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaks(table(spark, d, "documents"), table(spark, d, "eval_items")).select("doc_id", "item_id")


def p6_matches(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p6_clean(spark: SparkSession, d: str) -> DataFrame:
    return leakage.without_leaks(table(spark, d, "documents"), table(spark, d, "eval_items")).select("doc_id", "n_chars")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))[1].where("missed").select("source")


def p7_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))[0]


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))[1]


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return sentences.sentences(table(spark, d, "documents"))


_LEAKED = r"""
            WITH texts AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL),
                 items AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM eval_items WHERE text IS NOT NULL AND item_id IS NOT NULL),
                 held AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 10), lambda i: array_to_string(w[i:i + 11], ' '))) AS p FROM texts),
                 asked AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 10), lambda i: array_to_string(w[i:i + 11], ' '))) AS p FROM items)
            SELECT DISTINCT doc_id, item_id FROM held JOIN asked USING (p)
        """

_PAIRS = r"""
            WITH files AS (SELECT DISTINCT c.file_id, regexp_extract_all(c.clean_source, '[A-Za-z0-9_]+') AS w FROM (SELECT unnest(contracts) AS c FROM records)
                           WHERE lower(c.relative_path) LIKE '%.sol' AND c.clean_source IS NOT NULL AND c.file_id IS NOT NULL),
                 shingles AS (SELECT DISTINCT file_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM files),
                 sizes AS (SELECT file_id, count(*) AS n FROM shingles GROUP BY 1),
                 shared AS (SELECT a.file_id AS a, b.file_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.file_id < b.file_id GROUP BY 1, 2),
                 pairs AS (SELECT a AS file_id_a, b AS file_id_b FROM shared s JOIN sizes x ON x.file_id = s.a JOIN sizes y ON y.file_id = s.b WHERE s.n >= 0.7 * (x.n + y.n - s.n))
"""


def queries() -> dict:
    return {f.__name__: f for f in (p1_found, p1_kinds, p2_found, p2_pieces, p3_found, p3_shared, p4_found, p4_groups, p5_found, p6_found, p6_matches, p6_clean, p7_found, p7_mix, p7_shares, p8_found)}


def oracle_sql() -> dict[str, str]:
    return {
        "p2_found": """
            WITH items AS (
              SELECT DISTINCT 'file' AS item_kind, c.file_id AS item_id, c.clean_source AS text FROM (SELECT unnest(contracts) AS c FROM records)
              UNION
              SELECT DISTINCT 'spec', s.spec_id, s.text FROM (SELECT unnest(specs) AS s FROM records)
            )
            SELECT item_kind, item_id,
                   CASE WHEN list_max(list_transform(string_split(text, chr(10)), lambda x: length(x))) > 6000 THEN 'forced' ELSE 'natural' END AS cut
            FROM items WHERE length(text) > 6000
        """,
        "p4_found": _PAIRS + " SELECT file_id_a, file_id_b FROM pairs",
        "p4_groups": _PAIRS.replace("WITH files", "WITH RECURSIVE files") + """,
                 edges AS (SELECT file_id_a AS u, file_id_b AS v FROM pairs UNION ALL SELECT file_id_b, file_id_a FROM pairs),
                 walk AS (SELECT u AS file_id, u AS node FROM edges UNION SELECT w.file_id, e.v FROM walk w JOIN edges e ON e.u = w.node)
            SELECT file_id, min(node) AS group_id FROM walk GROUP BY 1""",
        "p6_found": _LEAKED,
        "p6_clean": f"SELECT doc_id, n_chars FROM documents WHERE doc_id IS NULL OR doc_id NOT IN (SELECT doc_id FROM ({_LEAKED}))",
        "p3_found": """
            WITH items AS (SELECT DISTINCT 'file' AS item_kind, c.file_id AS item_id, 'f' || coalesce(id, '') AS owner, c.clean_source AS text FROM (SELECT id, unnest(contracts) AS c FROM records)
                           UNION SELECT DISTINCT 'snapshot', history_id, 's' || coalesce(contract_hash, ''), spec_snapshot FROM error_history),
                 runs AS (SELECT item_kind, item_id, owner, unnest(list_transform(range(1, length(text) - 398), lambda i: hash(substring(text, i, 400)))) AS run FROM items WHERE length(text) >= 400),
                 shared AS (SELECT run FROM runs GROUP BY 1 HAVING min(owner) <> max(owner))
            SELECT DISTINCT item_kind, item_id FROM runs SEMI JOIN shared USING (run) WHERE item_id IS NOT NULL
        """,
    }
