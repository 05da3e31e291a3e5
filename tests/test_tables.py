"""History, search, evaluation, graphs, manifests and sources."""

import datetime as dt
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from vericorpus.operators import closure, evaluation, history, manifest, search
from vericorpus.sources import files


def key(spark, message, **options):
    return spark.createDataFrame([(message,)], "m string").select(history.error_key("m", **options).alias("k")).first()["k"]


def test_error_keys(spark):
    assert key(spark, "Line 189 `invariant foo() {` -> Error: Bad thing.") == "bad thing"
    assert key(spark, "Line 189 `invariant foo() {` -> Error: Bad thing.", strict_parity=True) == "… -> error: bad thing"
    assert key(spark, "Rule `grantAdmin` uses `x[1]`;") == "rule uses …"
    assert key(spark, "ERROR:  at line 7  twice  ") == "at twice"
    assert key(spark, 'could not type expression "f(a)", message: Missing env') == "missing env"
    assert key(spark, "Variable `ghostX` has not been declared").startswith("variable has not been declared — declare all")
    assert key(spark, "  ") == "" and key(spark, None) is None


def test_distinct_keys_keep_the_first(spark):
    row = spark.createDataFrame([(["B line 1", None, "a", "b line 2", " "],), (None,)], "e array<string>").select(history.distinct_keys("e").alias("k")).collect()
    assert row[0]["k"] == ["b", "a"] and row[1]["k"] == []


def test_known_errors_read_the_latest_rows(spark):
    at = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=n)
    rows = [("c", "r", n, [f"e{n % 60}", "same"], at(n)) for n in range(60)] + [("d", "r", 0, None, None), ("d", "s", 1, ["x"], None)]
    frame = spark.createDataFrame(rows, "contract_hash string, run_id string, attempt int, errors array<string>, created_at timestamp")
    got = {}
    for r in history.known_errors(frame).orderBy("ord").collect():
        got.setdefault(r["contract_hash"], []).append(r["error"])
    assert got["c"][:3] == ["e59", "same", "e58"] and len(got["c"]) == 51
    assert got["d"] == ["x"]


def test_history_table(spark, tmp_path):
    path = str(tmp_path / "history")
    history.ensure_history(spark, path)
    history.ensure_history(spark, path)
    rows = spark.createDataFrame([("c", "r", 1, "spec", ["A line 3", "a line 4"], None)], history.SCHEMA)
    history.append_history(rows, path)
    history.append_history(rows, path)
    back = spark.read.parquet(path)
    assert back.count() == 2 and back.first()["errors"] == ["a"] and back.where("created_at is null").count() == 0


def test_changes_and_recurrence(spark):
    rows = [(1, "c", "r", 0, "s", ["a"]), (2, "c", "r", 1, "s", ["a", "b"]), (3, "c", "r", 2, "t", ["b"]), (4, "c", "q", 0, None, None)]
    frame = spark.createDataFrame(rows, "history_id int, contract_hash string, run_id string, attempt int, spec_snapshot string, errors array<string>")
    assert {r["history_id"]: r["unchanged"] for r in history.changes(frame).collect()} == {1: False, 2: True, 3: False, 4: False}
    assert {(r["attempt"], r["error"]): r["recurring"] for r in history.recurring(frame).collect()} == {(0, "a"): False, (1, "a"): True, (1, "b"): False, (2, "b"): True}


def test_search_against_brute_force(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(60, 8))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    frame = spark.createDataFrame([(k, [float(x) for x in v]) for k, v in enumerate(vectors)] + [(99, None), (None, [0.0] * 8)], "vec_id long, embedding array<float>").repartition(3)
    queries = frame.where("vec_id % 7 = 0")
    got = search.nearest(frame, queries, 3, block=4).collect()
    singles = vectors.astype(np.float32).astype(float)
    for q in range(0, 60, 7):
        expected = sorted(range(60), key=lambda v: (-round(1 - ((singles[q] - singles[v]) ** 2).sum() / 2, 9), v))[:3]
        assert [r["vec_id"] for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])] == expected
    assert search.nearest(frame, queries, 0).count() == 9 * 3
    assert search.nearest(frame, queries, 2, skip_self=True).where("vec_id = query_id").count() == 0
    assert search.nearest(frame, queries.where("false")).count() == 0
    assert search.nearest(frame.where("false"), queries).count() == 0
    assert search.above_floor(search.nearest(frame, queries, 3), 0.999).count() == 9


def test_metadata_takes_precedence(spark):
    row = spark.sql("select 'doc' d, 0.5D s, map('score', '0.9', 'contract_name', 'C') m").select(search.hit_struct("d", "s", "m").alias("h")).first()["h"]
    assert (row["document"], row["score"], row["contract_name"]) == ("doc", 0.9, "C")


def test_rates(spark):
    pairs = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "id string")
    retrieved = spark.createDataFrame([("a", 1, "a"), ("a", 1, "a"), ("b", 1, None), ("b", 2, "a")], "query_id string, rank int, pair_id string")
    cases = evaluation.hit_cases(pairs, retrieved)
    assert {r["pair_id"]: (r["hit"], r["retrieved_pair_ids"]) for r in cases.collect()} == {"a": (True, ["a"]), "b": (False, [None, "a"])}
    assert tuple(evaluation.hit_rate(cases).first()) == (1, 2, 0.5)
    assert tuple(evaluation.hit_rate(cases.where("false")).first()) == (0, 0, 0.0)


def test_runs(spark):
    frame = spark.createDataFrame([("PASSED", "ok"), ("skipped", None), ("unverified", "CERTORAKEY missing"), ("failed", "x"), (None, "solc not found")], "status string, output string")
    rows = frame.select(evaluation.exit_code("status").alias("c"), evaluation.environment_error("output").alias("e")).collect()
    assert [r["c"] for r in rows] == [0, 0, 2, 1, 1] and [r["e"] for r in rows] == [False, False, True, False, True]


def test_closure_with_a_cycle_and_missing_files(spark):
    rows = [
        ("p", "src/A.sol", 'import "./B.sol"; import "lib/C.sol"; import "./none.sol";'),
        ("p", "src\\B.sol", 'import "../src/A.sol";'),
        ("p", "deps/c/C.sol", "// import \"./D.sol\";"),
        ("p", "deps/c/D.sol", None),
        ("q", "src/B.sol", ""),
    ]
    project = spark.createDataFrame(rows, "project_id string, path string, text string")
    text = spark.createDataFrame([("p", "lib/=deps/c # first\nli=wrong\nlib/x=other\n=none\nnothing")], "project_id string, text string")
    mapping = closure.remappings(text)
    assert [(r["prefix"], r["target"]) for r in mapping.orderBy("ord").collect()] == [("lib/", "deps/c"), ("li", "wrong"), ("lib/x", "other")]
    edges = closure.import_edges(project, mapping)
    reached = closure.import_closure(edges, spark.createDataFrame([("p", "src/A.sol")], "project_id string, path string"))
    assert {(r["path"], r["depth"]) for r in reached.collect()} == {("src/A.sol", 0), ("src/B.sol", 1), ("deps/c/C.sol", 1), ("deps/c/D.sol", 2)}
    assert closure.missing_imports(edges, reached).first()["missing"] == ["./none.sol"]
    joined = closure.project_text(reached, project).first()
    assert joined["sources"] == ["src/A.sol", "deps/c/C.sol", "src/B.sol", "deps/c/D.sol"] and joined["source_text"].startswith("// SOURCE: src/A.sol\nimport")


def test_manifests(spark):
    frame = spark.createDataFrame([("a/x", "é"), ("a/.hidden", "y"), ("b", "")], "path string, text string")
    rows = {r["path"]: r for r in manifest.entries(frame, "text").collect()}
    assert set(rows) == {"a/x", "b"} and rows["a/x"]["size"] == 2
    assert rows["b"]["checksum"] == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    made = manifest.manifest(frame, "1", "text").first()
    assert (made["file_count"], made["total_size"], [f["path"] for f in made["files"]]) == (2, 2, ["a/x", "b"])
    expected = spark.createDataFrame([("a/x", "0"), ("gone", "1")], "path string, checksum string")
    assert {r["path"]: r["status"] for r in manifest.compared(expected, frame, "text").collect()} == {"a/x": "mismatch", "gone": "missing", "b": "extra"}


def test_sources_and_sinks(spark, tmp_path):
    os.makedirs(tmp_path / "src" / "sub")
    (tmp_path / "src" / "a.sol").write_bytes(b"ok \xff end\n")
    (tmp_path / "src" / "sub" / "b.sol").write_text("two\nlines")
    texts = {os.path.basename(r["path"]): r["text"] for r in files.source_files(spark, str(tmp_path / "src")).collect()}
    assert texts == {"a.sol": "ok � end\n", "b.sol": "two\nlines"}
    assert files.binary_files(spark, str(tmp_path / "src")).count() == 2
    (tmp_path / "d.json").write_text(json.dumps([{"id": "1", "contracts": [{"clean_source": "x", "relative_path": "p"}], "specs": []}, {"id": "2"}]))
    data = files.dataset(spark, str(tmp_path / "d.json"))
    assert [(r["pos"], r["id"]) for r in data.orderBy("pos").collect()] == [(0, "1"), (1, "2")]
    assert evaluation.first_records(data, 1).count() == 1
    with pytest.raises(ValueError):
        evaluation.first_records(data, -1)
    paths = evaluation.pair_paths(data).orderBy("id").collect()
    assert paths[0]["contract_path"] == "p" and paths[0]["spec_path"] is None and paths[1]["contract_path"] is None
    files.write_report(spark.range(1).select(F.lit(1).alias("a")), str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).first()["a"] == 1
    files.write_specs(spark.createDataFrame([("s", 2)], "spec string, attempt int"), str(tmp_path / "specs"))
    assert (tmp_path / "specs" / "attempt=2").is_dir()
    with pytest.raises(Exception):
        files.index(spark, str(tmp_path / "none")).count()
