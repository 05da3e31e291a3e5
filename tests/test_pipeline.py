"""The way from files to specifications, boundary adapters and settings."""

from pyspark.sql import functions as F

from vericorpus import config
from vericorpus.plans import pipeline
from vericorpus.sources import boundary

TOKEN = "import \"./Base.sol\";\ncontract Token is Base {\n    uint256 public total;\n    function mint(uint256 a) external {}\n}\n"


def test_from_files_to_a_specification(spark):
    files = spark.createDataFrame([("p", "src/Token.sol", TOKEN), ("p", "src/Base.sol", "import 'x';\ncontract Base { address public owner; }")], "project_id string, path string, text string")
    entries = spark.createDataFrame([("p", "src/Token.sol")], "project_id string, path string")
    first = pipeline.prepared(files, entries).first()
    assert first["sources"] == ["src/Token.sol", "src/Base.sol"] and first["missing"] == ["x"] and first["contract_name"] == "Token" and first["draft_names"] == ["mint"]
    known = spark.createDataFrame([(first["contract_hash"], 0, "bad")], "contract_hash string, ord int, error string")
    projects = pipeline.prepared(files, entries, known=known)
    asked = pipeline.prompts(projects)
    assert [r["function_name"] for r in asked.orderBy("ord").collect()] == ["mint", "__cross_cutting__"]
    assert "KNOWN ERRORS:\n- bad" in asked.orderBy("ord").first()["prompt"]
    drafts = boundary.drafted(asked, lambda prompt: "```cvl\nusing T as t;\nrule r() {\n  assert total > 0;\n  assert owner() != address(0);\n}\n```" if "mint" in prompt else 1 / 0)
    made = pipeline.assembled(drafts, projects).first()
    assert "assert total() > 0;" in made["spec"] and "0x0" in made["spec"] and made["spec"].startswith("methods {") and [f["category"] for f in made["findings"]] == []


def test_validation_and_feedback(spark):
    specs = spark.createDataFrame([("r", 0, "c", "line one\nline two"), ("s", 0, "c", "x"), ("t", 0, "c", "y")], "run_id string, attempt int, contract string, spec string")

    def verify(contract, spec):
        if spec == "x":
            raise TimeoutError("late")
        if spec == "y":
            raise OSError("solc not found")
        return "failed", ["v"], "Error in spec file (a:2): Variable `e` has not been declared", 1

    runs = boundary.validated(specs, verify)
    assert {r["run_id"]: r["status"] for r in runs.collect()} == {"r": "failed", "s": "timed_out", "t": "unavailable"}
    lines = pipeline.feedback(runs.join(specs.select("run_id", "spec"), "run_id"))
    assert [r["text"] for r in lines.where("run_id = 'r'").orderBy("sub").collect()][0].startswith("Line 2 `line two`")
    seen = lines.where("sub = 0").selectExpr("run_id", "'variable has not been declared' as error")
    assert pipeline.feedback(runs.join(specs.select("run_id", "spec"), "run_id"), seen).where("recurring").count() == 0
    ahead = pipeline.open_runs(runs.withColumn("finished_at", F.current_timestamp()))
    assert {r["run_id"] for r in ahead.collect()} == {"r", "s"}
    assert pipeline.open_runs(runs.withColumn("finished_at", F.current_timestamp()), 1).count() == 0


def test_report(spark):
    pairs = spark.createDataFrame([("a",), ("b",)], "id string")
    retrieved = spark.createDataFrame([("a", 1, "a"), ("b", 4, "b")], "query_id string, rank int, pair_id string")
    results = spark.createDataFrame([("passed",), ("failed",)], "status string")
    row = pipeline.report(pairs, retrieved, results).first()
    assert (row["hits"], row["total"], row["hit_rate"], row["passed"], row["runs"], row["pass_rate"]) == (1, 2, 0.5, 1, 2, 0.5)


def test_settings(tmp_path):
    assert config.settings({}) == config.Settings()
    assert config.settings({"VERICORPUS_TOP_K": "5", "VERICORPUS_FLOOR": "0.5", "VERICORPUS_INDEX_PATH": ""}) == config.Settings(top_k=5, floor=0.5)
    assert config.first_existing([str(tmp_path / "no"), str(tmp_path)], "d") == str(tmp_path)
    assert config.first_existing([], "d") == "d"
