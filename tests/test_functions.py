"""Text and contract functions on fixtures with values worked out by hand."""

from pyspark.sql import functions as F

from vericorpus.functions import responses, solidity, text

VAULT = """// SPDX-License-Identifier: MIT
pragma solidity ^0.8.0;
import {A} from "./a/A.sol";
import "lib/B.sol";
contract Vault {
    address public immutable owner;
    uint256 public constant LIMIT = 5;
    mapping(address => uint256) public deposits;
    mapping(address => mapping(uint256 => bool)) public seen;
    IERC20 public token;
    Foo[] public list = x;
    modifier onlyOwner() { _; }
    function deposit(uint256 amount, bytes memory data) external payable {}
    function deposit(uint256 amount) public {}
    function balanceOf(address who) external view returns (uint256) { return 1; }
    function hidden(uint a) internal {}
}
contract B { }
"""


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column.alias("x")).first()["x"]


def test_lines_drop_only_the_last_empty_one(spark):
    assert one(spark, text.lines("t"), t="a\r\nb\n\nc\n") == ["a", "b", "", "c"]
    assert one(spark, text.lines("t"), t="") == []
    assert one(spark, text.lines("t"), t=None) is None


def test_first_block_counts_braces(spark):
    block = one(spark, text.first_block("t", r"methods\s*\{"), t="x methods { a { b } c } rest { }")
    assert (block["before"], block["body"], block["after"]) == ("x ", " a { b } c ", " rest { }")
    assert one(spark, text.first_block("t", r"methods\s*\{"), t="methods { open") is None
    assert one(spark, text.first_block("t", r"methods\s*\{"), t="none") is None


def test_paths(spark):
    assert one(spark, text.normal_path("t"), t=r".\a\..\b//c/./d.sol") == "b/c/d.sol"
    assert one(spark, text.normal_path("t"), t="../../x") == "x"
    assert one(spark, text.parent("t"), t="a/b/c.sol") == "a/b"
    assert one(spark, text.parent("t"), t="c.sol") == ""


def test_profile_names_features_and_signatures(spark):
    profile = one(spark, solidity.profile("s", "n"), s=VAULT, n="Vault")
    assert profile.startswith("SOLIDITY CONTRACT: Vault\nFEATURES: erc20, access-control")
    assert "deposit(uint256 amount, bytes memory data), deposit(uint256 amount), balanceOf(address who), hidden(uint a)" in profile
    assert one(spark, solidity.profile("s", "n"), s="", n=None) == "SOLIDITY CONTRACT: TargetContract\nFEATURES: none detected\nFUNCTIONS: none detected"


def test_profile_shows_forty_signatures(spark):
    source = "\n".join(f"function f{k}() external {{}}" for k in range(45))
    assert one(spark, solidity.profile("s", "n"), s=source, n="X").count("()") == 40


def test_declarations(spark):
    names = [e["name"] for e in one(spark, solidity.declarations("s"), s=VAULT)]
    assert names == ["owner", "LIMIT", "token", "list", "deposits", "seen", "deposit", "balanceOf"]
    texts = {e["name"]: e["text"].strip() for e in one(spark, solidity.declarations("s"), s=VAULT)}
    assert texts["seen"] == "function seen(address,uint256) external returns (bool) envfree;"
    assert texts["list"] == "function list() external returns (Foo[]) envfree;"
    assert texts["deposit"] == "function deposit(uint256,bytes) external;"
    assert texts["balanceOf"] == "function balanceOf(address) external returns (uint256);"


def test_declarations_with_the_known_quirks(spark):
    texts = {e["name"]: e["text"].strip() for e in one(spark, solidity.declarations("s", strict_parity=True), s=VAULT)}
    assert "immutable" in texts and "owner" not in texts
    assert texts["balanceOf"] == "function balanceOf(address) external;"


def test_names(spark):
    assert one(spark, solidity.contract_name("s", F.lit("B")), s=VAULT) == "B"
    assert one(spark, solidity.contract_name("s", F.lit("Other")), s=VAULT) == "Vault"
    assert one(spark, solidity.contract_name("s", F.lit("Other")), s="library L {}") == "Other"
    assert one(spark, solidity.contract_name("s", F.lit("Other")), s="abstract contract Only {}") == "Only"
    assert one(spark, solidity.draftable_names("s"), s=VAULT) == ["deposit", "deposit", "balanceOf"]
    assert one(spark, solidity.imports("s"), s=VAULT) == ["./a/A.sol", "lib/B.sol"]
    assert one(spark, solidity.public_mappings("s"), s=VAULT) == ["deposits", "seen"]
    deep = "mapping(a => mapping(b => mapping(c => d))) public deep; mapping(a => b) private no;"
    assert one(spark, solidity.public_mappings("s"), s=deep) == ["deep"]


def test_analysis(spark):
    assert one(spark, solidity.family("s"), s=VAULT) == "erc20-like"
    assert one(spark, solidity.family("s"), s="contract X { address boss; }") == "generic"
    assert one(spark, solidity.risk_signals("s"), s="x.delegatecall(y); uint supply;") == ["supply_management", "external_calls"]
    assert one(spark, solidity.modifier_names("s"), s=VAULT) == ["onlyOwner"]
    assert one(spark, solidity.state_variables("s"), s="uint256 a = 1;\n// int b;\nfunction f(uint c) {}\n  bool d;\nuint256 a;") == ["a", "d"]


def test_index_documents_round_trip(spark):
    document = solidity.index_document(F.lit("PROFILE"), F.col("t"))
    assert one(spark, solidity.spec_chunk(document), t="  rule r { }\n") == "rule r { }"
    assert one(spark, solidity.spec_chunk("t"), t=" plain ") == "plain"
    assert one(spark, solidity.spec_chunk("t"), t="P" + solidity.INDEX_SEPARATOR + "  ") == ("P" + solidity.INDEX_SEPARATOR).strip()


def test_responses(spark):
    raw = "<think>no methods { }</think>prose\n```cvl\n// note\nmethods { }\nrule a { }\n```\nmore"
    assert one(spark, responses.spec_of_response("t"), t=raw) == "methods { }\nrule a { }"
    assert one(spark, responses.spec_of_response("t"), t="  using A as a;  ") == "using A as a;"
    assert one(spark, responses.section("t"), t="a ```cvl x ``` b") == "x"
    assert one(spark, responses.section("t"), t="a ```cvl x ") == " x "
    assert one(spark, responses.section("t"), t="none") == "none"
    parts = one(spark, responses.property_sections("t"), t="SECTION 1: a SECTION 2: b")
    assert (parts["overview"], parts["specification"]) == ("a", "b")
    assert one(spark, responses.property_sections("t"), t="x")["overview"] is None
    hits = F.array(F.struct(F.lit("C").alias("contract_name"), F.lit("f.spec").alias("spec_filename"), F.lit(0.5).alias("score"), F.lit(" d ").alias("document")))
    assert one(spark, responses.reference_block(hits), t="") == "--- Reference Example 1 | Contract: C | Spec File: f.spec (Similarity: 0.5000) ---\nd\n"
    assert one(spark, responses.reference_block(F.slice(hits, 1, 0)), t="") == "No reference spec chunks retrieved."
    assert one(spark, responses.known_error_block(F.array(*(F.lit(str(k)) for k in range(30)))), t="").count("\n") == 19


def test_full_prompt_and_hints(spark):
    hits = "array(named_struct('contract_name', 'A', 'spec_filename', 'a.spec', 'score', 0.9D, 'document', 'd'))"
    row = spark.range(1).selectExpr("'contract T {}' s", "cast(null as string) n", "'methods {}' m", f"{hits} h", "transform(sequence(1, 30), x -> concat('e', x, '.')) e", "'Owner' o")
    got = row.select(responses.full_prompt("s", "n", "m", "h", "e").alias("p"), responses.full_prompt("s", "n", "m", "h", F.array().cast("array<string>")).alias("q"), solidity.property_hints("o").alias("o"), solidity.property_hints("m").alias("g")).first()
    assert got["p"].startswith("CONTRACT: TargetContract\ncontract T {}") and "- e20." in got["p"] and "e21." not in got["p"] and "KNOWN ERRORS" not in got["q"]
    assert len(got["o"]) == 2 and len(got["g"]) == 1
