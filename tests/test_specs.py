"""Checks, rewrites, merging and logs on specifications written for them."""

from pyspark.sql import functions as F

from vericorpus.operators import lint, logs, merge, rewrite

CONTRACT = "contract T { uint256 public total; mapping(address => uint256) public balances; address public owner; }"
CLEAN = """methods {
    function total() external returns (uint256) envfree;
    function balances(address) external returns (uint256) envfree;
}

rule r(address a) {
    env e;
    require balances(a) > 0;
    assert total() >= balances(a);
}
"""


def categories(spark, spec, contract=CONTRACT):
    rows = lint.exploded(spark.createDataFrame([(1, spec, contract)], "spec_id int, spec string, contract string")).collect()
    return [(r["category"], r["line"]) for r in sorted(rows, key=lambda r: r["ord"])]


def test_a_clean_specification_has_no_finding(spark):
    assert categories(spark, CLEAN) == []


def test_every_check_fires(spark):
    cases = {
        "missing_methods": "rule r() { }",
        "keyword_leak": "methods { function a() external view; }",
        "missing_getter": "methods { }\nrule r { assert owner() == 0; }",
        "forbidden_sum": CLEAN + "invariant s() sum(x) == 0;\n",
        "invariant_shape": CLEAN + "invariant s() old(x) == 0;\n",
        "undeclared_env": CLEAN + "rule q() {\n assert e.msg.sender == 0;\n}\n",
        "mapping_syntax": CLEAN + "rule q { assert balances[a] == 0; }\n",
        "uncalled_getter": CLEAN + "rule q { assert total > 0; }\n",
        "invalid_require": CLEAN + 'rule q { require x > 0, "no"; }\n',
        "invalid_require_invariant": CLEAN + "rule q { requireInvariant a > b; }\n",
        "bare_solidity_env": CLEAN + "rule q { assert msg.sender == x; }\n",
        "invariant_brace_body": CLEAN + "invariant s() { x == 0 }\n",
        "env_in_invariant": CLEAN + "invariant s() e.msg.sender == 0;\n",
        "undeclared_ghost": CLEAN + "rule q { assert ghostSum == 0; }\n",
        "deprecated_sinvoke": CLEAN + "rule q { sinvoke f(); }\n",
        "envfree_with_env": CLEAN + "rule q { assert total(e) == 0; }\n",
        "require_parens": CLEAN + "rule q { require(x > 0); }\n",
        "missing_semicolon": CLEAN + "rule q {\n  assert x > 0\n}\n",
    }
    for category, spec in cases.items():
        found = [c for c, _ in categories(spark, spec)]
        assert category in found, (category, found)


def test_lines_and_negatives(spark):
    assert ("keyword_leak", 2) in categories(spark, "methods {\n function a() external view;\n}")
    assert ("require_parens", 3) in categories(spark, "methods { }\nrule q {\n require(x);\n}")
    for fine in ("e.block.timestamp > 0", "total() > 0"):
        assert categories(spark, CLEAN + "rule q() {\n env e;\n assert " + fine + ";\n}\n") == []
    declared = "ghost mapping(address => uint256) ghostMap;\n" + CLEAN + "rule q { assert ghostMap(a) == 0; }\n"
    assert categories(spark, declared) == []
    assert categories(spark, None) == []
    assert [c for c, _ in categories(spark, "", None)] == ["missing_methods"]


def test_format(spark):
    rows = lint.findings(spark.createDataFrame([("methods { }\nrule q { require(x); }", "")], "spec string, contract string"))
    assert rows.select(lint.formatted("findings").alias("t")).first()["t"].startswith("- [require_parens] ") and "(line 2)" in rows.select(lint.formatted("findings").alias("t")).first()["t"]


def rewritten(spark, step, spec, contract="", methods="methods {\n}"):
    frame = spark.createDataFrame([(spec, contract, methods)], "s string, c string, m string")
    return frame.select(dict(rewrite.STEPS)[step](F.col("s"), F.col("c"), F.col("m")).alias("x")).first()["x"]


def test_rewrites(spark):
    assert rewritten(spark, "invocations", "sinvoke f(); invoke g();") == "f(); g();"
    assert rewritten(spark, "mutability", "function f() external view returns (uint);") == "function f() external returns (uint);"
    assert rewritten(spark, "methods", "a methods { x { y } } b", methods="M") == "a M b"
    assert rewritten(spark, "methods", "no block", methods="M") == "M\n\nno block"
    assert rewritten(spark, "methods", "methods { open", methods="M") == "M\n\nmethods { open"
    assert rewritten(spark, "mappings", "x = balances[a] + other[b];", CONTRACT) == "x = balances(a) + other[b];"
    assert rewritten(spark, "getters", "methods { total }\nassert total > owner();", CONTRACT) == "methods { total }\nassert total() > owner();"
    assert rewritten(spark, "env_declarations", "rule r() {\n  f(e.msg.sender);\n}") == "rule r() {\n    env e;\n\n  f(e.msg.sender);\n}"
    assert rewritten(spark, "env_declarations", "rule r(env e)  {\n  f(e.msg.sender);\n}") == "rule r(env e)  {\n  f(e.msg.sender);\n}"
    assert rewritten(spark, "requires", "requireInvariant a > b; requireInvariant inv(x);") == "require a > b; requireInvariant inv(x);"
    assert rewritten(spark, "env", "rule a { msg.sender; e.msg.value; }\ninvariant i() msg.sender == 0;\nrule b { block.timestamp; }") == "rule a { e.msg.sender; e.msg.value; }\ninvariant i() msg.sender == 0;\nrule b { e.block.timestamp; }"
    assert rewritten(spark, "ghosts", "ghost uint256 ghostA;\nmethods { }\nghostA ghostC ghostB") == "ghost uint256 ghostA;\nghost uint256 ghostB;\nghost uint256 ghostC;\n\nmethods { }\nghostA ghostC ghostB"
    assert rewritten(spark, "env_arguments_dropped", "methods { function f(uint) external envfree; function g() external; }\nf(e, 1); f(e); g(e);") == "methods { function f(uint) external envfree; function g() external; }\nf(1); f(); g(e);"
    assert rewritten(spark, "hooks", "hook Sstore admins(KEY address a) bool v STORAGE {") == "hook Sstore admins[KEY address a] bool v {"
    assert rewritten(spark, "hooks", "hook Sload uint256 v bal(KEY address a) {") == "hook Sload uint256 v bal[KEY address a] {"
    assert rewritten(spark, "zero_address", "a != address( 0 )") == "a != 0x0"
    methods = "methods {\n    function f(uint) external;\n    function g() external envfree;\n}"
    assert rewritten(spark, "env_arguments", "rule r() {\n env e;\n f(1); f(e, 2); g(); f();\n}\nrule q() {\n f(1);\n}", methods=methods) == "rule r(){\n env e;\n f(e, 1); f(e, 2); g(); f(e);\n}\nrule q() {\n f(1);\n}"
    assert rewritten(spark, "env_arguments", "rule r() {\n env e;\n f( e, 2); f( e ); f(\n1 ); h(f(1)); f(e.msg.value); f(env x);\n}", methods=methods) == "rule r(){\n env e;\n f( e, 2); f( e ); f(e, 1); h(f(e, 1)); f(e, e.msg.value); f(env x);\n}"
    assert rewritten(spark, "env_arguments", "rule r() {\n env e;\n f(1);", methods=methods) == "rule r() {\n env e;\n f(1);"
    assert rewritten(spark, "env_declarations", "\u0001\u0002 rule r() {\n  f(e.x);\n}\n\u0001") == "\u0001\u0002 rule r() {\n    env e;\n\n  f(e.x);\n}\n\u0001"
    assert rewritten(spark, "env", "\u0001\nrule a \u0001{ msg.sender; }") == "\u0001\nrule a \u0001{ e.msg.sender; }"
    assert rewritten(spark, "invariants", "invariant i(uint x) { a == b; }\n") == "invariant i(uint x)\n    a == b;\n"
    assert rewritten(spark, "invariants", "invariant i()\n    a == b\nrule r { }") == "invariant i()\n    a == b;\nrule r { }"


def test_rewrites_that_claim_to_be_idempotent(spark):
    for step, spec in (("hooks", "hook Sstore a(KEY address x) uint v STORAGE {"), ("env", "rule r { msg.sender; }"), ("zero_address", "address(0)"), ("invariants", "invariant i() { a }\n")):
        once = rewritten(spark, step, spec)
        assert rewritten(spark, step, once) == once


def test_the_whole_pipeline(spark):
    spec = "methods { }\nrule r() {\n  sinvoke total(e);\n  assert balances[msg.sender] != address(0);\n}\n"
    methods = "methods {\n    function total() external returns (uint256) envfree;\n}"
    frame = spark.createDataFrame([(1, spec, CONTRACT, methods), (2, None, None, None), (3, "", None, None)], "spec_id int, spec string, contract string, methods string")
    out = {r["spec_id"]: r["spec"] for r in rewrite.cleaned(frame).collect()}
    assert out[2] is None and out[3].startswith("methods {")
    assert "total();" in out[1] and "balances(e.msg.sender) != 0x0" in out[1] and "sinvoke" not in out[1]


def test_merge_keeps_the_first_of_a_name(spark):
    fragments = spark.createDataFrame(
        [
            ("p", 0, "ghost mathint g;\nmethods { x }\nrule a { 1 }\ninvariant b() x;"),
            ("p", 1, "we use ghost variables\nghost mathint g;\nrule a { 2 }\nrule c { 3 }"),
            ("q", 0, None),
        ],
        "project_id string, ord int, text string",
    )
    projects = spark.createDataFrame([("p", "M"), ("q", "N")], "project_id string, methods string")
    out = {r["project_id"]: r["spec"] for r in merge.merged(fragments, projects).collect()}
    assert out["p"] == "M\n\nghost mathint g;\n\nrule a { 1 }\n\ninvariant b() x;\n\nrule c { 3 }"
    assert out["q"] == "N\n\n"


def test_top_declarations():
    text = "import \"a\";\nusing B as b;\nwe use ghost variables here\nghost uint x { init_state axiom x == 0; }\nhook Sstore y uint v { x = v; }\n// ghost no;\nrule r { ghost z; }"
    found = merge.top_declarations(text)
    assert found[0] == 'import "a";' and "using B as b;" in found and any(d.startswith("hook Sstore y") for d in found)
    assert not any("variables" in d or "no;" in d or " z" in d for d in found)
    assert merge.top_declarations(None) == []


def test_log_enrichment(spark):
    runs = spark.createDataFrame(
        [
            (1, "noise\nError in spec file (a.spec:2:5): Variable `e` has not been declared\n", "first\n  second  \n"),
            (2, "Error in spec file (a.spec:9): odd", "x"),
            (3, "WARNING x\nplain\n\nCompiling y", None),
            (4, 'Syntax error: unexpected token near `("\nTypeError: bad', ""),
            (5, "Variable `q` has not been declared", ""),
            (6, None, ""),
        ],
        "id int, output string, spec string",
    )
    got = {}
    for r in logs.enriched(runs).orderBy("id", "ord", "sub").collect():
        got.setdefault(r["id"], []).append(r["text"])
    assert got[1] == ["Line 2 `second` -> Error: Variable `e` has not been declared", "  Suggestion: Add `env e;` as the first statement in the rule/invariant that uses `e`."]
    assert got[2] == ["Line 9 `` -> Error: odd"]
    assert got[3] == ["plain"]
    assert len(got[4]) == 3 and got[4][2] == "TypeError: bad"
    assert len(got[5]) == 2
    assert 6 not in got
