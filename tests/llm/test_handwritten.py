import random

from vericorpus.llm import handwritten as hw

BODY = "contract Pool {{\n    uint256 private total{0};\n\n    /// @notice ids here are generated by the gate, not by the pool\n    function take{0}(uint256 amount) external {{\n        require(amount <= total{0}, \"too much\");\n        total{0} -= amount;\n        emit Taken{0}(msg.sender, amount);\n    }}\n}}\n"


def third_party(seed):
    rng = random.Random(seed)
    lines = [f"    function step{rng.randrange(10**6)}(uint256 a) public pure returns (uint256) {{ return a * {rng.randrange(10**6)}; }}" for _ in range(40)]
    return "pragma solidity ^0.8.0;\n\ncontract Lib {\n" + "\n".join(lines) + "\n}\n"


def test_composition():
    assert hw.composition(BODY.format(1)) is None
    assert hw.composition(None) is None and hw.composition("") is None and hw.composition(" \n") is None
    for note in (
        "// Code generated by abigen 1.2. DO NOT EDIT.", "// <auto-generated />", "/* @generated by tool - changes will be lost */", "//////// AUTOGENERATED: run `x emit` ////////",
        "// THIS FILE WAS AUTO-GENERATED ON 2022-01-01 BY x-cli", "// produced mechanically from A.json", "/* Output of press v0.9; edit the template A.tmpl instead. */",
        "// Fichier généré par x 0.2, ne pas modifier", "// 本文件由 x 自动生成，请勿修改", "// built from A.yaml (x 2.3); manual edits get overwritten", "// @@codegen x@2.2 sha=1", "// Diese Datei wurde maschinell von x erzeugt.",
    ):
        assert hw.composition(note + "\n" + BODY.format(1)) == "generated", note
    for note in ("// do not edit the pool while a stake is pending", "// auto-compounding of the pool happens in the gate", "// third-party pools reach this through the gate", "// ids here are generated by the gate"):
        assert hw.composition(note + "\n" + BODY.format(1)) is None, note
    assert hw.composition("contract A{uint256 a;" + "function b(uint256 c)external{a=c;}" * 60 + "}") == "minified"
    assert hw.composition('export const x = "data:image/png;base64,' + "a//b+C9" * 300 + '";\n') == "data"
    assert hw.composition("[" + ",".join('{"name":"a","type":"b"}' for _ in range(60)) + "]") == "data"
    assert hw.composition("const a = [\n" + "  123, 456, 789,\n" * 30 + "];\n") == "data"
    assert hw.composition("library D {\n    bytes constant X =\n" + '        hex"00112233"\n' * 9 + "    ;\n}\n") == "data"
    assert hw.composition("library C {\n" + "".join(f"    uint256 internal constant N_{k:04d} = {k * 77};\n" for k in range(30)) + "}\n") == "data"
    assert hw.composition("library T {\n function at(uint x) {\n" + "".join(f"  if (x == {k}) return 0x{k:x}ff;\n" for k in range(30)) + " }\n}\n") == "data"
    bare = "interface I {\n" + "".join(f"    function f{chr(97 + k)}(uint256 a) external returns (bool b);\n" for k in range(12)) + "}\n"
    assert hw.composition(bare) == "generated"
    assert hw.composition("/// @notice what it is for\n" + bare) is None
    assert hw.composition("// File: a/A.sol\npragma solidity ^0.8.0;\ncontract A { }\n// File: a/B.sol\npragma solidity ^0.8.0;\ncontract B { }\n") == "generated"


def test_origin():
    packages = frozenset(hw.package_key(p) for p in ("basic-lib", "@scope/contracts"))
    assert hw.origin("node_modules/@scope/contracts/a/X.sol", "", packages) == "scope-contracts"
    assert hw.origin("vendor/basic-lib-1.2.3/X.sol", "", packages) == "basic-lib"
    assert hw.origin("deps/basic-lib@1.2.3/contracts/X.sol", "", packages) == "basic-lib"
    assert hw.origin("contracts\\external\\scope-contracts\\X.sol", "", packages) == "scope-contracts"
    assert hw.origin("contracts/vendor/VendorPool.sol", BODY.format(1), packages) is None
    assert hw.origin(None, "// Vendored from @scope/contracts v1.2 (a/X.sol)", packages) == "scope-contracts"
    assert hw.origin("src/X.sol", "// upstream: basic-lib, tag 4.5", packages) == "basic-lib"
    assert hw.origin("src/X.sol", "// follows the interface of basic-lib (x)", packages) is None


def test_operator(spark):
    lib, other = third_party(1), third_party(2)
    edited = lib.replace("contract Lib", "contract Ours").replace("* ", "+ ", 3)
    half = "\n".join(lib.split("\n")[:16]) + "\n" + "\n".join(third_party(3).split("\n")[3:40])
    rows = [
        (1, "node_modules/basic-lib/Lib.sol", lib, "x"), (1, "node_modules/basic-lib/Lib.sol", lib, "x"), (2, "src/Renamed.sol", edited, "x"), (3, None, lib, "x"), (4, "src/Half.sol", half, "x"),
        (5, "src/A.sol", BODY.format(1), "x"), (6, "src/B.sol", BODY.format(2), "x"), (7, "src/N.sol", None, "x"), (8, "LICENSE", lib, "x"), (9, "readme.md", "// <auto-generated />", "x"),
        (10, "src/M.js", "var a=1;" * 500, "x"), (None, "src/M.js", "var a=1;" * 500, "x"), (11, "src/Other.sol", other, "x"), (12, "sub/package.json", "[" + "1," * 900, "x"),
    ]
    files = spark.createDataFrame(rows, "file_id bigint, relative_path string, clean_source string, kind string")
    packages = spark.createDataFrame([("basic-lib",), (None,)], "package string")
    got = {r["file_id"]: r["kind"] for r in hw.not_handwritten(files, packages).collect()}
    assert got == {1: "vendored", 2: "vendored", 3: "vendored", 10: "minified"}
    assert hw.not_handwritten(files.where("false"), packages).count() == 0
    assert {r["file_id"] for r in hw.not_handwritten(files, packages.where("false")).collect()} == {1, 2, 3, 10}


def test_widely_renamed_files(spark):
    lib, other = third_party(1), third_party(2)
    names = ("Lib", "LibV2", "FlatLib", "LibCopy", "OurLib")
    rows = [(k, f"node_modules/basic-lib/{n}.sol", lib + f"\nuint256 constant MARK_OF_{n} = {k};\n" * (k % 2)) for k, n in enumerate(names)]
    half = "\n".join(lib.split("\n")[:28]) + "\n" + "\n".join(third_party(3).split("\n")[3:24])
    less = "\n".join(lib.split("\n")[:18]) + "\n" + "\n".join(third_party(4).split("\n")[3:40])
    rows += [(10, "src/Mine.sol", lib.replace("contract Lib", "contract Ours")), (11, "src/Half.sol", half), (12, "src/Less.sol", less), (13, "src/Other.sol", other)]
    files = spark.createDataFrame(rows, "file_id bigint, relative_path string, clean_source string")
    got = {r["file_id"]: r["containment"] for r in hw.not_handwritten(files, spark.createDataFrame([("basic-lib",)], "package string")).collect()}
    assert set(got) == {0, 1, 2, 3, 4, 10, 11} and got[10] == 1.0 and 0.5 <= got[11] < 0.7


def test_notes_stand_anywhere():
    license_text = "".join(f"// line {k} of a license that takes many lines before anything else is said\n" for k in range(60))
    code = BODY.format(1)
    for text in (license_text + "// @generated\n" + code, "/*\n" + license_text.replace("//", " ") + "   DO NOT EDIT.\n*/\n" + code, code + "\n// Code generated by abigen 1.2. DO NOT EDIT.\n"):
        assert hw.composition(text) == "generated"
    assert hw.composition(license_text + code * 9 + "// do not edit the pool while a stake is pending\n") is None
    packages = frozenset({"basic-lib"})
    assert hw.origin("src/X.sol", license_text + "// Copied from other-lib v1.2\n" + code, packages) == "other-lib"
    assert hw.origin("src/X.sol", code * 20 + "\n// Copied from basic-lib v1.2\n", packages) == "basic-lib"
    assert hw.origin("src/X.sol", code * 20 + "\n// this function was copied from basic-lib v1.2\n", packages) is None
    assert hw.origin("src/X.sol", code * 20 + "\n// the share taken from bucket 3\n", packages) is None
