"""Files that nobody wrote by hand: generated, minified, vendored, or data kept as code (problem 1).

Method. Vendored copies: the lines of every file known to come from a third party (its
directory names a known package, or a header says where it was taken from)
form an inverted index of line hashes to origins. A file's rarest lines find the origins that may
hold enough of it (prefix filter), and the exact containment of all its own lines in such an origin decides, in whichever repository
and directory the file lies, so edited and renamed copies are found as well. All other kinds follow from
the composition of a file's own tokens and lines: share of characters in overlong lines, share of lines
of the commonest shape and whether that shape carries literals, declarations without a body or a comment,
joined files, and the notes that generators leave in any comment.

Cases: null and empty texts are hand-written (nothing speaks against them); a null path is a
file without a directory; license files, manifests and readmes are never reported; rows delivered twice
count once; files without an id are left out; empty tables give an empty result; further
columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vericorpus.llm._hashing import Rolling, blocks, code_points
from vericorpus.session import staged

#: Least share of a file's own lines that an origin holds for the file to be a copy of it.
CONTAINED = 0.5
#: Least characters of an indexed line.
LEAST_LINE = 20
#: A line is overlong from here on; a file is minified or a blob if this share of its characters lies in such lines.
OVERLONG, OVERLONG_SHARE = 300, 0.6
#: Share of a file's lines of one shape with a literal from which it is a table of data.
TABLE_SHARE, TABLE_LINES = 0.6, 6

_ASIDE = re.compile(r"(?i)(?!.*\.(?:sol|[jt]sx?|vy)$)^(licen[cs]e|copying|unlicen[cs]e|notice)([-._].*)?$|^package(-lock)?\.json$|^readme([-._].*)?$")

#: Notes of generators, in the languages of the corpus.
_GENERATED = re.compile(
    r"""(?ix)
    \bauto-?\s?generated\b | @generated\b | @@codegen\b | \bcode\ generated\b | \bgenerated\ (by|from|with|on|using)\ +[`'"<]?[\w.-]*(\d|gen|cli|\.\w)
    | \bdo\ not\ (edit|modify)\s*(\.|!|$|\*/|by\ hand|manually|this\ file) | \b(manual|your)\ (edits|changes)\b[^\n]{0,30}\b(overwritten|lost)\b | \bchanges\ will\ be\ lost\b
    | \bedit\ the\ template\b | \b(produced|emitted|created)\ (mechanically|automatically)\b | \boutput\ of\ [\w.-]+\ v?\d
    | \bfichier\ g[ée]n[ée]r[ée]\b | \bne\ pas\ modifier\b | 自动生成 | 自動生成 | \b(automatisch|maschinell)\b[^\n]{0,40}\b(erzeugt|erstellt|generiert)\b | \bgenerado\ autom[aá]ticamente\b | \bno\ (editar|modificar)\b
    """
)
_JOINED = re.compile(r"(?im)^\s*(//|/\*)\s*(sources?\ flattened|file:?\s+\S+\.sol|=+\s*\S+\.sol\s*=+)")
_COMMENT = re.compile(r"""("(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')|//[^\n]*|/\*.*?(?:\*/|\Z)""", re.S)
_LEADING = re.compile(r"(?:\s+|//[^\n]*|/\*.*?(?:\*/|\Z))*+", re.S)
_MARKED = re.compile(r"(?m)^[ \t]*(?:\#|<!--|//|/\*|\*).*")
#: What stands before a note on its line: a comment mark; the part of a file that alone the note is about.
_COMMENTED = re.compile(r"//|/\*|^\s*(\*|#|<!--)")
_PART = re.compile(r"(?i)\b(function|modifier|method|struct|event|error|constant|snippet|formula|logic|algorithm|line|part)s?\b")
_STRING = re.compile(r'"[^"\n]*"?|\'[^\'\n]*\'?')
_NUMBER = re.compile(r"\b(?:0x[0-9a-fA-F]+|\d[\d_]*(?:\.\d+)?(?:e\d+)?)\b")
_NAME = re.compile(r"[A-Za-z_$][\w$]*")
_NUMBERED_ERROR = re.compile(r"\berror \w*[A-Za-z]\d+\(")
#: A declaration without a body in a typed script: a name, parameters, and a type with parameters of its own.
_SIGNATURE = re.compile(r"""["']?[\w$(),\[\]]+["']?\??\s*(?:<[^>]*>)?\([^{}]*\)\s*:\s*[\w.]+<[^{}]*>\s*[;,]$""")
_ORIGIN = re.compile(r"(?i)\b(?:vendored|copied|imported|taken|borrowed)\s+from\s+(@?[\w./-]*\w)[\s,]+v?(?:tag\s*)?\d|\bupstream:\s*(@?[\w./-]*\w)\s*,")


def aside(path: str | None) -> bool:
    """Whether a path is a license file, a manifest or a readme."""
    return bool(path) and bool(_ASIDE.match(path.replace("\\", "/").rsplit("/", 1)[-1]))


def composition(text: str | None) -> str | None:
    """What the composition of a text says it is: generated, minified, data, or nothing."""
    if not text or not text.strip():
        return None
    lines = text.splitlines()
    comments: list[str] = []
    bare = _COMMENT.sub(lambda m: m.group(1) or comments.append(m.group(0)) or " ", text)
    if any(map(_GENERATED.search, comments)) or any(map(_GENERATED.search, _MARKED.findall(text))):
        return "generated"
    overlong = sum(len(line) for line in lines if len(line) >= OVERLONG)
    if overlong >= OVERLONG_SHARE * len(text):
        literals = sum(len(m) for m in _STRING.findall(bare) if len(m) > 200)
        if bare.lstrip()[:1] in "[{" or literals > 0.5 * len(text):
            return "data"
        return "minified" if len(bare) > 0.5 * len(text) else None
    if len(_JOINED.findall(text)) and len(re.findall(r"(?m)^\s*pragma\s+solidity\b", bare)) > 1:
        return "generated"
    code = [line.strip() for line in bare.splitlines() if len(line.strip()) > 1]
    if len(code) >= TABLE_LINES:
        shapes: dict[str, int] = {}
        for line in code:
            shape = _NAME.sub("a", _NUMBER.sub("0", _NUMBERED_NAME.sub("a", _STRING.sub("\u00a7", line))))
            shape = re.sub(r"(?:0,? ?)+", "0", re.sub(r"(?:\u00a7,? ?)+", "\u00a7", shape))
            shapes[shape] = shapes.get(shape, 0) + 1
        shape, most = max(shapes.items(), key=lambda x: x[1])
        if most >= TABLE_SHARE * len(code) and re.search("[0\u00a7]", shape) and not re.search("[{}]", shape):
            return "data"
    declared = sum(line.startswith(("function ", "event ", "error ")) and line.endswith(";") for line in code)
    if declared >= 4 and declared >= 0.7 * len(code) and re.search(r"\binterface\b", bare):
        if len(_NUMBERED_ERROR.findall(bare)) >= 2 or not re.search(r"///|/\*\*(?!\s*\n?\s*\*?[^*]*SPDX)", text):
            return "generated"
    typed = sum(bool(_SIGNATURE.match(line)) for line in code)
    if typed >= 3 and typed >= 0.6 * len(code):
        return "generated"
    return None


_NUMBERED_NAME = re.compile(r"\b[A-Za-z_$]+_?\d+[\w$]*\b")


def package_key(name: str) -> str:
    """A package's name as directories spell it: without @, scope joined by a hyphen."""
    return name.strip().lower().lstrip("@").replace("/", "-")


def origin(path: str | None, text: str | None, packages: frozenset[str]) -> str | None:
    """The third-party package that a file's directory or header names."""
    path = re.sub(r"@([\w-]+)/([\w.-]+)", r"\1-\2", (path or "").replace("\\", "/").lower())
    directories = path.split("/")[:-1]
    for part in directories:
        name = re.sub(r"[-@]v?\d+(\.\w+)*$", "", part)
        if name in packages:
            return name
    if "node_modules" in directories:
        after = directories[directories.index("node_modules") + 1 :]
        if after:
            return after[0]
    text = text or ""
    for found in _ORIGIN.finditer(text):
        name, before = package_key(found.group(1) or found.group(2)), text[text.rfind("\n", 0, found.start()) + 1 : found.start()]
        # behind the header a known package or a version has to be named, and not as the source of a part
        if found.end() <= max(2000, _LEADING.match(text).end()) or (
            _COMMENTED.search(before) and not _PART.search(before) and (name in packages or re.search(r"(?i)(\bv|tag\s*)\d$", found.group(0)))
        ):
            return name
    return None


_FILES = "file_id bigint, kind string, origin string, own_lines int, lines array<bigint>"


def _file_rows(packages: frozenset[str], least_line: int):
    skip = re.compile(r"\s*(import\b|pragma\b|//|/\*|\*)")

    def run(batches):
        for batch in batches:
            ids, paths, texts = (batch.column(k).to_pylist() for k in range(3))
            keep = [k for k in range(len(ids)) if not aside(paths[k])]
            for a, b in blocks([len(texts[k] or "") for k in keep]):
                rows, body, sizes = [], [], []
                for k in keep[a:b]:
                    text = texts[k] or ""
                    come = origin(paths[k], text, packages)
                    kind = "vendored" if come else composition(text)
                    own = [] if kind and not come else [s for s in {x.strip() for x in text.splitlines() if not skip.match(x)} if len(s) >= least_line]
                    base = (paths[k] or "").replace("\\", "/").rsplit("/", 1)[-1].lower()
                    rows.append((ids[k], kind, f"{come}/{base}" if come else None, len(own)))
                    body += own
                    sizes.append(len(own))
                codes, offsets = code_points(body)
                hashes = Rolling(codes).slices(offsets[:-1], offsets[1:]).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), pa.array(hashes))
                columns = list(zip(*rows)) or [[]] * 4
                kinds = (pa.int64(), pa.string(), pa.string(), pa.int32())
                yield pa.RecordBatch.from_arrays([*(pa.array(list(c), t) for c, t in zip(columns, kinds)), lists], names=[x.split()[0] for x in _FILES.split(", ")])

    return run


def not_handwritten(files: DataFrame, packages: DataFrame, contained: float = CONTAINED, least_line: int = LEAST_LINE) -> DataFrame:
    """The files that are generated, minified, vendored or data: file_id, kind, origin (of vendored ones) and containment (measured; null where a path or a note says it).

    ``files`` has file_id bigint, relative_path string and clean_source string, ``packages`` (a list kept by hand) package string.
    """
    spark = files.sparkSession
    known = frozenset(package_key(r[0]) for r in packages.select("package").where("package is not null").distinct().collect())
    seen = staged(
        files.where("file_id is not null").select(F.col("file_id").cast("bigint").alias("file_id"), "relative_path", "clean_source")
        .mapInArrow(_file_rows(known, least_line), _FILES),
        "files",
    )
    lines = seen.where("origin is not null").select("origin", F.explode("lines").alias("line")).distinct()
    # origins of equal line sets are one
    merged = lines.groupBy("origin").agg(F.array_sort(F.collect_list("line")).alias("lines")).groupBy("lines").agg(F.max("origin").alias("origin"))
    index = staged(merged.select("origin", F.explode("lines").alias("line")), "index")
    spread = index.groupBy("line").agg(F.count("*").alias("origins"))
    open_files = seen.where("kind is null and own_lines > 0")
    need = F.ceil(F.lit(contained) * F.col("own_lines")).cast("int")
    # only files of which enough lines have an origin at all; rare lines stand first
    known = staged(
        open_files.select("file_id", "own_lines", F.explode("lines").alias("line")).join(spread, "line")
        .groupBy("file_id").agg(F.max("own_lines").alias("own_lines"), F.array_sort(F.collect_set(F.struct("origins", "line"))).alias("own"))
        .where(F.size("own") >= F.greatest(need, F.lit(1))),
        "known",
    )
    # of any so many lines, one that an origin of enough hits holds is among the rarest size - need + 1
    rarest = known.select("file_id", F.explode(F.slice("own", 1, F.size("own") - F.greatest(need, F.lit(1)) + 1)["line"]).alias("line"))
    candidates = rarest.join(index, "line").select("file_id", "origin").distinct()
    hits = (
        known.select("file_id", "own_lines", F.explode(F.col("own")["line"]).alias("line")).join(candidates, "file_id").join(index, ["origin", "line"])
        .groupBy("file_id", "origin").agg(F.count("*").alias("hits"), F.max("own_lines").alias("own_lines"))
        .where(F.col("hits") >= contained * F.col("own_lines"))
        .groupBy("file_id").agg(F.max(F.struct((F.col("hits") / F.col("own_lines")).alias("containment"), "origin")).alias("best"))
        .select("file_id", F.lit("vendored").alias("kind"), F.col("best.origin").alias("origin"), F.round("best.containment", 6).alias("containment"))
    )
    said = seen.where("kind is not null").select("file_id", "kind", "origin", F.lit(None).cast("double").alias("containment"))
    found = said.unionByName(hits)
    return found.groupBy("file_id").agg(F.min(F.struct("kind", "origin", "containment")).alias("f")).select("file_id", "f.kind", "f.origin", "f.containment")
