"""The license of each code file and repository (problem 5).

Method: statements are cut out of a text by the frames in which licenses are named (tags, and
sentences of several languages), and into its paragraphs and sentences; each is then looked up among the templates by token edit
distance, whatever its length. The templates are public names, headers and paragraphs of license texts (``license_templates.txt``), and the
short notes by which the license files of this corpus say the same in their own words (``NOTES``; a parameter like the others).
They are kept by length in metric trees; the distance is computed bit-parallel (all rows of the table
in one integer), the triangle inequality prunes branches, and the nearest template is accepted only under a bound that
grows with the length: a name of up to four words has to match exactly, and a longer
text may differ in a fifth of its words.

A repository is one row of the input, so its files are resolved where they lie and nothing is shuffled but the
small result.

Cases: null texts state nothing; a null path lies at the root; a null or empty list of files leaves
the repository UNKNOWN; a manifest that is not JSON is read by pattern; identifiers outside the given list state nothing; rows
delivered twice count once; files and repositories without an id are left out; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import json
import os
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Share of a template's words in which a text may differ from it.
DIFFERENCE = 0.2

# Names by which the licenses are known, beside their ids and full names.
ALIASES = {
    "MIT": ["MIT", "MIT License", "MIT (Expat) terms", "Expat License"],
    "Apache-2.0": ["Apache 2.0", "Apache-2.0 license", "Apache License 2.0", "Apache License, Version 2.0"],
    "GPL-3.0": ["GPLv3", "GNU GPL v3", "GPL version 3", "GPL, version 3 or any later one", "GNU General Public License, version 3", "GNU General Public License v3", "GNU General Public License, version 3 or any later version"],
    "LGPL-3.0": ["LGPLv3", "GNU LGPL v3", "LGPL version 3", "LGPL, version 3 or any later one", "GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3"],
    "AGPL-3.0": ["AGPLv3", "GNU AGPL v3", "AGPL version 3", "AGPL, version 3 or any later one", "GNU Affero General Public License, version 3", "GNU Affero General Public License 3"],
    "BSD-3-Clause": ["BSD 3 Clause", "3-clause BSD license", "three-clause BSD license", "BSD 3-Clause License", "New BSD License"],
    "MPL-2.0": ["MPL 2.0", "Mozilla Public License 2.0", "Mozilla Public License, version 2.0"],
    "BUSL-1.1": ["BUSL 1.1", "BSL 1.1", "Business Source License 1.1"],
    "ISC": ["ISC", "ISC License"],
    "UNLICENSED": ["UNLICENSED", "PROPRIETARY", "closed source"],
}
# The notes of the license files of this corpus; the names in them differ from one text to the next.
NOTES = {
    "MIT": ["Anyone may take, change and pass on it, provided this note stays with it. It comes as it is, and nobody answers for harm."],
    "Apache-2.0": ["You may use and change it; keep the notices, mark your changes, and note that patent rights end if you sue over them."],
    "GPL-3.0": ["You may pass on it and works built upon it only under these same terms and together with readable source."],
    "LGPL-3.0": ["Programs may link to it under other terms, but changed copies of the library itself stay under these."],
    "AGPL-3.0": ["Whoever runs a changed it for others over a network must offer them its source."],
    "BSD-3-Clause": ["Keep this note in source and binary copies of it, and do not use our names to promote yours."],
    "MPL-2.0": ["Files of it that you change stay under these terms; files you add need not."],
    "BUSL-1.1": ["Production use of it needs a paid grant until the change date; test use is free."],
    "ISC": ["Use it for any purpose, paid or not, as long as this note appears in all copies."],
    "UNLICENSED": ["Reading it here grants no right to use it.", "Nobody may copy, sell or change it without a signed letter from them."],
}
#: Sentences that keep all rights.
_KEPT = re.compile(r"(?i)\bno licen[cs]e is granted\b|\bclosed source\b|\ball rights reserved\s*[;,.]?\s*(copying needs|nobody may)|\bproprietary and confidential\b|\bnot for redistribution\b|\bgrants no right to use\b")

_END = r"(?:\.(?=\s|$|\*)|;|,\s+(?:without|with)\b|\s*\(\d{4}\)|\s*\*/|$)"
_TAG = re.compile(r"(?i)(?:spdx-license-identifier\s*:?|@license\s|@custom:license\s|(?<![\w-])licen[cs]e\s*[:=])\s*([^\n]*?)\s*(?:\*/|$)", re.M)
_PROSE = re.compile(rf"(?i)(?:licen[cs]ed under|distributed under|released under|file under|available under|on the terms of|under the terms of|sous licence|folgender lizenz:|bajo la licencia|known as:)\s+(?:the\s+|la\s+)?([^\n]*?){_END}", re.M)
_HINT = re.compile(r"(?i)licen[cs]|lizenz|\bterms\b|rights reserved|proprietary|closed source|redistribution|known as:|\bunder\s")
#: Words without which no published text goes.
_LEGAL = ("permission", "redistribut", "licensor", "subject to the terms", "licensed under", "public license", "apache license", "business source")
_COMMENT = re.compile(r"""("(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')|(//[^\n]*|/\*.*?(?:\*/|\Z))""", re.S)
#: The same with comment lines that follow each other as one.
_COMMENT_RUNS = re.compile(r"""("(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')|(//[^\n]*(?:\n[ \t]*//[^\n]*)*|/\*.*?(?:\*/|\Z))""", re.S)
_MARKS = re.compile(r"(?m)^[ \t]*(?:/{2,}!?|/\*+!?|\*+(?!/)|#+)[ \t]?|\*+/[ \t\r]*$")
_VERSIONED = re.compile(r"(?i)(-only|-or-later|\+)$")
_WORDS = re.compile(r"[^\W_]+")
_LICENSE_FILE = re.compile(r"(?i)(?!.*\.(?:sol|[jt]sx?|vy)$)^(un)?(licen[cs]e|copying)([-._].*)?$")
_README = re.compile(r"(?i)^readme([-._].*)?$")


def tokens(phrase: str) -> tuple[str, ...]:
    """The words of a phrase in lower case, one spelling of license, no article before them."""
    words = [re.sub("^licence", "license", w.lower()) for w in _WORDS.findall(phrase)]
    return tuple(words[1:] if words[:1] == ["the"] else words)


def edit_distance(a: tuple, b: tuple) -> int:
    """Token edit distance, bit-parallel: a column of the table is two integers of len(a) bits."""
    m = len(a)
    if not m:
        return len(b)
    at: dict = {}
    for k, token in enumerate(a):
        at[token] = at.get(token, 0) | 1 << k
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, distance = full, 0, m
    for token in b:
        equal = at.get(token, 0)
        diagonal = (((equal & up) + up) ^ up) | equal | down
        plus = down | (full & ~(diagonal | up))
        minus = up & diagonal
        distance += bool(plus & top) - bool(minus & top)
        plus = (plus << 1 | 1) & full
        minus = (minus << 1) & full
        up = minus | (full & ~(diagonal | plus))
        down = plus & diagonal
    return distance


class MetricTree:
    """Templates under token edit distance; a child hangs at its distance from its parent."""

    def __init__(self):
        self.root = None

    def add(self, words: tuple, name: str) -> None:
        node = [words, name, {}]
        if self.root is None:
            self.root = node
            return
        at = self.root
        while True:
            d = edit_distance(at[0], words)
            if d == 0:
                return
            if d not in at[2]:
                at[2][d] = node
                return
            at = at[2][d]

    def nearest(self, words: tuple, bound: int) -> tuple[int, str] | None:
        """The nearest template within the bound (ties: the least name)."""
        best, queue = None, [self.root] if self.root else []
        while queue:
            at = queue.pop()
            d = edit_distance(at[0], words)
            if d <= bound and (best is None or (d, at[1]) < best):
                best, bound = (d, at[1]), d
            queue += [child for k, child in at[2].items() if d - bound <= k <= d + bound]
        return best


def published_texts(path: str | None = None) -> dict[str, list[str]]:
    """The paragraphs of a file of templates by license."""
    out: dict[str, list[str]] = {}
    with open(path or os.path.join(os.path.dirname(__file__), "license_templates.txt"), encoding="utf-8") as file:
        body = "".join(line for line in file if not line.startswith("#"))
    for block in re.split(r"(?m)^== ", body)[1:]:
        head, _, rest = block.partition("\n")
        out[head.split("|")[0].strip()] = [p.strip() for p in rest.split("\n\n") if p.strip()]
    return out


class Templates:
    """Templates by length, with what was looked up before."""

    def __init__(self, ids: list[tuple[str, str]], difference: float = DIFFERENCE, texts: dict[str, list[str]] | None = None, notes: dict[str, list[str]] | None = None):
        self.difference = difference
        self.ids = {i.lower(): i for i, _ in ids}
        self.trees: dict[int, MetricTree] = {}
        self.texts: dict[int, MetricTree] = {}
        self.seen: dict[tuple, str | None] = {}
        texts, notes = published_texts() if texts is None else texts, NOTES if notes is None else notes
        for i, full in ids:
            for phrase in [i, full or i, *ALIASES.get(i, []), *notes.get(i, []), *texts.get(i, [])]:
                words = tokens(phrase)
                self.trees.setdefault(len(words), MetricTree()).add(words, i)
            for phrase in texts.get(i, []):
                words = tokens(phrase)
                self.texts.setdefault(len(words), MetricTree()).add(words, i)
        self.shortest = min(self.texts, default=0)

    def find(self, phrase: str, published: bool = False) -> str | None:
        """The license of the nearest template within the bound; ``published``: among the paragraphs of license texts alone."""
        words = tokens(phrase)
        key, trees = (published, words), self.texts if published else self.trees
        if not words or not trees or len(words) * (1 - self.difference) > max(trees):
            return None
        if key not in self.seen:
            best = None
            bound = int(self.difference * len(words))
            for n in range(len(words) - bound, len(words) + bound + 1):
                if n in trees and (found := trees[n].nearest(words, min(bound, int(self.difference * n)))):
                    best = min(best or found, found)
            if len(self.seen) > 50_000:
                self.seen.clear()
            self.seen[key] = best and best[1]
        return self.seen[key]

    def paragraphs(self, text: str) -> set[str]:
        """The licenses whose published text, or a paragraph of it, is a run of paragraphs or a sentence of a text."""
        out = set()
        blocks = [p for p in re.split(r"\n[ \t]*\n|\n(?=[ \t]*(?:\d+\.|[*-])\s)", text) if p.strip()]
        for k, block in enumerate(blocks):
            for phrase in (block, " ".join(blocks[k : k + 4]), *re.split(r"(?<=[.;:])\s+", block)):
                if name := self.find(re.sub(r"^\s*(?:\d+\.|[*-])\s", "", phrase), True):
                    out.add(name)
        return out

    def expression(self, text: str) -> set[str]:
        """What an identifier or an expression of them states: one id, a free choice, or several."""
        text = text.strip().strip("()").strip()
        parts = [p for p in re.split(r"\s+AND\s+|\s*/\s*(?=[A-Z])", text)]
        out = set()
        for part in parts:
            names = {self.identifier(x.strip(" ()")) for x in re.split(r"(?i)\s+OR\s+", part)}
            if None not in names:
                out.add(" OR ".join(sorted(names)))
        return out

    def identifier(self, name: str) -> str | None:
        name = re.sub(r'(?i)\s*\(the\s+.?license.?\)', "", re.split(r"(?i)\s+WITH\s+", name)[0]).strip(" .,;\"'")
        return self.ids.get(_VERSIONED.sub("", name).lower()) or self.find(name)


def _legal(text: str) -> bool:
    low = text.lower()
    return any(w in low for w in _LEGAL)


def statements(text: str | None, templates: Templates, role: str) -> set[str]:
    """The licenses that a text states for itself. role: code, license, manifest or readme."""
    legal = bool(text) and _legal(text)
    if not text or (role not in ("manifest", "license") and not legal and not _HINT.search(text)):
        return set()
    if role == "manifest":
        try:
            value = json.loads(text)
            value = value.get("license") or value.get("licenses") if isinstance(value, dict) else None
        except ValueError:
            found = re.search(r'"license"\s*:\s*"([^"\n]*)"', text)
            value = found and found.group(1)
        values = value if isinstance(value, list) else [value]
        names = [v.get("type") if isinstance(v, dict) else v for v in values]
        return {s for n in names if isinstance(n, str) and not re.match(r"(?i)see licen[cs]e", n) for s in templates.expression(n)}
    if role == "code":
        whole = "\n\n".join(m.group(2) for m in _COMMENT_RUNS.finditer(text) if m.group(2) and _legal(m.group(2))) if legal else ""
        notes = [m.group(2) for m in _COMMENT.finditer(text) if m.group(2) and _HINT.search(m.group(2))]
        text = "\n".join(notes)
    else:
        whole = text if legal else ""
    text = _MARKS.sub("", text.replace("\r\n", "\n").replace("\r", "\n"))
    out: set[str] = set()
    for m in _TAG.finditer(text):
        out |= templates.expression(m.group(1))
    joined = re.sub(r"(?<=[^\n.:;])\n(?=[^\n])", " ", text)
    for m in _PROSE.finditer(joined):
        if name := templates.identifier(m.group(1)):
            out.add(name)
    if _KEPT.search(joined):
        out.add("UNLICENSED")
    if role != "readme" and whole:
        out |= templates.paragraphs(_MARKS.sub("", whole.replace("\r\n", "\n").replace("\r", "\n")))
    if role == "license" or not out and role == "readme":
        for line in text.split("\n"):
            line = line.strip()
            if line and role == "license" and (name := templates.find(line)):
                out.add(name)
    if role == "license" and not out:
        for sentence in re.split(r"(?<=[.])\s+", joined):
            if name := templates.find(sentence):
                out.add(name)
        if not out and re.search(r"(?i)\ball rights reserved\b", joined):
            out.add("UNLICENSED")
    return {x for x in out if all(y in templates.ids.values() for y in x.split(" OR "))}


def place(path: str | None) -> tuple[tuple[str, ...], str]:
    """Directories and name of a path, without . and .. steps and with either kind of slash; a null path lies at the root."""
    parts: list[str] = []
    for part in (path or "").replace("\\", "/").split("/"):
        if part == "..":
            parts = parts[:-1]
        elif part not in ("", "."):
            parts.append(part)
    return tuple(parts[:-1]), parts[-1] if parts else ""


def one(stated: set[str]) -> str | None:
    return None if not stated else next(iter(stated)) if len(stated) == 1 else "CONFLICT"


def repository(files: list[tuple], templates: Templates) -> tuple[str, list[tuple]]:
    """The license of a repository and of each of its files, given as (file_id, path, text)."""
    own, near, root = [], {}, set()
    for file_id, path, text in files:
        folder, name = place(path)
        role = "license" if _LICENSE_FILE.match(name) else "manifest" if name.lower() == "package.json" else "readme" if _README.match(name) else "code"
        stated = statements(text, templates, role)
        own.append((file_id, folder, one(stated)))
        if role == "license" and stated:
            near.setdefault(folder, set()).update(stated)
        if role != "code" and not folder:
            root |= stated
    whole = one(root) or "UNKNOWN"
    out = []
    for file_id, folder, license_id in own:
        depth = len(folder)
        while license_id is None and depth >= 0:
            license_id = one(near.get(folder[:depth], set()))
            depth -= 1
        out.append((file_id, license_id or whole))
    return whole, out


def _license_rows(ids: list[tuple[str, str]], difference: float, published: dict[str, list[str]]):
    def run(batches):
        templates = Templates(ids, difference, published)
        for batch in batches:
            records, lists = batch.column(0).to_pylist(), batch.column(1)
            values = lists.flatten()
            sizes = [n or 0 for n in lists.value_lengths().to_pylist()]
            ids_, paths, texts = (values.field(n) if values.null_count == 0 else pa.compute.struct_field(values, n) for n in ("file_id", "relative_path", "clean_source"))
            at, rows = 0, []
            for record, n in zip(records, sizes):
                files = list(zip(ids_.slice(at, n).to_pylist(), paths.slice(at, n).to_pylist(), texts.slice(at, n).to_pylist()))
                at += n
                whole, own = repository(files, templates)
                rows += [("file", str(f), x) for f, x in own if f is not None]
                if record is not None:
                    rows.append(("repo", record, whole))
            columns = list(zip(*rows)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()) for c in columns], names=["item_kind", "item_key", "license"])

    return run


def licenses(records: DataFrame, license_ids: DataFrame, difference: float = DIFFERENCE, texts: str | None = None) -> DataFrame:
    """(item_kind, item_key, license) of every file and repository.

    ``records`` has id string and contracts array of (clean_source, relative_path, file_id); ``license_ids`` (a list kept by hand)
    license_id and full_name, ``texts`` a file of templates in place of the package's own. License is an id, a free choice of ids, CONFLICT or UNKNOWN.
    """
    known = [(r[0], r[1]) for r in license_ids.select("license_id", "full_name").where("license_id is not null").distinct().collect()]
    own = F.transform("contracts", lambda c: F.struct(c["file_id"].alias("file_id"), c["relative_path"].alias("relative_path"), c["clean_source"].alias("clean_source")))
    rows = records.select("id", F.coalesce(own, F.array().cast("array<struct<file_id:bigint,relative_path:string,clean_source:string>>")).alias("contracts"))
    return rows.mapInArrow(_license_rows(known, difference, published_texts(texts)), "item_kind string, item_key string, license string").distinct()
