"""Column functions over text: lines, balanced blocks, paths. All are built-in expressions; identifiers are ASCII."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def lines(text) -> Column:
    """The lines of a text without their ends; a final line end gives no further line. Null gives null."""
    parts = F.split(col(text), "\\R")
    return F.when(F.size(parts) > 0, F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))).otherwise(parts)).otherwise(parts)


def strip(text) -> Column:
    """A text without white space at either end."""
    return F.regexp_replace(col(text), r"^\s+|\s+\z", "")


def find_all(text, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(col(text), F.lit(pattern), F.lit(group))


def matches(text, pattern: str) -> Column:
    return col(text).rlike(pattern)


def any_of(text, words) -> Column:
    """Whether a text contains any of some words."""
    return F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(col(text), w))


def distinct_by_first(entries: Column, key) -> Column:
    """Entries (structs) without those whose key an earlier entry has; order is kept."""
    empty = F.slice(entries, 1, 0)
    return F.aggregate(entries, empty, lambda acc, e: F.when(F.exists(acc, lambda x: key(x) == key(e)), acc).otherwise(F.concat(acc, F.array(e))))


def first_block(text, head: str) -> Column:
    """The braced block behind the first match of ``head`` (a pattern that ends with the opening brace).

    A struct of before (text before the match), body (between the braces) and after (text behind the closing brace); null if there
    is no match or the block is not closed. Braces are counted over the pieces between braces, so the work is linear.
    """
    text = col(text)
    found = F.regexp_extract(text, head, 0)
    start = F.position(found, text)  # first occurrence of the first match is the match
    rest = F.substring(text, start + F.length(found), F.length(text))
    state = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("length"))

    def step(acc: Column, piece: Column) -> Column:
        last = F.right(piece, F.lit(1))
        move = F.when(last == "{", 1).when(last == "}", -1).otherwise(0)
        return F.when(acc["depth"] == 0, acc).otherwise(F.struct((acc["depth"] + move).alias("depth"), (acc["length"] + F.length(piece)).alias("length")))

    end = F.aggregate(F.split(rest, r"(?<=[{}])"), state, step)
    block = F.struct(
        F.substring(text, F.lit(1), start - 1).alias("before"),
        F.substring(rest, F.lit(1), end["length"] - 1).alias("body"),
        F.substring(rest, end["length"] + 1, F.length(rest)).alias("after"),
    )
    return F.when((found != "") & (end["depth"] == 0), block)


def after_first(text, head: str) -> Column:
    """What stands behind the first match of a pattern, or the whole text."""
    text = col(text)
    found = F.regexp_extract(text, head, 0)
    return F.when(found != "", F.substring(text, F.position(found, text) + F.length(found), F.length(text))).otherwise(text)


def with_matches(text, pattern: str, change) -> Column:
    """A text with every match of a pattern (none empty) changed by ``change(match, k)``, k counting from 0; what stands between stays."""
    between, found = F.split(col(text), pattern), find_all(text, pattern)
    changed = F.zip_with(F.transform(found, change), F.slice(between, 2, F.greatest(F.size(between) - 1, F.lit(0))), lambda m, t: F.concat(m, t))
    return F.concat(F.get(between, 0), F.array_join(changed, ""))


def pieces(text, head: str) -> Column:
    """A text cut before every match of a pattern (none empty); the pieces joined give the text."""
    between, found = F.split(col(text), head), find_all(text, head)
    tails = F.slice(between, 2, F.greatest(F.size(between) - 1, F.lit(0)))
    return F.concat(F.slice(between, 1, 1), F.zip_with(found, tails, lambda m, t: F.concat(m, t)))


def normal_path(path) -> Column:
    """A path with forward slashes and without . and .. steps."""
    steps = F.split(F.regexp_replace(col(path), r"\\", "/"), "/")
    empty = F.slice(steps, 1, 0)
    folded = F.aggregate(
        steps,
        empty,
        lambda acc, s: F.when((s == "") | (s == "."), acc)
        .when((s == "..") & (F.size(acc) > 0), F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(s == "..", acc)
        .otherwise(F.concat(acc, F.array(s))),
    )
    return F.array_join(folded, "/")


def parent(path) -> Column:
    """The directory of a normal path, empty at the root."""
    return F.regexp_replace(col(path), r"/?[^/]*$", "")
