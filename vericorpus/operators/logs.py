"""Verifier logs: lines matched to specification lines and to suggestions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vericorpus.functions.text import lines, strip

_LOCATED = r"Error in spec file \([^:]+:(\d+)(?::\d+)?\):\s*(.*)"

# Parts of messages and what helps, the first that occurs counts.
SUGGESTIONS = (
    ("unexpected token near `(", "Function calls must have a single argument list. Rewrite `f(x)(e, y)` as `f(x, e, y);`."),
    ("require` in `require(", "Remove parentheses around condition. Write `require condition;` not `require(condition);`."),
    ("Variable `e` has not been declared", "Add `env e;` as the first statement in the rule/invariant that uses `e`."),
    ("sum()", "Do not use `sum()` on raw mappings. Use a ghost variable with a hook instead."),
    ("before` / `after` keywords", "Do not use `before` / `after` keywords in CVL."),
    ("old(`", "Do not use `old(...)` or `@old` in CVL."),
)


def suggestion(message: Column) -> Column:
    """The suggestion of the first part that a message contains, or null. A few fixed rules, so an expression and no join."""
    out = F.lit(None).cast("string")
    for part, text in reversed(SUGGESTIONS):
        out = F.when(F.contains(message, F.lit(part)), F.lit(text)).otherwise(out)
    return out


def enriched(runs: DataFrame) -> DataFrame:
    """(keys..., ord, sub, text): the feedback lines of each run's output.

    ``runs`` has output and spec beside its keys. A located error gives its line's text and, where one fits, a suggestion;
    other syntax, type and name errors are passed on. A run without any of these gives its lines that are neither blank nor warnings.
    The line of the specification is looked up in the row itself, so nothing is shuffled.
    """
    keys = [c for c in runs.columns if c not in ("output", "spec")]
    spec_lines = F.coalesce(lines("spec"), F.array().cast("array<string>"))
    rows = runs.withColumn("_spec", spec_lines).withColumn("_lines", F.filter(F.coalesce(lines("output"), F.array().cast("array<string>")), lambda x: strip(x) != ""))

    def feedback(raw: Column) -> Column:
        line = strip(raw)
        number = F.regexp_extract(line, _LOCATED, 1).try_cast("int")
        message = F.regexp_extract(line, _LOCATED, 2)
        code = F.when((number > 0) & (number <= F.size("_spec")), strip(F.get(F.col("_spec"), number - 1))).otherwise(F.lit(""))
        located = F.array_compact(F.array(F.format_string("Line %d `%s` -> Error: %s", number, code, message), F.concat(F.lit("  Suggestion: "), suggestion(message))))
        syntax = F.contains(line, F.lit("Syntax error:")) | F.contains(line, F.lit("TypeError:")) | F.contains(line, F.lit("Undefined"))
        passed = F.array_compact(F.array(line, F.when(F.contains(line, F.lit('unexpected token near `("')), F.lit("  Suggestion: " + SUGGESTIONS[0][1]))))
        unknown = F.contains(line, F.lit("Variable `")) & F.contains(line, F.lit("has not been declared"))
        named = F.array(line, F.lit("  Suggestion: " + SUGGESTIONS[2][1]))
        return F.when(line.rlike(_LOCATED), located).when(syntax, passed).when(unknown, named).otherwise(F.array().cast("array<string>"))

    rows = rows.withColumn("_found", F.transform("_lines", feedback))
    plain = F.transform(F.filter("_lines", lambda x: ~x.startswith("WARNING") & ~x.startswith("Compiling")), lambda x: F.array(x))
    rows = rows.withColumn("_out", F.when(F.exists("_found", lambda x: F.size(x) > 0), F.col("_found")).otherwise(plain))
    return rows.select(*keys, F.posexplode("_out").alias("ord", "_texts")).select(*keys, "ord", F.posexplode("_texts").alias("sub", "text"))
