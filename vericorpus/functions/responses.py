"""Column functions over drafters' responses and prompts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vericorpus.functions.text import col, strip


def spec_of_response(response) -> Column:
    """The specification in a response: reasoning dropped, the first untagged or cvl fence, from the first anchor on."""
    plain = F.regexp_replace(F.regexp_replace(col(response), r"(?s)<think>.*?</think>", ""), r"(?s)<reasoning>.*?</reasoning>", "")
    fenced = r"(?s)```(?:cvl)?\s*\n(.*?)```"
    content = F.when(plain.rlike(fenced), F.regexp_extract(plain, fenced, 1)).otherwise(plain)
    anchored = F.regexp_extract(content, r"(?s)\b(?:methods\s*\{|import\s|using\s).*", 0)
    return strip(F.when(anchored != "", anchored).otherwise(content))


def section(content, marker: str = "```cvl") -> Column:
    """What stands between a marker and the next fence: all if there is no marker, the unstripped rest if it is not closed."""
    content = col(content)
    at = F.locate(marker, content)
    rest = F.substring(content, at + len(marker), F.length(content))
    end = F.locate("```", rest)
    return F.when(at == 0, content).when(end == 0, rest).otherwise(strip(F.substring(rest, F.lit(1), end - 1)))


def property_sections(content) -> Column:
    """The two numbered sections of a response and the response itself; a missing section is null."""
    content = col(content)
    one, two = F.locate("SECTION 1:", content), F.locate("SECTION 2:", content)
    first = F.substring(content, one + 10, F.when(two > 0, two - one - 10).otherwise(F.length(content)))
    return F.struct(
        F.when(one > 0, strip(first)).alias("overview"),
        F.when(two > 0, strip(F.substring(content, two + 10, F.length(content)))).alias("specification"),
        content.alias("raw"),
    )


def reference_block(hits) -> Column:
    """Retrieved hits (an array of contract_name, spec_filename, score, document) as numbered examples."""
    shown = F.transform(
        col(hits),
        lambda h, i: F.format_string(
            "--- Reference Example %d | Contract: %s | Spec File: %s (Similarity: %.4f) ---\n%s\n",
            i + 1, F.coalesce(h["contract_name"], F.lit("Unknown Contract")), F.coalesce(h["spec_filename"], F.lit("spec.spec")), F.coalesce(h["score"], F.lit(0.0)), strip(F.coalesce(h["document"], F.lit(""))),
        ),
    )
    return F.when(F.size(shown) > 0, F.array_join(shown, "\n")).otherwise(F.lit("No reference spec chunks retrieved."))


def known_error_block(errors, most: int = 20) -> Column:
    """The first known errors as a list for a prompt; empty without any."""
    kept = F.slice(F.coalesce(col(errors), F.array().cast("array<string>")), 1, most)
    return F.when(F.size(kept) > 0, F.concat(F.lit("- "), F.array_join(kept, "\n- "))).otherwise(F.lit(""))


def function_prompt(function, methods, hits, errors) -> Column:
    """A prompt for one function's rules, as data: nothing is sent from here."""
    known = known_error_block(errors, 10)
    return F.concat(
        F.lit("FUNCTION: "), col(function), F.lit("\n\nMETHODS:\n"), col(methods), F.lit("\n\nREFERENCES:\n"), reference_block(hits),
        F.when(known != "", F.concat(F.lit("\n\nKNOWN ERRORS:\n"), known)).otherwise(F.lit("")),
    )


def full_prompt(source, name, methods, hits, errors) -> Column:
    """The prompt for a whole specification in one call, as data; it shows the first twenty known errors."""
    known = known_error_block(errors, 20)
    return F.concat(
        F.lit("CONTRACT: "), F.coalesce(col(name), F.lit("TargetContract")), F.lit("\n"), col(source), F.lit("\n\nMETHODS:\n"), col(methods), F.lit("\n\nREFERENCES:\n"), reference_block(hits),
        F.when(known != "", F.concat(F.lit("\n\nKNOWN ERRORS:\n"), known)).otherwise(F.lit("")),
    )


def annotated_feedback(issues, known_keys, key) -> Column:
    """Feedback lines, those whose normalized key was seen before marked as recurring."""
    def line(issue: Column) -> Column:
        k = key(issue)
        return F.concat(F.lit("- "), issue, F.when((k != "") & F.array_contains(col(known_keys), k), F.lit("  [RECURRING]")).otherwise(F.lit("")))

    return F.array_join(F.transform(col(issues), line), "\n")
