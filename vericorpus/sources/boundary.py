"""Boundary tables: what drafting services and verifiers give, and adapters that call them per row.

The engine works on the tables; the adapters are for jobs that want to fill them from Spark. The function is the
caller's, runs in the Python workers, and an exception of it becomes a row of its own and not a failed task.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame

DRAFTS = "project_id string, ord int, function_name string, text string"
VALIDATION_RUNS = "run_id string, attempt int, status string, command array<string>, output string, returncode int"


def drafted(prompts: DataFrame, draft: Callable[[str], str]) -> DataFrame:
    """Drafts of prompts (project_id, ord, function_name, prompt); a failed call gives a null text."""

    def run(batches):
        for pdf in batches:
            texts = []
            for prompt in pdf["prompt"]:
                try:
                    texts.append(draft(prompt))
                except Exception:
                    texts.append(None)
            yield pd.DataFrame({"project_id": pdf["project_id"], "ord": pdf["ord"], "function_name": pdf["function_name"], "text": texts})

    return prompts.select("project_id", "ord", "function_name", "prompt").mapInPandas(run, DRAFTS)


def validated(specs: DataFrame, verify: Callable[[str, str], tuple]) -> DataFrame:
    """Validation runs of specifications (run_id, attempt, contract, spec); ``verify`` gives status, command, output and return code."""

    def run(batches):
        for pdf in batches:
            rows = []
            for run_id, attempt, contract, spec in zip(pdf["run_id"], pdf["attempt"], pdf["contract"], pdf["spec"]):
                try:
                    status, command, output, code = verify(contract, spec)
                except TimeoutError as error:
                    status, command, output, code = "timed_out", [], str(error), None
                except Exception as error:
                    status, command, output, code = "unavailable", [], str(error), None
                rows.append((run_id, attempt, status, command, output, code))
            out = pd.DataFrame(rows, columns=["run_id", "attempt", "status", "command", "output", "returncode"])
            yield out.astype({"returncode": "Int32"})

    return specs.select("run_id", "attempt", "contract", "spec").mapInPandas(run, VALIDATION_RUNS)
