"""Settings of a job: plain values, overridden from a mapping such as the environment."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields, replace


@dataclass(frozen=True)
class Settings:
    top_k: int = 3
    floor: float = 0.75
    latest_errors: int = 50
    validation_timeout: int = 300
    most_repairs: int = 3
    index_path: str = ""
    history_path: str = ""


def settings(values: Mapping[str, str], prefix: str = "VERICORPUS_") -> Settings:
    """The defaults with the values that are given; each is read as the default's type. An empty value counts as not given."""
    base = Settings()
    given = {f.name: type(getattr(base, f.name))(values[prefix + f.name.upper()]) for f in fields(base) if values.get(prefix + f.name.upper())}
    return replace(base, **given)


def first_existing(candidates: list[str], default: str = "") -> str:
    """The first path that exists, or the default."""
    return next((c for c in candidates if os.path.exists(c)), default)
