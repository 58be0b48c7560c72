"""Settings of a pipeline: defaults, then a JSON file, then the environment; checked before a run."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field, fields

_TRUE = ("true", "1", "yes", "on")
# fixed values: the environment variables that override a setting
ENVIRONMENT = {"REQUEST_DELAY": "request_delay", "MAX_RETRIES": "max_retries", "DATABASE_URL": "database", "LOG_LEVEL": "log_level", "OUTPUT_DIR": "output_dir"}


@dataclass
class Settings:
    request_delay: float = 1.0
    max_retries: int = 3
    timeout: float = 30.0
    max_us_trials: int = 1000
    max_eu_pages: int = 10
    database: str = "trials"
    output_dir: str = "output"
    log_level: str = "INFO"
    export_csv: bool = True
    export_json: bool = True
    deduplicate_trials: bool = True
    unknown: dict = field(default_factory=dict)

    def errors(self) -> list[str]:
        """What is wrong: negative or non-numeric numbers, flags that are none; empty if all is well."""
        out = []
        for f in fields(self):
            v = getattr(self, f.name)
            if f.type == "bool" and not isinstance(v, bool) or f.type in ("int", "float") and (isinstance(v, bool) or not isinstance(v, (int, float)) or v < 0):
                out.append(f"invalid value for {f.name}: {v!r}")
        return out


def _typed(kind: str, text: str) -> object:
    if kind == "bool":
        return text.strip().lower() in _TRUE
    try:
        return int(text) if kind == "int" else float(text) if kind == "float" else text
    except ValueError:
        return text  # reported by errors()


def load_settings(file: str | None = None, environment: Mapping[str, str] | None = None) -> Settings:
    """Settings with those of a JSON file over the defaults and those of the environment over both; unknown keys of the file are kept apart."""
    kinds = {f.name: f.type for f in fields(Settings)}
    given: dict = {}
    if file:
        with open(file, encoding="utf-8") as f:
            given = json.load(f)
    s = Settings(**{k: v for k, v in given.items() if k in kinds}, **({"unknown": {k: v for k, v in given.items() if k not in kinds}}))
    for variable, name in ENVIRONMENT.items():
        if environment and variable in environment:
            setattr(s, name, _typed(kinds[name], environment[variable]))
    return s
