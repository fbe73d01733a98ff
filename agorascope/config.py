"""Settings as nested dictionaries."""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable
from pathlib import Path

DEFAULTS: dict = {
    "embedding": {"batch": 32, "max_tokens": 512, "overlap": 50},
    "requests": {"input_tokens": 100_000, "batches": 100, "comments_per_batch": 4, "pause": 0.0},
    "ingest": {"min_score": None, "min_comments": None, "recent_days": None, "top_n": None, "refresh_days": 7},
}


def merged(base: dict, more: dict | None) -> dict:
    """Values of more over those of base, dictionary by dictionary."""
    out = dict(base)
    for k, v in (more or {}).items():
        out[k] = merged(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def read(path: str) -> dict:
    """A file of settings: JSON, or YAML where a parser for it is installed. A missing file, or one of another kind, is an error."""
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as e:
            raise ValueError(f"{path}: no YAML parser is installed; use JSON") from e
        found = yaml.safe_load(text) or {}
    else:
        found = json.loads(text)
    if not isinstance(found, dict):
        raise ValueError(f"{path}: settings must be a dictionary")
    return found


def load(path: str | None = None, required: bool = False) -> dict:
    """Defaults with a file's values over them. No path, or a missing file that is not required, changes nothing."""
    if not path or not (required or Path(path).exists()):
        return merged(DEFAULTS, None)
    return merged(DEFAULTS, read(path))


def credential(settings: dict, keys: tuple[str, ...], variable: str, environment: dict[str, str] | None = None) -> str | None:
    """A secret from the environment, or else from nested settings; null if neither has it."""
    value: object = (os.environ if environment is None else environment).get(variable)
    if not value:
        value = settings
        for k in keys:
            value = value.get(k) if isinstance(value, dict) else None
    return str(value) if value else None


def paced(model: Callable[[str], str], seconds: float) -> Callable[[str], str]:
    """A model that waits between two calls of a worker."""
    last = [0.0]

    def call(prompt: str) -> str:
        time.sleep(max(0.0, last[0] + seconds - time.monotonic()))
        last[0] = time.monotonic()
        return model(prompt)

    return call


class Pace:
    """When the calls of one task may begin, so that `tasks` tasks together make at most `rate` a second.

    Each task has its share of the rate; the first call of task k comes k shares of a turn late, so tasks do not call in step. A
    service that says how long to wait (`Busy`) moves the next call by that, and nothing is saved up meanwhile."""

    def __init__(self, rate: float, tasks: int, task: int, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.turn, self.clock, self.sleep = max(1, tasks) / rate, clock, sleep
        self.next = clock() + task / rate

    def wait(self) -> None:
        self.sleep(max(0.0, self.next - self.clock()))
        self.next = max(self.next, self.clock()) + self.turn

    def hold(self, seconds: float) -> None:
        self.next = max(self.next, self.clock() + seconds)


class Busy(OSError):
    """A service asks to be left alone for some seconds."""

    def __init__(self, message: str, seconds: float):
        super().__init__(message)
        self.seconds = seconds
