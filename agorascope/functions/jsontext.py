"""JSON in and out of model replies."""

from __future__ import annotations

import ast
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

FENCE = re.compile(r"^```[a-zA-Z]*\s*|\s*```$")
KEYS = ("results", "items", "data", "evaluations")


def is_json(text: Column) -> Column:
    return F.try_parse_json(text).isNotNull()


def salvaged(text: Column, opening: str = "[", closing: str = "]") -> Column:
    """The text if it is JSON, else its part from the first opening to the last closing bracket, else null."""
    own = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)^\s+|\s+$", "")
    part = F.regexp_extract(own, rf"(?s)(\{opening}.*\{closing})", 1)
    return F.when((own != "") & is_json(own), own).when((part != "") & is_json(part), part)


def rows_of(text: Column, schema: str) -> Column:
    """The records of a reply: a list, or a list under items or results, or one record."""
    own = salvaged(text)
    own = F.coalesce(own, salvaged(text, "{", "}"))
    wrapped = F.from_json(own, f"items array<{schema}>, results array<{schema}>")
    return F.when(own.startswith("["), F.from_json(own, f"array<{schema}>")).when(own.startswith("{"), F.coalesce(wrapped["items"], wrapped["results"], F.array(F.from_json(own, schema))))


def loose_records(text: str | None) -> list[dict]:
    """Records of a reply that may be fenced, surrounded by prose, wrapped in an object, or a Python literal."""
    own = FENCE.sub("", (text or "").strip()).strip()
    for part in (own, own[own.find("[") : own.rfind("]") + 1], own[own.find("{") : own.rfind("}") + 1]):
        for read in (json.loads, ast.literal_eval):
            try:
                value = read(part)
            except (ValueError, SyntaxError, RecursionError, MemoryError):
                continue
            if isinstance(value, dict):
                value = next((value[k] for k in KEYS if isinstance(value.get(k), list)), [value])
            if isinstance(value, list):
                return [v for v in value if isinstance(v, dict)]
    return []


def loose_json(text: Column) -> Column:
    """loose_records() as a JSON array, by an Arrow function; for replies that salvaged() cannot read."""
    @F.pandas_udf("string")
    def read(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield part.map(lambda t: json.dumps(loose_records(t)))

    return read(text)


def compact(*columns: Column) -> Column:
    return F.to_json(F.struct(*columns))
