"""Plan inspection for tests and tuning: what did Catalyst make of a frame?"""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def physical_plan(df: DataFrame) -> str:
    """Only the physical plan section of the extended explain."""
    text = plan_text(df, "extended")
    marker = "== Physical Plan =="
    return text[text.index(marker):] if marker in text else text


def count_exchanges(df: DataFrame) -> int:
    """Number of shuffle exchanges in the physical plan (broadcasts excluded)."""
    return len(re.findall(r"(?<![A-Za-z])Exchange\b", physical_plan(df)))


def pushed_filters(df: DataFrame) -> list[str]:
    """The ``PushedFilters`` list of every scan in the plan (bracket contents, nesting kept)."""
    return re.findall(r"PushedFilters: \[(.*)\]\s*$", plan_text(df, "formatted"), flags=re.M)


def read_schemas(df: DataFrame) -> list[str]:
    """The ``ReadSchema`` of every scan in the plan."""
    return re.findall(r"ReadSchema: (struct<[^\n]*>)", plan_text(df, "formatted"))
