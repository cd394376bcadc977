"""What the physical plan does: scans, joins, shuffles."""

from __future__ import annotations

import io
import re
from contextlib import redirect_stdout
from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class PlanSummary:
    pushed_filters: tuple[str, ...]
    scan_columns: tuple[str, ...]
    joins: tuple[str, ...]
    shuffles: int
    broadcasts: int
    reads_cache: bool
    python_stages: int


def plan_text(df: DataFrame) -> str:
    """The formatted physical plan, as ``explain`` prints it."""
    printed = io.StringIO()
    with redirect_stdout(printed):
        df.explain("formatted")
    return printed.getvalue()


def summarize_plan(df: DataFrame) -> PlanSummary:
    """Summary of the plan before execution. Nodes appear as ``Name (id)`` in the tree."""
    text = plan_text(df)
    filters = re.findall(r"PushedFilters: \[(.*?)\]\n", text)
    schemas = re.findall(r"ReadSchema: struct<(.*?)>\n", text)
    return PlanSummary(
        pushed_filters=tuple(f for line in filters for f in re.findall(r"\w+\([^()]*\)", line)),
        scan_columns=tuple(
            field.split(":")[0] for schema in schemas for field in schema.split(",") if field
        ),
        joins=tuple(re.findall(r"(\w+Join|CartesianProduct)(?: \w+)* \(\d+\)", text)),
        shuffles=len(re.findall(r"(?<!\w)Exchange \(\d+\)", text)),
        broadcasts=len(re.findall(r"BroadcastExchange \(\d+\)", text)),
        reads_cache="InMemoryTableScan" in text,
        python_stages=len(re.findall(r"(?:Python|Pandas|Arrow)\w* \(\d+\)", text)),
    )
