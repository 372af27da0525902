"""Reading query plans."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """What ``explain`` would print."""
    printed = io.StringIO()
    with contextlib.redirect_stdout(printed):
        df.explain(mode=mode)
    return printed.getvalue()


def exchanges(df: DataFrame) -> list[str]:
    """Partitionings of the exchanges in the plan as it stands before it runs."""
    return re.findall(r"Exchange (\w+partitioning\([^)]*\)|SinglePartition)", plan_text(df, "simple"))


def operators(df: DataFrame) -> list[str]:
    """Names of the physical operators, from the root down."""
    return re.findall(r"^[\s:+\-*]*(?:\(\d+\) )?([A-Z]\w+)", plan_text(df, "simple"), re.M)
