"""Plan inspection used by tests and bench (``explain`` text only)."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def physical_plan(df: DataFrame) -> str:
    """Final physical plan (with AQE off in the caller, the plan that runs)."""
    return plan_text(df, "simple")
