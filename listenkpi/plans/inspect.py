"""Read a DataFrame's physical plan as text, for the plan checks of the tests and the bench."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def count(df: DataFrame, node: str) -> int:
    """Occurrences of a physical operator name in the (simple) plan."""
    return len(re.findall(rf"\b{re.escape(node)}\b", plan_text(df, "simple")))


def python_nodes(df: DataFrame) -> list[str]:
    text = plan_text(df, "simple")
    return [n for n in PYTHON_NODES if n in text]


def read_schemas(df: DataFrame) -> list[str]:
    """The ``ReadSchema`` of every file scan (the columns actually read)."""
    return re.findall(r"ReadSchema: (struct<[^\n]*>)", plan_text(df, "simple"))
