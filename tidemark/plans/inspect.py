"""Plan inspection helpers (used by the plan tests and for reviewing plans)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def explain_string(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints, as a string."""
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def count_nodes(plan: str, name: str) -> int:
    """Occurrences of an operator name in the plan tree (tree section only)."""
    tree = plan.split("\n\n")[0] if "\n\n" in plan else plan
    return len(re.findall(rf"\b{re.escape(name)}\b", tree))


PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "MapInArrow", "FlatMapGroupsInArrow", "PythonUDF")


def has_python(plan: str) -> bool:
    return any(n in plan for n in PYTHON_NODES)
