"""Column names that do not clash with a caller's."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """``wanted`` with as many underscores in front as no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        name = f"__{name}"
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def shielded(docs: DataFrame, *used: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` without columns that begin like those of the operators, and the way back.

    Columns with two underscores in front get other names until the second result is
    applied; ``used`` are left alone, as the operator reads them.
    """
    given = [c for c in docs.columns if c.startswith("__") and c not in used]
    taken, other = {c.lower() for c in docs.columns}, {}
    for number, name in enumerate(given):
        new = f"kept{number}"
        while new in taken:
            new += "_"
        other[name] = new
    back = {new: name for name, new in other.items()}
    return docs.withColumnsRenamed(other), lambda df: df.withColumnsRenamed(back)
