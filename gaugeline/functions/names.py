"""Column references by exact name."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(name: str) -> Column:
    """The column of exactly this name; ``%used`` or ``a.b`` need no quoting by the caller."""
    return F.col("`" + name.replace("`", "``") + "`")


def cols(names: Iterable[str]) -> list[Column]:
    return [col(n) for n in names]


def name_list(names: str | Iterable[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)
