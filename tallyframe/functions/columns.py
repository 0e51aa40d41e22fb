"""Small helpers for naming columns."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def named(name: str) -> Column:
    """The column called ``name``, whatever characters the name holds."""
    return F.col(sql_name(name))


def sql_name(name: str) -> str:
    """The column name as SQL text."""
    return "`" + name.replace("`", "``") + "`"


def sql_text(text: str) -> str:
    """The string as a SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Names of the numeric columns, in table order."""
    skip = set(exclude)
    return [
        field.name
        for field in df.schema.fields
        if isinstance(field.dataType, T.NumericType) and field.name not in skip
    ]


def chunks(names: Sequence[str], size: int) -> Iterator[list[str]]:
    """Cut a list of names in runs of at most ``size``."""
    for start in range(0, len(names), size):
        yield list(names[start : start + size])
