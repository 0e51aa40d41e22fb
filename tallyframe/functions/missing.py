"""What counts as a missing cell.

A cell of a coded survey table is missing when it is NULL or NaN, holds an empty
string or a text such as ``NA``, or holds a code that stands for "no value". The
test is built per column type: under ANSI SQL a single untyped expression would
try to cast ``'abc'`` to a number and fail the job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions.columns import sql_name, sql_text

# The texts and the code that mean "no value" unless told otherwise.
MISSING_TEXTS = ("None", "NULL", "NA")
MISSING_CODES = (99,)


def missing_sql(
    field: T.StructField,
    codes: Sequence[float] = MISSING_CODES,
    texts: Sequence[str] = MISSING_TEXTS,
    text_match: str = "contains",
) -> str:
    """SQL text that is TRUE where the cell of ``field`` is missing and never NULL.

    ``text_match='contains'`` calls a string missing when one of ``texts`` occurs
    anywhere in it, so ``'BANANA'`` is missing because of ``NA``;
    ``'equals'`` compares the whole string.
    """
    if text_match not in ("contains", "equals"):
        raise ValueError(f"text_match must be 'contains' or 'equals', not {text_match!r}")
    cell = sql_name(field.name)
    tests = [f"{cell} IS NULL"]
    if isinstance(field.dataType, (T.StringType, T.CharType, T.VarcharType)):
        if text_match == "contains":
            tests += [f"contains({cell}, {sql_text(text)})" for text in texts]
        else:
            tests += [f"{cell} = {sql_text(text)}" for text in texts]
        tests.append(f"{cell} = ''")
        as_number = f"try_cast({cell} AS DOUBLE)"
        tests.append(f"isnan({as_number})")
        tests += [f"{as_number} = {float(code)!r}D" for code in codes]
    elif isinstance(field.dataType, T.NumericType):
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            tests.append(f"isnan({cell})")
        tests += [f"{cell} = {_number_sql(code)}" for code in codes]
    return f"coalesce({' OR '.join(tests)}, false)"


def _number_sql(code: float) -> str:
    return f"{code!r}D" if isinstance(code, float) else str(code)


def missing(field: T.StructField, *args, **options) -> Column:
    """The test of ``missing_sql`` as a column."""
    return F.expr(missing_sql(field, *args, **options))


def present_sql(cell: str) -> str:
    """SQL text that is TRUE where a numeric cell is neither NULL nor NaN."""
    return f"({cell} IS NOT NULL AND NOT isnan({cell}))"
