"""Aggregate expressions, as SQL text.

A wide table needs hundreds of them; one parsed text per table costs far less than a
call to the JVM for every part of every expression.
"""

from __future__ import annotations

from tallyframe.functions.columns import sql_name
from tallyframe.functions.missing import present_sql


def varies_sql(cell: str) -> str:
    """TRUE when the cell takes more than one value.

    A deviation of zero does not tell: merged over several tasks, the deviation of
    a constant column can come out as a rounding error above zero.
    """
    return f"(min({cell}) < max({cell}))"


def pairwise_corr_sql(a: str, b: str, complete: bool = False) -> str:
    """Pearson correlation over the rows where both columns are present.

    NULL, not an error and not NaN, when either side is constant or fewer than two
    rows qualify. ``corr`` divides by zero on a constant column under ANSI SQL.
    ``complete`` says that no cell is missing: then the tests for it go, and the
    deviation of ``b`` is the same aggregate for every ``a``.
    """
    x, y = f"CAST({sql_name(a)} AS DOUBLE)", f"CAST({sql_name(b)} AS DOUBLE)"
    if not complete:
        both = f"{present_sql(x)} AND {present_sql(y)}"
        x, y = f"if({both}, {x}, NULL)", f"if({both}, {y}, NULL)"
    spread = f"stddev_samp({x}) * stddev_samp({y})"
    corr = f"try_divide(covar_samp({x}, {y}), {spread})"
    return f"if({varies_sql(x)} AND {varies_sql(y)}, {corr}, NULL)"
