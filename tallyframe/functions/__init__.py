"""Column expressions and SQL texts. All of it is built-in Spark SQL, no Python rows."""

from tallyframe.functions.columns import named, numeric_columns
from tallyframe.functions.hashing import hash_part, hash_unit
from tallyframe.functions.missing import missing, missing_sql
from tallyframe.functions.statistics import pairwise_corr_sql

__all__ = [
    "hash_part",
    "hash_unit",
    "missing",
    "missing_sql",
    "named",
    "numeric_columns",
    "pairwise_corr_sql",
]
