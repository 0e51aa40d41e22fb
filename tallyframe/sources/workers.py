"""Work in Arrow batches: the package at hand in Python workers, and functions over batches."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Not needed where ``PYTHONPATH``, which executors inherit or are set up with, names it.
    """
    root = Path(__file__).resolve().parents[2]
    named = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    context = spark.sparkContext
    if str(root) in named or context.applicationId in _shipped:
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="tallyframe-"), "tallyframe_package.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as file:
        for source in sorted((root / "tallyframe").rglob("*.py")):
            file.write(source, source.relative_to(root))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def map_arrow(df: DataFrame, run: Callable, schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` with this package at hand in the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)
