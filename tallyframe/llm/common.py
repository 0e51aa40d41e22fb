"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.sources import use_checkpoint_dir

#: Bytes of ASCII white space: what separates words. ``bytes.split()`` cuts at just these.
SPACES = " \t\n\r\x0b\x0c"
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8 bytes; none for null."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").split()


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    This cuts the lineage: what follows reads files that survive the loss of any
    executor. The folder is that of ``spark.checkpoint.dir``. Shuffle files of steps that are
    over go once the driver has let go of their frames, which is hurried along here.
    """
    spark = df.sparkSession
    path = f"{use_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    out = spark.read.schema(df.schema).parquet(path)
    out._stage_path = path
    return out


def discard(*staged: DataFrame) -> None:
    """Delete the files of steps that nothing will read again."""
    for df in staged:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._stage_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


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


def map_batches(
    df: DataFrame, schema: str | T.StructType, each: Callable[[dict[str, list]], dict[str, list]], rows: int = 2048
) -> DataFrame:
    """``mapInArrow`` for a function from column lists to column lists.

    At most ``rows`` rows of an Arrow batch are worked on at a time, so the need does not
    grow with a partition.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(T._parse_datatype_string(schema) if isinstance(schema, str) else schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, rows):
                part = batch.slice(first, rows)
                made = each({name: part.column(at).to_pylist() for at, name in enumerate(part.schema.names)})
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made[field.name], type=field.type) for field in target], schema=target
                )
        # The worker goes on to other tasks; what this one held is not kept for them.
        pa.default_memory_pool().release_unused()

    return map_arrow(df, run, schema)


@contextmanager
def smaller_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows in what runs inside; smaller ones that are set already stay.

    A batch stands in the executor's buffers and several times in the worker that works on it.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    # Zero or less means no limit.
    if not 0 < int(before) <= rows:
        spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def give_back() -> None:
    """Hand back to the system what Python has freed on the driver, where the C library can do so."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without its columns of these names, in whatever case."""
    return df.select(*[f"`{name}`" for name in df.columns if name.lower() not in names])


def likely_among(df: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column, bits: int = 26) -> DataFrame:
    """The rows of ``df`` whose key may be among the wanted ones, before a join that decides.

    The keys' hashes are marks in a bitmap of ``2 ** bits`` bits, in pieces of 4 KB. It has a
    size of at most 8 MB whatever the tables, and so may be broadcast. The fuller it is, the
    more rows pass that the join then drops; none is lost.
    """

    def place(column: Column) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(1 << bits)) + 1

    marks = wanted.select(place(wanted_key).alias("place")).groupBy(
        F.bitmap_bucket_number("place").alias("__bucket")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("__marks"))
    own = place(key)
    bit = F.bitmap_bit_position(own)
    byte = F.conv(F.hex(F.expr("substring(__marks, __bit div 8 + 1, 1)")), 16, 10).cast("int")
    joined = df.withColumn("__bit", bit.cast("int")).withColumn("__bucket", F.bitmap_bucket_number(own))
    return joined.join(F.broadcast(marks), "__bucket").filter(
        byte.bitwiseAND(F.expr("shiftleft(1, __bit % 8)")) != 0
    ).select(*[f"`{name}`" for name in df.columns])


def rows_in(df: DataFrame) -> int:
    """A count of rows."""
    return df.agg(F.count(F.lit(1)).alias("n")).first()["n"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id"):
    """Whether ``crc32`` of the id's text leaves 0 when divided by 5; null ids are not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def plain(pattern: str) -> re.Pattern:
    """A pattern whose letter classes and case rules are those of ASCII."""
    return re.compile(pattern, re.ASCII)
