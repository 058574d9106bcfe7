"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import os

import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import scratch_path

#: White space of the word rules: blank, tab, line feed, vertical tab, form
#: feed, carriage return.  Used as a regex class and as a character list.
WS_CLASS = r"[\x20\x09-\x0D]+"
WS_CHARS = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one table of the data folder (any path Spark can open)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file; ``TESSERA_TOKENIZERS`` names another
    folder than the installed one."""
    folder = os.environ.get("TESSERA_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: later stages re-read files, so a lost executor costs no recompute."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def arrow_out(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """Record batch from plain lists or arrays in ``schema`` order."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type)
         for f, c in ((f, columns[f.name]) for f in schema)], schema=schema)


def byte_blocks(batches, text: int, limit: int = 8 << 20):
    """Cut record batches into blocks of at most ``limit`` bytes of column
    number ``text`` (one longer row is a block of its own), which bounds what
    a task holds at once whatever the batch size is."""
    for b in batches:
        n, lo = b.num_rows, 0
        col = b.column(text)
        sizes = pa.compute.fill_null(pa.compute.binary_length(col), 0).to_pylist()
        used = 0
        for i, s in enumerate(sizes):
            if used and used + s > limit:
                yield b.slice(lo, i - lo)
                lo, used = i, 0
            used += s
        if lo < n:
            yield b.slice(lo, n - lo)


def extended(df: DataFrame, **fields: str) -> T.StructType:
    """The schema of ``df`` with more fields, by name and type."""
    more = df.sparkSession.createDataFrame(
        [], ", ".join(f"`{n}` {t}" for n, t in fields.items())).schema
    return T.StructType([*df.schema.fields, *more.fields])


def lean(run):
    """``run`` over the batches of a task, giving memory back to the system at
    the end: Python workers serve many tasks, and what one leaves with its
    allocators would count against the next."""
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except AttributeError:             # only glibc has it
                pass
    return wrapped
