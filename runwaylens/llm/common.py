"""Small helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
# Rows that a Python worker turns into lists and strings at once.
SMALL_BATCH = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Words of a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from all training: crc32 of its id as text leaves 1 when divided by 3.

    A NULL id is never held out and never learned from (its remainder is NULL).
    """
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def learnable(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 != 1, F.lit(False))


def map_batches(df: DataFrame, make: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply a function to every Arrow batch. Spark bounds a batch by rows and by bytes, so memory stays bounded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield make(batch)

    return df.mapInArrow(run, schema)


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = SMALL_BATCH) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of few rows, so that what is made of many long texts is never held at once.

    At the end of the task the worker gives its free memory back: later stages run in the same processes.
    """
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def size_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text; 0 for NULL."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
