"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile
from collections.abc import Callable, Hashable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clicklake.session import scratch_dir

CHUNK = 1 << 20
_BYTE_SPACE = re.compile(rb"[ \t-\r]")
_SPACE = re.compile(r"\s")
_KEPT: dict[Hashable, Any] = {}
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, for jobs that were not submitted with it (``--py-files``); once per application.

    Batches of texts get 8 MiB at most, unless the session says otherwise: Spark's 64 MiB stand in the executor and in the worker at
    once, for every task.
    """
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, "8m")
    context = spark.sparkContext
    if any(os.path.basename(f).startswith("clicklake-") for f in context._python_includes):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if not os.path.isdir(package):  # the package is in an archive, so it was submitted
        return
    archive = os.path.join(tempfile.mkdtemp(), f"clicklake-{context.applicationId}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, files in os.walk(package):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(archive)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared scratch folder: computed once, and read again when an executor is lost."""
    spark = frame.sparkSession
    path = scratch_dir(spark, f"llm-{name}")
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def kept(key: Hashable, build: Callable[[], Any]) -> Any:
    """What ``build`` makes, kept in this worker process from task to task until an operator asks for another one: a worker that
    serves several operators in turn holds the memory of one."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = build()
    return _KEPT[key]


def release() -> None:
    """Give up what ``kept`` holds in this worker process."""
    _KEPT.clear()


def unit(*parts: Column) -> Column:
    """A number in [0, 1) that depends on the parts alone."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def remainder(doc_id: Column, modulus: int) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(modulus))


def byte_chunks(data: bytes | np.ndarray) -> Iterator[bytes | np.ndarray]:
    """The data in pieces of about a MiB that end before ASCII white space."""
    start = 0
    while start < len(data):
        end = start + CHUNK
        if end < len(data):
            found = _BYTE_SPACE.search(data, end)
            end = found.start() if found else len(data)
        yield data[start:end]
        start = end


def byte_words(data: bytes) -> Iterator[list[bytes]]:
    """Words between ASCII white space, in lists of about a MiB of text, so that a huge text is never held as words at once."""
    for chunk in byte_chunks(data):
        yield chunk.split()


def slices(batch: pa.RecordBatch, column: str, size: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``size`` bytes in a column of texts (a row at least), without copying it."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    parts = (np.cumsum(lengths) - lengths) // size
    starts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), batch.num_rows]
    for start, end in zip(starts, starts[1:], strict=False):
        yield batch.slice(start, end - start)


def text_chunks(text: str) -> Iterator[str]:
    """The text in pieces of about a MiB that end at white space."""
    start = 0
    while start < len(text):
        end = start + CHUNK
        if end < len(text):
            found = _SPACE.search(text, end)
            end = found.start() if found else len(text)
        yield text[start:end]
        start = end
