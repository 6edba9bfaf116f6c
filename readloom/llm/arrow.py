"""Small helpers shared by the Arrow-batched operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import SparkSession

#: Rows of an Arrow batch that goes to Python at most; texts are long, and both sides hold whole batches.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's limit of rows in an Arrow batch to BATCH_ROWS."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; a null is an empty text."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b or b"" for b in column.cast(kind).to_pylist()]


def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[object, bytes]]:
    """(id, text bytes) of two-column batches."""
    for batch in batches:
        yield from zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), strict=True)


def by_bytes(pairs: Iterable[tuple[object, bytes]], limit: int) -> Iterator[list[tuple[object, bytes]]]:
    """Runs of rows whose texts hold about ``limit`` bytes; a longer text is a run of its own."""
    run: list[tuple[object, bytes]] = []
    size = 0
    for pair in pairs:
        if run and size + len(pair[1]) > limit:
            yield run
            run, size = [], 0
        run.append(pair)
        size += len(pair[1])
    if run:
        yield run
