"""What Python workers keep between tasks, and how much text they get at a time. Spark uses workers again, so what one
stage leaves there would outlive it."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import SparkSession

HELD: list[dict] = []
BATCH_BYTES = 4 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"

Batches = Iterator[pa.RecordBatch]


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches end at about ``BATCH_BYTES``, unless the session has a limit of its own. Spark cuts them by rows only,
    and holds a batch several times: its columns, its message and the worker's copy."""
    if spark.conf.get(_BATCH_CONF, None) is None:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))


def shared(cache: dict) -> dict:
    """A module's cache that ``release`` empties."""
    HELD.append(cache)
    return cache


def release() -> None:
    """Empties the caches of this worker, and gives free memory back where Arrow and the C library can."""
    for cache in HELD:
        cache.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def released(task: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """The task of a ``mapInArrow`` without what earlier stages left in its worker; it leaves nothing itself."""

    def run(batches: Batches) -> Batches:
        release()
        try:
            yield from task(batches)
        finally:
            release()

    return run


def text_blocks(texts: pa.Array, most_words: int, rows: int = 64) -> Iterator[list[str | None]]:
    """Texts as Python strings, in blocks of about ``most_words`` words; a whole batch of them would take many times that."""
    held, size = [], 0
    for at in range(0, len(texts), rows):
        for text in texts.slice(at, rows).to_pylist():
            held.append(text)
            size += len(text) // 6 if text else 1
            if size >= most_words:
                yield held
                held, size = [], 0
    if held:
        yield held
