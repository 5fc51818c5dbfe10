"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
BLOCK_WORDS = 1 << 20


def word_blocks(raw: bytes, overlap: int = 0, block: int = BLOCK_WORDS) -> Iterator[list[bytes]]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text in lists of at most ``block``, each starting with the last
    ``overlap`` words of the one before, so that a very long text never becomes one list of objects."""
    if len(raw) <= 8 * block:
        yield raw.split()  # bytes.split() separates at exactly these six characters
        return
    words: list[bytes] = []
    fresh = 0
    for found in _WORD.finditer(raw):
        words.append(found.group())
        fresh += 1
        if len(words) == block:
            yield words
            words, fresh = (words[-overlap:] if overlap else []), 0
    if fresh or not words:
        yield words


_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession, limit: str = "4m") -> None:
    """Let tasks see texts in batches of ``limit`` bytes, if the session has Spark's default of 64 MB.

    Several copies of a batch are in a Python worker at a time, so this is what bounds its memory.  No result depends
    on it; a session that sets another value keeps it.
    """
    if spark.conf.get(_BATCH_BYTES) == "67108864b":
        spark.conf.set(_BATCH_BYTES, limit)


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text, b"" for null, one at a time."""
    for at in range(0, len(column), 256):
        for value in column.slice(at, 256).cast(pa.large_binary()):
            yield value.as_py() or b""


def stream_groups(
    batches: Iterable[pa.RecordBatch], keys: list[str], chunk_rows: int = 1 << 16
) -> Iterator[dict[str, np.ndarray]]:
    """Whole groups from batches sorted by ``keys`` (integers without nulls): one dict of arrays per group."""
    held: list[pa.RecordBatch] = []
    rows = 0

    def split(table: pa.Table, last: bool) -> Iterator[dict[str, np.ndarray]]:
        columns = {name: table[name].combine_chunks().to_numpy(zero_copy_only=False) for name in table.column_names}
        n = table.num_rows
        change = np.zeros(n, dtype=bool)
        for key in keys:
            change[1:] |= columns[key][1:] != columns[key][:-1]
        bounds = np.flatnonzero(change)
        starts = np.concatenate([[0], bounds])
        ends = np.concatenate([bounds, [n]])
        if not last:
            starts, ends = starts[:-1], ends[:-1]
        for start, end in zip(starts.tolist(), ends.tolist()):
            yield {name: values[start:end] for name, values in columns.items()}
        split.rest = n - (ends[-1] if len(ends) else 0)

    due = chunk_rows
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
        if rows >= due:
            table = pa.Table.from_batches(held)
            yield from split(table, last=False)
            rest = int(split.rest)
            held = table.slice(table.num_rows - rest).to_batches()
            rows = rest
            due = max(chunk_rows, 2 * rest)
    if rows:
        yield from split(pa.Table.from_batches(held), last=True)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, … start+length-1 of every pair, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def row_struct(columns: Iterable[str]) -> Column:
    """All of ``columns`` as one struct, so that working columns beside it cannot clash with their names."""
    return F.struct(*[F.col(f"`{name}`") for name in columns])
