"""Token ids packed into rows of one length, for training files.

Documents longer than a row are split without loss: full rows, and a rest.  The rests and the short documents are
packed best-fit-decreasing: the longest first, each into the row with the least room that still holds it.  That row is
found by a segment tree over the possible room.

Packing is narrow.  A task packs its own documents in batches of at most ``BATCH_TOKENS`` tokens (one longer document
is a batch), so memory is bounded, nothing is shuffled, and a lost task repeats its own part only.  Rows that stay
short are a few per batch.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

ROW_TOKENS = 2_048
PAD = 50_256  # free in the vocabularies of 50,256 tokens
BATCH_TOKENS = 1 << 22


class RoomTree:
    """Open rows by the room they have: the least room of at least n is found in logarithmic time."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.any = bytearray(2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        node = self.leaves + room
        while node and not self.any[node]:
            self.any[node] = 1
            node >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """(room, row) of the row with the least room of at least ``size``, taken out; None if there is none."""
        node = self.leaves + size
        if not self.any[node]:
            # Up to the first ancestor with something to the right, then down to its leftmost leaf.
            while node > 1 and (node & 1 or not self.any[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.any[2 * node] else 2 * node + 1
        room = node - self.leaves
        row = self.rows[room].pop()
        if not self.rows[room]:
            self.any[node] = 0
            node >>= 1
            while node and not (self.any[2 * node] or self.any[2 * node + 1]):
                self.any[node] = 0
                node >>= 1
        return room, row


def best_fit_decreasing(sizes: np.ndarray, length: int) -> list[list[int]]:
    """Positions of ``sizes`` in each row; longest first, ties in the given order."""
    tree, rows = RoomTree(length), []
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        found = tree.take(size)
        if found is None:
            found = (length, len(rows))
            rows.append([])
        room, row = found
        rows[row].append(item)
        if room > size:
            tree.put(room - size, row)
    return rows


_PACKED = (
    "shard int, row long, n_tokens int, ids binary, positions binary, cu_seqlens array<int>, doc_ids array<long>, "
    "pieces array<int>"
)


def pack_rows(encoded: DataFrame, length: int = ROW_TOKENS, pad: int = PAD, batch_tokens: int = BATCH_TOKENS) -> DataFrame:
    """Packed rows of ``encoded(doc_id, ids)``.

    ``ids`` and ``positions`` are a matrix row each: ``length`` little-endian unsigned 32-bit integers, padded with
    ``pad`` and 0; positions start again at 0 in every segment.  ``cu_seqlens`` are the cumulative segment lengths from
    0 to ``n_tokens``; segment i is piece ``pieces[i]`` of document ``doc_ids[i]``.  (shard, row) is unique.

    A document without tokens, or with null ids, is in no row.  Repeated rows are packed like others and null ids of
    documents stay null.  Other columns are ignored; an empty table gives an empty result.
    """

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        made = 0
        held: list[tuple[int | None, int, np.ndarray]] = []
        tokens = 0

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal made
            sizes = np.fromiter((len(ids) for _, _, ids in held), dtype=np.int64, count=len(held))
            rows = best_fit_decreasing(sizes, length)
            for at in range(0, len(rows), 512):
                some = rows[at: at + 512]
                matrix = np.full((len(some), length), pad, dtype="<u4")
                places = np.zeros((len(some), length), dtype="<u4")
                ends, docs, pieces = [], [], []
                for line, items in enumerate(some):
                    edge = [0]
                    for item in items:
                        ids = held[item][2]
                        matrix[line, edge[-1]: edge[-1] + len(ids)] = ids
                        places[line, edge[-1]: edge[-1] + len(ids)] = np.arange(len(ids))
                        edge.append(edge[-1] + len(ids))
                    ends.append(edge)
                    docs.append([held[item][0] for item in items])
                    pieces.append([held[item][1] for item in items])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard] * len(some), type=pa.int32()),
                        pa.array(range(made, made + len(some)), type=pa.int64()),
                        pa.array([edge[-1] for edge in ends], type=pa.int32()),
                        pa.array([line.tobytes() for line in matrix], type=pa.binary()),
                        pa.array([line.tobytes() for line in places], type=pa.binary()),
                        pa.array(ends, type=pa.list_(pa.int32())),
                        pa.array(docs, type=pa.list_(pa.int64())),
                        pa.array(pieces, type=pa.list_(pa.int32())),
                    ],
                    names=["shard", "row", "n_tokens", "ids", "positions", "cu_seqlens", "doc_ids", "pieces"],
                )
                made += len(some)
            held.clear()

        for batch in batches:
            for doc, row in zip(batch.column(0).to_pylist(), batch.column(1)):
                if not row.is_valid:
                    continue
                ids = row.values.to_numpy()
                if tokens and tokens + len(ids) > batch_tokens:
                    yield from packed()
                    tokens = 0
                for piece, at in enumerate(range(0, len(ids), length)):
                    held.append((doc, piece, ids[at: at + length]))
                tokens += len(ids)
        if held:
            yield from packed()

    return encoded.select("doc_id", "ids").mapInArrow(pack, _PACKED)


def write_packed(packed: DataFrame, folder: str) -> None:
    """Write packed rows as Parquet; the binary columns of a file, one after the other, are its matrices."""
    packed.write.parquet(folder)


def unpack_rows(packed: DataFrame) -> DataFrame:
    """(doc_id, piece, ids) of every segment: the inverse of ``pack_rows``, for checks."""

    def unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, pieces, out = [], [], []
            columns = (batch.column(name) for name in ("ids", "cu_seqlens", "doc_ids", "pieces"))
            for ids, edge, own, piece in zip(*columns):
                row, edge = np.frombuffer(ids.as_py(), dtype="<u4"), edge.as_py()
                docs += own.as_py()
                pieces += piece.as_py()
                out += [row[a:b].astype(np.int32) for a, b in zip(edge, edge[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, type=pa.int64()), pa.array(pieces, type=pa.int32()),
                 pa.array(out, type=pa.list_(pa.int32()))],
                names=["doc_id", "piece", "ids"],
            )

    return packed.mapInArrow(unpack, "doc_id long, piece int, ids array<int>")
