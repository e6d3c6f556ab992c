"""Packing of whole documents into token sequences by harmonic classes.

A remainder of length r belongs to class k = capacity // r (1 .. max_class), the
reciprocal-capacity class (capacity / (k + 1), capacity / k], and a bin of class
k takes exactly k remainders. Every worker packs its own partition, with no
shuffle: bins never cross partitions. Documents may be cut, so what a full bin
still has room for is filled from the head of the next document, and a document
longer than the capacity first gives full sequences. What is left in open bins
when a partition ends is cut into full sequences and then into sequences whose
lengths are powers of two, which need no padding.

Defined cases: a null text counts as empty; every document, empty ones too, ends
with `end_id`, so no document vanishes; repeated rows are packed each for
itself; a long text is cut into full sequences as it comes; a null doc_id is
kept; extra columns are ignored; an empty table gives
no rows. At most max_class open bins are held, whatever the partition's size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import encoder, release

PIECE_SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class Packer:
    """Packs one worker's documents; `emit` gets each finished sequence's pieces.

    A piece is (doc_id, start, ids, doc_tokens) with ids as bytes, 4 a token.
    """

    def __init__(self, capacity: int = 2048, max_class: int = 32):
        self.capacity, self.max_class = capacity, max_class
        self.bins: dict[int, list] = {}
        self.pending: list = []  # a full bin that still has room, and that room
        self.room = 0
        self.done: list[list] = []

    def _close(self, pieces: list) -> None:
        self.room = self.capacity - sum(len(p[2]) // 4 for p in pieces)
        if self.room:
            self.pending = pieces
        else:
            self.done.append(pieces)

    def add(self, doc_id, ids: bytes) -> None:
        n, at = len(ids) // 4, 0
        if self.room:
            at = min(self.room, n)
            self.pending.append((doc_id, 0, ids[: 4 * at], n))
            self.room -= at
            if not self.room:
                self.done.append(self.pending)
        # a document that the room took whole leaves nothing to place, so no other bin fills meanwhile
        while n - at >= self.capacity:
            self.done.append([(doc_id, at, ids[4 * at : 4 * (at + self.capacity)], n)])
            at += self.capacity
        if at < n:
            k = min(self.capacity // (n - at), self.max_class)
            pieces = self.bins.setdefault(k, [])
            pieces.append((doc_id, at, ids[4 * at :], n))
            if len(pieces) == k:
                del self.bins[k]
                self._close(pieces)

    def finish(self) -> None:
        rest = (self.pending if self.room else []) + [p for k in sorted(self.bins) for p in self.bins[k]]
        self.bins, self.room = {}, 0
        left = sum(len(p[2]) // 4 for p in rest)
        sizes = [self.capacity] * (left // self.capacity)
        sizes += [1 << b for b in reversed(range(self.capacity.bit_length())) if (left % self.capacity) >> b & 1]
        pieces, piece = iter(rest), None
        for size in sizes:
            out = []
            while size:
                doc_id, start, ids, n = piece or next(pieces)
                take = min(size, len(ids) // 4)
                out.append((doc_id, start, ids[: 4 * take], n))
                piece = (doc_id, start + take, ids[4 * take :], n) if 4 * take < len(ids) else None
                size -= take
            self.done.append(out)

    def drain(self) -> list[list]:
        out, self.done = self.done, []
        return out


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 1, max_class: int = 32) -> DataFrame:
    """One row per piece, with its token ids as little-endian unsigned 32-bit."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, packer, sequence = encoder(tokenizer_path), Packer(capacity, max_class), TaskContext.get().partitionId() << 33
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

        def rows(sequences: list[list]) -> pa.RecordBatch:
            nonlocal sequence
            cols: list[list] = [[] for _ in schema]
            for pieces in sequences:
                offset = 0
                for doc_id, start, ids, n in pieces:
                    length = len(ids) // 4
                    for col, v in zip(cols, (doc_id, start, length, ids, n, sequence, offset)):
                        col.append(v)
                    offset += length
                sequence += 1
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                packer.add(doc_id, code.encode(text.as_py() or "") + end)
                if len(packer.done) >= 512:
                    yield rows(packer.drain())
        packer.finish()
        yield rows(packer.drain())
        code.memo.clear()
        release()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(work, PIECE_SCHEMA)
