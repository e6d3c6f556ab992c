"""Groups of adjacent rows in a stream of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups, rows of equal `key` being adjacent, with the places where groups begin (and the end).

    A group that goes on in the next batch is held back until it is whole.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch.column(key).to_numpy(zero_copy_only=False)
        other = np.flatnonzero(k != k[-1])
        whole = int(other[-1]) + 1 if len(other) else 0  # rows before the batch's last group
        if whole or (held and held[-1].column(key)[-1].as_py() != k[0]):
            if not whole and held:  # the held group ended with its batch
                yield _cut(held, key)
                held = [batch]
                continue
            yield _cut([*held, batch.slice(0, whole)], key)
            held = [batch.slice(whole)]
        else:
            held.append(batch)
    if held:
        yield _cut(held, key)


def _cut(parts: list[pa.RecordBatch], key: str) -> tuple[pa.Table, np.ndarray]:
    table = pa.Table.from_batches([p for p in parts if p.num_rows])
    k = table.column(key).to_numpy()
    return table, np.concatenate([[0], np.flatnonzero(k[1:] != k[:-1]) + 1, [len(k)]])
