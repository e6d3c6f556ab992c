"""Stable intervals of frames as they arrive."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..schemas import BUILD_FRACTION, CUT_THRESHOLD, SCHEMAS, TILE_THRESHOLD

STATE = "last_idx long, tiles array<double>, start_idx long, grp long, entered_by string"


def closed_intervals(frames: DataFrame, idle: str | None = None, tile_threshold: float = TILE_THRESHOLD, build_fraction: float = BUILD_FRACTION, cut_threshold: float = CUT_THRESHOLD) -> DataFrame:
    """Intervals of a stream of frames (video_id, idx, tiles), each as soon as it is closed.

    With `idle`, a video without frames for that time is closed with `end`; the
    stream then wakes up by itself. State is one frame's
    tiles and four scalars a video. Frames of one micro-batch are put in order
    of idx; one that comes after a later one of an earlier micro-batch is left
    out, as its neighbours have been compared already.
    """
    idle_ms = int(pd.Timedelta(idle).total_seconds() * 1000) if idle else 0
    columns = [c.split(" ")[0] for c in SCHEMAS["interval"].split(", ")]

    def kinds(tiles: np.ndarray) -> np.ndarray:
        """Class of each frame but the first, all at once, by the rule of operators.segmentation."""
        d = np.abs(np.diff(tiles, axis=0))
        med = np.median(d, axis=1)
        share = (d - med[:, None] > tile_threshold).mean(axis=1)
        return np.select([med > cut_threshold, share == 0, share <= build_fraction], ["cut", "stable", "build"], "cut")

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            last, _, start, grp, entered = state.get
            state.remove()
            yield pd.DataFrame([(key[0], start, last, grp, entered, "end")], columns=columns)
            return
        held = [*state.get] if state.exists else None
        rows = pd.concat(list(batches)).sort_values("idx").drop_duplicates("idx")
        idx, tiles = rows["idx"].to_numpy(), np.array(rows["tiles"].tolist(), dtype=float)
        if held is None:
            held = [int(idx[0]), None, int(idx[0]), 0, "start"]
        else:
            late = idx <= held[0]
            idx, tiles = np.concatenate([[held[0]], idx[~late]]), np.concatenate([[held[1]], tiles[~late]])
        out, found = [], kinds(tiles)
        for i in np.flatnonzero(found != "stable"):
            out.append((key[0], held[2], int(idx[i]), held[3], held[4], str(found[i])))
            held[2:] = [int(idx[i + 1]), held[3] + int(found[i] == "cut"), str(found[i])]
        held[0], held[1] = int(idx[-1]), tiles[-1].tolist()
        state.update(tuple(held))
        if idle_ms:
            state.setTimeoutDuration(idle_ms)
        yield pd.DataFrame(out, columns=columns)

    return frames.groupBy("video_id").applyInPandasWithState(step, SCHEMAS["interval"], STATE, "append", GroupStateTimeout.ProcessingTimeTimeout if idle_ms else GroupStateTimeout.NoTimeout)
