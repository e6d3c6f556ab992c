"""Functions over pixel blocks, in Arrow batches with numpy."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import GRID, EngineError


#: What may stand between the header fields of a grey map: blanks, and comments up to the end of their line.
_GAP = rb"(?:\s|#[^\n]*\n)+"
#: The header as a whole: magic, width, height and largest value, then the one blank before the pixels. Fixed format.
PGM_HEADER = re.compile(rb"(?P<magic>P\d)" + _GAP + _GAP.join(rb"(?P<%s>\d+)" % name for name in (b"width", b"height", b"most")) + rb"\s")


def read_pgm(data: bytes) -> tuple[int, int, bytes]:
    """Width, height and pixels of a binary grey map of one byte a pixel; bytes after the pixels are ignored."""
    header = PGM_HEADER.match(data)
    if header is None or header["magic"] != b"P5":
        raise EngineError("no header of a binary grey map")
    if int(header["most"]) > 255:
        raise EngineError("only one byte a pixel is supported")
    width, height = int(header["width"]), int(header["height"])
    rows = memoryview(data)[header.end() :]
    if len(rows) < width * height:
        raise EngineError("grey map has too few pixels")
    return width, height, bytes(rows[: width * height])


def tile_means(a: bytes, b: bytes, width: int, height: int, grid: int = GRID) -> list[float]:
    """Mean absolute difference of each tile, row by row; a tile without pixels gives 0."""
    shape = (height, width)
    d = np.abs(np.frombuffer(a, np.uint8)[: width * height].reshape(shape).astype(np.int64) - np.frombuffer(b, np.uint8)[: width * height].reshape(shape))
    sums = np.zeros((height + 1, width + 1), dtype=np.int64)
    sums[1:, 1:] = d.cumsum(0).cumsum(1)
    ys, xs = (np.arange(grid + 1) * n // grid for n in shape)
    tiles = sums[ys[1:]][:, xs[1:]] - sums[ys[:-1]][:, xs[1:]] - sums[ys[1:]][:, xs[:-1]] + sums[ys[:-1]][:, xs[:-1]]
    count = np.diff(ys)[:, None] * np.diff(xs)[None, :]
    return np.where(count > 0, tiles / np.maximum(count, 1), 0.0).ravel().tolist()


def pgm_udf():
    """UDF (content) -> width, height, pixels."""

    @F.pandas_udf("struct<width:int,height:int,pixels:binary>")
    def pgm(data: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([read_pgm(bytes(x)) for x in data], columns=["width", "height", "pixels"])

    return pgm


def pixel_diffs(grid: int = GRID):
    """UDF (before, after, width, height) -> tile differences; null before gives null."""

    @F.pandas_udf("array<double>")
    def diffs(before: pd.Series, after: pd.Series, width: pd.Series, height: pd.Series) -> pd.Series:
        return pd.Series([None if a is None else tile_means(bytes(a), bytes(b), int(w), int(h), grid) for a, b, w, h in zip(before, after, width, height)])

    return diffs


def array_diffs(before: Column, after: Column, scale: float = 1.0) -> Column:
    """Absolute differences of two equally long arrays of tile values, in the JVM."""
    return F.zip_with(before, after, lambda a, b: F.abs(a.cast("double") - b.cast("double")) * scale)
