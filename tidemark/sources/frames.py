"""Frames out of videos by an external decoder, which need not be installed for anything else."""

from __future__ import annotations

import shutil
import struct
import subprocess
import zlib
from collections.abc import Iterator
from itertools import batched
from typing import BinaryIO

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import FPS, SCHEMAS, THUMB_WIDTH, EngineError


class DecoderMissing(RuntimeError):
    """A binary that decodes videos is not on the path."""


def require(binary: str) -> str:
    found = shutil.which(binary)
    if not found:
        raise DecoderMissing(f"{binary} is not installed; decode elsewhere and read thumbs instead")
    return found


def grey_stream(stream: BinaryIO) -> Iterator[tuple[int, int, bytes]]:
    """(width, height, pixels) of each frame of an uncompressed YUV4MPEG2 stream of one plane."""
    fields = stream.readline().split()
    if not fields or fields[0] != b"YUV4MPEG2":
        raise EngineError("the decoder gave no frames")
    size = {f[:1]: int(f[1:]) for f in fields[1:] if f[:1] in (b"W", b"H")}
    width, height = size[b"W"], size[b"H"]
    while stream.readline():  # the frame's own header
        pixels = stream.read(width * height)
        if len(pixels) < width * height:
            raise EngineError("the decoder's last frame is cut off")
        yield width, height, pixels


def _thumbs(path: str, fps: float, width: int) -> Iterator[tuple[int, int, bytes]]:
    """Small grey frames through a pipe, one at a time: nothing is written to the worker's disk."""
    shrink = f"fps={fps},scale={width}:-2,format=gray"
    with subprocess.Popen([require("ffmpeg"), "-nostdin", "-loglevel", "error", "-i", path, "-filter:v", shrink, "-strict", "-1", "-f", "yuv4mpegpipe", "pipe:1"], stdout=subprocess.PIPE) as decoder:
        yield from grey_stream(decoder.stdout)
    if decoder.returncode:
        raise subprocess.CalledProcessError(decoder.returncode, decoder.args)


def _frame(path: str, t: float) -> bytes:
    out = subprocess.run([require("ffmpeg"), "-v", "error", "-ss", f"{t:.3f}", "-i", path, "-frames:v", "1", "-q:v", "2", "-f", "image2pipe", "-c:v", "mjpeg", "-"], check=True, capture_output=True)
    return out.stdout


def extract_thumbs(videos: DataFrame, fps: float = FPS, width: int = THUMB_WIDTH, decode=None) -> DataFrame:
    """Thumbs (T1) of videos (video_id, path); decode(path, fps, width) -> (width, height, pixels) of each replaces the external decoder."""
    decode = decode or _thumbs

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for video_id, path in zip(batch["video_id"], batch["path"]):
                for part in batched(enumerate(decode(path, fps, width)), 256):
                    yield pd.DataFrame([(video_id, i, *x) for i, x in part], columns=["video_id", "idx", "width", "height", "pixels"])

    return videos.select("video_id", "path").mapInPandas(work, SCHEMAS["thumb"])


def extract_frames(manifest: DataFrame, videos: DataFrame, decode=None) -> DataFrame:
    """(video_id, file, content) of the kept frames alone; decode(path, t) -> image."""
    decode = decode or _frame

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(content=[decode(p, t) for p, t in zip(batch["path"], batch["t"])])[["video_id", "file", "content"]]

    wanted = manifest.join(videos, "video_id").select("video_id", "file", "t", "path")
    return wanted.mapInPandas(work, SCHEMAS["image"])


def _png(width: int, height: int, pixels: bytes) -> bytes:
    """A grey PNG of the pixels."""
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    rows = b"".join(b"\0" + pixels[y * width : (y + 1) * width] for y in range(height))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def thumb_images(manifest: DataFrame, thumbs: DataFrame, fps: float = FPS) -> DataFrame:
    """(video_id, file, content) of the kept frames where only thumbs are given: the thumbs themselves."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(content=[_png(*x) for x in zip(batch["width"], batch["height"], batch["pixels"])])[["video_id", "file", "content"]]

    kept = manifest.select("video_id", "file", F.round(F.col("t") * fps).cast("long").alias("idx")).join(thumbs, ["video_id", "idx"])
    return kept.select("video_id", "file", "width", "height", "pixels").mapInPandas(work, SCHEMAS["image"])


def transcribe(videos: DataFrame, recognise) -> DataFrame:
    """Segments (T5) by recognise(path) -> JSON text in the recogniser's own shape."""
    from .subtitles import parse_speech_json

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"video_id": batch["video_id"], "value": [recognise(p) for p in batch["path"]]})

    return parse_speech_json(videos.select("video_id", "path").mapInPandas(work, "video_id string, value string").withColumn("value", F.col("value")))
