"""python -m tidemark -a ROOT STAGE: one stage over all videos of a project.

Options that every stage shares stand before its name.
"""

from __future__ import annotations

import argparse
import importlib
import subprocess
import sys
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.evaluation import artifact_text
from .plans import stages as S
from .plans.catalog import Catalog
from .plans.provider import Cache, Provider, offline
from .schemas import FPS, QUESTIONS, EngineError
from .sources import frames, subtitles

STAGES = ("sample", "transcribe", "ocr", "correct", "align", "describe", "reconstruct", "resolve", "distill", "verify", "run", "status")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidemark")
    p.add_argument("-a", "--artifact", default="artifact", help="root of the project's tables")
    p.add_argument("--provider", help="module:function that returns a Provider; without it answers are digests")
    p.add_argument("--model", help="name of the model, given to the provider's function")
    sub = p.add_subparsers(dest="stage", required=True)
    for name in STAGES:
        s = sub.add_parser(name)
        if name in ("sample", "run"):
            s.add_argument("--thumbs", help="folder of <video>/<number>.pgm; without it --videos are decoded")
            s.add_argument("--fps", type=float, default=FPS)
        if name in ("sample", "transcribe", "run"):
            s.add_argument("--videos", help="folder of videos")
        if name in ("transcribe", "run"):
            s.add_argument("--from", dest="transcripts", help="folder of .vtt, .srt and .json files; without it --videos are recognised")
            s.add_argument("--asr", help="module:function that takes a model's name and returns path -> JSON text of segments")
            s.add_argument("--asr-model", default="medium")
        if name in ("verify", "run"):
            s.add_argument("-n", type=int, default=QUESTIONS)
    return p


def _named(name: str) -> Callable:
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def _provider(name: str | None, model: str | None) -> Provider:
    if not name:
        return offline(model=model) if model else offline()
    return _named(name)(model) if model else _named(name)()


def _videos(spark: SparkSession, path: str | None) -> DataFrame:
    """(video_id, path) of the files in a folder; their content is not read here."""
    if not path:
        raise EngineError("there is nothing to read: name a folder of videos")
    files = spark.read.format("binaryFile").load(path).select("path")
    return files.select(F.regexp_extract("path", r"([^/]+?)(\.[^./]*)?$", 1).alias("video_id"), "path")


def _counts(df: DataFrame, *conditions: Column) -> list[int]:
    return [*df.agg(F.count("*"), *(F.count_if(c) for c in conditions)).first()]


def execute(spark: SparkSession, args: argparse.Namespace) -> None:
    """Run one stage, write its tables and say in a line what came of it."""
    c = Catalog(spark, args.artifact)
    stage = args.stage
    if stage == "run":
        for s in ("sample", "transcribe", "ocr", "correct", "describe", "align", "reconstruct", "resolve", "distill", "verify"):
            execute(spark, argparse.Namespace(**vars(args) | {"stage": s}))
        return
    if stage == "status":
        c.status().orderBy("video_id", "stage").show(1000, truncate=False)
        return
    provider, cache = _provider(args.provider, args.model), Cache(spark, c.path("model_cache"))
    if stage == "sample":
        if args.thumbs:
            thumbs = subtitles.read_thumbs(spark, args.thumbs)
            found = c.write("frame", S.sample(thumbs, args.fps))
            c.write("image", frames.thumb_images(found, thumbs, args.fps))
        else:
            files = _videos(spark, args.videos)
            found = c.write("frame", S.sample(frames.extract_thumbs(files, args.fps), args.fps))
            c.write("image", frames.extract_frames(found, files))
        print("sample: kept %d frames" % found.count())
    elif stage == "transcribe":
        if args.transcripts:
            found = subtitles.read_transcripts(spark, args.transcripts)
        elif args.asr:
            found = frames.transcribe(_videos(spark, args.videos), _named(args.asr)(args.asr_model))
        else:
            raise EngineError("transcribe needs transcripts (--from) or videos with a recogniser (--videos, --asr)")
        print("transcribe: %d segments" % c.write("segment", found).count())
    elif stage == "ocr":
        found = c.write("ocr", S.ocr(c.need("frame"), c.need("image"), cache, provider))
        print("ocr: read %d frames, %d of them with text" % (*_counts(found, F.col("text") != ""),))
    elif stage == "correct":
        segments = c.need("segment")
        found = c.write("segment_corrected", S.correct(segments, c.need("ocr"), c.need("frame"), cache, provider))
        changed = found.join(segments.select("video_id", "seg_no", F.col("text").alias("heard")), ["video_id", "seg_no"]).where("text <> heard").count()
        print("correct: changed %d segments" % changed)
    elif stage == "describe":
        print("describe: %d frames" % c.write("description", S.describe(c.need("frame"), c.need("image"), c.segments(), cache, provider)).count())
    elif stage == "align":
        found = c.write("aligned", S.align(c.need("frame"), c.segments(), c.read("description")))
        c.write_document("aligned.md", found)
        print("align: %d documents" % found.count())
    elif stage == "reconstruct":
        found = c.write("reconstruction", S.reconstruct(c.need("description"), c.need("image"), c.segments(), cache, provider))
        print("reconstruct: made %d, of which %d still do not match their frames" % (*_counts(found, F.col("roundtrip.verdict") == "mismatch"),))
    elif stage == "resolve":
        found = c.write("resolved_line", S.resolve(c.need("frame"), c.segments(), c.read("description"), cache, provider))
        c.write_document("resolved.md", S.resolved_document(found))
        print("resolve: %d lines" % found.count())
    elif stage == "distill":
        c.need("segment")
        made = S.distill(c.segments(), c.read("resolved_line"), c.read("description"), c.read("reconstruction"), cache, provider, c.path("distill_work"))
        made = {name: c.write(name, df) for name, df in made.items()}
        c.write_document("distilled.json", S.distilled_document(made["header"], made["claim"], made["glossary"], made["new_state"]))
        print("distill: %d claims, %d of them with a quote that the transcript does not hold" % (*_counts(made["claim"], ~F.col("quote_verified")),))
    elif stage == "verify":
        claims = c.need("claim")
        distilled = claims.groupBy("video_id").agg(F.to_json(F.sort_array(F.collect_list(F.struct("chunk", "claim_no", "claim", "mechanism", "contrast", "example", "scope", "status", "quote", "t")))).alias("text"))
        resolved = c.read("resolved_line").groupBy("video_id").agg(S.T.ordered_text(F.col("text"), F.col("line_no"), "\n").alias("text"))
        earlier = c.read("report").select("video_id", F.regexp_extract("iteration", r"(\d+)", 1).cast("int").alias("iteration"))
        report = S.verify(S.source_content(c.need("frame"), c.segments(), c.read("description")), artifact_text(distilled, resolved, ["video_id"]), claims, c.segments(), earlier, cache, provider, args.n)
        found = S.materialized(report, c.path("report_new"))
        c.write("report", found, "append")
        for r in found.select("video_id", "iteration", "score", F.size("holes").alias("holes"), F.size("unsupported_claims").alias("unsupported")).orderBy("video_id").toLocalIterator():
            print("verify: %s, %s: score %s, %d holes, %d unsupported claims" % r)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("tidemark").getOrCreate()
    try:
        execute(spark, args)
    except (FileNotFoundError, RuntimeError, ValueError, subprocess.CalledProcessError, PySparkException) as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    return 0
