"""The stages from raw tables to a verified artifact, over a provider and its cache."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import evaluation, quotes, ranking, runs, segmentation, temporal, timeline
from ..schemas import CHUNK_MINUTES, CORRECTION_BATCH, FIRST_CHUNK, FRAME_LOOK_BACK, HEADER_BUDGET, NO_SPEECH, NO_VISUAL, QUESTIONS, RESOLUTION_BATCH, RESOLVED_HEADING, SCHEMAS, SPEECH_RADIUS, EngineError
from .provider import Cache, Provider

VIDEO = ["video_id"]

#: Our own instructions to the models; answers are asked for as JSON throughout.
PROMPTS = {
    "ocr": "Write down all text that can be read in this frame and nothing else. If there is none, write NO_TEXT.",
    "correct": "On-screen text:\n{vocabulary}\n\nTranscript segments as JSON:\n{segments}\n\nCorrect only what the recogniser misheard. Return a JSON array of {{\"i\", \"text\"}} with the changed segments alone.",
    "describe": "Frame at {ts}. Speech around it: {speech}\n\nReturn JSON with description, pointer_target, content_type, needs_reconstruction and on_screen_text_gist.",
    "reconstruct": "Speech around this frame: {speech}\nIts type: {kind}\n\nWrite its content as text of the fitting format.",
    "check": "Compare the frame with this text of it:\n{body}\n\nReturn JSON with verdict (match, minor_issues, mismatch) and discrepancies.",
    "repair": "This text of the frame does not match it:\n{body}\n\nDiscrepancies:\n{discrepancies}\n\nWrite it again.",
    "resolve": "Replace what the speaker points at by its name, and change nothing else:\n{context}",
    "boundaries": "Return a JSON array of seconds at which arguments end, chunks of {least} to {most} minutes:\n{transcript}",
    "distill": "Established so far:\n{state}\n\nChunk {chunk}, {start} to {end}:\n{lines}\n\nOn screen:\n{visual}\n\nReturn JSON with claims (claim, mechanism, contrast, example, scope, status, novel, corrected, quote, t, frames), glossary (term, definition, t) and new_state (lines).",
    "header": "Return JSON with title, one_line and assumed_context for:\n{chunks}",
    "questions": "{source}\n\nReturn a JSON array of {n} questions with q, ground_truth, kind, probes and t.",
    "answers": "{artifact}\n\nAnswer from this text alone. Return a JSON array of i and answer:\n{questions}",
    "grades": "Grade each answer. Return a JSON array of i, verdict (correct, partial, wrong, missing) and hole:\n{rows}",
    "reverse": "{transcript}\n\nWhich claims does this support? Return a JSON array of i, supported and note:\n{claims}",
}


def prompt(name: str, **holes) -> Column:
    """A template with columns in its holes."""
    text = F.lit(PROMPTS[name].replace("{{", "{").replace("}}", "}"))
    return reduce(lambda t, x: F.replace(t, F.lit("{" + x[0] + "}"), F.coalesce(x[1].cast("string"), F.lit(""))), holes.items(), text)


def answers_as(answered: DataFrame, schema: str, array: bool) -> DataFrame:
    """Parse `answer` into `parsed`; an answer without JSON is an error.

    The check runs over the answers by itself: an error raised in an expression
    could be moved below the join with the cache, to rows of other requests.
    """
    text = T.json_text(F.col("answer"), array)
    bad = answered.where(text.isNull()).select(F.substring("answer", 1, 200)).limit(1).collect()
    if bad:
        raise EngineError(f"no JSON in the answer: {bad[0][0]}")
    return answered.withColumn("parsed", F.from_json(text, schema))


def materialized(df: DataFrame, path: str) -> DataFrame:
    """Write a stage table and read it back, so that what follows never asks again."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sample(thumbs: DataFrame, fps: float = 1.0, **limits) -> DataFrame:
    """Manifest of the kept frames of thumbs (T1)."""
    if thumbs.isEmpty():
        raise EngineError("there are no thumbs to sample from")
    return segmentation.manifest(segmentation.keepers(segmentation.frame_intervals(thumbs, VIDEO, **limits)), VIDEO, fps)


def _numbered(df: DataFrame, *order: str) -> DataFrame:
    return df.withColumn("src", (F.row_number().over(Window.partitionBy(*VIDEO).orderBy(*order)) - 1).cast("long"))


def ocr(manifest: DataFrame, images: DataFrame, cache: Cache, provider: Provider) -> DataFrame:
    """Text of every kept frame; images: video_id, file, content."""
    asked = manifest.join(images, ["video_id", "file"]).select("video_id", "file", F.array("content").alias("images"), prompt("ocr").alias("prompt"))
    return cache.answer(asked, provider, max_tokens=4000, effort="low").select("video_id", "file", T.ocr_text(F.col("answer")).alias("text"))


def correct(segments: DataFrame, ocr_texts: DataFrame, manifest: DataFrame, cache: Cache, provider: Provider) -> DataFrame:
    """Corrected segments of the videos that have on-screen text rows; the others' stay as they are."""
    order = _numbered(manifest, "t", "file").select("video_id", "file", "src")
    counted = ranking.line_frequencies(ocr_texts.join(order, ["video_id", "file"]), VIDEO, "src")
    vocabulary = ranking.prefix_budget(counted, VIDEO).groupBy("video_id").agg(T.ordered_text(F.col("line"), F.col("rank"), "\n").alias("vocabulary"))
    payload = F.to_json(F.transform(F.sort_array(F.collect_list(F.struct("seg_no", "text"))), lambda s: F.struct(s["seg_no"].alias("i"), s["text"].alias("text"))))
    asked = runs.batches(segments, "seg_no", CORRECTION_BATCH).groupBy("video_id", "batch").agg(payload.alias("segments"))
    asked = asked.join(ocr_texts.select("video_id").distinct(), "video_id", "left_semi").join(vocabulary, "video_id", "left")
    asked = asked.select("video_id", "batch", prompt("correct", vocabulary=F.col("vocabulary"), segments=F.col("segments")).alias("prompt"))
    found = answers_as(cache.answer(asked, provider, max_tokens=32_000), "array<struct<i:long,text:string>>", True)
    changes = found.select("video_id", "batch", F.posexplode("parsed").alias("no", "c")).select("video_id", "c.i", "c.text", F.struct("batch", "no").alias("src"))
    return evaluation.apply_corrections(segments, changes, VIDEO)


def describe(manifest: DataFrame, images: DataFrame, segments: DataFrame, cache: Cache, provider: Provider) -> DataFrame:
    """Descriptions (T7) of every kept frame with the speech around it."""
    centers = manifest.select("video_id", F.col("file").alias("left_id"), F.col("t").alias("center"))
    speech = temporal.speech_windows(centers, segments, VIDEO, SPEECH_RADIUS, NO_SPEECH).withColumnRenamed("left_id", "file")
    asked = manifest.join(speech, ["video_id", "file"]).join(images, ["video_id", "file"])
    asked = asked.select("video_id", "file", "t", F.array("content").alias("images"), prompt("describe", ts=F.col("ts"), speech=F.col("window")).alias("prompt"))
    found = answers_as(cache.answer(asked, provider), "struct<description:string,pointer_target:string,content_type:string,needs_reconstruction:boolean,on_screen_text_gist:string>", False)
    return found.select("video_id", "file", "t", "parsed.*")


def align(manifest: DataFrame, segments: DataFrame, descriptions: DataFrame | None = None) -> DataFrame:
    """(video_id, document): frames and speech on one timeline."""
    d = _numbered(descriptions, "t", "file") if descriptions is not None else None
    lines = timeline.rendered(_numbered(manifest, "interval_start", "file"), segments.withColumn("src", F.col("seg_no")), d, VIDEO)
    return timeline.document(lines, VIDEO)


def repair_once(made: DataFrame, repair: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """made (with `verdict`) with each mismatch repaired and checked once more, and never twice."""
    return made.where("verdict <> 'mismatch' OR verdict IS NULL").unionByName(repair(made.where("verdict = 'mismatch'")))


def reconstruct(descriptions: DataFrame, images: DataFrame, segments: DataFrame, cache: Cache, provider: Provider) -> DataFrame:
    """Reconstructions (T8) of the frames that need one: made, checked against the image, at most once repaired."""
    flagged = descriptions.where(F.coalesce("needs_reconstruction", F.lit(False))).join(images, ["video_id", "file"])
    speech = temporal.speech_windows(flagged.select("video_id", F.col("file").alias("left_id"), F.col("t").alias("center")), segments, VIDEO, SPEECH_RADIUS, NO_SPEECH).withColumnRenamed("left_id", "file")
    flagged = flagged.join(speech, ["video_id", "file"]).withColumn("kind", T.falsy_to(F.col("content_type"), "other")).withColumn("images", F.array("content"))
    keep = ["video_id", "file", "t", "kind", "images", "body"]

    def checked(rows: DataFrame) -> DataFrame:
        asked = rows.select(*keep, prompt("check", body=F.col("body")).alias("prompt"))
        found = answers_as(cache.answer(asked, provider), "struct<verdict:string,discrepancies:array<string>>", False)
        return found.select(*keep, F.col("parsed").alias("roundtrip"), F.col("parsed.verdict").alias("verdict"))

    def made(rows: DataFrame) -> DataFrame:
        return cache.answer(rows, provider).select("video_id", "file", "t", "kind", "images", F.col("answer").alias("body"))

    def repair(rows: DataFrame) -> DataFrame:
        asked = rows.select("video_id", "file", "t", "kind", "images", prompt("repair", body=F.col("body"), discrepancies=F.array_join("roundtrip.discrepancies", "\n")).alias("prompt"))
        return checked(made(asked))

    first = made(flagged.select("video_id", "file", "t", "kind", "images", prompt("reconstruct", speech=F.col("window"), kind=F.col("kind")).alias("prompt")))
    done = repair_once(checked(first), repair)
    return done.select("video_id", F.col("file").alias("frame"), "t", F.col("kind").alias("content_type"), T.reconstruction_file(F.col("file"), F.col("kind")).alias("file"), "body", "roundtrip")


def resolve(manifest: DataFrame, segments: DataFrame, descriptions: DataFrame, cache: Cache, provider: Provider) -> DataFrame:
    """Resolved lines (T10): every batch of segments with the frames seen meanwhile."""
    b = runs.batches(segments, "seg_no", RESOLUTION_BATCH)
    spans = b.groupBy("video_id", "batch").agg((F.min_by("start", "seg_no") - FRAME_LOOK_BACK).alias("lo"), F.max_by("end", "seg_no").alias("hi"))
    shown = temporal.interval_join(spans, manifest.select("*", F.col("interval_start").alias("r_lo"), F.col("t").alias("r_hi")), VIDEO, 600.0)
    keys = ["video_id", "batch"]
    frames = shown.withColumn("src", F.row_number().over(Window.partitionBy(*keys).orderBy("interval_start", "file")))
    d = shown.select(*keys, "file").join(_numbered(descriptions, "t", "file"), ["video_id", "file"])
    lines = timeline.rendered(frames, b.withColumn("src", F.col("seg_no")), d, keys)
    context = timeline.document(lines, keys)
    asked = context.select(*keys, prompt("resolve", context=F.col("document")).alias("prompt"))
    found = cache.answer(asked, provider, max_tokens=32_000)
    out = found.select(*keys, F.posexplode(F.split(T.stripped(F.col("answer")), T.LINE_BREAKS, -1)).alias("no", "text"))
    return out.select("video_id", (F.row_number().over(Window.partitionBy("video_id").orderBy("batch", "no")) - 1).cast("long").alias("line_no"), "text")


def _transcript_lines(segments: DataFrame) -> DataFrame:
    return segments.select("video_id", F.col("seg_no").alias("line_no"), T.stamped_line(F.col("start"), F.col("text")).alias("text"))


def boundaries(segments: DataFrame, cache: Cache, provider: Provider) -> DataFrame:
    """(video_id, boundaries): none, and no call, for videos up to the longest chunk."""
    least, most = CHUNK_MINUTES
    long = temporal.durations(segments, VIDEO).where(F.col("duration") > most * 60)
    text = _transcript_lines(segments).groupBy("video_id").agg(T.ordered_text(F.col("text"), F.col("line_no"), "\n").alias("transcript"))
    asked = long.join(text, "video_id").select("video_id", "duration", prompt("boundaries", least=F.lit(least), most=F.lit(most), transcript=F.col("transcript")).alias("prompt"))
    found = answers_as(cache.answer(asked, provider, max_tokens=4000), "array<double>", True)
    found = found.select("video_id", temporal.inner_boundaries(F.col("parsed"), F.col("duration")).alias("boundaries"))
    return segments.select("video_id").distinct().join(found, "video_id", "left").withColumn("boundaries", F.coalesce("boundaries", F.array().cast("array<double>")))


def visual_context(spans: DataFrame, descriptions: DataFrame, reconstructions: DataFrame) -> DataFrame:
    """(video_id, chunk, visual): what was on screen in each chunk's span, with reconstructions."""
    r = runs.last_wins(reconstructions, ["video_id", "frame"], "t").select("video_id", F.col("frame").alias("file"), F.col("file").alias("made"), "body")
    d = _numbered(descriptions, "t", "file").withColumn("r_lo", F.col("t")).withColumn("r_hi", F.col("t"))
    inside = temporal.interval_join(spans.select("video_id", "chunk", F.col("t_lo").alias("lo"), F.col("t_hi").alias("hi")), d, VIDEO, 600.0).join(r, ["video_id", "file"], "left")
    pointer = F.when(F.nullif("pointer_target", F.lit("")).isNotNull(), F.concat(F.lit(" (pointer on: "), F.col("pointer_target"), F.lit(")"))).otherwise("")
    body = F.when(F.col("made").isNotNull(), F.concat(F.lit("\n  reconstruction ("), F.col("made"), F.lit("):\n"), F.col("body"))).otherwise("")
    entry = F.concat(F.lit("["), T.fmt_ts(F.col("t")), F.lit("] "), F.col("file"), F.lit(": "), F.coalesce("description", F.lit("")), pointer, body)
    found = inside.groupBy("video_id", "chunk").agg(T.ordered_text(entry, F.col("src"), "\n").alias("visual"))
    return spans.join(found, ["video_id", "chunk"], "left").withColumn("visual", F.coalesce("visual", F.lit(NO_VISUAL)))


DISTILLED = "struct<claims:array<struct<claim:string,mechanism:string,contrast:string,example:string,scope:string,status:string,novel:boolean,corrected:string,quote:string,t:double,frames:array<string>>>,glossary:array<struct<term:string,definition:string,t:double>>,new_state:array<string>>"


def distill(segments: DataFrame, resolved: DataFrame, descriptions: DataFrame, reconstructions: DataFrame, cache: Cache, provider: Provider, path: str) -> dict[str, DataFrame]:
    """Claims, glossary, new_state and header tables.

    What chunk k is asked depends on what chunks before it established, so all
    videos' chunks of one number go together, number after number; each round is
    written before the next. Videos without resolved lines use their transcript.
    """
    spark = segments.sparkSession
    plain = resolved.where((T.stripped(F.col("text")) != "") & ~F.col("text").startswith("#"))
    lines = plain.unionByName(_transcript_lines(segments).join(plain.select("video_id").distinct(), "video_id", "left_anti"))
    lines = lines.join(boundaries(segments, cache, provider), "video_id")
    stamp = temporal.line_time(F.col("text"))
    lines = materialized(temporal.assign_chunks(lines, VIDEO, stamp, F.col("boundaries")).drop("boundaries"), f"{path}/lines")
    spans = visual_context(temporal.chunk_spans(lines, VIDEO, stamp), descriptions, reconstructions)
    text = lines.groupBy("video_id", "chunk").agg(T.ordered_text(F.col("text"), F.col("line_no"), "\n").alias("lines"))
    todo = materialized(spans.join(text, ["video_id", "chunk"]), f"{path}/chunks")
    last = todo.agg(F.max("chunk")).first()[0] or 0
    done = spark.createDataFrame([], f"video_id string, chunk long, parsed {DISTILLED}")
    for k in range(1, last + 1):
        state = done.select("video_id", "chunk", F.posexplode("parsed.new_state").alias("no", "s")).groupBy("video_id").agg(T.ordered_text(F.concat(F.lit("- "), F.col("s")), F.struct("chunk", "no"), "\n").alias("state"))
        asked = todo.where(F.col("chunk") == k).join(state, "video_id", "left")
        asked = asked.select("video_id", "chunk", prompt("distill", state=T.falsy_to(F.col("state"), FIRST_CHUNK), chunk=F.col("chunk"), start=T.fmt_ts(F.col("t_lo")), end=T.fmt_ts(F.col("t_hi")), lines=F.col("lines"), visual=F.col("visual")).alias("prompt"))
        answered = answers_as(cache.answer(asked, provider, max_tokens=32_000, effort="high"), DISTILLED, False).select("video_id", "chunk", "parsed")
        answered.write.mode("overwrite").parquet(f"{path}/distilled/round={k}")
        # the rounds of this run alone: an earlier run into the same folder may have left more
        done = spark.read.schema(f"video_id string, chunk long, parsed {DISTILLED}").parquet(*(f"{path}/distilled/round={i}" for i in range(1, k + 1)))
    claims = done.select("video_id", "chunk", F.posexplode("parsed.claims").alias("no", "c")).select("video_id", "chunk", F.col("no").cast("long").alias("claim_no"), "c.*")
    transcripts = segments.groupBy("video_id").agg(T.ordered_text(F.col("text"), F.col("seg_no"), " ").alias("transcript"))
    checked = materialized(quotes.check_claims(claims, transcripts), f"{path}/claims")
    whole = done.groupBy("video_id").agg(F.substring(T.ordered_text(F.to_json("parsed"), F.col("chunk"), "\n"), 1, HEADER_BUDGET).alias("chunks"))
    header = answers_as(cache.answer(whole.select("video_id", prompt("header", chunks=F.col("chunks")).alias("prompt")), provider), "struct<title:string,one_line:string,assumed_context:string>", False)
    header = header.select("video_id", "parsed.*").join(quotes.failures(checked, VIDEO), "video_id", "left").na.fill(0, ["quote_check_failures"])
    glossary = done.select("video_id", "chunk", F.explode("parsed.glossary").alias("g")).select("video_id", "chunk", "g.*")
    new_state = done.select("video_id", "chunk", F.posexplode("parsed.new_state").alias("line_no", "line")).withColumn("line_no", F.col("line_no").cast("long"))
    return {"claim": checked, "glossary": glossary, "new_state": new_state, "header": header}


def source_content(manifest: DataFrame, segments: DataFrame, descriptions: DataFrame) -> DataFrame:
    """(video_id, run, kind, text): the sampled frames and the speech between them as content blocks."""
    rich = runs.last_wins(_numbered(descriptions, "t", "file"), ["video_id", "file"], "src").select("video_id", "file", F.col("needs_reconstruction").alias("rich"))
    frames = _numbered(manifest, "interval_start", "file").join(rich, ["video_id", "file"], "left").withColumn("t", F.col("interval_start"))
    frames = ranking.sample_frames(frames, VIDEO).select("video_id", F.lit("frame").alias("kind"), "t", "src", F.concat(F.lit("["), F.col("ts"), F.lit("] frame "), F.col("file"), F.lit(":")).alias("line"))
    speech = segments.select("video_id", F.lit("speech").alias("kind"), F.col("start").alias("t"), F.col("seg_no").alias("src"), T.speech_line(F.col("start"), F.col("end"), F.col("text")).alias("line"))
    w = Window.partitionBy("video_id").orderBy("t", F.col("kind") == "speech", "src")
    return timeline.coalesced_runs(frames.unionByName(speech).withColumn("pos", F.row_number().over(w)), VIDEO)


def verify(source: DataFrame, artifact: DataFrame, claims: DataFrame, segments: DataFrame, earlier: DataFrame, cache: Cache, provider: Provider, n_questions: int = QUESTIONS) -> DataFrame:
    """Reports (T12e) of a new iteration: questions from the source, answers from the artifact alone, grades, reverse check.

    artifact: video_id, text; earlier: video_id, iteration (a number) of the reports so far.
    """
    content = source.groupBy("video_id").agg(T.ordered_text(F.col("text"), F.col("run"), "\n").alias("source"))
    asked = content.select("video_id", prompt("questions", source=F.col("source"), n=F.lit(n_questions)).alias("prompt"))
    q = answers_as(cache.answer(asked, provider, effort="high"), "array<struct<q:string,ground_truth:string,kind:string,probes:string,t:double>>", True)
    questions = q.select("video_id", F.posexplode("parsed").alias("i", "x")).select("video_id", F.col("i").cast("long").alias("i"), "x.*")
    numbered = lambda *cols: F.to_json(F.transform(F.sort_array(F.collect_list(F.struct("i", *cols))), lambda s: F.struct(*(s[c].alias(c) for c in ("i", *cols)))))
    asked = questions.groupBy("video_id").agg(numbered("q").alias("questions")).join(artifact, "video_id")
    a = answers_as(cache.answer(asked.select("video_id", prompt("answers", artifact=F.col("text"), questions=F.col("questions")).alias("prompt")), provider), "array<struct<i:long,answer:string>>", True)
    answers = a.select("video_id", F.posexplode("parsed").alias("src", "x")).select("video_id", "src", "x.*")
    rows = evaluation.graded_rows(questions, answers, VIDEO).groupBy("video_id").agg(numbered("q", "ground_truth", "answer").alias("rows"))
    g = answers_as(cache.answer(rows.select("video_id", prompt("grades", rows=F.col("rows")).alias("prompt")), provider, effort="high"), "array<struct<i:long,verdict:string,hole:string>>", True)
    grades = g.select("video_id", F.posexplode("parsed").alias("src", "x")).select("video_id", "src", "x.*")
    indexed = evaluation.claim_index(claims, VIDEO, ["chunk", "claim_no"])
    transcript = _transcript_lines(segments).groupBy("video_id").agg(T.ordered_text(F.col("text"), F.col("line_no"), "\n").alias("transcript"))
    asked = indexed.groupBy("video_id").agg(numbered("claim", "quote").alias("claims")).join(transcript, "video_id")
    r = answers_as(cache.answer(asked.select("video_id", prompt("reverse", transcript=F.col("transcript"), claims=F.col("claims")).alias("prompt")), provider, effort="high"), "array<struct<i:long,supported:boolean,note:string>>", True)
    bad = evaluation.unsupported(r.select("video_id", F.explode("parsed").alias("x")).select("video_id", "x.*")).groupBy("video_id").agg(F.sort_array(F.collect_list(F.struct("i", "supported", "note"))).alias("unsupported_claims"))
    found = evaluation.holes(questions, grades, VIDEO).withColumnRenamed("q", "question")
    found = found.groupBy("video_id").agg(F.sort_array(F.collect_list(F.struct("i", "verdict", "kind", "probes", "t", "question", "hole"))).alias("holes"))
    scores = evaluation.scores(questions, grades, VIDEO)
    number = evaluation.next_iterations(scores.select("video_id").join(earlier, "video_id", "left"), VIDEO)
    out = scores.join(number, "video_id").join(found, "video_id", "left").join(bad, "video_id", "left")
    empty = lambda c: F.coalesce(c, F.array())
    out = out.withColumn("holes", empty(F.col("holes"))).withColumn("unsupported_claims", empty(F.col("unsupported_claims")))
    return out.select(*(c.split(" ")[0] for c in SCHEMAS["report"].split(", ") if c.split(" ")[0] in out.columns))


def resolved_document(lines: DataFrame) -> DataFrame:
    """(video_id, document): the resolved lines below a heading."""
    text = T.ordered_text(F.col("text"), F.col("line_no"), "\n")
    return lines.groupBy(*VIDEO).agg(F.concat(F.lit(RESOLVED_HEADING + "\n\n"), text, F.lit("\n")).alias("document"))


def distilled_document(header: DataFrame, claims: DataFrame, glossary: DataFrame, new_state: DataFrame) -> DataFrame:
    """(video_id, document): header and chunks, each with its claims, terms and established facts, as JSON."""

    def listed(df: DataFrame, name: str, order: list[str], value) -> DataFrame:
        rows = F.sort_array(F.collect_list(F.struct(*order, value.alias("v"))))
        return df.groupBy("video_id", "chunk").agg(F.transform(rows, lambda x: x["v"]).alias(name))

    inner = lambda df: F.struct(*(c for c in df.columns if c not in ("video_id", "chunk", "claim_no", "line_no")))
    parts = [listed(claims, "claims", ["claim_no"], inner(claims)), listed(glossary, "glossary", ["t", "term"], inner(glossary)), listed(new_state, "new_state", ["line_no"], F.col("line"))]
    chunks = reduce(lambda x, y: x.join(y, ["video_id", "chunk"], "full"), parts)
    row = F.struct("chunk", "claims", "glossary", "new_state")
    chunks = chunks.groupBy(*VIDEO).agg(F.collect_list(row).alias("rows"))
    chunks = chunks.withColumn("chunks", F.array_sort("rows", lambda x, y: (x["chunk"] - y["chunk"]).cast("int")))
    return header.join(chunks, "video_id", "left").select("video_id", F.to_json(F.struct("title", "one_line", "assumed_context", "quote_check_failures", "chunks")).alias("document"))
