"""The stages end to end with an offline provider."""

import json
import re
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidemark.plans import stages as S
from tidemark.plans.catalog import Catalog
from tidemark.plans.provider import Cache, offline, request_key, split_by_cache

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import tests


def respond(prompt, images, system, max_tokens, effort):
    if prompt.startswith("Write down all text"):
        return " NO_TEXT " if images[0].endswith(b"0") else "Quartz drift slide\nab"
    if "Correct only" in prompt:
        n = json.loads(re.search(r"as JSON:\n(.*?)\n", prompt)[1])
        return "Sure: " + json.dumps([{"i": s["i"], "text": s["text"].replace("courts", "quartz")} for s in n if "courts" in s["text"]] + [{"i": 999, "text": "stray"}])
    if prompt.startswith("Frame at"):
        return json.dumps({"description": "a plot", "pointer_target": "the peak", "content_type": "chart", "needs_reconstruction": images[0].endswith(b"1"), "on_screen_text_gist": None})
    if prompt.startswith("Speech around"):
        return "first try"
    if prompt.startswith("Compare"):
        return json.dumps({"verdict": "match" if "again" in prompt else "mismatch", "discrepancies": ["axis"]})
    if prompt.startswith("This text of the frame"):
        return "again"
    if prompt.startswith("Replace what"):
        return "\n".join(x for x in prompt.splitlines() if re.match(r"\[\d+:\d+–", x) and "![" not in x)
    if prompt.startswith("Return a JSON array of seconds"):
        return "```json\n[600, 300, 0]\n```"
    if prompt.startswith("Established so far"):
        k = int(re.search(r"Chunk (\d+),", prompt)[1])
        seen = re.search(r"Established so far:\n(.*?)\n\nChunk", prompt, re.S)[1]
        assert ("(nothing yet" in seen) == (k == 1) and (k == 1 or f"- fact {k - 1}" in seen)
        return json.dumps({"claims": [{"claim": f"c{k}", "quote": "the quartz drift" if k == 1 else "never said", "status": "asserted", "t": 1.0, "frames": []}], "glossary": [{"term": "quartz", "definition": "d", "t": 0}], "new_state": [f"fact {k}"]})
    if prompt.startswith("Return JSON with title"):
        return json.dumps({"title": "T", "one_line": "o", "assumed_context": "a"})
    if "questions with q" in prompt:
        return json.dumps([{"q": f"q{i}", "ground_truth": "g", "kind": "verbal", "probes": "claim", "t": i} for i in range(3)])
    if "Answer from this text alone" in prompt:
        return json.dumps([{"i": 0, "answer": "g"}, {"i": 1, "answer": "?"}])
    if prompt.startswith("Grade each"):
        assert "(no answer)" in prompt
        return json.dumps([{"i": 0, "verdict": "correct", "hole": ""}, {"i": 1, "verdict": "wrong", "hole": "h"}])
    if "Which claims" in prompt:
        return json.dumps([{"i": 0, "supported": True}, {"i": 1, "supported": False, "note": "n"}])
    raise AssertionError(prompt[:200])


def test_all_stages(spark, tmp_path):
    c = Catalog(spark, str(tmp_path))
    provider, cache = offline(respond), Cache(spark, c.path("model_cache"))
    frames = [("v", float(t), f"00:{t:02d}", float(t - 3), float(t), f"frames/f{i}.jpg", 0, "build" if i else "start") for i, t in enumerate((5, 12))]
    manifest = c.write("frame", spark.createDataFrame(frames, c.read("frame").schema))
    images = spark.createDataFrame([("v", f"frames/f{i}.jpg", bytearray(f"img{i}".encode())) for i in range(2)], "video_id string, file string, content binary")
    texts = ["about the courts drift", "this one here", "and later more"]
    rows = [("v", i, float(s), float(s + 8), t, [(float(s), float(s + 1), "w")]) for i, (s, t) in enumerate(zip((0, 10, 800), texts))]
    c.write("segment", spark.createDataFrame(rows, c.read("segment").schema))
    ocr = c.write("ocr", S.ocr(manifest, images, cache, provider))
    assert {r["file"]: r["text"] for r in ocr.collect()} == {"frames/f0.jpg": "", "frames/f1.jpg": "Quartz drift slide\nab"}
    c.write("segment_corrected", S.correct(c.read("segment"), ocr, manifest, cache, provider))
    best = c.segments().orderBy("seg_no").collect()
    assert [r["text"] for r in best] == ["about the quartz drift", *texts[1:]] and [r["words"] is None for r in best] == [True, False, False]
    d = c.write("description", S.describe(manifest, images, c.segments(), cache, provider))
    assert d.count() == 2
    assert "    pointer on: the peak" in S.align(manifest, c.segments(), d).first()["document"]
    r = c.write("reconstruction", S.reconstruct(d, images, c.segments(), cache, provider)).collect()
    assert [(x["frame"], x["file"], x["body"], x["roundtrip"]["verdict"]) for x in r] == [("frames/f1.jpg", "reconstructions/f1.md", "again", "match")]
    resolved = c.write("resolved_line", S.resolve(manifest, c.segments(), d, cache, provider))
    assert resolved.count() == 3
    made = S.distill(c.segments(), resolved, d, c.read("reconstruction"), cache, provider, c.path("work"))
    claims = c.write("claim", made["claim"])
    assert {x["claim"]: x["quote_verified"] for x in claims.collect()} == {"c1": True, "c2": False}
    assert made["header"].first()["quote_check_failures"] == 1 and made["glossary"].count() == 2
    artifact = spark.createDataFrame([("v", "the artifact")], "video_id string, text string")
    earlier = spark.createDataFrame([("v", 3)], "video_id string, iteration int")
    report = c.write("report", S.verify(S.source_content(manifest, c.segments(), d), artifact, claims, c.segments(), earlier, cache, provider)).first()
    assert (report["iteration"], report["score"], report["ungraded"]) == ("iter_04", "1/3", 1)
    assert [h["i"] for h in report["holes"]] == [1] and [u["i"] for u in report["unsupported_claims"]] == [1]
    status = {r["stage"]: r["done"] for r in c.status().collect()}
    assert all(status.values()) and len(status) == 9
    n = cache.read().count()
    S.ocr(manifest, images, cache, offline(lambda *a: 1 / 0)).collect()  # every answer comes from the cache
    assert cache.read().count() == n


def test_a_second_run_forgets_the_first(spark, tmp_path):
    """Rounds that an earlier run left in the work folder neither reach prompts nor claims."""
    c = Catalog(spark, str(tmp_path))
    told = []

    def chunks(prefix, n):
        def answer(prompt, images, system, max_tokens, effort):
            if prompt.startswith("Return a JSON array of seconds"):
                return json.dumps([900 * i for i in range(1, n)])
            if prompt.startswith("Established so far"):
                state = re.search(r"Established so far:\n(.*?)\n\nChunk", prompt, re.S)[1]
                if prefix == "new" and "old" in state:
                    raise AssertionError(state)
                k = int(re.search(r"Chunk (\d+),", prompt)[1])
                return json.dumps({"claims": [{"claim": f"{prefix}{k}", "quote": "x"}], "glossary": [], "new_state": [f"{prefix}-fact{k}"]})
            return json.dumps({"title": "T", "one_line": "o", "assumed_context": "a"})

        return answer

    segments = spark.createDataFrame([("v", i, 900.0 * i + 1, 900.0 * i + 800, f"part {i}", None) for i in range(4)], c.read("segment").schema)
    for prefix, n in (("old", 4), ("new", 2)):
        cache = Cache(spark, c.path(f"cache-{prefix}"))
        made = S.distill(segments, c.read("resolved_line"), c.read("description"), c.read("reconstruction"), cache, offline(chunks(prefix, n)), c.path("work"))
        told.append(sorted(r["claim"] for r in made["claim"].collect()))
    assert told == [["old1", "old2", "old3", "old4"], ["new1", "new2"]]


def test_keys(spark):
    df = spark.createDataFrame([("a",), ('quote " and \n',), ("ä",)], "p string")
    keys = [[r[0] for r in df.select(request_key(m, F.col("p"), system=s, max_tokens=t, effort=e)).collect()] for m, s, t, e in (("m", None, 1, None), ("n", None, 1, None), ("m", "s", 1, None), ("m", None, 2, None), ("m", None, 1, "low"))]
    assert len({k for row in keys for k in row}) == 15
    cache = df.limit(1).select(request_key("m", F.col("p")).alias("key"), F.lit("t").alias("text"))
    hit, miss = split_by_cache(df.withColumn("key", request_key("m", F.col("p"))), cache)
    assert hit.count() == 1 and miss.count() == 2


def test_answers_that_do_not_parse(spark):
    with pytest.raises(Exception, match="no JSON in the answer"):
        S.answers_as(spark.createDataFrame([("hm",)], "answer string"), "array<int>", True).collect()


def test_answers_that_came_are_kept(spark, tmp_path):
    """A refusal, a cut and a failing call are raised and not kept; the others' answers are, and are not asked for again."""
    from tidemark.plans.provider import Answer, ModelError, Provider

    asked = spark.createDataFrame([(p,) for p in ("good", "refuse", "long", "break", "other")], "prompt string")
    cache = Cache(spark, str(tmp_path / "cache"))

    def call(prompt, images, system, max_tokens, effort):
        if prompt == "break":
            raise OSError("no line")
        return Answer(prompt.upper(), {"refuse": "refusal", "long": "max_tokens"}.get(prompt, "end"), "m-1", "3 tokens")

    with pytest.raises(ModelError, match="3 requests"):
        cache.answer(asked, Provider("m", lambda: call))
    assert {(r["text"], r["model"], r["usage"]) for r in cache.read().collect()} == {("GOOD", "m-1", "3 tokens"), ("OTHER", "m-1", "3 tokens")}
    again = cache.answer(asked, Provider("m", lambda: lambda prompt, *a: f"second {prompt}")).collect()
    assert {r["prompt"]: r["answer"] for r in again} == {"good": "GOOD", "other": "OTHER", "refuse": "second refuse", "long": "second long", "break": "second break"}


def test_command_line(spark, tmp_path, capsys):
    from tidemark.cli import execute, main, parser

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "v.vtt").write_text("00:01.000 --> 00:02.000\nhello\n")
    (tmp_path / "thumbs" / "v").mkdir(parents=True)
    for i, v in enumerate((10, 10, 200), 1):
        (tmp_path / "thumbs" / "v" / f"{i:06d}.pgm").write_bytes(b"P5\n16 8\n255\n" + bytes([v]) * 128)
    run = lambda *args: execute(spark, parser().parse_args(["-a", str(tmp_path / "out"), *args]))
    run("transcribe", "--from", str(tmp_path / "in"))
    run("sample", "--thumbs", str(tmp_path / "thumbs"))
    run("ocr")
    run("align")
    c = Catalog(spark, str(tmp_path / "out"))
    assert c.segments().first()["text"] == "hello" and c.read("ocr").count() == 2
    assert {bytes(r["content"])[:8] for r in c.read("image").collect()} == {b"\x89PNG\r\n\x1a\n"}
    done = {r["stage"]: r["done"] for r in c.status().collect()}
    assert done["segment"] and done["ocr"] and not done["report"]
    said = capsys.readouterr().out
    assert "transcribe: 1 segments" in said and "sample: kept 2 frames" in said and "read 2 frames, 2 of them with text" in said
    text = "\n".join(r["value"] for r in spark.read.text(c.path("documents/aligned.md")).collect())
    assert text.startswith("# Aligned") and '"hello"' in text
    # errors are told and end with 1, also where a table is missing
    import tidemark.cli

    for args, message in ((["describe"], "no table frame"), (["transcribe"], "transcribe needs"), (["sample"], "folder of videos"), (["verify"], "no table claim")):
        assert main(["-a", str(tmp_path / "empty"), *args]) == 1 and message in capsys.readouterr().err
    recogniser = f"{__name__}:recogniser"
    sys.modules.setdefault(__name__, sys.modules[recogniser.partition(":")[0]])
    (tmp_path / "videos").mkdir()
    (tmp_path / "videos" / "w.mp4").write_bytes(b"0")
    run("transcribe", "--videos", str(tmp_path / "videos"), "--asr", recogniser, "--asr-model", "tiny")
    assert [(r["video_id"], r["text"]) for r in c.read("segment").collect()] == [("w", "by tiny")]
    assert tidemark.cli._provider(None, "own").model == "own"


def recogniser(size):
    return lambda path: json.dumps({"segments": [{"start": 0, "end": 1, "text": f" by {size}", "words": []}]})


def test_documents(spark):
    segment = spark.createDataFrame([("v", 1, "b"), ("v", 0, "a")], "video_id string, line_no long, text string")
    assert S.resolved_document(segment).first()["document"].endswith("\n\na\nb\n")
    header = spark.createDataFrame([("v", "T", "o", "a", 1)], "video_id string, title string, one_line string, assumed_context string, quote_check_failures long")
    claims = spark.createDataFrame([("v", 2, 0, "c2"), ("v", 1, 1, "b1"), ("v", 1, 0, "a1")], "video_id string, chunk long, claim_no long, claim string")
    glossary = spark.createDataFrame([("v", 1, "term", "d", 0.0)], "video_id string, chunk long, term string, definition string, t double")
    state = spark.createDataFrame([("v", 2, 0, "fact")], "video_id string, chunk long, line_no long, line string")
    found = json.loads(S.distilled_document(header, claims, glossary, state).first()["document"])
    assert found["title"] == "T" and [[x["claim"] for x in k["claims"]] for k in found["chunks"]] == [["a1", "b1"], ["c2"]]
    assert found["chunks"][0]["glossary"][0]["term"] == "term" and found["chunks"][1]["new_state"] == ["fact"]


def test_streaming_like_batch(spark, tmp_path):
    from tidemark.operators.segmentation import frame_intervals
    from tidemark.streaming.segmentation import closed_intervals

    values = [10, 10, 200, 200, 201, 90, 200]
    rows = [(v, i, [float(x)] * 8) for v in ("a", "b") for i, x in enumerate(values)]
    df = spark.createDataFrame(rows, "video_id string, idx long, tiles array<double>")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = closed_intervals(stream).writeStream.format("memory").queryName("closed").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    assert q.awaitTermination(60)
    got = {tuple(r) for r in spark.table("closed").select("video_id", "start_idx", "end_idx", "grp", "entered_by", "exited_by").collect()}
    want = {tuple(r) for r in frame_intervals(df, ["video_id"], tiles="tiles").where("exited_by <> 'end'").select("video_id", "start_idx", "end_idx", "grp", "entered_by", "exited_by").collect()}
    assert got == want and want
