import pytest

from tidemark.sources import subtitles

VTT = "﻿WEBVTT\n\nNOTE hi\n\n1\n00:01.000 --> 00:04.000 line:0 align:start\n<c.x>Hello</c> &amp;  <b>there</b>\n\n2\n00:05.000 --> 00:07.500\nsecond\nline\n\n00:00:59.000 --> 00:01:02.000\n42\n"


def parse(spark, text):
    return [(r["start"], r["end"], r["text"]) for r in subtitles.parse_subtitles(spark.createDataFrame([("v", text)], "video_id string, value string")).orderBy("seg_no").collect()]


def test_vtt(spark):
    assert parse(spark, VTT) == [(1.0, 4.0, "Hello &amp; there"), (5.0, 7.5, "second line")]


def test_srt_commas_and_number_inside(spark):
    assert parse(spark, "1\r\n00:00:04,000 --> 00:00:07,500\r\nA\r\n42\r\n\r\n2\r\n00:00:08,000 --> 00:00:09,000\r\nB\r\n") == [(4.0, 7.5, "A 42"), (8.0, 9.0, "B")]


def test_repeats_merge_over_an_empty_cue(spark):
    text = "00:01.000 --> 00:02.000\nsame\n\n00:02.000 --> 00:02.500\n<i></i>\n\n00:02.500 --> 00:03.000\nsame\n\n00:04.000 --> 00:05.000\nother\n"
    assert parse(spark, text) == [(1.0, 3.0, "same"), (4.0, 5.0, "other")]


def test_other_line_breaks_and_empty(spark):
    assert parse(spark, "00:01.000 --> 00:02.000\x0bone two") == [(1.0, 2.0, "one two")]
    assert parse(spark, "") == []


def test_speech_json(spark):
    value = '{"segments": [{"start": 1, "end": 2.5, "text": "  hello   there ", "words": [{"start": 1, "end": 1.5, "word": " hello"}, {"start": 1.5, "end": 2, "text": "there "}]}, {"start": 3, "end": 4, "text": "", "words": []}]}'
    rows = subtitles.parse_speech_json(spark.createDataFrame([("v", value)], "video_id string, value string")).orderBy("seg_no").collect()
    assert rows[0]["text"] == "hello there" and [w["word"] for w in rows[0]["words"]] == ["hello", "there"]
    assert rows[1]["text"] == "" and rows[1]["words"] is None


def test_read_transcripts(spark, tmp_path):
    (tmp_path / "a.VTT").write_text("00:01.000 --> 00:02.000\nx\n")
    (tmp_path / "b.json").write_text('{"segments":[{"start":0,"end":1,"text":"y"}]}')
    rows = subtitles.read_transcripts(spark, str(tmp_path)).orderBy("video_id").collect()
    assert [(r["video_id"], r["text"]) for r in rows] == [("a", "x"), ("b", "y")]
    (tmp_path / "c.txt").write_text("z")
    with pytest.raises(Exception, match="neither .vtt, .srt nor .json"):
        subtitles.read_transcripts(spark, str(tmp_path)).collect()


def test_missing_table(spark, tmp_path):
    assert subtitles.read_table(spark, "claim", str(tmp_path / "none")).count() == 0
    with pytest.raises(ValueError):
        subtitles.read_table(spark, "claim", str(tmp_path / "none"), missing_ok=False)


def test_grey_stream_of_a_decoder(spark):
    import io

    from tidemark.schemas import EngineError
    from tidemark.sources import frames

    body = b"YUV4MPEG2 W4 H2 F1:1 Ip A1:1 Cmono\n" + b"".join(b"FRAME\n" + bytes([10 + i, 35]) * 4 for i in range(3))
    assert list(frames.grey_stream(io.BytesIO(body))) == [(4, 2, bytes([10 + i, 35]) * 4) for i in range(3)]
    for bad in (b"", b"GIF89a\n", body[:-1]):
        with pytest.raises(EngineError):
            list(frames.grey_stream(io.BytesIO(bad)))
    videos = spark.createDataFrame([("v", "a.mp4"), ("w", "b.mp4")], "video_id string, path string")
    rows = frames.extract_thumbs(videos, decode=lambda path, fps, width: iter([(2, 1, path[:2].encode())] * 300)).collect()
    assert len(rows) == 600 and {(r["video_id"], bytes(r["pixels"])) for r in rows} == {("v", b"a."), ("w", b"b.")}
    assert sorted(r["idx"] for r in rows if r["video_id"] == "v") == list(range(300))
