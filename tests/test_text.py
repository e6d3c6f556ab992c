import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import text as T


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v"))).first()[0]


@pytest.mark.parametrize("seconds,stamp", [(252.0, "04:12"), (3723.0, "1:02:03"), (0.0, "00:00"), (0.5, "00:00"), (1.5, "00:02"), (2.5, "00:02"), (-3.0, "00:00"), (3599.6, "1:00:00")])
def test_fmt_ts(spark, seconds, stamp):
    assert one(spark, seconds, T.fmt_ts, "double") == stamp


@pytest.mark.parametrize("stamp,seconds", [("04:12", 252.0), ("1:02:03", 3723.0), ("00:07,500", 7.5), ("42", 42.0), (" 42 ", 42.0), ("9:1:02:03", 3723.0), ("4,5", None), ("a:b", None)])
def test_parse_ts(spark, stamp, seconds):
    assert one(spark, stamp, T.parse_ts) == seconds


def test_normalized_like_unicode_words(spark):
    assert one(spark, "  It's ÄÖ, naïve—ßtraße_1 x!", T.normalized) == "it s äö naïve ßtraße_1 x"


def test_normalized_in_one_pass(spark):
    """One pattern over the text, with the rows of two: other characters as blanks, then blanks as one."""
    in_two = lambda c: T.collapsed(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}_" + T.BLANK_CLASS[1:], " "))
    assert T.normalized(F.col("v"))._jc.toString().count("regexp_replace") == 1
    texts = [None, "", " .", "a" + T.BLANKS + "b", "a..b", "_ -_", "\u0130 \u03a3\u03c2 e\u0301\u200b\ufeffx \U0001f600\u0967\u2167", "." * 100_000]
    texts += [f"{chr(c)}a{chr(c)} {chr(c)}B" for c in range(0x3000)]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    assert df.where(~T.normalized(F.col("v")).eqNullSafe(in_two(F.col("v")))).count() == 0


@pytest.mark.parametrize("t,name", [(0.25, "frames/frame_000000.2.jpg"), (12.0, "frames/frame_000012.0.jpg"), (123456.75, "frames/frame_123456.8.jpg")])
def test_frame_file(spark, t, name):
    assert one(spark, t, T.frame_file, "double") == name


@pytest.mark.parametrize(
    "answer,array,found",
    [
        ('[{"i": 1}, {"i": 2}]', True, '[{"i": 1}, {"i": 2}]'),
        ('see [{"i": 1}, {"i": 2}] there', True, '[{"i": 1}, {"i": 2}]'),
        ('see [{"i": 1}] there', True, '[{"i": 1}]'),
        ('text\n```json\n{"a": [1]}\n```\nmore', False, '{"a": [1]}'),
        ('so: {"a": [1]} ok', False, '{"a": [1]}'),
        ("nothing", True, None),
    ],
)
def test_json_text(spark, answer, array, found):
    assert one(spark, answer, lambda c: T.json_text(c, array)) == found


def test_media_types_and_extensions(spark):
    assert one(spark, "a/b.JPEG", T.media_type) == "image/jpeg"
    assert one(spark, "a/b.txt", T.media_type) is None
    row = spark.createDataFrame([("frames/frame_1.0.jpg", "diagram"), ("x.jpg", None)], "f string, t string").select(T.reconstruction_file(F.col("f"), F.col("t"))).collect()
    assert [r[0] for r in row] == ["reconstructions/frame_1.0.mmd", "reconstructions/x.md"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(min_value=-10, max_value=1e6, allow_nan=False), min_size=50, max_size=50))
def test_fmt_ts_like_python(spark, values):
    def model(x):
        s = max(0, int(round(x)))
        h, m, s = s // 3600, s // 60 % 60, s % 60
        return f"{h}:{m:02d}:{s:02d}" if h else f"{m:02d}:{s:02d}"

    halves = [math.floor(v) + 0.5 for v in values]
    rows = spark.createDataFrame([(v,) for v in values + halves], "v double").select("v", T.fmt_ts(F.col("v"))).collect()
    assert [r[1] for r in rows] == [model(r[0]) for r in rows]
