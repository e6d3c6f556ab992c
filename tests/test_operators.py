import difflib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import evaluation, quotes, ranking, runs, temporal, timeline


def test_windows_are_closed(spark):
    s = spark.createDataFrame([("v", 0, 0.0, 5.0, "decays"), ("v", 1, 35.0, 60.0, "later"), ("v", 2, 35.5, 36.0, "last")], "video_id string, seg_no long, start double, end double, text string")
    c = spark.createDataFrame([("v", "a", 5.0), ("v", "b", 500.0), ("w", "c", 5.0)], "video_id string, left_id string, center double")
    found = {r["left_id"]: r["window"] for r in temporal.speech_windows(c, s, ["video_id"], 30, "none").collect()}
    assert found == {"a": "decays later", "b": "none", "c": "none"}


def test_interval_join_like_a_loop(spark):
    rng = random.Random(3)
    make = lambda n: [(f"v{rng.randrange(3)}", i, lo, lo + rng.choice([0, 1, 50])) for i in range(n) for lo in [rng.randrange(-50, 200)]]
    left, right = make(60), make(60)
    a = spark.createDataFrame([(k, i, float(x), float(y)) for k, i, x, y in left], "k string, left_id long, lo double, hi double")
    b = spark.createDataFrame([(k, i, float(x), float(y)) for k, i, x, y in right], "k string, r_id long, r_lo double, r_hi double")
    want = sorted((i, j) for k, i, x, y in left for m, j, u, v in right if k == m and v >= x and u <= y)
    assert sorted((r["left_id"], r["r_id"]) for r in temporal.interval_join(a, b, ["k"], 17.0).collect()) == want
    outer = temporal.interval_join(a, b, ["k"], 17.0, "left")
    assert outer.select("left_id").distinct().count() == 60


def test_chunks(spark):
    lines = ["[00:10] a", "[04:00] b", " ", "[09:30] c", "[12:00] d", "  "]
    df = spark.createDataFrame([("v", i, x) for i, x in enumerate(lines)], "video_id string, line_no long, text string")
    out = temporal.assign_chunks(df, ["video_id"], temporal.line_time(F.col("text")), F.array(F.lit(300.0), F.lit(570.0)))
    assert [(r["line_no"], r["chunk"]) for r in out.orderBy("line_no").collect()] == [(0, 1), (1, 1), (2, 1), (3, 2), (4, 2), (5, 2)]
    hours = spark.createDataFrame([("v", 0, "[59:50] a"), ("v", 1, "[1:00:10] b")], "video_id string, line_no long, text string")
    out = temporal.assign_chunks(hours, ["video_id"], temporal.line_time(F.col("text")), F.array(F.lit(3600.0)))
    assert [r["chunk"] for r in out.orderBy("line_no").collect()] == [1, 2]


def test_timeline(spark):
    m = spark.createDataFrame([("v", 0, 11.0, "00:11", 4.0, 11.0, "frames/a.jpg", 0, "build"), ("v", 1, 20.0, "00:20", 12.0, 20.0, "frames/b.jpg", 1, "cut")], "video_id string, src long, t double, ts string, interval_start double, interval_end double, file string, grp long, entered_by string")
    s = spark.createDataFrame([("v", 0, 4.0, 8.0, "one"), ("v", 1, 15.0, 16.0, "two")], "video_id string, src long, start double, end double, text string")
    d = spark.createDataFrame([("v", "frames/a.jpg", 0, "old", "x"), ("v", "frames/a.jpg", 1, "a slide", "the title"), ("v", "frames/b.jpg", 0, "b", "")], "video_id string, file string, src long, description string, pointer_target string")
    lines = [r["line"] for r in timeline.rendered(m, s, None, ["video_id"]).orderBy("pos").collect()]
    assert lines == ["[00:04–00:11] ![frame at 00:11](frames/a.jpg)  <!-- build step, accretion group 0 -->", '[00:04–00:08] "one"', "[00:12–00:20] ![frame at 00:20](frames/b.jpg)", '[00:15–00:16] "two"']
    doc = timeline.document(timeline.rendered(m, s, d, ["video_id"]), ["video_id"]).first()["document"]
    assert "    frame content: a slide\n    pointer on: the title\n" in doc and "old" not in doc and doc.count("pointer on") == 1 and doc.endswith('"two"\n')


TALK = "so it's the decay curve that matters here, and the half life is about five days, which nobody expected when the first measurements came in last spring"


@pytest.mark.parametrize(
    "quote,found",
    [
        ("the half life is about five days", True),
        ("Its the decay CURVE that matters here", True),
        ("and the half life is around five days which nobody expected when the first measurements", True),
        ("radioactivity fades exponentially over time", False),
        ("", False),
        (None, False),
        ("word " * 60, False),
    ],
)
def test_quotes(spark, quote, found):
    claims = spark.createDataFrame([("v", quote)], "video_id string, quote string")
    assert quotes.check_claims(claims, spark.createDataFrame([("v", TALK)], "video_id string, transcript string")).first()["quote_verified"] is found


def test_fuzzy_like_a_plain_scan():
    rng = random.Random(4)
    vocabulary = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta"]
    for _ in range(60):
        t = [rng.choice(vocabulary) for _ in range(40)]
        n = rng.randrange(1, 30)
        at = rng.randrange(0, 10)
        q = t[at : at + n]
        for _ in range(rng.randrange(0, 4)):
            q[rng.randrange(len(q))] = rng.choice(vocabulary)
        step = max(1, len(q) // 4)
        want = any(difflib.SequenceMatcher(None, " ".join(q), " ".join(t[i : i + len(q)])).ratio() >= 0.85 for i in range(0, len(t) - len(q) + 1, step))
        assert quotes.fuzzy_ratio_reached(" ".join(q), " ".join(t)) == want


def subsequence(a, b):
    last = [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(row[j], last[j + 1]))
        last = row
    return last[-1]


def test_common_subsequences():
    """Of a quote and each window, against the plain table."""
    rng = random.Random(6)
    for letters in ("ab", "abcdefgh", "a\u00e9\U0001f600z"):
        t = quotes.Transcript(" ".join("".join(rng.choices(letters, k=rng.randrange(1, 9))) for _ in range(90)))
        for n in (1, 5, 40):
            q = " ".join("".join(rng.choices(letters, k=rng.randrange(1, 9))) for _ in range(n))
            first = np.array(sorted(rng.sample(range(90 - n + 1), 20)) + [90 - n])
            assert t.common(q, t.starts[first], t.ends[first + n - 1]).tolist() == [subsequence(q, " ".join(t.words[i : i + n])) for i in first]


def test_few_windows_are_compared_by_matching_blocks(monkeypatch):
    """Quotes read backwards have the characters of many windows, but not their order."""
    rng = random.Random(6)
    talk = quotes.Transcript(" ".join("".join(rng.choices("etaoin", k=4)) for _ in range(400)))
    compared, plain = [], difflib.SequenceMatcher
    monkeypatch.setattr(quotes.difflib, "SequenceMatcher", lambda *a: compared.append(a) or plain(*a))
    assert not any(talk.holds_nearly(" ".join(talk.words[i : i + 12])[::-1]) for i in range(0, 380, 10))
    assert len(compared) < 10


def test_claims_of_a_long_video_are_dealt_out(spark, monkeypatch):
    """A row for each block of claims, and the same verdicts, equal and missing quotes included."""
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(600)]
    said = [" ".join(words[i : i + 6]) for i in range(0, 590, 7)]
    told = [x if i % 3 else x[::-1] if i % 2 else x.replace("a", "", 1) for i, x in enumerate(said)] + [None, "", said[1], said[1]]
    claims = spark.createDataFrame([("v", i, x) for i, x in enumerate(told)] + [("w", 0, said[0])], "video_id string, claim_no long, quote string")
    transcripts = spark.createDataFrame([("v", " ".join(words))], "video_id string, transcript string")
    seen = lambda: sorted((r["video_id"], r["claim_no"], r["quote_verified"]) for r in quotes.check_claims(claims, transcripts).collect())
    assert "RepartitionByExpression" in quotes.check_claims(claims, transcripts)._jdf.queryExecution().optimizedPlan().toString()
    in_one = seen()
    assert len(in_one) == len(told) + 1 and {x for _, _, x in in_one} == {True, False}
    for block in (1, 5, 1000):
        monkeypatch.setattr(quotes, "CLAIM_BLOCK", block)
        assert seen() == in_one


def test_exact_matches_by_anchor_too(spark, monkeypatch):
    texts = ["one two three four five six seven eight", "xone two three four five sixy seven", "five six"]
    texts += ["", None, "thirty-three four! FIVE"]
    wanted = ["two three four five six", "one two three four five six", "five six", "nothing like it at all here", "...", "three four five", "four five", "five", "ne two", "six", "two three four five", "e two three four fi", None, "five six"]
    q = spark.createDataFrame([*enumerate(wanted)], "quote_id long, quote string")
    t = spark.createDataFrame([*enumerate(texts)], "transcript_id long, transcript string")
    plain = lambda x: re.sub(r"\s+", " ", re.sub(r"[^\w\s]", " ", (x or "").lower())).strip()
    want = sorted((i, j) for i, a in enumerate(wanted) for j, b in enumerate(texts) if plain(a) and plain(a) in plain(b))
    assert sorted(tuple(r) for r in quotes.exact_matches(q, t).collect()) == want
    monkeypatch.setattr(quotes, "SHORT_BLOCK", 2)
    assert sorted(tuple(r) for r in quotes.exact_matches(q, t).collect()) == want


def test_few_quotes_take_one_pass(spark, sf_dir, monkeypatch):
    """No transcript is moved or read twice for quotes that one automaton takes; with more of them the rows are the same."""
    from tidemark.plans.queries import QUERIES

    got = QUERIES["quote_failures"](spark, sf_dir)
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan parquet [doc_id") == 1
    monkeypatch.setattr(quotes, "SHORT_BLOCK", 50)
    assert sorted(got.collect()) == sorted(QUERIES["quote_failures"](spark, sf_dir).collect())


def test_claims_like_a_plain_check(spark, sf_dir):
    """The query's verdicts against difflib over every window of every conversation."""
    from tidemark.plans.queries import QUERIES, _claims

    plain = lambda x: re.sub(r"\s+", " ", re.sub(r"[^\w\s]", " ", (x or "").lower())).strip()
    claims, transcripts = _claims(spark, sf_dir)
    said = {r["video_id"]: plain(r["transcript"]) for r in transcripts.collect()}
    want = {}
    for r in claims.collect():
        q, t = plain(r["quote"]), said[r["video_id"]]
        w, n = t.split(), len(q.split())
        windows = [" ".join(w[i : i + n]) for i in range(0, len(w) - n + 1, max(1, n // 4))] if n else []
        want[r["video_id"], r["turn"]] = bool(q) and (q in t or any(difflib.SequenceMatcher(None, q, x).ratio() >= 0.85 for x in windows))
    got = {(r["video_id"], r["turn"]): r["quote_verified"] for r in QUERIES["fuzzy_quotes"](spark, sf_dir).collect()}
    assert got == want and len(set(want.values())) == 2


def test_claims(spark):
    claims = spark.createDataFrame([("v", 0, "about five days"), ("v", 1, "an invented line"), ("w", 0, "no transcript")], "video_id string, claim_no long, quote string")
    checked = quotes.check_claims(claims, spark.createDataFrame([("v", TALK)], "video_id string, transcript string"))
    assert {(r["video_id"], r["claim_no"]): r["quote_verified"] for r in checked.collect()} == {("v", 0): True, ("v", 1): False, ("w", 0): False}
    assert {r["video_id"]: r["quote_check_failures"] for r in quotes.failures(checked, ["video_id"]).collect()} == {"v": 1, "w": 1}


def vocabulary(texts, limit):
    counts, out, used = {}, [], 0
    for t in texts:
        for line in t.splitlines():
            if len(line.strip()) > 2:
                counts[line.strip()] = counts.get(line.strip(), 0) + 1
    for line in sorted(counts, key=lambda k: -counts[k]):
        if used + len(line) > limit:
            break
        out.append(line)
        used += len(line) + 1
    return out


@pytest.mark.parametrize("limit", [0, 3, 12, 40, 10_000])
def test_vocabulary_stops_at_the_first_too_long(spark, limit):
    rng = random.Random(5)
    texts = ["\n".join(rng.choice([" abc", "a longer line ", "xy", "", "mid line", "z" * 15]) for _ in range(6)) for _ in range(5)]
    df = spark.createDataFrame([("v", i, t) for i, t in enumerate(texts)], "video_id string, pos long, text string")
    for keys in (["video_id"], []):
        got = ranking.prefix_budget(ranking.line_frequencies(df, keys, "pos"), keys, limit).orderBy("rank").collect()
        assert [r["line"] for r in got] == vocabulary(texts, limit)


@pytest.mark.parametrize("n,n_rich", [(40, 5), (41, 0), (41, 41), (100, 3), (100, 40), (100, 60), (90, 39), (0, 0)])
def test_frame_budget(spark, n, n_rich):
    rng = random.Random(n * 100 + n_rich)
    rich = set(rng.sample(range(n), n_rich))
    frames = [(float(i), i in rich) for i in range(n)]
    if n > 40:
        r, rest = [f for f in frames if f[1]], [f for f in frames if not f[1]]
        room = 40 - min(len(r), 40)
        stride = max(1, len(rest) // room) if room else len(rest) + 1
        want = sorted(r[:40] + rest[::stride])[:40]
    else:
        want = frames
    df = spark.createDataFrame([("v", t, i, x) for i, (t, x) in enumerate(frames)], "video_id string, t double, src long, rich boolean")
    assert [r["t"] for r in ranking.sample_frames(df, ["video_id"]).orderBy("t").collect()] == [w[0] for w in want]


def test_scores_and_holes(spark):
    q = spark.createDataFrame([("v", i, f"q{i}") for i in range(4)], "video_id string, i long, q string")
    g = spark.createDataFrame([("v", 0, "correct", "", 0), ("v", 1, "wrong", None, 1), ("v", 2, "wrong", "x", 2), ("v", 2, "correct", "", 3), ("v", 9, "correct", "", 4)], "video_id string, i long, verdict string, hole string, src long")
    assert evaluation.scores(q, g, ["video_id"]).select("correct", "total", "ungraded", "score").first() == (3, 4, 1, "3/4")
    assert [(r["i"], r["hole"]) for r in evaluation.holes(q, g, ["video_id"]).collect()] == [(1, "")]
    r = spark.createDataFrame([(0, True), (1, False), (2, None)], "i long, supported boolean")
    assert [x["i"] for x in evaluation.unsupported(r).collect()] == [1]


def test_carried_state_and_batches(spark):
    df = spark.createDataFrame([("v", 1, ["a"]), ("v", 2, None), ("v", 3, ["b", "c"]), ("v", 4, [])], "video_id string, chunk long, items array<string>")
    assert [r["carried"] for r in runs.carried_state(df, ["video_id"], "chunk", "items").orderBy("chunk").collect()] == [[], ["a"], ["a"], ["a", "b", "c"]]
    assert [r["batch"] for r in runs.batches(spark.range(5).withColumnRenamed("id", "p"), "p", 2).orderBy("p").collect()] == [0, 0, 1, 1, 2]


def test_normalized_matches_python(spark, sf_dir):
    from tidemark.functions.text import normalized

    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", normalized(F.col("text")).alias("n")).collect()
    assert all(r["n"] == re.sub(r"\s+", " ", re.sub(r"[^\w\s]", " ", r["text"].lower())).strip() for r in rows)
