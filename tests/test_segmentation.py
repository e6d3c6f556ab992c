import random

import pytest

from tidemark.functions.pixels import read_pgm, tile_means
from tidemark.operators import segmentation as S
from tidemark.schemas import EngineError

W, H = 64, 32


def flat(v):
    return bytes([v]) * (W * H)


def patched(v, patch, x0=0, y0=0, w=8, h=8):
    rows = [bytearray([v]) * W for _ in range(H)]
    for y in range(y0, y0 + h):
        rows[y][x0 : x0 + w] = bytes([patch]) * w
    return b"".join(map(bytes, rows))


def thumbs(spark, frames, video="v"):
    return spark.createDataFrame([(video, i, W, H, f) for i, f in enumerate(frames)], "video_id string, idx long, width int, height int, pixels binary")


def kinds(spark, *frames):
    return [r["kind"] for r in S.transitions(thumbs(spark, frames), ["video_id"]).orderBy("idx").collect()]


def test_grey_map_with_comment():
    body = bytes(range(256)) * 8
    assert read_pgm(b"P5\n# a comment\n64 32\n255\n" + body + b"extra") == (64, 32, body)


@pytest.mark.parametrize("data", [b"P2\n2 2\n255\n1234", b"P5\n2 2\n65535\n1234", b"P5\n2 2\n255\n123", b"P5\n2"])
def test_bad_grey_maps(data):
    with pytest.raises(EngineError):
        read_pgm(data)


@pytest.mark.parametrize(
    "frames,kind",
    [
        ((flat(100), flat(100)), "stable"),
        ((flat(200), patched(200, 0)), "build"),
        ((flat(200), flat(20)), "cut"),
        ((flat(100), flat(115)), "stable"),
        ((flat(100), patched(106, 250)), "build"),
    ],
)
def test_transition_kinds(spark, frames, kind):
    assert kinds(spark, *frames) == [kind]


def test_groups_of_a_growing_slide(spark):
    base, one = flat(200), patched(200, 0)
    two = bytes(b if i // W < 16 else 40 if i % W < 8 and i // W < 24 else b for i, b in enumerate(one))
    other = flat(20)
    found = S.frame_intervals(thumbs(spark, [base, base, one, one, one, two, other, other]), ["video_id"]).orderBy("start_idx").collect()
    assert [r["grp"] for r in found] == [0, 0, 0, 1]
    assert [r["end_idx"] for r in found] == [1, 4, 5, 7]
    assert [r["entered_by"] for r in found] == ["start", "build", "build", "cut"]
    assert [r["exited_by"] for r in found] == ["build", "build", "cut", "end"]
    m = S.manifest(S.keepers(S.frame_intervals(thumbs(spark, [base, base, one]), ["video_id"])), ["video_id"]).orderBy("t").collect()
    assert [(r["file"], r["ts"], r["interval_start"]) for r in m] == [("frames/frame_000001.0.jpg", "00:01", 0.0), ("frames/frame_000002.0.jpg", "00:02", 2.0)]


def test_single_frame_between_cuts_goes(spark):
    found = S.keepers(S.frame_intervals(thumbs(spark, [flat(220)] * 2 + [flat(128)] + [flat(30)] * 2), ["video_id"])).orderBy("start_idx").collect()
    assert [r["end_idx"] for r in found] == [1, 4]


def test_no_frames(spark):
    assert S.frame_intervals(thumbs(spark, []), ["video_id"]).count() == 0


def test_uneven_tiles():
    rng = random.Random(1)
    for w, h in ((10, 7), (64, 36), (3, 3)):
        a, b = (bytes(rng.randrange(256) for _ in range(w * h)) for _ in range(2))
        want = []
        for ty in range(8):
            for tx in range(8):
                cells = [(x, y) for y in range(ty * h // 8, (ty + 1) * h // 8) for x in range(tx * w // 8, (tx + 1) * w // 8)]
                want.append(sum(abs(a[y * w + x] - b[y * w + x]) for x, y in cells) / len(cells) if cells else 0.0)
        assert tile_means(a, b, w, h) == pytest.approx(want)


def test_random_sequences_like_a_loop(spark):
    rng = random.Random(2)
    rows, want = [], []
    for v in range(20):
        ks = [rng.choice(["stable", "stable", "build", "cut"]) for _ in range(rng.randrange(1, 15))]
        rows += [(f"v{v}", i, None if not i else k) for i, k in enumerate(ks)]
        cur, grp, out = [0, 0, 0, "start"], 0, []
        for i, k in enumerate(ks[1:], 1):
            if k == "stable":
                cur[1] = i
                continue
            out.append((*cur, k))
            grp += k == "cut"
            cur = [i, i, grp, k]
        want += [(f"v{v}", *x) for x in [*out, (*cur, "end")]]
    found = S.intervals(spark.createDataFrame(rows, "video_id string, idx long, kind string"), ["video_id"]).select("video_id", "start_idx", "end_idx", "grp", "entered_by", "exited_by").collect()
    assert sorted(map(tuple, found)) == sorted(want)
