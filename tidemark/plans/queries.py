"""Queries over the driver's tables: each applies operators of the engine, and each has its SQL beside it.

The tables stand in for videos: conversations are transcripts (a turn every 30
seconds), vectors are 8 x 8 tile grids, events are timed frames and speech,
documents are on-screen text and resolved lines, benchmark passages are quotes,
orders and lineitems are chunks and claims.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import evaluation, quotes, ranking, runs, segmentation, temporal, timeline
from ..sources import subtitles
from . import provider

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(f):
        QUERIES[name] = f
        if oracle:
            ORACLE[name] = oracle
        return f

    return register


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _epoch(ts: str = "ts"):
    """Whole seconds of an event."""
    return F.unix_timestamp(F.col(ts).cast("timestamp")).cast("double")


FMT = "CASE WHEN {s} // 3600 > 0 THEN printf('%d:%02d:%02d', {s} // 3600, ({s} // 60) % 60, {s} % 60) ELSE printf('%02d:%02d', {s} // 60, {s} % 60) END"
WS = r"[\t\n\x0B\f\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
NORM = r"trim(regexp_replace(regexp_replace(lower({c}), '[^\p{{L}}\p{{N}}_" + WS[1:-1].replace("{", "{{").replace("}", "}}") + r"]', ' ', 'g'), '" + WS.replace("{", "{{").replace("}", "}}") + r"+', ' ', 'g'))"


def fmt(seconds: str) -> str:
    """SQL of fmt_ts: halves round to even."""
    return FMT.format(s=f"cast(greatest(0, round_even({seconds}, 0)) AS BIGINT)")


def norm(c: str) -> str:
    return NORM.format(c=c)


SECONDS = "CAST(floor(epoch(ts)) AS BIGINT)"


# B1, B8
@query("fmt_ts_half_even", f"SELECT event_id, {fmt('event_id * 0.5')} AS stamp, '[' || {fmt('event_id * 0.5')} || '] ' || event_type AS line FROM events")
def fmt_ts_half_even(spark, sf_dir):
    t = F.col("event_id") * 0.5
    return _read(spark, sf_dir, "events").select("event_id", T.fmt_ts(t).alias("stamp"), T.stamped_line(t, F.col("event_type")).alias("line"))


# B2
@query("parse_ts_stamps", "SELECT event_id, CAST(event_id AS DOUBLE) AS seconds, CAST(event_id + 0.5 AS DOUBLE) AS with_comma FROM events")
def parse_ts_stamps(spark, sf_dir):
    stamp = T.fmt_ts(F.col("event_id"))
    return _read(spark, sf_dir, "events").select("event_id", T.parse_ts(stamp).alias("seconds"), T.parse_ts(F.concat(F.lit(" "), stamp, F.lit(",500"))).alias("with_comma"))


# B3
@query("strip_cue_tags", f"SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '{WS}+', ' ', 'g')) AS text FROM pages")
def strip_cue_tags(spark, sf_dir):
    return _read(spark, sf_dir, "pages").select("page_id", T.clean_cue(F.col("html")).alias("text"))


# B4
@query("normalize_text", f"SELECT doc_id, {norm('text')} AS normalized FROM documents")
def normalize_text(spark, sf_dir):
    return _read(spark, sf_dir, "documents").select("doc_id", T.normalized(F.col("text")).alias("normalized"))


# B9, B10
@query("frame_file_names", "SELECT vec_id, vec_id / 4.0::DOUBLE AS t, 'frames/' || printf('frame_%08.1f.jpg', vec_id / 4.0::DOUBLE) AS file FROM embeddings")
def frame_file_names(spark, sf_dir):
    t = T.frame_time(F.col("vec_id"), 4)
    return _read(spark, sf_dir, "embeddings").select("vec_id", t.alias("t"), T.frame_file(t).alias("file"))


_TYPE = "CASE event_type WHEN 'click' THEN 'equation' WHEN 'view' THEN 'diagram' WHEN 'error' THEN NULL ELSE event_type END"


# B11
@query("reconstruction_file_names", f"SELECT event_id, 'reconstructions/frame_' || event_id || CASE {_TYPE} WHEN 'equation' THEN '.tex' WHEN 'diagram' THEN '.mmd' ELSE '.md' END AS file FROM events")
def reconstruction_file_names(spark, sf_dir):
    frame = F.concat(F.lit("frames/frame_"), F.col("event_id").cast("string"), F.lit(".jpg"))
    return _read(spark, sf_dir, "events").select("event_id", T.reconstruction_file(frame, F.expr(_TYPE)).alias("file"))


# B17
@query("ocr_sentinel", "SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN '' ELSE trim(text, ' \t\n\r' || chr(11) || chr(12)) END AS text FROM documents")
def ocr_sentinel(spark, sf_dir):
    raw = F.when(F.col("doc_id") % 7 == 0, "  NO_TEXT\n").otherwise(F.col("text"))
    return _read(spark, sf_dir, "documents").select("doc_id", T.ocr_text(raw).alias("text"))


# B18
@query("header_truncation", "SELECT doc_id, CAST(length(substring(text, 1, 20000)) AS BIGINT) AS n_chars_kept, md5(substring(text, 1, 20000)) AS digest FROM documents")
def header_truncation(spark, sf_dir):
    from ..schemas import HEADER_BUDGET

    kept = F.substring("text", 1, HEADER_BUDGET)
    return _read(spark, sf_dir, "documents").select("doc_id", F.length(kept).cast("long").alias("n_chars_kept"), F.md5(kept).alias("digest"))


_LINES = r"SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents"
_CUES = f"""
SELECT doc_id, line_no, trim(regexp_replace(regexp_replace(line, '<[^>]+>', '', 'g'), '{WS}+', ' ', 'g')) AS text,
       line_no * 5.0::DOUBLE AS "start", line_no * 5.0::DOUBLE + 4 AS "end"
FROM ({_LINES}) WHERE NOT regexp_full_match(rtrim(line, ' \t\r'), '[0-9]+')
"""


# A6
@query(
    "cue_lines_to_segments",
    f"""
WITH c AS (SELECT * FROM ({_CUES}) WHERE text <> ''),
m AS (SELECT *, CASE WHEN text IS NOT DISTINCT FROM lag(text) OVER w AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS new FROM c WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)),
r AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY line_no) AS run FROM m)
SELECT doc_id, CAST(run - 1 AS BIGINT) AS seg_no, arg_min("start", line_no) AS "start", arg_max("end", line_no) AS "end", any_value(text) AS text FROM r GROUP BY doc_id, run
""",
)
def cue_lines_to_segments(spark, sf_dir):
    stamp = lambda s: F.format_string("%02d:%02d:%02d.000", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)
    cue = F.transform(F.split("text", "\n", -1), lambda line, i: F.concat(stamp(i * 5), F.lit(" --> "), stamp(i * 5 + 4), F.lit(" line:0\n"), line, F.lit("\n\n")))
    files = _read(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", F.concat(F.lit("WEBVTT\n\n"), F.array_join(cue, "")).alias("value"))
    return subtitles.parse_subtitles(files, "doc_id").drop("words")


_EVENTS = f"SELECT *, CAST({SECONDS} AS DOUBLE) AS t FROM events"


# F8
@query(
    "adjacent_duplicate_merge",
    f"""
WITH e AS (SELECT user_id, event_id, event_type, t AS "start", t + 1 AS "end" FROM ({_EVENTS})),
m AS (SELECT *, CASE WHEN event_type = lag(event_type) OVER w THEN 0 ELSE 1 END AS new FROM e WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM m)
SELECT user_id, CAST(run - 1 AS BIGINT) AS seg_no, arg_min("start", event_id) AS "start", arg_max("end", event_id) AS "end", any_value(event_type) AS event_type FROM r GROUP BY user_id, run
""",
)
def adjacent_duplicate_merge(spark, sf_dir):
    e = _read(spark, sf_dir, "events").select("user_id", "event_id", "event_type", _epoch().alias("start"), (_epoch() + 1).alias("end"))
    return runs.merge_repeats(e, ["user_id"], "event_id", "event_type")


# A7
@query(
    "speech_json_segments",
    """
SELECT event_id, CAST(0 AS BIGINT) AS seg_no, CAST(event_id AS DOUBLE) AS "start", CAST(event_id + 1 AS DOUBLE) AS "end", event_type || ' said' AS text,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_type || ',' || json_extract_string(props, '$.k') END AS words
FROM events
""",
)
def speech_json_segments(spark, sf_dir):
    k = F.get_json_object("props", "$.k")
    word = lambda name, value: F.concat(F.lit('{"start":0,"end":1,"' + name + '":" '), value, F.lit(' "}'))
    words = F.when(F.col("event_id") % 3 == 0, "").otherwise(F.concat(word("word", F.col("event_type")), F.lit(","), word("text", k)))
    value = F.concat(F.lit('{"segments":[{"start":'), F.col("event_id").cast("string"), F.lit(',"end":'), (F.col("event_id") + 1).cast("string"), F.lit(',"text":"  '), F.col("event_type"), F.lit(' \\n  said ","words":['), words, F.lit("]}]}"))
    found = subtitles.parse_speech_json(_read(spark, sf_dir, "events").select("event_id", value.alias("value")), "event_id")
    return found.withColumn("words", F.array_join(F.transform("words", lambda w: w["word"]), ","))


# B16, E10
@query("full_text", "SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS text FROM conversations GROUP BY conv_id")
def full_text(spark, sf_dir):
    return _read(spark, sf_dir, "conversations").groupBy("conv_id").agg(T.ordered_text(F.col("text"), F.col("turn"), " ").alias("text"))


def _transitions_sql(scale: int) -> str:
    return f"""
SELECT label, vec_id AS idx, {scale} AS scale, CASE WHEN med > 25.0 THEN 'cut' WHEN changed = 0 THEN 'stable' WHEN changed / len(diffs) <= 0.25 THEN 'build' ELSE 'cut' END AS kind
FROM (SELECT *, len(list_filter(diffs, lambda d: d - med > 14.0)) AS changed FROM (
  SELECT *, list_aggregate(diffs, 'median') AS med FROM (
    SELECT label, vec_id, list_transform(list_zip(before, embedding), lambda z: abs(z[1]::DOUBLE - z[2]::DOUBLE) * {scale}) AS diffs
    FROM (SELECT *, lag(embedding) OVER (PARTITION BY label ORDER BY vec_id) AS before FROM embeddings) WHERE before IS NOT NULL)))
"""


def _grids(spark, sf_dir):
    return _read(spark, sf_dir, "embeddings").select("label", F.col("vec_id").alias("idx"), "embedding")


# E1-E3, F1
@query("transition_classes", f"{_transitions_sql(40)} UNION ALL {_transitions_sql(120)}")
def transition_classes(spark, sf_dir):
    found = [segmentation.transitions(_grids(spark, sf_dir), ["label"], tiles="embedding", scale=float(s)).select("label", "idx", F.lit(s).alias("scale"), "kind") for s in (40, 120)]
    return found[0].unionByName(found[1])


_KINDS = f"""
SELECT user_id, event_id AS idx, CASE WHEN d IS NULL THEN 'start' WHEN d <= 5 THEN 'stable' WHEN d <= 100 THEN 'build' ELSE 'cut' END AS kind
FROM (SELECT *, abs(value - lag(value) OVER (PARTITION BY user_id ORDER BY event_id)) AS d FROM events)
"""


def _intervals_sql(kinds: str, key: str) -> str:
    return f"""
SELECT {key}, start_idx, end_idx, grp, entered_by, coalesce(lead(entered_by) OVER (PARTITION BY {key} ORDER BY no), 'end') AS exited_by FROM (
  SELECT {key}, no, min(idx) AS start_idx, max(idx) AS end_idx, CAST(min(g) AS BIGINT) AS grp, arg_min(kind, idx) AS entered_by FROM (
    SELECT *, sum(CASE WHEN kind IN ('build', 'cut') THEN 1 ELSE 0 END) OVER w AS no, sum(CASE WHEN kind = 'cut' THEN 1 ELSE 0 END) OVER w AS g
    FROM ({kinds}) WINDOW w AS (PARTITION BY {key} ORDER BY idx)) GROUP BY {key}, no)
"""


def _event_kinds(spark, sf_dir):
    from pyspark.sql import Window

    d = F.abs(F.col("value") - F.lag("value").over(Window.partitionBy("user_id").orderBy("event_id")))
    return _read(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("idx"), F.when(d.isNull(), F.lit(None)).when(d <= 5, "stable").when(d <= 100, "build").otherwise("cut").alias("kind"))


_GRID_KINDS = f"SELECT e.label, e.vec_id AS idx, coalesce(k.kind, 'start') AS kind FROM embeddings e LEFT JOIN ({_transitions_sql(120)}) k ON k.idx = e.vec_id AND k.label = e.label"


# F2
@query("frame_intervals", _intervals_sql(_GRID_KINDS, "label"))
def frame_intervals(spark, sf_dir):
    return segmentation.frame_intervals(_grids(spark, sf_dir), ["label"], tiles="embedding", scale=120.0)


@query("event_intervals", _intervals_sql(_KINDS, "user_id"))
def event_intervals(spark, sf_dir):
    return segmentation.intervals(_event_kinds(spark, sf_dir), ["user_id"])


_KEPT = f"SELECT * FROM ({_intervals_sql(_KINDS, 'user_id')}) WHERE NOT (start_idx = end_idx AND entered_by = 'cut' AND exited_by = 'cut')"


# C1
@query("kept_intervals", _KEPT)
def kept_intervals(spark, sf_dir):
    return segmentation.keepers(event_intervals(spark, sf_dir))


# F3, G15
@query("frame_manifest", f"SELECT user_id, end_idx / 4.0::DOUBLE AS t, {fmt('end_idx / 4.0::DOUBLE')} AS ts, start_idx / 4.0::DOUBLE AS interval_start, end_idx / 4.0::DOUBLE AS interval_end, 'frames/' || printf('frame_%08.1f.jpg', end_idx / 4.0::DOUBLE) AS file, grp, entered_by FROM ({_KEPT})")
def frame_manifest(spark, sf_dir):
    return segmentation.manifest(kept_intervals(spark, sf_dir), ["user_id"], fps=4)


_MINUTES = f"CAST(({SECONDS} // 3600) * 60 AS DOUBLE)"
_MERGED = f"SELECT user_id, CASE WHEN event_type IN ('error', 'purchase') THEN 'frame' ELSE 'speech' END AS kind, {_MINUTES} AS t, event_id AS src FROM events"


def _coarse(spark, sf_dir):
    """Events by the hour: frames are errors and purchases, the others speech."""
    t = (F.floor(_epoch() / 3600) * 60).cast("double")
    e = _read(spark, sf_dir, "events").select("user_id", t.alias("t"), F.col("event_id").alias("src"), "event_type", "value")
    is_frame = F.col("event_type").isin("error", "purchase")
    return e.where(is_frame), e.where(~is_frame)


# F4
@query("ordered_merge", f"SELECT user_id, kind, t, src, row_number() OVER (PARTITION BY user_id ORDER BY t, kind = 'speech', src) - 1 AS pos FROM ({_MERGED})")
def ordered_merge(spark, sf_dir):
    return timeline.merged(*_coarse(spark, sf_dir), ["user_id"])


# F5
@query(
    "speech_runs",
    f"""
WITH e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t, kind = 'speech', src) - 1 AS pos FROM ({_MERGED})),
m AS (SELECT *, CASE WHEN kind = 'frame' OR lag(kind) OVER w = 'frame' OR row_number() OVER w = 1 THEN 1 ELSE 0 END AS new FROM e WINDOW w AS (PARTITION BY user_id ORDER BY pos)),
r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY pos) AS run FROM m)
SELECT user_id, CAST(run AS BIGINT) AS run, kind, string_agg(CAST(src AS VARCHAR), chr(10) ORDER BY pos) AS text FROM r GROUP BY user_id, run, kind
""",
)
def speech_runs(spark, sf_dir):
    return timeline.coalesced_runs(ordered_merge(spark, sf_dir).withColumn("line", F.col("src").cast("string")), ["user_id"])


_RENDERED = f"""
SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY t, kind = 'speech', src) - 1 AS pos, kind, line FROM (
  SELECT user_id, 'frame' AS kind, {_MINUTES} AS t, event_id AS src,
    '[' || {fmt(_MINUTES)} || '–' || {fmt(_MINUTES + ' + 7')} || '] ![frame at ' || {fmt(_MINUTES + ' + 7')} || '](frames/' || event_id || '.jpg)'
    || CASE WHEN event_type = 'purchase' THEN '  <!-- build step, accretion group ' || event_id % 5 || ' -->' ELSE '' END
    || CASE WHEN event_id % 2 = 0 THEN chr(10) || '    frame content: shown ' || event_id || CASE WHEN event_id % 4 = 0 THEN chr(10) || '    pointer on: item ' || event_id % 9 ELSE '' END ELSE '' END AS line
  FROM events WHERE event_type IN ('error', 'purchase')
  UNION ALL
  SELECT user_id, 'speech', {_MINUTES}, event_id, '[' || {fmt(_MINUTES)} || '–' || {fmt(_MINUTES + ' + 2.5')} || '] "' || event_type || '"' FROM events WHERE event_type NOT IN ('error', 'purchase'))
"""


def _rendered(spark, sf_dir):
    frames, speech = _coarse(spark, sf_dir)
    file = F.concat(F.lit("frames/"), F.col("src").cast("string"), F.lit(".jpg"))
    manifest = frames.select("user_id", "src", F.col("t").alias("interval_start"), T.fmt_ts(F.col("t") + 7).alias("ts"), file.alias("file"), F.when(F.col("event_type") == "purchase", "build").otherwise("cut").alias("entered_by"), (F.col("src") % 5).alias("grp"))
    pointer = F.when(F.col("src") % 4 == 0, F.concat(F.lit("item "), (F.col("src") % 9).cast("string"))).otherwise("")
    found = frames.where("src % 2 = 0").select("user_id", file.alias("file"), "src", F.concat(F.lit("shown "), F.col("src").cast("string")).alias("description"), pointer.alias("pointer_target"))
    earlier = found.withColumn("src", F.col("src") - 1).withColumn("description", F.lit("an earlier description"))
    segments = speech.select("user_id", "src", F.col("t").alias("start"), (F.col("t") + 2.5).alias("end"), F.col("event_type").alias("text"))
    return timeline.rendered(manifest, segments, found.unionByName(earlier), ["user_id"])


# B5-B7, D1, G16
@query("rendered_timeline", _RENDERED)
def rendered_timeline(spark, sf_dir):
    return _rendered(spark, sf_dir)


# E10, G16
@query("rendered_document", f"SELECT user_id, '# Aligned multimodal context' || chr(10) || chr(10) || string_agg(line, chr(10) ORDER BY pos) || chr(10) AS document FROM ({_RENDERED}) GROUP BY user_id")
def rendered_document(spark, sf_dir):
    return timeline.document(_rendered(spark, sf_dir), ["user_id"])


# D5, G7
@query(
    "speech_windows",
    f"""
WITH e AS ({_EVENTS})
SELECT c.user_id, c.event_id AS left_id, coalesce(string_agg(CAST(s.event_id AS VARCHAR), ' ' ORDER BY s.event_id), '(no speech near this frame)') AS "window"
FROM e c LEFT JOIN e s ON s.user_id = c.user_id AND s.event_type = 'click' AND s.t + 60 >= c.t - 86400 AND s.t <= c.t + 86400
WHERE c.event_type = 'error' GROUP BY c.user_id, c.event_id
""",
)
def speech_windows(spark, sf_dir):
    from ..schemas import NO_SPEECH

    e = _read(spark, sf_dir, "events").withColumn("t", _epoch())
    centers = e.where("event_type = 'error'").select("user_id", F.col("event_id").alias("left_id"), F.col("t").alias("center"))
    segments = e.where("event_type = 'click'").select("user_id", F.col("event_id").alias("seg_no"), F.col("t").alias("start"), (F.col("t") + 60).alias("end"), F.col("event_id").cast("string").alias("text"))
    return temporal.speech_windows(centers, segments, ["user_id"], 86_400, NO_SPEECH)


# D6, F9, G9
@query(
    "batch_frames",
    f"""
WITH e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS pos FROM ({_EVENTS})),
b AS (SELECT user_id, CAST(pos // 40 AS BIGINT) AS batch, arg_min(t, pos) AS t_lo, arg_max(t, pos) + 5 AS t_hi FROM e GROUP BY ALL)
SELECT b.user_id, b.batch, count(f.event_id) AS n_frames, min(f.event_id) AS first_frame, max(f.event_id) AS last_frame
FROM b JOIN e f ON f.user_id = b.user_id AND f.event_type = 'error' AND f.t <= b.t_hi AND f.t + 3 >= b.t_lo - 60 GROUP BY b.user_id, b.batch
""",
)
def batch_frames(spark, sf_dir):
    from pyspark.sql import Window

    from ..schemas import FRAME_LOOK_BACK, RESOLUTION_BATCH

    e = _read(spark, sf_dir, "events").select("user_id", "event_id", "event_type", _epoch().alias("t")).withColumn("pos", F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1)
    b = runs.batches(e, "pos", RESOLUTION_BATCH).groupBy("user_id", "batch").agg((F.min_by("t", "pos") - FRAME_LOOK_BACK).alias("lo"), (F.max_by("t", "pos") + 5).alias("hi"))
    frames = e.where("event_type = 'error'").select("user_id", F.col("t").alias("r_lo"), (F.col("t") + 3).alias("r_hi"), "event_id")
    met = temporal.interval_join(b, frames, ["user_id"], 7 * 86_400.0)
    return met.groupBy("user_id", "batch").agg(F.count("*").alias("n_frames"), F.min("event_id").alias("first_frame"), F.max("event_id").alias("last_frame"))


_BOUNDS = [300.0, 570.0, 900.0, 3600.0]
_CHUNK_LINES = f"""
SELECT conv_id, turn AS line_no, CASE WHEN turn % 3 = 2 THEN text ELSE '[' || {fmt('turn * 170')} || '] ' || text END AS text, CASE WHEN turn % 3 = 2 THEN NULL ELSE turn * 170.0::DOUBLE END AS t FROM conversations
"""
_CHUNKS = f"""
SELECT conv_id, line_no, t, CAST(dense_rank() OVER (PARTITION BY conv_id ORDER BY slot) AS BIGINT) AS chunk FROM (
  SELECT *, max(CASE WHEN t IS NULL THEN 0 ELSE (t >= 300)::INT + (t >= 570)::INT + (t >= 900)::INT + (t >= 3600)::INT END) OVER (PARTITION BY conv_id ORDER BY line_no) AS slot FROM ({_CHUNK_LINES}))
"""


def _chunk_lines(spark, sf_dir):
    t = F.col("turn") * 170.0
    text = F.when(F.col("turn") % 3 == 2, F.col("text")).otherwise(T.stamped_line(t, F.col("text")))
    lines = _read(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("line_no"), text.alias("text"))
    return temporal.assign_chunks(lines, ["conv_id"], temporal.line_time(F.col("text")), F.array(*map(F.lit, _BOUNDS)))


# D8, C6
@query("asof_chunks", f"SELECT conv_id, line_no, chunk FROM ({_CHUNKS})")
def asof_chunks(spark, sf_dir):
    return _chunk_lines(spark, sf_dir).select("conv_id", "line_no", "chunk")


# E7
@query("chunk_spans", f"SELECT conv_id, chunk, coalesce(min(t), 0) AS t_lo, coalesce(max(t), 0) AS t_hi FROM ({_CHUNKS}) GROUP BY conv_id, chunk")
def chunk_spans(spark, sf_dir):
    return temporal.chunk_spans(_chunk_lines(spark, sf_dir), ["conv_id"], temporal.line_time(F.col("text")))


# E9, C4, G10
@query(
    "duration_gate",
    """
SELECT conv_id, duration, CAST(list_reduce(list_transform(list_sort(list_filter([450.0::DOUBLE, 100.0, 0.0, 725.0, 5000.0], lambda b: b > 0 AND b < duration)), lambda b: printf('%.1f', b)), lambda a, b: a || ',' || b) AS VARCHAR) AS boundaries
FROM (SELECT conv_id, arg_max(turn * 90.0::DOUBLE + length(text) / 10.0::DOUBLE, turn) AS duration FROM conversations GROUP BY conv_id) WHERE duration > 720
""",
)
def duration_gate(spark, sf_dir):
    from ..schemas import CHUNK_MINUTES

    segments = _read(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("seg_no"), (F.col("turn") * 90.0 + F.length("text") / 10.0).alias("end"))
    proposed = F.array(*map(F.lit, [450.0, 100.0, 0.0, 725.0, 5000.0]))
    found = temporal.durations(segments, ["conv_id"]).where(F.col("duration") > CHUNK_MINUTES[1] * 60)
    return found.withColumn("boundaries", F.array_join(F.transform(temporal.inner_boundaries(proposed, F.col("duration")), lambda b: F.format_string("%.1f", b)), ","))


_SHOWN = f"""
SELECT CAST(user_id AS VARCHAR) AS video_id, event_id, CAST({SECONDS} // 3600 AS DOUBLE) AS t, 'frames/' || event_id || '.jpg' AS file, event_type FROM events
"""


# D7, D2, G11
@query(
    "visual_context",
    f"""
WITH e AS ({_SHOWN}), s AS (SELECT video_id, min(t) + 24 AS t_lo, max(t) - 24 AS t_hi FROM e GROUP BY video_id)
SELECT s.video_id, s.t_lo, s.t_hi, coalesce(string_agg('[' || {fmt('e.t')} || '] ' || e.file || ': ' || e.event_type || CASE WHEN e.event_type = 'purchase' THEN ' (pointer on: cart)' ELSE '' END
  || CASE WHEN o.o_orderkey IS NOT NULL THEN chr(10) || '  reconstruction (reconstructions/' || e.event_id || '.md):' || chr(10) || o.o_orderpriority ELSE '' END, chr(10) ORDER BY e.t, e.file), '(no visual content in this span)') AS visual
FROM s LEFT JOIN e ON e.video_id = s.video_id AND e.t >= s.t_lo AND e.t <= s.t_hi LEFT JOIN orders o ON o.o_orderkey = e.event_id GROUP BY s.video_id, s.t_lo, s.t_hi
""",
)
def visual_context(spark, sf_dir):
    """Users are videos of one chunk on a clock of hours; orders are reconstructions of the frames that they share a number with."""
    from . import stages

    file = F.concat(F.lit("frames/"), F.col("event_id").cast("string"), F.lit(".jpg"))
    pointer = F.when(F.col("event_type") == "purchase", "cart").otherwise("")
    e = _read(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("video_id"), "event_id", F.floor(_epoch() / 3600).cast("double").alias("t"), file.alias("file"), F.col("event_type").alias("description"), pointer.alias("pointer_target"))
    spans = e.groupBy("video_id").agg(F.lit(1).cast("long").alias("chunk"), (F.min("t") + 24).alias("t_lo"), (F.max("t") - 24).alias("t_hi"))
    made = e.join(_read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("event_id"), F.col("o_orderpriority").alias("body")), "event_id")
    made = made.select("video_id", F.col("file").alias("frame"), "t", T.reconstruction_file(F.col("file"), F.lit("code")).alias("file"), "body")
    return stages.visual_context(spans, e.drop("event_id"), made).select("video_id", "t_lo", "t_hi", "visual")


_NORMED = f"d AS (SELECT doc_id, {norm('text')} AS t FROM documents), b AS (SELECT item_id, {norm('text')} AS q FROM benchmark)"


# G1, exact
@query("exact_quotes", f"WITH {_NORMED} SELECT item_id AS quote_id, doc_id AS transcript_id FROM d JOIN b ON contains(t, q) WHERE q <> ''")
def exact_quotes(spark, sf_dir):
    return quotes.exact_matches(_read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("quote_id"), F.col("text").alias("quote")), _read(spark, sf_dir, "documents").select(F.col("doc_id").alias("transcript_id"), F.col("text").alias("transcript")))


def _claims(spark, sf_dir):
    """A quote for each conversation turn (its middle words) and the whole conversation as transcript; some quotes are changed or invented."""
    c = _read(spark, sf_dir, "conversations")
    words = F.split("text", " ")
    quote = F.array_join(F.slice(words, 2, 12), " ")
    quote = F.when(F.col("turn") % 4 == 1, F.concat(quote, F.lit(" zzqx"))).when(F.col("turn") % 4 == 3, F.concat(F.lit("never said this, "), F.reverse(quote))).otherwise(F.upper(quote))
    claims = c.select(F.col("conv_id").cast("string").alias("video_id"), "turn", quote.alias("quote"))
    transcripts = c.groupBy(F.col("conv_id").cast("string").alias("video_id")).agg(T.ordered_text(F.col("text"), F.col("turn"), " ").alias("transcript"))
    return claims, transcripts


# F11
@query(
    "candidate_windows",
    f"""
WITH q AS (SELECT conv_id, turn, {norm("array_to_string(list_slice(string_split(text, ' '), 2, 13), ' ')")} AS q FROM conversations),
t AS (SELECT conv_id, {norm("string_agg(text, ' ' ORDER BY turn)")} AS t FROM conversations GROUP BY conv_id),
j AS (SELECT q.conv_id, turn, len(string_split(q, ' ')) AS n, string_split(t, ' ') AS w FROM q JOIN t ON q.conv_id = t.conv_id WHERE q <> ''),
g AS (SELECT *, greatest(1, n // 4) AS step FROM j WHERE len(w) >= n)
SELECT conv_id, turn, CAST((len(w) - n) // step + 1 AS BIGINT) AS n_windows, array_to_string(list_slice(w, ((len(w) - n) // step) * step + 1, ((len(w) - n) // step) * step + n), ' ') AS last_window FROM g
""",
)
def candidate_windows(spark, sf_dir):
    c = _read(spark, sf_dir, "conversations")
    q = c.select("conv_id", "turn", T.normalized(F.array_join(F.slice(F.split("text", " "), 2, 12), " ")).alias("q")).where("q <> ''")
    t = c.groupBy("conv_id").agg(T.normalized(T.ordered_text(F.col("text"), F.col("turn"), " ")).alias("t"))
    w = q.join(t, "conv_id").withColumn("w", quotes.candidate_windows(F.col("q"), F.col("t")))
    return w.where(F.size("w") > 0).select("conv_id", "turn", F.size("w").cast("long").alias("n_windows"), F.element_at("w", -1).alias("last_window"))


# G1, G2: the ratio of matching blocks has no SQL form
@query("fuzzy_quotes")
def fuzzy_quotes(spark, sf_dir):
    claims, transcripts = _claims(spark, sf_dir)
    return quotes.check_claims(claims, transcripts).select("video_id", "turn", "quote_verified")


# E5
@query(
    "quote_failures",
    f"WITH {_NORMED} SELECT length(q) // 200 AS size, count(*) FILTER (WHERE NOT found) AS quote_check_failures FROM (SELECT item_id, any_value(q) AS q, bool_or(coalesce(contains(t, q), FALSE)) AS found FROM b LEFT JOIN d ON contains(t, q) AND q <> '' GROUP BY item_id) GROUP BY size",
)
def quote_failures(spark, sf_dir):
    """Passages that no document holds word for word, by their length in steps of 200 characters."""
    found = exact_quotes(spark, sf_dir).select("quote_id").distinct().withColumn("hit", F.lit(True))
    size = F.floor(F.length(T.normalized(F.col("text"))) / 200).alias("size")
    checked = _read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("quote_id"), size).join(found, "quote_id", "left").withColumn("quote_verified", F.coalesce("hit", F.lit(False)))
    return quotes.failures(checked, ["size"])


_FREQUENCIES = f"""
SELECT source, line, count(*) AS n, min(doc_id * 1000000 + no) AS first FROM (
  SELECT source, doc_id, unnest(string_split(text, chr(10))) AS raw, trim(raw, ' \t\r' || chr(11) || chr(12)) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS no FROM documents)
WHERE length(line) > 2 GROUP BY source, line
"""


# E4, C3
@query("line_frequencies", f"SELECT source, line, n, first // 1000000 AS first_pos, CAST(first % 1000000 AS INT) AS first_line FROM ({_FREQUENCIES})")
def line_frequencies(spark, sf_dir):
    return ranking.line_frequencies(_read(spark, sf_dir, "documents"), ["source"], "doc_id")


# F7
@query(
    "prefix_budget",
    f"""
WITH o AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, first, line) AS rank FROM ({_FREQUENCIES})),
u AS (SELECT *, coalesce(sum(length(line) + 1) OVER (PARTITION BY source ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(line) > 20000 AS over FROM o)
SELECT source, line, n, CAST(rank AS INT) AS rank FROM (SELECT *, bool_or(over) OVER (PARTITION BY source ORDER BY rank) AS stop FROM u) WHERE NOT stop
""",
)
def prefix_budget(spark, sf_dir):
    return ranking.prefix_budget(line_frequencies(spark, sf_dir), ["source"]).select("source", "line", "n", "rank")


# F6
@query(
    "stride_sample",
    """
WITH f AS (SELECT d.source, d.doc_id, n_chars AS t, coalesce(l.quality = 1, FALSE) AS rich FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
c AS (SELECT *, count(*) OVER (PARTITION BY source) AS n, count(*) FILTER (WHERE rich) OVER (PARTITION BY source) AS n_rich, row_number() OVER (PARTITION BY source, rich ORDER BY t, doc_id) - 1 AS place FROM f),
s AS (SELECT *, 40 - least(n_rich, 40) AS room, n - n_rich AS rest FROM c),
k AS (SELECT * FROM s WHERE n <= 40 OR CASE WHEN rich THEN place < 40 ELSE place % (CASE WHEN room > 0 THEN greatest(1, rest // room) ELSE rest + 1 END) = 0 END),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY t, NOT rich, doc_id) AS rank FROM k)
SELECT source, doc_id, rich, rank FROM r WHERE n <= 40 OR rank <= 40
""",
)
def stride_sample(spark, sf_dir):
    labels = _read(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("rich"))
    frames = _read(spark, sf_dir, "documents").join(labels, "doc_id", "left").select("source", "doc_id", F.col("n_chars").alias("t"), F.col("doc_id").alias("src"), "rich")
    return ranking.sample_frames(frames, ["source"]).select("source", "doc_id", "rich", "rank")


def _segments(spark, sf_dir):
    c = _read(spark, sf_dir, "conversations")
    words = F.array(F.struct(F.lit(0.0).alias("start"), F.lit(1.0).alias("end"), F.substring("text", 1, 5).alias("word")))
    return c.select("conv_id", F.col("turn").alias("seg_no"), (F.col("turn") * 30.0).alias("start"), (F.col("turn") * 30.0 + F.length("text") / 10.0).alias("end"), "text", words.alias("words"))


# D10, G6
@query(
    "sparse_corrections",
    "SELECT conv_id, turn AS seg_no, CASE WHEN (conv_id + turn) % 5 = 0 THEN 'second ' || text ELSE text END AS text, (conv_id + turn) % 5 <> 0 AS has_words FROM conversations",
)
def sparse_corrections(spark, sf_dir):
    s = _segments(spark, sf_dir)
    hit = s.where((F.col("conv_id") + F.col("seg_no")) % 5 == 0)
    change = lambda word, src: hit.select("conv_id", F.col("seg_no").alias("i"), F.concat(F.lit(word), F.col("text")).alias("text"), F.lit(src).alias("src"))
    stray = hit.select("conv_id", (F.col("seg_no") + 100_000).alias("i"), F.lit("out of range").alias("text"), F.lit(3).alias("src"))
    out = evaluation.apply_corrections(s, change("first ", 1).unionByName(change("second ", 2)).unionByName(stray), ["conv_id"])
    return out.select("conv_id", "seg_no", "text", F.col("words").isNotNull().alias("has_words"))


# A12
@query("best_transcript", "SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 0 ELSE 1 END AS seg_no, coalesce('quality ' || l.quality, d.text) AS text FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")
def best_transcript(spark, sf_dir):
    """Documents are transcripts of one segment, labels the corrected ones."""
    raw = _read(spark, sf_dir, "documents").select("doc_id", F.lit(0).alias("seg_no"), "text")
    corrected = _read(spark, sf_dir, "labels").select("doc_id", F.lit(1).alias("seg_no"), F.concat(F.lit("quality "), F.col("quality").cast("string")).alias("text"))
    return evaluation.best_transcript(raw, corrected.join(raw, "doc_id", "left_semi"), ["doc_id"])


# F9
@query("fixed_batches", "SELECT source, pos // 120 AS batch, count(*) AS n, min(doc_id) AS first_doc, max(doc_id) AS last_doc FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos FROM documents) GROUP BY source, batch")
def fixed_batches(spark, sf_dir):
    from pyspark.sql import Window

    from ..schemas import CORRECTION_BATCH

    d = _read(spark, sf_dir, "documents").select("source", "doc_id", (F.row_number().over(Window.partitionBy("source").orderBy("doc_id")) - 1).alias("pos"))
    return runs.batches(d, "pos", CORRECTION_BATCH).groupBy("source", "batch").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))


# F10
@query(
    "carried_state",
    """
SELECT conv_id, turn, coalesce(string_agg(item, chr(10)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '(nothing yet — this is the first chunk)') AS carried
FROM (SELECT conv_id, turn, CASE WHEN turn % 3 <> 1 THEN '- ' || role || ' ' || turn END AS item FROM conversations)
""",
)
def carried_state(spark, sf_dir):
    from ..schemas import FIRST_CHUNK

    item = F.when(F.col("turn") % 3 != 1, F.array(F.concat(F.lit("- "), F.col("role"), F.lit(" "), F.col("turn").cast("string"))))
    out = runs.carried_state(_read(spark, sf_dir, "conversations").select("conv_id", "turn", item.alias("items")), ["conv_id"], "turn", "items")
    return out.select("conv_id", "turn", T.falsy_to(F.array_join("carried", "\n"), FIRST_CHUNK).alias("carried"))


_VERDICT = "CASE WHEN l.quality = 1 THEN 'correct' WHEN l.toxic = 1 THEN 'wrong' ELSE 'missing' END"


def _graded(spark, sf_dir):
    q = _read(spark, sf_dir, "documents").select("source", F.col("doc_id").alias("i"))
    verdict = F.when(F.col("quality") == 1, "correct").when(F.col("toxic") == 1, "wrong").otherwise("missing")
    g = _read(spark, sf_dir, "labels").select("doc_id", verdict.alias("verdict"), F.when(F.col("doc_id") % 2 == 0, F.lit("a gap")).alias("hole"), F.col("doc_id").alias("src"))
    return q, g.join(q.select(F.col("i").alias("doc_id"), "source"), "doc_id").withColumnRenamed("doc_id", "i")


# E6
@query(
    "score_strings",
    "SELECT source, CAST(count(*) FILTER (WHERE quality = 1) AS BIGINT) AS correct, count(*) AS total, count(*) FILTER (WHERE l.doc_id IS NULL) AS ungraded, count(*) FILTER (WHERE quality = 1) || '/' || count(*) AS score FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY source",
)
def score_strings(spark, sf_dir):
    return evaluation.scores(*_graded(spark, sf_dir), ["source"])


# D3, C8
@query("holes", f"SELECT source, d.doc_id AS i, {_VERDICT} AS verdict, CASE WHEN d.doc_id % 2 = 0 THEN 'a gap' ELSE '' END AS hole FROM documents d JOIN labels l ON l.doc_id = d.doc_id WHERE {_VERDICT} <> 'correct'")
def holes(spark, sf_dir):
    return evaluation.holes(*_graded(spark, sf_dir), ["source"])


# D4, B20
@query("answers_with_default", "SELECT source, d.doc_id AS i, CASE WHEN l.doc_id IS NULL THEN '(no answer)' ELSE 'quality ' || l.quality END AS answer FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")
def answers_with_default(spark, sf_dir):
    q = _read(spark, sf_dir, "documents").select("source", F.col("doc_id").alias("i"))
    a = _read(spark, sf_dir, "labels").join(q.withColumnRenamed("i", "doc_id"), "doc_id").select("source", F.col("doc_id").alias("i"), F.concat(F.lit("quality "), F.col("quality").cast("string")).alias("answer"), F.col("doc_id").alias("src"))
    return evaluation.graded_rows(q, a, ["source"])


# E8
@query("nested_claim_count", "SELECT o_custkey, CAST(sum(coalesce(n, 0)) AS BIGINT) AS n_claims FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey GROUP BY o_custkey")
def nested_claim_count(spark, sf_dir):
    claims = _read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list("l_linenumber").alias("claims"))
    return evaluation.claim_counts(_read(spark, sf_dir, "orders").join(claims, "o_orderkey", "left"), ["o_custkey"])


# E11, C9, G14
@query(
    "unsupported_claims",
    """
SELECT o_custkey, i, l_orderkey, l_linenumber FROM (
  SELECT o_custkey, l_orderkey, l_linenumber, row_number() OVER (PARTITION BY o_custkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_returnflag) - 1 AS i, CASE WHEN l_returnflag = 'R' THEN FALSE WHEN l_returnflag = 'A' THEN TRUE END AS supported
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey) WHERE NOT coalesce(supported, TRUE)
""",
)
def unsupported_claims(spark, sf_dir):
    claims = _read(spark, sf_dir, "lineitem").join(_read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    supported = F.when(F.col("l_returnflag") == "R", False).when(F.col("l_returnflag") == "A", True)
    indexed = evaluation.claim_index(claims.withColumn("supported", supported), ["o_custkey"], ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag"])
    return evaluation.unsupported(indexed).select("o_custkey", "i", "l_orderkey", "l_linenumber")


# A14
@query(
    "artifact_text",
    "SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, concat_ws(chr(10) || chr(10), '## distilled.yaml' || chr(10) || chr(10) || d.text, '## resolved.md' || chr(10) || chr(10) || 'quality ' || l.quality) AS text FROM documents d FULL JOIN labels l ON l.doc_id = d.doc_id",
)
def artifact_text(spark, sf_dir):
    d = _read(spark, sf_dir, "documents").select("doc_id", "text")
    r = _read(spark, sf_dir, "labels").select("doc_id", F.concat(F.lit("quality "), F.col("quality").cast("string")).alias("text"))
    return evaluation.artifact_text(d, r, ["doc_id"])


# F12
@query("next_iteration", "SELECT conv_id, printf('iter_%02d', max(turn) + 1) AS iteration FROM conversations GROUP BY conv_id")
def next_iteration(spark, sf_dir):
    return evaluation.next_iterations(_read(spark, sf_dir, "conversations"), ["conv_id"], "turn")


# G20
@query("stage_status", "SELECT d.doc_id, stage, CASE stage WHEN 'transcript' THEN TRUE ELSE l.doc_id IS NOT NULL END AS done FROM documents d CROSS JOIN (VALUES ('transcript'), ('report')) s(stage) LEFT JOIN labels l ON l.doc_id = d.doc_id")
def stage_status(spark, sf_dir):
    d = _read(spark, sf_dir, "documents").select("doc_id")
    expected = d.withColumn("stage", F.explode(F.array(F.lit("transcript"), F.lit("report"))))
    present = d.withColumn("stage", F.lit("transcript")).unionByName(_read(spark, sf_dir, "labels").select("doc_id", F.lit("report").alias("stage")))
    return evaluation.stage_status(expected, present, ["doc_id"])


_KEY = """sha256('{"effort":null,"max_tokens":16000,"messages":[{"content":[{"text":"' || replace(replace(replace(%s, '\\', '\\\\'), '"', '\\"'), chr(10), '\\n') || '","type":"text"}],"role":"user"}],"model":"offline","system":null}')"""


# B14, G4, B19
@query("request_keys", f"SELECT conv_id, turn, {_KEY % 'text'} AS key FROM conversations")
def request_keys(spark, sf_dir):
    return _read(spark, sf_dir, "conversations").select("conv_id", "turn", provider.request_key("offline", F.col("text")).alias("key"))


# D11, G3
@query("cache_split", f"SELECT conv_id, turn, {_KEY % 'text'} IN (SELECT {_KEY % 'text'} FROM conversations WHERE role = 'user') AS hit FROM conversations")
def cache_split(spark, sf_dir):
    requests = request_keys(spark, sf_dir)
    asked = _read(spark, sf_dir, "conversations").where("role = 'user'")
    cache = asked.select(provider.request_key("offline", F.col("text")).alias("key")).select("key", F.lit("kept").alias("text")).dropDuplicates(["key"])
    hits, misses = provider.split_by_cache(requests, cache)
    return hits.select("conv_id", "turn", F.lit(True).alias("hit")).unionByName(misses.select("conv_id", "turn", F.lit(False).alias("hit")))


# A13, B14
@query(
    "image_blocks",
    "SELECT page_id, base64(encode(html)) AS data, sha256(base64(encode(html))) AS digest, CASE page_id % 5 WHEN 0 THEN 'image/jpeg' WHEN 1 THEN 'image/png' WHEN 2 THEN 'image/gif' WHEN 3 THEN 'image/webp' END AS media_type FROM pages",
)
def image_blocks(spark, sf_dir):
    suffix = F.element_at(F.array(*map(F.lit, ["a/x.JPG", "b.png", "c.d/e.Gif", "f.webp", "g.txt"])), (F.col("page_id") % 5 + 1).cast("int"))
    content = F.encode("html", "UTF-8")
    return _read(spark, sf_dir, "pages").select("page_id", T.base64_text(content).alias("data"), provider.image_digest(content).alias("digest"), T.media_type(suffix).alias("media_type"))


# G8
@query(
    "bounded_repair",
    "SELECT d.doc_id, CASE WHEN l.quality = 0 THEN 'repaired' ELSE 'first' END AS body, CASE WHEN l.quality = 0 AND l.toxic = 1 THEN 'mismatch' ELSE 'match' END AS verdict FROM documents d JOIN labels l ON l.doc_id = d.doc_id",
)
def bounded_repair(spark, sf_dir):
    from .stages import repair_once

    made = _read(spark, sf_dir, "documents").join(_read(spark, sf_dir, "labels"), "doc_id").select("doc_id", "toxic", F.lit("first").alias("body"), F.when(F.col("quality") == 0, "mismatch").otherwise("match").alias("verdict"))
    repair = lambda rows: rows.withColumn("body", F.lit("repaired")).withColumn("verdict", F.when(F.col("toxic") == 1, "mismatch").otherwise("match"))
    return repair_once(made, repair).select("doc_id", "body", "verdict")


# 3.4
@query(
    "latest_reports_ranked",
    """
SELECT conv_id, turn, role, rank FROM (SELECT conv_id, turn, role, CASE role WHEN 'assistant' THEN 0 WHEN 'user' THEN 1 ELSE 3 END AS rank, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS n FROM conversations) WHERE n = 1
""",
)
def latest_reports_ranked(spark, sf_dir):
    latest = evaluation.latest_reports(_read(spark, sf_dir, "conversations"), ["conv_id"], "turn")
    status = F.when(F.col("role") == "assistant", "demonstrated_on_screen").when(F.col("role") == "user", "asserted").otherwise("cited")
    return evaluation.status_ranked(latest.withColumn("status", status)).select("conv_id", "turn", "role", F.col("status_rank").alias("rank"))


# B12
@query("tolerant_json", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CASE WHEN event_id % 4 = 3 THEN 2 ELSE 1 END AS n FROM events WHERE event_id % 5 < 4")
def tolerant_json(spark, sf_dir):
    p = F.col("props")
    wrapped = (
        F.when(F.col("event_id") % 5 == 4, F.lit("no json at all"))
        .when(F.col("event_id") % 4 == 0, F.concat(F.lit("Sure:\n```json\n["), p, F.lit("]\n```\nthat is it")))
        .when(F.col("event_id") % 4 == 1, F.concat(F.lit("Here you go: ["), p, F.lit("] as asked")))
        .when(F.col("event_id") % 4 == 2, F.concat(F.lit("  ["), p, F.lit("]\n")))
        .otherwise(F.concat(F.lit("two of them ["), p, F.lit(", "), p, F.lit("] here")))
    )
    found = _read(spark, sf_dir, "events").select("event_id", F.from_json(T.json_text(wrapped, array=True), "array<struct<k:long>>").alias("a"))
    return found.where("a IS NOT NULL").select("event_id", F.col("a")[0]["k"].alias("k"), F.size("a").alias("n"))


# A1, E1: pixel blobs made from the vectors, one pixel a tile
@query(
    "pixel_diffs",
    """
WITH p AS (SELECT label, vec_id, list_transform(embedding, lambda x: greatest(least(floor((x::DOUBLE + 1) * 127), 255), 0)) AS px FROM embeddings),
b AS (SELECT *, lag(px) OVER (PARTITION BY label ORDER BY vec_id) AS before FROM p),
d AS (SELECT label, vec_id, list_transform(list_zip(before, px), lambda z: abs(z[1] - z[2])) AS diffs FROM b WHERE before IS NOT NULL),
m AS (SELECT *, list_aggregate(diffs, 'median') AS med FROM d)
SELECT label, vec_id AS idx, round(med, 6) AS med, CASE WHEN med > 25.0 THEN 'cut' WHEN changed = 0 THEN 'stable' WHEN changed / len(diffs) <= 0.25 THEN 'build' ELSE 'cut' END AS kind
FROM (SELECT *, len(list_filter(diffs, lambda d: d - med > 14.0)) AS changed FROM m)
""",
)
def pixel_diffs(spark, sf_dir):
    from ..functions.pixels import pgm_udf

    byte = lambda x: F.lpad(F.hex(F.greatest(F.least(F.floor((x.cast("double") + 1) * 127), F.lit(255)), F.lit(0)).cast("int")), 2, "0")
    blob = F.concat(F.encode(F.lit("P5\n# made from a vector\n8 8\n255\n"), "US-ASCII"), F.unhex(F.array_join(F.transform("embedding", byte), "")))
    thumbs = _read(spark, sf_dir, "embeddings").select("label", F.col("vec_id").alias("idx"), pgm_udf()(blob).alias("p")).select("label", "idx", "p.*")
    found = segmentation.transitions(thumbs, ["label"])
    return found.select("label", "idx", F.round("med", 6).alias("med"), "kind")


def entry_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which benchmark passages occur word for word in which documents."""
    return exact_quotes(spark, sf_dir)
