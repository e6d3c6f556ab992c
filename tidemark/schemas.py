"""Schemas of the engine's tables and its operating constants.

Every table carries `video_id`; times are seconds as doubles; positions that
fix an order (`idx`, `seg_no`, `line_no`) are columns.
"""

from __future__ import annotations

WORD = "struct<start:double,end:double,word:string>"
SCHEMAS = {
    "thumb": "video_id string, idx long, width int, height int, pixels binary",
    "transition": "video_id string, idx long, diffs array<double>, kind string",
    "interval": "video_id string, start_idx long, end_idx long, grp long, entered_by string, exited_by string",
    "frame": "video_id string, t double, ts string, interval_start double, interval_end double, file string, grp long, entered_by string",
    "segment": f"video_id string, seg_no long, start double, end double, text string, words array<{WORD}>",
    "image": "video_id string, file string, content binary",
    "ocr": "video_id string, file string, text string",
    "description": "video_id string, file string, t double, description string, pointer_target string, content_type string, needs_reconstruction boolean, on_screen_text_gist string",
    "reconstruction": "video_id string, frame string, t double, content_type string, file string, body string, roundtrip struct<verdict:string,discrepancies:array<string>>",
    "resolved_line": "video_id string, line_no long, text string",
    "chunk": "video_id string, chunk long, span string",
    "claim": "video_id string, chunk long, claim_no long, claim string, mechanism string, contrast string, example string, scope string, status string, novel boolean, corrected string, quote string, t double, frames array<string>, quote_verified boolean",
    "glossary": "video_id string, chunk long, term string, definition string, t double",
    "new_state": "video_id string, chunk long, line_no long, line string",
    "header": "video_id string, title string, one_line string, assumed_context string, quote_check_failures long",
    "question": "video_id string, i long, q string, ground_truth string, kind string, probes string, t double",
    "answer": "video_id string, i long, answer string",
    "grade": "video_id string, i long, verdict string, hole string",
    "reverse": "video_id string, i long, supported boolean, note string",
    "report": "video_id string, iteration string, score string, correct long, total long, ungraded long, holes array<struct<i:long,verdict:string,kind:string,probes:string,t:double,question:string,hole:string>>, unsupported_claims array<struct<i:long,supported:boolean,note:string>>",
    "model_cache": "key string, text string, model string, usage string",
}

#: Enumerations. Fixed values.
ENTERED_BY = ("start", "build", "cut")
EXITED_BY = ("build", "cut", "end")
TRANSITIONS = ("stable", "build", "cut")
CONTENT_TYPES = ("slide", "chart", "code", "diagram", "equation", "whiteboard", "terminal", "talking_head", "demo", "other")
ROUNDTRIP_VERDICTS = ("match", "minor_issues", "mismatch")
CLAIM_STATUS = ("demonstrated_on_screen", "asserted", "speculated", "cited")
GRADES = ("correct", "partial", "wrong", "missing")

#: Operating constants. Fixed values.
FPS = 1.0
THUMB_WIDTH = 64
GRID = 8
TILE_THRESHOLD = 14.0
BUILD_FRACTION = 0.25
CUT_THRESHOLD = 25.0
SPEECH_RADIUS = 30.0
FUZZY_THRESHOLD = 0.85
CHUNK_MINUTES = (5, 12)
CORRECTION_BATCH = 120
RESOLUTION_BATCH = 40
FRAME_LOOK_BACK = 60.0
VOCABULARY_BUDGET = 20_000
HEADER_BUDGET = 20_000
SOURCE_IMAGES = 40
QUESTIONS = 18
REPAIR_ROUNDS = 1
NO_TEXT = "NO_TEXT"
NO_ANSWER = "(no answer)"
NO_SPEECH = "(no speech near this frame)"
NO_VISUAL = "(no visual content in this span)"
FIRST_CHUNK = "(nothing yet — this is the first chunk)"
RESOLVED_HEADING = "# Deixis-resolved transcript"
EXTENSIONS = {"equation": ".tex", "diagram": ".mmd"}
MEDIA_TYPES = {".jpg": "image/jpeg", ".jpeg": "image/jpeg", ".png": "image/png", ".webp": "image/webp", ".gif": "image/gif"}


class EngineError(ValueError):
    """An input that the engine cannot use."""
