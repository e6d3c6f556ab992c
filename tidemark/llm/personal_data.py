"""Personal data in whole texts: patterns propose, checksums confirm, context scores.

Base kinds are email, ip, card and phone: leftmost non-overlapping matches of a
pattern for each kind, kept if the kind's check holds (Luhn for cards, parts of
at most 255 for addresses, 9 to 15 digits for phones); a failing match is
dropped and not retried. Further kinds never replace a base span: `iban`
(country, length and mod-97) and `number`, 9 to 15 digits with separators that
words such as "phone" or "ssn" close by lift over the threshold.

Offsets count code points, the end is exclusive. A null text counts as empty;
an empty text has no spans; repeated rows give repeated rows; other columns are
left alone. Long texts are scanned whole, in time linear in their length.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import release

#: Order of kinds at equal starts; the first four are the base. Fixed values.
KINDS = ("email", "ip", "card", "phone", "iban", "number")
BASE = KINDS[:4]
#: Patterns of the base kinds and of the further ones. Fixed values.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
NUMBERS = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3,}+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])([A-Z]{2})[0-9]{2}")
NUMBER = re.compile(r"(?<![\w.+-])\(?[0-9]{2,5}\)?(?:[ -][0-9]{2,5}){1,4}(?![\w-])")
#: Characters of an IBAN by country, from the registry of ISO 13616. Fixed values.
IBAN_CHARS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}
#: What follows the first four characters of a country's IBAN.
IBAN_REST = {c: re.compile(rf"(?: ?[A-Z0-9]){{{n - 4}}}(?![A-Za-z0-9])") for n, cs in IBAN_CHARS.items() for c in cs.split()}
#: Words near a span that raise its score, by kind. Fixed values.
CONTEXT = {
    "email": ("mail", "contact", "write", "reach"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "payment", "credit", "charge"),
    "phone": ("phone", "call", "tel", "mobile", "fax"),
    "iban": ("iban", "bank", "account", "transfer"),
    "number": ("phone", "call", "tel", "mobile", "fax", "ssn", "social", "passport", "telefon", "téléphone", "teléfono"),
}
#: Score of a confirmed span and of an unconfirmed one, what context adds, and the least score of a span that no checksum confirms.
CONFIRMED, PROPOSED, LIFT, LEAST = 0.8, 0.4, 0.2, 0.6
WORD = re.compile(r"[^\W\d_]+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    """Whether the Luhn sum of a digit string is a multiple of 10."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def mod97(code: str) -> bool:
    """Whether an IBAN without blanks leaves 1 modulo 97."""
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the e-mail pattern, found from each "@" so that no text is scanned twice."""
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            free = m.end()
        else:
            free = max(free, at)  # what stands before this "@" belongs to no later match
        at = text.find("@", max(free, at + 1))


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """IBANs of their country's length that mod-97 confirms, whatever follows; a failing start does not hide a later one."""
    free = 0
    for m in IBAN.finditer(text):
        if m.start() >= free and (rest := IBAN_REST.get(m[1])) and (r := rest.match(text, m.end())) and mod97(text[m.start() : r.end()].replace(" ", "")):
            free = r.end()
            yield m.start(), free


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """Matches of four numbers with dots between: by fours, from the left, of each run of numbers with dots.

    No digit is read twice, however long a run of digits is.
    """
    for run in NUMBERS.finditer(text):
        parts, at = run[0].split("."), run.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            size = sum(map(len, four)) + 3
            # leading zeros do not count; a number of four digits or more is over 255 whatever it is
            if all(len(p) <= 3 or len(p.lstrip("0")) <= 3 for p in four) and all(int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, at + size
            at += size + 1


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base kinds, by start and then kind."""
    found = [(s, e, "email") for s, e in _emails(text)]
    found += [(s, e, "ip") for s, e in _ips(text)]
    for m in CARD.finditer(text):
        if 12 <= m.end() - m.start() <= 37 and 12 <= len(d := _digits(m[0])) <= 19 and luhn(d):  # 19 digits have 18 blanks between at most
            found.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                found.append((m.start(), m.end(), "phone"))
    found.sort(key=lambda x: (x[0], KINDS.index(x[2])))
    return found


def _near(text: str, start: int, end: int, kind: str, window: int) -> bool:
    words = WORD.findall(text[max(0, start - window) : start].lower()) + WORD.findall(text[end : end + window].lower())
    return any(w in CONTEXT[kind] for w in words)


def scored_spans(text: str, window: int = 40) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) of every span: the base ones and those that the further kinds add."""
    base = base_spans(text)
    more = [(s, e, "iban") for s, e in _ibans(text)]
    starts, reach = [], []  # of the spans so far by start, with the furthest end up to each
    for s, e, _ in sorted(base + more):
        starts.append(s)
        reach.append(max(e, reach[-1]) if reach else e)
    for m in NUMBER.finditer(text):
        before = bisect.bisect_left(starts, m.end())
        if 9 <= len(_digits(m[0])) <= 15 and not (before and reach[before - 1] > m.start()):
            if PROPOSED + LIFT * _near(text, m.start(), m.end(), "number", window) >= LEAST:
                more.append((m.start(), m.end(), "number"))
    out = []
    for s, e, kind in sorted(base + more, key=lambda x: (x[0], KINDS.index(x[2]))):
        score = (PROPOSED if kind in ("number", "phone") else CONFIRMED) + LIFT * _near(text, s, e, kind, window)
        out.append((kind, s, e, score))
    return out


SPANS = "array<struct<kind:string,start:long,end:long,score:double>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def find_spans(docs: DataFrame, window: int = 40) -> DataFrame:
    """(doc_id, spans) of every document, spans by start and then kind."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[dict(zip(("kind", "start", "end", "score"), s)) for s in scored_spans(t.as_py() or "", window)] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _SPANS)], names=["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(work, f"doc_id long, spans {SPANS}")


def redacted(text: str, window: int = 40) -> str:
    """The text with each span replaced by its kind in brackets, until nothing is found."""
    while found := scored_spans(text, window):
        out, at = [], 0
        for kind, start, end, _ in found:
            if start >= at:
                out += [text[at:start], f"[{kind.upper()}]"]
            at = max(at, end)
        text = "".join([*out, text[at:]])
    return text


def redact(docs: DataFrame, window: int = 40) -> DataFrame:
    """docs with spans replaced in `text`, and `n_chars` brought up to date where it is a column. Null texts stay null."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array([None if (t := x.as_py()) is None else redacted(t, window) for x in texts], pa.string()))
        release()

    out = docs.withColumn("text", F.col("text").cast("string"))
    out = out.mapInArrow(work, out.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def _is(kind: str):
    return lambda s: s["kind"] == kind


def digest(found: DataFrame) -> DataFrame:
    """Counts and digests of find_spans() rows."""
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select(
        "doc_id",
        *(F.size(F.filter("spans", _is(k))).cast("long").alias(f"n_{k}") for k in BASE),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("top_score"),
    )
