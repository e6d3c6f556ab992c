"""Does a quote occur in a transcript: word for word after normalising, else nearly."""

from __future__ import annotations

import difflib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.text import normalized
from ..schemas import FUZZY_THRESHOLD

#: Words of the inner gram by which a quote and a transcript meet, at most.
ANCHOR = 4
#: Most quotes, and most characters in them, that are looked for in one pass over the transcripts: an automaton takes about 46 bytes a character.
SHORT_BLOCK, SHORT_CHARS = 20_000, 4_000_000


def contains(quote: Column, transcript: Column) -> Column:
    """Whether a normalised quote occurs in a normalised transcript; an empty quote does not."""
    return F.coalesce((quote != "") & F.contains(transcript, quote), F.lit(False))


def _grams(words: Column, size: int) -> Column:
    """Hashes of all runs of `size` words (1 to ANCHOR) of an array, in order: of words, of pairs, then of pairs and what follows."""
    bound = lambda value, use: F.get(F.transform(F.array(value), use), F.lit(0))  # noqa: E731  use's argument is computed once
    joined = lambda x, y, at: F.zip_with(x, F.slice(y, at + 1, F.greatest(F.size(y) - at, F.lit(0))), lambda p, q: F.xxhash64(p, q))
    trimmed = lambda runs, h: F.slice(runs, F.lit(1), F.greatest(F.size(h) - (size - 1), F.lit(0)))  # noqa: E731  the shorter side was padded
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    if size == 1:
        return hashed
    if size == 2:
        return bound(hashed, lambda h: trimmed(joined(h, h, 1), h))
    return bound(hashed, lambda h: bound(joined(h, h, 1), lambda two: trimmed(joined(two, h if size == 3 else two, 2), h)))


def exact_matches(quotes: DataFrame, transcripts: DataFrame) -> DataFrame:
    """(quote_id, transcript_id) of every quote in every transcript that holds it.

    quotes: quote_id, quote; transcripts: transcript_id, transcript. Quotes that
    one automaton takes are looked for in one pass, which moves no transcript.
    Where there are more, a match may cut a quote's first and last word short but
    holds its inner words whole. So quotes of three words or more meet
    transcripts by an equi-join on the hash of an inner run of words, of the
    quote's runs the one that the fewest transcripts hold: a common run is no hot
    key. Only pairs that meet are compared. Quotes of one or two words, which
    have no such run, are looked for by automata, block by block.
    """
    q = quotes.select("quote_id", normalized(F.col("quote")).alias("quote")).where("quote <> ''")
    if _blocks(q) <= 1:
        return _scanned(q, transcripts)
    q = q.withColumn("words", F.split("quote", " "))
    long, short = q.where(F.size("words") > 2), q.where(F.size("words") <= 2).select("quote_id", "quote")
    found = _scanned(short, transcripts)
    inner = F.size("words") - 2
    size = F.least(inner, F.lit(ANCHOR))  # shorter runs only where the quote has no longer one
    for k in sorted(r[0] for r in long.select(size).distinct().collect()):
        part = long.where(size == k).select("quote_id", "quote", _grams(F.slice("words", F.lit(2), inner), k).alias("grams"))
        found = found.unionByName(_met(part, transcripts, k))
    return found


def _met(quotes: DataFrame, transcripts: DataFrame, size: int) -> DataFrame:
    """Matches of quotes (quote_id, quote, grams), by the rarest of their inner grams of `size` words."""
    grams = quotes.select("quote_id", F.explode(F.array_distinct("grams")).alias("gram"))
    words = transcripts.select("transcript_id", F.split(normalized(F.col("transcript")), " ").alias("words"))
    held = words.select("transcript_id", F.explode(F.array_distinct(_grams(F.col("words"), size))).alias("gram")).join(grams.select("gram").distinct(), "gram")
    often = held.groupBy("gram").agg(F.count("*").alias("often"))
    anchors = grams.join(often, "gram").groupBy("quote_id").agg(F.min_by("gram", F.struct("often", "gram")).alias("gram"))
    pairs = held.join(anchors, "gram").select("quote_id", "transcript_id")
    pairs = pairs.join(quotes.select("quote_id", "quote"), "quote_id").join(transcripts.select("transcript_id", "transcript"), "transcript_id")
    return pairs.where(F.contains(normalized(F.col("transcript")), F.col("quote"))).select("quote_id", "transcript_id")


def _blocks(quotes: DataFrame) -> int:
    """How many automata quotes (quote_id, quote) take."""
    n, chars = quotes.agg(F.count("*"), F.coalesce(F.sum(F.length("quote")), F.lit(0))).first()
    return max(-(-n // SHORT_BLOCK), -(-chars // SHORT_CHARS))


#: The automaton that this Python worker made last, by its name: tasks of one pass share it.
_AUTOMATON: dict = {}


def _automaton(name: str, block: list[tuple]):
    """The automaton of a block of (quote_id, quote), and the ids of each quote."""
    if name not in _AUTOMATON:
        import ahocorasick

        same: dict[str, list] = {}
        for quote_id, quote in block:
            same.setdefault(quote, []).append(quote_id)
        automaton = ahocorasick.Automaton()
        for quote in same:
            automaton.add_word(quote, quote)
        automaton.make_automaton()
        _AUTOMATON.clear()
        _AUTOMATON[name] = automaton, same
    return _AUTOMATON[name]


def _scanned(quotes: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Matches of quotes (quote_id, quote): each pass looks for a block of them of bounded size in all transcripts at once."""
    kinds = [quotes.schema["quote_id"].dataType, transcripts.schema["transcript_id"].dataType]
    out = quotes.sparkSession.createDataFrame([], f"quote_id {kinds[0].simpleString()}, transcript_id {kinds[1].simpleString()}")
    id_type = to_arrow_type(kinds[0])
    blocks = _blocks(quotes)
    texts = transcripts.select("transcript_id", normalized(F.col("transcript")).alias("transcript"))
    for b in range(blocks):
        block = [tuple(r) for r in quotes.where(F.pmod(F.xxhash64("quote"), F.lit(blocks)) == b).collect()]

        def work(batches: Iterator[pa.RecordBatch], block=block, name=uuid.uuid4().hex) -> Iterator[pa.RecordBatch]:
            automaton, same = _automaton(name, block)
            for batch in batches:
                found: tuple[list, list] = ([], [])
                for transcript_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    for quote in {x for _, x in automaton.iter(text.as_py() or "")}:
                        found[0].extend(same[quote])
                        found[1].extend([transcript_id] * len(same[quote]))
                yield pa.RecordBatch.from_arrays([pa.array(found[0], id_type), pa.array(found[1], batch.schema.field(0).type)], names=["quote_id", "transcript_id"])

        if block:
            out = out.unionByName(texts.mapInArrow(work, out.schema))
    return out


def candidate_windows(quote: Column, transcript: Column) -> Column:
    """Windows of the quote's number of words over the transcript, a quarter of it (at least 1) apart; both normalised.

    The tail is left out where the step passes it.
    """
    # what stands inside a lambda is evaluated anew for every element: the words are bound once by an outer one
    bound = F.array(F.struct(F.split(transcript, " ").alias("words"), F.size(F.split(quote, " ")).alias("n")))

    def windows(x: Column) -> Column:
        words, n = x["words"], x["n"]
        step = F.greatest(F.floor(n / 4), F.lit(1)).cast("int")
        starts = F.when(F.size(words) >= n, F.sequence(F.lit(0), F.size(words) - n, step)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(words, i + 1, n), " "))

    return F.get(F.transform(bound, windows), F.lit(0))


#: Characters are counted in so many classes.
_CLASSES = 64
#: About how many claims meet their transcript in one row, and the most characters of windows that are compared at once.
CLAIM_BLOCK, WINDOW_CHARS = 64, 1_000_000


class Transcript:
    """A normalised transcript, made ready once for all quotes that are looked for in it."""

    def __init__(self, text: str):
        self.words = text.split()
        self.text = " ".join(self.words)
        lengths = np.fromiter(map(len, self.words), dtype=np.int64, count=len(self.words))
        self.ends = np.cumsum(lengths + 1) - 1
        self.starts = self.ends - lengths
        self.codes = self._codes(self.text)
        self._sums = None

    @staticmethod
    def _codes(text: str) -> np.ndarray:
        return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)

    def sums(self) -> np.ndarray:
        """For each class, how many of its characters stand before each word's start, and before the end of the text."""
        if self._sums is None:
            word = np.repeat(np.arange(len(self.words)), np.diff(np.append(self.starts, len(self.text))))
            counts = np.bincount(word * _CLASSES + self.codes % _CLASSES, minlength=len(self.words) * _CLASSES).reshape(-1, _CLASSES)
            self._sums = np.zeros((_CLASSES, len(self.words) + 1), dtype=np.int32)
            counts.T.cumsum(1, out=self._sums[:, 1:])
        return self._sums

    def common(self, quote: str, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Length of the longest common subsequence of the quote and each window of the text, none of them empty.

        All windows are one bit row, a bit a character and a spare one behind each
        window that takes its carry, so a character of the quote is one addition.
        """
        size = ends - starts
        first = np.cumsum(size + 1) - size - 1
        at = np.arange(first[-1] + size[-1] + 1)
        spare = first + size
        # the character at a spare bit is read but does not count
        codes = self.codes[np.minimum(at + np.repeat(starts - first, size + 1), len(self.codes) - 1)]
        inside = np.ones(len(at), dtype=bool)
        inside[spare] = False
        row = lambda bits: int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
        held = {c: row((codes == ord(c)) & inside) for c in set(quote)}
        rest = mask = row(inside)
        for c in quote:
            if use := rest & held[c]:
                rest = (rest + use | rest - use) & mask
        bits = np.unpackbits(np.frombuffer(rest.to_bytes(len(at) // 8 + 1, "little"), dtype=np.uint8), bitorder="little")[: len(at)]
        return size - np.add.reduceat(bits, first, dtype=np.int64)

    def holds_nearly(self, quote: str, threshold: float = FUZZY_THRESHOLD, autojunk: bool = True) -> bool:
        """Whether a window is as similar to the normalised quote as the threshold asks, by matching blocks.

        Matching blocks never hold more of a character than either side has, so
        the sums of the classes' lesser counts bound the ratio from above; for
        all windows at once they come from differences of running sums. Matching
        blocks are also a common subsequence, so the longest one bounds the ratio
        of what is left. Only windows that may reach the threshold are compared.
        """
        n = len(quote.split())
        if not n or n > len(self.words):
            return False
        step, last = max(1, n // 4), len(self.words) - n + 1
        own = np.bincount(self._codes(quote) % _CLASSES, minlength=_CLASSES).astype(np.int32)
        used = np.flatnonzero(own)
        seen: set[str] = set()
        for begin in range(0, last, 4096 * step):  # bounded memory
            end = min(begin + 4096 * step, last)
            held = self.sums()[used, begin + n : end + n : step] - self.sums()[used, begin:end:step]
            size = self.ends[begin + n - 1 : end + n - 1 : step] - self.starts[begin:end:step]
            ok = 2 * np.minimum(held, own[used, None]).sum(0) >= threshold * (size + len(quote)) - 1e-9
            part, size = np.arange(begin, end, step)[ok], size[ok]
            few = max(1, WINDOW_CHARS // int(size.max(initial=1)))
            for at in range(0, len(part), few):
                first, width = part[at : at + few], size[at : at + few]
                common = self.common(quote, self.starts[first], self.ends[first + n - 1])
                ok = 2 * common >= threshold * (width + len(quote)) - 1e-9
                for i in first[ok][np.argsort(-common[ok], kind="stable")].tolist():
                    window = self.text[self.starts[i] : self.ends[i + n - 1]]
                    if window not in seen and difflib.SequenceMatcher(None, quote, window, autojunk).ratio() >= threshold:
                        return True
                    seen.add(window)
        return False


def fuzzy_ratio_reached(quote: str, transcript: str, threshold: float = FUZZY_THRESHOLD, autojunk: bool = True) -> bool:
    """Whether a window of the transcript is as similar to the quote as the threshold asks; both normalised."""
    return Transcript(transcript).holds_nearly(quote, threshold, autojunk)


def check_claims(claims: DataFrame, transcripts: DataFrame, threshold: float = FUZZY_THRESHOLD, autojunk: bool = True) -> DataFrame:
    """claims with `quote_verified` against their video's transcript (video_id, transcript); no quote or no transcript fails.

    A video's claims meet its transcript as one row, so each transcript is
    normalised once. The row is dealt out by blocks of claims, so a long video is
    no long task. Exact matches are settled in the JVM; what is left goes to Arrow
    batches, where each transcript is made ready once a block.
    """
    claims = claims.drop("quote_verified")
    row = F.struct(*(F.col(c) for c in claims.columns))
    told = claims.groupBy("video_id").agg(F.collect_list(F.struct(row.alias("row"), normalized(F.coalesce("quote", F.lit(""))).alias("q"))).alias("told"))
    said = transcripts.select("video_id", normalized(F.coalesce("transcript", F.lit(""))).alias("t"))
    n = F.ceil(F.size("told") / CLAIM_BLOCK)
    # by hash, not by place: the order of a collected list may change when a task is run again
    blocks = F.transform(F.sequence(F.lit(1).cast("long"), n), lambda i: F.filter("told", lambda c: F.pmod(F.xxhash64(c["q"]), n) == i - 1))
    met = told.join(said, "video_id", "left").select("video_id", F.coalesce("t", F.lit("")).alias("t"), F.posexplode(blocks).alias("block", "told"))
    met = met.where(F.size("told") > 0).repartition("video_id", "block")
    met = met.withColumn("exact", F.transform("told", lambda c: contains(c["q"], F.col("t"))))
    met = met.select(F.col("told.row").alias("rows"), F.col("told.q").alias("q"), "exact", "t")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            verified = []
            for quotes, exact, text in zip(batch.column("q").to_pylist(), batch.column("exact").to_pylist(), batch.column("t")):
                transcript = Transcript(text.as_py()) if not all(exact) else None
                near = {q: transcript.holds_nearly(q, threshold, autojunk) for q in {q for q, e in zip(quotes, exact) if not e}}
                verified.append([e or near[q] for q, e in zip(quotes, exact)])
            yield pa.RecordBatch.from_arrays([batch.column("rows"), pa.array(verified, pa.list_(pa.bool_()))], names=["rows", "verified"])

    out = met.mapInArrow(work, met.select("rows", F.col("exact").alias("verified")).schema)
    return out.select(F.explode(F.arrays_zip("rows", "verified")).alias("x")).select("x.rows.*", F.col("x.verified").alias("quote_verified"))


def failures(checked: DataFrame, keys: list[str]) -> DataFrame:
    return checked.groupBy(*keys).agg(F.count_if(~F.col("quote_verified")).alias("quote_check_failures"))
