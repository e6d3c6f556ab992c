"""Token counts of every prefix of a text by dynamic programming.

For BPE the encoding of a prefix ends in exactly one token t for which the rest
of the prefix is itself an encoding that t may follow, that is, the last token
of the rest and t stay two tokens when encoded together. So
count[k] = count[k - len(t)] + 1, and one pass over the text gives the exact
count at every prefix; truncation and budget questions are then look-ups.

With word ends (a suffix on a word's last symbol) a prefix that ends inside a
word has the suffix on its own last symbol. The pass therefore keeps, for each
position, the last token without the suffix (which longer prefixes build on) and
finds the one with the suffix for the answer. Words never merge across white
space, so the pass runs a word at a time and equal short words share its result.

Characters that the normaliser joins (a letter and a combining mark, say) are
taken by clusters, between which nothing joins: a prefix that ends within a
cluster differs from the whole word's prefix in its last characters alone, which
are added to the states before them.

Memory: what is kept between words are words of at most SHORT characters, bounded
in number; a long word takes a few arrays of its own length, for as long as it is
counted.
"""

from __future__ import annotations

import functools
import math
import re
import struct
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import byte_symbols

#: Unicode White_Space. Fixed values.
SPACE = "\t\n\x0b\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The splitting pattern of the word-end vocabulary. Fixed values.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+").findall
END = "</w>"
#: How a vocabulary must normalise and split texts, as its file says it. Fixed values.
SPLITTING = (
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
)
#: Longest words and pieces, in characters, whose results are kept for others.
SHORT = 40


class PrefixCounter:
    """Prefix token counts under a byte-level BPE vocabulary with word ends."""

    def __init__(self, path: str, bound: int = 300_000):
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = file["model"]
        if (file["normalizer"], file["pre_tokenizer"], model["end_of_word_suffix"], model["continuing_subword_prefix"], model["byte_fallback"], model["ignore_merges"]) != (*SPLITTING, END, None, False, False):
            raise ValueError(f"{path}: prefixes are counted for byte-level BPE with word ends, split as SPLITTING says")
        self.vocab = model["vocab"]
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {m: i for i, m in enumerate(merges)}
        self.made = {a + b: (i, (a, b)) for i, (a, b) in reversed([*enumerate(merges)])}
        self.edges: tuple[dict, dict] = ({}, {})
        self.nodes: dict[str, tuple[str, int, int]] = {}
        self.longest = max(map(len, self.vocab))
        #: by token without word end: 1 if it is a token as it is, plus 2 if it is one with a word end
        self.kinds: dict[str, int] = {}
        for t in self.vocab:
            ended = t.endswith(END) and t != END
            key = t[: -len(END)] if ended else t
            self.kinds[key] = self.kinds.get(key, 0) | (2 if ended else 1)
        #: all ends of tokens: a run of symbols that is none of them ends no token
        self.tails = frozenset(t[i:] for t in self.kinds for i in range(len(t)))
        self.symbol = byte_symbols()
        self.bound = bound
        self.units: dict[str, bytes] = {}
        self.latin_units: dict[str, bytes] = {}
        self.stays: dict[tuple[str, str], bool] = {}
        self.split = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+").findall
        latin = [chr(i) for i in range(256)]
        letters, numbers = ("".join(c for c in latin if regex.match(rf"\p{{{k}}}", c)) for k in "LN")
        space = "\t\n\x0b\f\r \x85\xa0"
        self.latin = re.compile(rf" ?(?:'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{space}{letters}{numbers}]+)|[{space}]+").findall
        self.special = re.compile("|".join(re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()))

    def _edge(self, token: str, side: int) -> list[tuple[str, float]]:
        """The symbols at one edge of a token as it is merged, each with the rank of the merge that replaces it.

        side 0: its left edge, side 1: its right edge.
        """
        found = self.edges[side].get(token)
        if found is None:
            if token in self.made:
                rank, parts = self.made[token]
                before = self._edge(parts[side], side)
                found = [*before[:-1], (before[-1][0], rank), (token, math.inf)]
            else:
                found = [(token, math.inf)]
            self.edges[side][token] = found
        return found

    def _follows(self, a: str, b: str) -> bool:
        """Whether tokens a and b, encoded together, stay a and b.

        They do unless, while each is being merged, the symbols that meet at
        their border form a merge that comes before the next one of either.
        """
        found = self.stays.get((a, b))
        if found is None:
            left, right = self._edge(a, 1), self._edge(b, 0)
            i = j = 0
            found = True
            while True:
                (x, till_x), (y, till_y) = left[i], right[j]
                r = self.rank.get((x, y), math.inf)
                if r < till_x and r <= till_y and r < math.inf:  # of equal merges the left one comes first
                    found = False
                    break
                if till_x == till_y == math.inf:
                    break
                if till_x <= till_y:
                    i += 1
                else:
                    j += 1
            if len(self.stays) > self.bound:
                self.stays.clear()
            self.stays[a, b] = found
        return found

    def piece(self, piece: str) -> tuple[int, ...]:
        """Counts after each code point of one piece of the splitting pattern."""
        if len(piece) > 1 and piece[0] == "'" and piece[1].isalpha():
            # a contraction: cut short, its quote and letters are pieces of their own
            quote, whole = self.piece("'")[0], self._dp(piece)[-1]
            out = (quote, *(quote + c for c in self._dp(piece[1:])[:-1]), whole)
        else:
            out = self._dp(piece)
        return out

    def _step(self, s: str, last: list, inner: list, ended: list, first: int = 0) -> None:
        """Add the state of one more prefix: its last token and count without word end, and its count with it.

        The lists hold the states of the prefixes before, from prefix `first` of
        the word on; s is the word from there, as far as the new prefix goes.
        """
        kinds, tails, follows, k = self.kinds, self.tails, self._follows, len(last)
        token, n, m = "", 0, 0
        for j in range(k - 1, -1, -1):
            t = s[j:k]
            if t not in tails:
                break
            kind = kinds.get(t)
            if kind:
                start = first + j == 0
                if not n and kind & 1 and (start or follows(last[j], t)):
                    token, n = t, inner[j] + 1
                if not m and kind & 2 and (start or follows(last[j], t + END)):
                    m = inner[j] + 1
                if n and m:
                    break
        last.append(token)
        inner.append(n)
        ended.append(m)

    def _states(self, s: str) -> tuple[list, list, list]:
        """The states of all prefixes of a word, the empty one first."""
        last, inner, ended = [""], [0], [0]
        for _ in s:
            self._step(s, last, inner, ended)
        return last, inner, ended

    def _node(self, s: str) -> tuple[str, int, int]:
        """The state of a short prefix, kept for all words that begin with it."""
        node = self.nodes.get(s)
        if node is None:
            kinds, tails, follows, k = self.kinds, self.tails, self._follows, len(s)
            last, inner, ended = "", 0, 0
            for j in range(k - 1, -1, -1):
                t = s[j:]
                if t not in tails:
                    break
                kind = kinds.get(t)
                if not kind:
                    continue
                before = (self.nodes.get(s[:j]) or self._node(s[:j])) if j else _START
                if not inner and kind & 1 and (not j or follows(before[0], t)):
                    last, inner = t, before[1] + 1
                if not ended and kind & 2 and (not j or follows(before[0], t + END)):
                    ended = before[1] + 1
                if inner and ended:
                    break
            if len(self.nodes) > 2 * self.bound:
                self.nodes.clear()
            node = self.nodes[s] = (last, inner, ended)
        return node

    def _symbols(self, text: str) -> str:
        return "".join([self.symbol[b] for b in text.encode()])

    def _dp(self, piece: str) -> tuple[int, ...]:
        plain = piece.isascii() and piece.isprintable()
        if len(piece) <= SHORT and plain:
            known, node = self.nodes.get, self._node
            return tuple([(known(p) or node(p))[2] for p in [piece[:k] for k in range(1, len(piece) + 1)]])
        s = piece if plain else self._symbols(piece)
        if len(s) <= SHORT:
            ended = [0, *(self._node(s[:k])[2] for k in range(1, len(s) + 1))]  # shorter prefixes first: no look-up nests deeply
        else:
            ended = self._states(s)[2]
        if len(s) == len(piece):
            return tuple(ended[1:])
        return tuple([ended[k] for k in np.cumsum([len(c.encode()) for c in piece]).tolist()])

    def unit(self, unit: str) -> bytes:
        """Steps of the count at each code point of a word with its white space before, as 16-bit integers."""
        word = unit.lstrip(_SPACES)
        if not word:
            return bytes(2 * len(unit))
        low = "".join(map(str.lower, word))
        if len(low) == len(word) and unicodedata.is_normalized("NFC", word):
            counts = self._counted(low)
        else:
            counts = self._clustered(word)
        return bytes(2 * (len(unit) - len(word))) + np.diff(np.array(counts), prepend=0).astype("<i2").tobytes()

    def _counted(self, word: str) -> list[int]:
        """Counts after each code point of a normalised word."""
        counts, base = [], 0
        for p in PIECES(word):
            counts += [base + c for c in self.piece(p)]
            base = counts[-1]
        return counts

    def _clustered(self, word: str) -> list[int]:
        """Counts after each code point of a word that the normaliser changes."""
        starts = [i for i, c in enumerate(word) if not i or not _joins(c)]
        clusters = [word[a:b] for a, b in zip(starts, [*starts[1:], len(word)])]
        normal = lambda x: "".join(map(str.lower, unicodedata.normalize("NFC", x)))
        parts = [normal(c) for c in clusters]
        whole = "".join(parts)
        table = [0, *self._counted(whole)]
        bounds = [0, *np.cumsum([len(p) for p in PIECES(whole)]).tolist()]
        states: dict[int, tuple] = {}
        counts, at, piece = [], 0, 0
        for cluster, part in zip(clusters, parts):
            while bounds[piece + 1] < at:
                piece += 1  # the piece that holds the character before this cluster
            for m in range(1, len(cluster)):
                x = normal(cluster[:m])
                if part.startswith(x):
                    counts.append(table[at + len(x)])
                else:
                    counts.append(self._with_tail(whole, table, bounds, piece, states, at, x))
            at += len(part)
            counts.append(table[at])
        return counts

    def _with_tail(self, whole: str, table: list, bounds: list, piece: int, states: dict, at: int, tail: str) -> int:
        """The count of whole[:at] + tail."""
        begin = bounds[piece]
        if at - begin <= SHORT:  # from the piece before, if a contraction could begin there
            if piece and begin - bounds[piece - 1] <= 3:
                begin = bounds[piece - 1]
            return table[begin] + sum(self.piece(p)[-1] for p in PIECES(whole[begin:at] + tail))
        # a long piece goes on from its states at the character before
        if piece not in states:
            states.clear()
            text = whole[begin : bounds[piece + 1]]
            states[piece] = (self._symbols(text), *self._states(self._symbols(text)), np.concatenate([[0], np.cumsum([len(c.encode()) for c in text])]))
        s, last, inner, ended, offsets = states[piece]
        k = int(offsets[at - begin])
        first, *others = PIECES("".join(c for c in whole[at - SHORT // 2 : at]).lstrip("'") + tail)
        own = first[len(whole[at - SHORT // 2 : at].lstrip("'")) :]
        low = max(0, k - self.longest)
        last, inner, ended = last[low : k + 1], inner[low : k + 1], ended[low : k + 1]
        text = s[low:k] + self._symbols(own)
        for _ in range(len(text) - (k - low)):
            self._step(text, last, inner, ended, low)
        return table[begin] + ended[-1] + sum(self.piece(p)[-1] for p in others)

    def _missing(self, unit: str) -> bytes:
        """Steps of one lower-case Latin-1 piece with at most one space before, or of white space."""
        word = unit.lstrip(_SPACES)
        blank = bytes(2 * (len(unit) - len(word)))
        if word:
            counts = self.piece(word)
            blank += struct.pack(f"<{len(counts)}h", counts[0], *map(int.__sub__, counts[1:], counts))
        if len(unit) <= SHORT:
            if len(self.latin_units) > 2.5 * self.bound:
                self.latin_units.clear()
            self.latin_units[unit] = blank
        return blank

    def _plain(self, text: str) -> bytes:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            pass
        else:  # lower case keeps lengths here, and nothing is joined or split
            known, found = self.latin_units, self.latin(text.lower())
            try:
                return b"".join(map(known.__getitem__, found))
            except KeyError:
                return b"".join([known.get(u) or self._missing(u) for u in found])
        units, out = self.units, []
        for u in self.split(text):
            step = units.get(u)
            if step is None:
                step = self.unit(u)
                if len(u) <= SHORT:
                    if len(units) > self.bound:
                        units.clear()
                    units[u] = step
            out.append(step)
        return b"".join(out)

    def steps(self, text: str) -> np.ndarray:
        """Change of the count at each code point; the counts are its running sums."""
        if "<|" not in text or not (found := list(self.special.finditer(text))):
            return np.frombuffer(self._plain(text), dtype="<i2")
        out, at = [], 0
        for m in found:
            # up to its last character a special string is ordinary text; there it becomes one token
            part = np.frombuffer(self._plain(text[at : m.end() - 1]), dtype="<i2").astype(np.int64)
            before = int(np.frombuffer(self._plain(text[at : m.start()]), dtype="<i2").sum())
            out += [part, np.array([before + 1 - part.sum()])]
            at = m.end()
        return np.concatenate([*out, np.frombuffer(self._plain(text[at:]), dtype="<i2")])

    def table(self, text: str) -> np.ndarray:
        """The exact token count of text[:k] for k = 0 .. len(text)."""
        return np.concatenate([[0], np.cumsum(self.steps(text), dtype=np.int64)])


@functools.cache
def _seconds() -> frozenset[str]:
    """Characters that the normaliser may join with one before them, besides combining marks."""
    found = (unicodedata.decomposition(chr(i)).split(" ") for i in range(sys.maxunicode + 1))
    jamo = (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))  # Hangul syllables are composed by rule
    return frozenset((*(chr(int(d[1], 16)) for d in found if len(d) == 2 and not d[0].startswith("<")), *map(chr, jamo)))


def _joins(c: str) -> bool:
    """Whether a character, or what it is decomposed into, may join with or move before the one in front of it."""
    if c.isascii():
        return False
    first = unicodedata.normalize("NFD", c)[0]
    return bool(unicodedata.combining(first)) or first in _seconds()


_START = ("", 0, 0)
_SPACES = "\t\n\x0b\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_COUNTERS: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def fitting(table: np.ndarray, limit: int) -> int:
    """The longest prefix, in code points, whose count is at most limit."""
    if table[-1] <= limit:
        return len(table) - 1
    return int(np.flatnonzero(table <= limit)[-1])


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 2048, with_steps: bool = False) -> DataFrame:
    """Per document n_bytes, n_tokens, over_limit and fit_chars, and the steps of its prefix table on request.

    fit_chars is the longest prefix of at most `limit` tokens, read from the
    table. A null text counts as empty (0 tokens); repeated rows give repeated
    rows; a null doc_id is kept; other columns are ignored.
    """
    names = ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"] + ["steps"] * with_steps
    types = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64()] + [pa.binary()] * with_steps

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(tokenizer_path)
        for batch in batches:
            rows = []
            for text in batch.column(1):
                text = text.as_py() or ""
                steps = c.steps(text)
                n = int(steps.sum(dtype=np.int64))
                fit = len(text) if n <= limit else fitting(np.concatenate([[0], np.cumsum(steps, dtype=np.int64)]), limit)
                rows.append((len(text.encode()), n, n > limit, fit, steps.astype("<i2").tobytes() if with_steps else None))
            cols = [batch.column(0), *(list(x) for x in zip(*rows))][: len(names)] if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) if not isinstance(v, pa.Array) else v for v, t in zip(cols, types)], names=names)

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long" + ", steps binary" * with_steps
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(work, schema)
