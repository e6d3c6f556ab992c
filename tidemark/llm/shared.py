"""Storage and tokenizer helpers that the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import json
import os
import re
import sys
import tempfile
import uuid
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

#: ASCII white space as the operators see it: \x20 and \x09-\x0D.
ASCII_SPACE = " \t\n\x0b\f\r"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as spark.checkpoint.dir names it.

    Where that setting is absent, a temporary folder of this machine serves a
    session that runs on this machine alone; on a cluster it is an error.
    """
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir")
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = getattr(sc, "_tidemark_shared", None)
        if not found:
            found = sc._tidemark_shared = "file://" + tempfile.mkdtemp(prefix="tidemark-")
    return found.rstrip("/")


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back.

    This cuts the lineage: a lost executor costs no recomputation beyond the
    stage that is running.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._tidemark_path = path
    if _SCRATCH:
        _SCRATCH[-1].append(table)
    return table


#: Tables written inside scratch(), by its nesting.
_SCRATCH: list[list[DataFrame]] = []


@contextlib.contextmanager
def scratch() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Delete the tables that are written meanwhile, but for those that are given to the function it returns."""
    kept: list[DataFrame] = []

    def keep(table: DataFrame) -> DataFrame:
        kept.append(table)
        return table

    _SCRATCH.append([])
    try:
        yield keep
    finally:
        made = _SCRATCH.pop()
        discard(*(t for t in made if not any(t is k for k in kept)))


def discard(*tables: DataFrame) -> None:
    """Delete tables of materialize() that nothing reads any more; a table that is a result stays."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table._tidemark_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release() -> None:
    """Give back the memory that a task has freed: its Python worker lives on for other stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable bytes stand for themselves, the others follow from U+0100."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class MemoEncoder:
    """Byte-level BPE ids of whole texts, encoded piece by piece.

    Byte-level BPE never merges across the pieces of its splitting pattern, so
    the ids of a text are those of its pieces in order, and pieces repeat a lot.
    A piece's ids are kept, up to `bound` pieces. New pieces are merged by
    tiktoken's core over the ranks of the tokenizers file itself, which gives the
    ids of the tokenizers library several times faster; a vocabulary whose ids
    do not follow its merges, and texts with special strings, go to the library,
    and so does every text if the file normalises or splits texts otherwise.
    Pieces over SHORT characters are not kept, so `bound` also bounds the bytes.
    """

    #: How a file must split texts for its pieces to be those of PIECES. Fixed values.
    SPLITTING = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    SHORT = 64

    #: The splitting pattern of byte-level BPE. Fixed values.
    PIECES = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str, bound: int = 300_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.bound = bound
        self.memo: dict[str, bytes] = {}
        self.single = self._core(path)
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        self.by_pieces = file["normalizer"] is None and file["pre_tokenizer"] == self.SPLITTING and not file["model"].get("ignore_merges")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        latin = [chr(i) for i in range(256)]
        named = {
            r"\p{L}": "".join(c for c in latin if regex.match(r"\p{L}", c)),
            r"\p{N}": "".join(c for c in latin if regex.match(r"\p{N}", c)),
            r"\s": "".join(c for c in latin if regex.match(r"\p{White_Space}", c)),
        }
        esc = {k: re.escape(v) for k, v in named.items()}
        # the same pattern over Latin-1 with plain classes: several times faster
        self.latin = re.compile(
            rf"'(?:[sdmt]|ll|ve|re)| ?[{esc[r'\p{L}']}]+| ?[{esc[r'\p{N}']}]+"
            rf"| ?[^{esc[r'\s']}{esc[r'\p{L}']}{esc[r'\p{N}']}]+"
            rf"|[{esc[r'\s']}]+(?![^{esc[r'\s']}])|[{esc[r'\s']}]+"
        ).findall
        self.any = regex.compile(self.PIECES.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"(?!\S)", r"(?!\P{White_Space})")).findall

    @staticmethod
    def _core(path: str):
        """tiktoken's merge of one piece over the file's vocabulary, or None if ids do not follow the merges."""
        import tiktoken

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, merges = model["vocab"], [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        made = [vocab.get(a + b) for a, b in merges]
        if len(set(made)) != len(made) or None in made or made != sorted(made):
            return None
        byte = {c: b for b, c in enumerate(byte_symbols())}
        known = {*made, *(vocab[c] for c in byte if c in vocab)}
        ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if i in known}
        return tiktoken.Encoding("pieces", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._encode_single_piece

    def _fresh(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of pieces that are not kept yet; the short ones are kept from now on."""
        fresh = [p for p in set(pieces) if p not in self.memo]
        if self.single and sys.byteorder == "little":
            found = {p: array("I", self.single(p)).tobytes() for p in fresh}
        else:
            found = {p: np.array(e.ids, dtype="<u4").tobytes() for p, e in zip(fresh, self.tokenizer.encode_batch_fast(fresh, add_special_tokens=False))}
        short = {p: ids for p, ids in found.items() if len(p) <= self.SHORT}
        if len(self.memo) + len(short) > self.bound:
            found |= {p: self.memo[p] for p in set(pieces) if p in self.memo}
            self.memo.clear()
        self.memo |= short
        return found

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not self.by_pieces or any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        try:
            text.encode("latin-1")
            pieces = self.latin(text)
        except UnicodeEncodeError:
            pieces = self.any(text)
        known = self.memo
        try:
            return b"".join(map(known.__getitem__, pieces))
        except KeyError:
            found = self._fresh(pieces)
            return b"".join([known[p] if p in known else found[p] for p in pieces])


_ENCODERS: dict[str, MemoEncoder] = {}


def encoder(path: str) -> MemoEncoder:
    """One encoder a process and file: a reused Python worker keeps its pieces."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _ENCODERS:
        _ENCODERS[path] = MemoEncoder(path)
    return _ENCODERS[path]
