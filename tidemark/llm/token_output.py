"""Token ids in training order, as binary shards of fixed stride.

All documents, each followed by `end_id`, are one stream of tokens in the order
of `order` (columns such as a file's name and a row's number in it), cut into
sequences of `length` ids with dense numbers 0 .. n - 1. A keyed Feistel network
on the next even number of bits, walked in cycles until it falls below n,
permutes these numbers: the result is a sequence's global slot. Slot s is row
s % rows of shard s // rows, so every shard but the last has the same number of
sequences and bytes, and a reader finds any slot by two divisions.

1. Documents are encoded where they are read, and their ids written once, with
   their place in the run of consecutive rows that a task reads.
2. Runs in order give each run's first place in the stream, one small row a run.
3. Each document's ids are cut at the borders of sequences and go to the shards
   of their slots, in one shuffle; a task fills a shard of bounded size in memory
   and writes it with one sequential write.

The order depends on the key and on the input's files, not on how they are split
into partitions. A task writes a file of its own name; the index lists the files
of the tasks that were committed, so a task that runs twice does no harm, and
what others left is deleted.

Defined cases: a null text counts as empty and gives its `end_id` alone; a long
text is one row of ids; the last sequence is padded with `pad_id`; repeated rows
are written each; a null doc_id is listed as null; other columns do not matter;
an empty table gives no sequences; without `order`, rows stand in the order of
the input's partitions.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import discard, encoder, materialize, release, shared_dir
from .streams import runs


#: How hard ids are compressed on their way: with level 1 they take a fifth more.
LEVEL = 9


class Feistel:
    """A keyed permutation of 0 .. size - 1: four Feistel rounds, walked in cycles."""

    ROUNDS = 4

    def __init__(self, size: int, key: int):
        self.size = size
        self.half = max(1, ((max(size, 2) - 1).bit_length() + 1) // 2)
        self.mask = np.uint64((1 << self.half) - 1)
        self.keys = np.random.default_rng(key).integers(0, 1 << 63, self.ROUNDS, dtype=np.uint64)

    def _round(self, x: np.ndarray, k: np.uint64) -> np.ndarray:
        x = (x ^ k) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (x ^ (x >> np.uint64(32))) & self.mask

    def _pass(self, x: np.ndarray, back: bool) -> np.ndarray:
        a, b, h = x >> np.uint64(self.half), x & self.mask, np.uint64(self.half)
        for k in self.keys[::-1] if back else self.keys:
            a, b = (b ^ self._round(a, k), a) if back else (b, a ^ self._round(b, k))
        return a << h | b

    def _walk(self, x, back: bool) -> np.ndarray:
        x = np.atleast_1d(np.asarray(x, dtype=np.uint64)).copy()
        todo = np.arange(len(x))
        while len(todo):
            x[todo] = self._pass(x[todo], back)
            todo = todo[x[todo] >= self.size]
        return x

    def forward(self, x) -> np.ndarray:
        return self._walk(x, False)

    def inverse(self, x) -> np.ndarray:
        return self._walk(x, True)


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _encoded(docs: DataFrame, tokenizer_path: str, end_id: int, dtype: str) -> DataFrame:
    """(file, first, start, doc_id, n, ids): ids of every document, `start` tokens after its run (file, first) began."""
    names = ["file", "first", "start", "doc_id", "n", "ids"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, end = encoder(tokenizer_path), np.array([end_id], dtype="<u4").tobytes()
        run, row, start = None, None, 0
        for batch in batches:
            cols: list[list] = [[] for _ in names]
            for file, number, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3)):
                if run is None or file != run[0] or number != row + 1:
                    run, start = (file, number), 0
                row = number
                ids = np.frombuffer(code.encode(text.as_py() or "") + end, dtype="<u4").astype(dtype).tobytes()
                n = len(ids) // np.dtype(dtype).itemsize
                for col, v in zip(cols, (*run, start, doc_id, n, ids)):
                    col.append(v)
                start += n
            types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)
        code.memo.clear()
        release()

    return docs.mapInArrow(work, "file string, first long, start long, doc_id long, n long, ids binary")


def _pieces(ids: DataFrame, order: Feistel, length: int, rows: int, dtype: str) -> DataFrame:
    """(shard, slots, offsets, sizes, doc_ids, data): what a batch of documents has for each shard, ids compressed."""
    width = np.dtype(dtype).itemsize
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            if not batch.num_rows:
                continue
            begin, n = batch.column("place").to_numpy(), batch.column("n").to_numpy()
            first, last = begin // length, (begin + n - 1) // length
            count = last - first + 1
            doc = np.repeat(np.arange(len(n)), count)
            number = first[doc] + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            lo = np.maximum(number * length, begin[doc])
            hi = np.minimum((number + 1) * length, (begin + n)[doc])
            slot = order.forward(number).astype(np.int64)
            by = np.argsort(slot // rows, kind="stable")
            shard = (slot // rows)[by]
            cuts = np.flatnonzero(np.diff(shard, prepend=-1, append=-1)[: len(shard) + 1])
            data, ids = [], [x.as_buffer() for x in batch.column("ids")]
            for a, b in zip(cuts, cuts[1:]):
                data.append(pack.compress(b"".join(memoryview(ids[doc[k]])[(lo[k] - begin[doc[k]]) * width : (hi[k] - begin[doc[k]]) * width] for k in by[a:b])))
            ends = pa.array(cuts, pa.int32())
            lists = [pa.ListArray.from_arrays(ends, v) for v in (pa.array(slot[by]), pa.array((lo - number * length)[by]), pa.array((hi - lo)[by]), batch.column("doc_id").take(pa.array(doc[by])))]
            yield pa.RecordBatch.from_arrays([pa.array(shard[cuts[:-1]]), *lists, pa.array(data, pa.binary())], schema=pa.schema([("shard", pa.int64()), *((c, pa.list_(k)) for c, k in zip(("slots", "offsets", "sizes", "doc_ids"), kinds)), ("data", pa.binary())]))

    return ids.select("place", "n", "doc_id", "ids").mapInArrow(work, "shard long, slots array<long>, offsets array<long>, sizes array<long>, doc_ids array<long>, data binary")


def write_shards(docs: DataFrame, tokenizer_path: str, key: int = 17, length: int = 2048, end_id: int = 50256, pad_id: int = 0, rows: int = 8192, path: str | None = None, order: tuple[str, str] | None = None) -> tuple[DataFrame, str]:
    """Write all documents' sequences; returns (manifest, path).

    The manifest has slot, shard, byte_offset, n_tokens, ids_crc32 and doc_ids
    (the documents with ids in the sequence, in order). rows: sequences a shard,
    which a task holds in memory; ids take 2 bytes if the vocabulary allows.
    order: columns of docs with a file's name and a row's number in it.
    """
    spark = docs.sparkSession
    path = path or f"{shared_dir(spark)}/shards-{uuid.uuid4().hex}"
    from tokenizers import Tokenizer

    dtype = "<u2" if max(Tokenizer.from_file(tokenizer_path).get_vocab_size(), end_id + 1, pad_id + 1) <= 1 << 16 else "<u4"
    stride = length * np.dtype(dtype).itemsize
    place = [F.col(order[0]).cast("string"), F.col(order[1]).cast("long")] if order else [F.format_string("%010d", F.spark_partition_id()), F.monotonically_increasing_id()]
    source = docs.select(*place, F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ids = materialize(_encoded(source, tokenizer_path, end_id, dtype), "shard-ids", **{"compression": "zstd", "parquet.compression.codec.zstd.level": str(LEVEL)})
    # one row a run of rows that a task has read: as many as there are splits of the input
    begun = Window.orderBy("file", "first").rowsBetween(Window.unboundedPreceding, -1)
    runs_ = ids.groupBy("file", "first").agg(F.sum("n").alias("total")).withColumn("base", F.coalesce(F.sum("total").over(begun), F.lit(0)))
    runs_ = materialize(runs_, "shard-runs")
    total = runs_.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    size = -(-total // length)
    placed = ids.join(F.broadcast(runs_.select("file", "first", "base")), ["file", "first"]).withColumn("place", F.col("base") + F.col("start"))
    shards = max(1, -(-size // rows))
    filesystem, root = _filesystem(path)
    filesystem.create_dir(root, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        filesystem, root = _filesystem(path)
        attempt = TaskContext.get().taskAttemptId()
        for table, starts in runs(batches, "shard"):
            for lo, hi in zip(starts, starts[1:]):
                shard = table.column("shard")[int(lo)].as_py()
                here = min(rows, size - shard * rows)
                out = np.full(here * length, pad_id, dtype=dtype)
                filled, held = np.zeros(here, dtype=np.int64), [[] for _ in range(here)]
                for r in range(int(lo), int(hi)):
                    slots, offsets, sizes, doc_ids, data = (table.column(c)[r] for c in ("slots", "offsets", "sizes", "doc_ids", "data"))
                    slots, offsets, sizes = (x.values.to_numpy() for x in (slots, offsets, sizes))
                    data, at = np.frombuffer(unpack.decompress(data.as_py(), max_output_size=int(sizes.sum()) * (stride // length)), dtype=dtype), 0
                    for slot, offset, n, doc_id in zip((slots - shard * rows).tolist(), offsets.tolist(), sizes.tolist(), doc_ids.as_py()):
                        out[slot * length + offset : slot * length + offset + n] = data[at : at + n]
                        held[slot].append((offset, doc_id))
                        at += n
                    np.maximum.at(filled, slots - shard * rows, offsets + sizes)
                file = f"{shard:08d}-{attempt}.bin"
                with filesystem.open_output_stream(f"{root}/{file}") as f:
                    f.write(out.tobytes())
                sums = [zlib.crc32(out[i * length : i * length + n].tobytes()) for i, n in enumerate(filled.tolist())]
                found = [list(dict.fromkeys(d for _, d in sorted(x, key=lambda y: y[0]))) for x in held]
                cols = [pa.array(np.full(here, shard)), pa.array(np.arange(here)), pa.array(filled), pa.array(sums, pa.int64()), pa.array(found, pa.list_(pa.int64())), pa.array([file] * here, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, names=["shard", "place", "n_tokens", "ids_crc32", "doc_ids", "file"])

    moved = _pieces(placed, Feistel(max(1, size), key), length, rows, dtype).repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("shard")
    written = materialize(moved.mapInArrow(write, "shard long, place long, n_tokens long, ids_crc32 long, doc_ids array<long>, file string"), "shard-rows")
    discard(ids, runs_)
    files = [r["file"] for r in written.select("shard", "file").distinct().orderBy("shard").collect()]  # one row a shard
    with filesystem.open_output_stream(f"{root}/index.json") as f:
        f.write(json.dumps({"key": key, "length": length, "dtype": dtype, "pad_id": pad_id, "rows": rows, "sequences": size, "files": files}).encode())
    from pyarrow.fs import FileSelector

    for x in filesystem.get_file_info(FileSelector(root)):
        if x.path.endswith(".bin") and x.base_name not in set(files):  # of tasks that were not committed
            filesystem.delete_file(x.path)
    return written.select((F.col("shard") * rows + F.col("place")).alias("slot"), "shard", (F.col("place") * stride).alias("byte_offset"), "n_tokens", "ids_crc32", "doc_ids"), path


def read_sequences(path: str, start: int = 0, count: int | None = None) -> Iterator[np.ndarray]:
    """The padded sequences of slots start, start + 1, ...: sequential reads of the shards from there on."""
    filesystem, root = _filesystem(path)
    with filesystem.open_input_stream(f"{root}/index.json") as f:
        index = json.loads(f.read())
    rows, stride = index["rows"], index["length"] * np.dtype(index["dtype"]).itemsize
    end = index["sequences"] if count is None else min(index["sequences"], start + count)
    for shard in range(start // rows, -(-end // rows)):
        with filesystem.open_input_file(f"{root}/{index['files'][shard]}") as f:
            f.seek(max(0, start - shard * rows) * stride)
            for _ in range(max(start, shard * rows), min(end, (shard + 1) * rows)):
                yield np.frombuffer(f.read(stride), dtype=index["dtype"])
