"""Near-duplicate texts: MinHash signatures, a multi-index Hamming join, exact links.

1. Each text's set of distinct 5-word shingles is hashed (64 bits a shingle) and
   gets a signature of 64 MinHash symbols of 16 bits. Equal sets are one class,
   and only one representative of a class goes on.
2. Two sets of Jaccard similarity s differ in a symbol with probability 1 - s,
   so links lie within a signature distance T that the binomial tail gives
   (missed with probability `miss` at the threshold itself). Signatures split
   into m = T // 2 + 1 chunks; by pigeonhole a pair within T has at most one
   error in some chunk, so it shares one of the keys that leave one symbol of a
   chunk out: all pairs within T meet. Rows that share a key are compared by
   three bits of each symbol and by set size, both necessary for a link, and
   each key's connected parts leave as stars, not as pairs.
   A key that more than `hot` rows share is split into blocks, and all pairs of
   its blocks are groups of their own.
3. Components of these are the only places where links can be. Each one's
   members are first compared, on whole shingle sets, with its smallest member
   alone: those that link with it are one component already. Only the rest must
   be compared with all members, in blocks of bounded size: (rest block, block)
   pairs, in each of which pairs outside the signature limit or connected
   already need no comparison.
4. Components of the exact links are the result.

No partner or candidate is capped. What a task holds of one group is bounded:
`hot` signatures, or two blocks of shingle sets; Arrow's limit of bytes bounds
the rows that come at once, so only a single text beyond that limit exceeds it.
Defined cases: null and empty texts, or texts without words, have no set and
link with nothing; with fewer than five words the whole sequence is the one
shingle; long texts give their whole set, 8 bytes a shingle; repeated rows share
a class; rows of equal doc_id are one vertex; a null doc_id links with nothing;
other columns do not matter, and without_duplicates() keeps them whatever their
names; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import materialize, release, scratch
from .streams import runs

SYMBOLS, WORDS = 64, 5
#: Most candidate documents whose ids are broadcast to pick their texts; beyond it they are joined by shuffle.
MOST_BROADCAST = 500_000
_U = np.uint64
_GENERATOR = np.random.default_rng(20_240_607)
_FACTORS = _GENERATOR.integers(0, 1 << 63, SYMBOLS, dtype=_U) * _U(2) + _U(1)
_MASKS = _GENERATOR.integers(0, 1 << 63, SYMBOLS, dtype=_U)
_STEP = _U(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: multiply and shift until every bit depends on all."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _WordHashes(dict):
    """64-bit hashes of words, kept up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_HASHES = _WordHashes()


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; empty without words."""
    words = text.encode().lower().split() if text else []  # bytes: A-Z alone and ASCII white space alone
    if not words:
        return np.zeros(0, dtype=_U)
    h = np.fromiter(map(_HASHES.__getitem__, words), dtype=_U, count=len(words))
    k = min(WORDS, len(h))
    n = len(h) - k + 1
    out = np.full(n, k, dtype=_U)
    for i in range(k):
        out *= _STEP
        out += h[i : i + n]
    return np.unique(mix64(out))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(len(sets), SYMBOLS) of 16-bit symbols; every set must have elements."""
    flat, starts = np.concatenate(sets), np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), SYMBOLS), dtype=np.uint16)
    for k in range(SYMBOLS):
        least = np.minimum.reduceat((flat ^ _MASKS[k]) * _FACTORS[k], starts)
        out[:, k] = mix64(least) & _U(0xFFFF)
    return out


def distance_limit(similarity: float, miss: float = 1e-6) -> int:
    """The least distance that a pair of just this similarity exceeds with at most this probability."""
    p, tail, t = 1 - similarity, 1.0, -1
    while tail > miss:
        t += 1
        tail -= math.comb(SYMBOLS, t) * p**t * (1 - p) ** (SYMBOLS - t)
    return t


def _sets(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, f1, f2, signature); without words the last three are null."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("signature", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                sets = [shingles(t.as_py()) for t in batch.column(1)]
                full = [s for s in sets if len(s)]
                found = iter(signatures(full)) if full else iter(())
                cols: list[list] = [[], [], [], []]
                for s in sets:
                    cols[0].append(len(s))
                    # sums of mixed hashes identify a set in any order
                    cols[1].append(int(mix64(s ^ _STEP).sum(dtype=_U).astype(np.int64)) if len(s) else None)
                    cols[2].append(int(mix64(s + _STEP).sum(dtype=_U).astype(np.int64)) if len(s) else None)
                    cols[3].append(next(found).tobytes() if len(s) else None)
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, f.type) for c, f in zip(cols, [*schema][1:]))], schema=schema)
        _HASHES.clear()
        release()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(work, "doc_id long, n_shingles long, f1 long, f2 long, signature binary")


def chunks(limit: int) -> list[range]:
    """Runs of symbols such that a pair within the limit has one with at most one error."""
    m = min(limit // 2 + 1, SYMBOLS)
    cuts = [SYMBOLS * i // m for i in range(m + 1)]
    return [range(a, b) for a, b in zip(cuts, cuts[1:])]


def _keyed(reps: DataFrame, limit: int) -> DataFrame:
    """Each representative under each of its keys, with three bit planes of its signature."""
    schema = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("n", pa.int64()), ("p0", pa.int64()), ("p1", pa.int64()), ("p2", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                ids, n = batch.column("id").to_numpy(), batch.column("n").to_numpy()
                sig = np.frombuffer(b"".join(batch.column("signature").to_pylist()), dtype=np.uint16).reshape(-1, SYMBOLS).astype(_U)
                planes = _planes(sig)
                for c in chunks(limit):
                    for out in c:
                        key = np.full(len(ids), out + 1, dtype=_U)
                        for p in c:
                            if p != out:
                                key = key * _STEP + sig[:, p] + _U(1)
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (mix64(key).astype(np.int64), ids, n, *planes)], schema=schema)

    return reps.mapInArrow(work, "key long, id long, n long, p0 long, p1 long, p2 long")


def _near(p: list[np.ndarray], n: np.ndarray, i, others, limit: int, percent: int) -> np.ndarray:
    """Which of the others may link with i, by signature planes and set sizes."""
    d = np.bitwise_count((p[0][i] ^ p[0][others]) | (p[1][i] ^ p[1][others]) | (p[2][i] ^ p[2][others]))
    small, large = np.minimum(n[i], n[others]), np.maximum(n[i], n[others])
    return (d <= limit) & (100 * small >= percent * large)


def _planes(signatures: np.ndarray) -> list[np.ndarray]:
    """Three bits of each symbol, as one 64-bit plane for each bit."""
    s = signatures.astype(_U)
    return [((s >> _U(b) & _U(1)) << np.arange(SYMBOLS, dtype=_U)).sum(axis=1, dtype=_U).astype(np.int64) for b in range(3)]


def _split(reps: DataFrame, limit: int, hot: int) -> DataFrame:
    """The keyed rows, those of hot keys under keys of pairs of blocks.

    Keys are counted on a sixteenth of the rows. That decides on the plan alone:
    rows that share a key meet under one of its pairs of blocks all the same.
    """
    keyed = _keyed(reps, limit)
    some = _keyed(reps.where(F.pmod(F.xxhash64("id", F.lit("some")), F.lit(16)) == 0), limit)
    blocks = F.ceil(16 * F.col("count") / hot).cast("int")
    keys = materialize(some.groupBy("key").count().where(F.col("count") >= max(2, hot // 32)).select(F.col("key").alias("hot_key"), blocks.alias("blocks")), "near-hot")
    n = keys.count()
    if not n:
        return keyed
    keys = F.broadcast(keys) if n <= MOST_BROADCAST else keys
    met = keyed.join(keys, keyed["key"] == keys["hot_key"])
    met = met.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks"))).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.withColumn("key", F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")))
    return keyed.join(keys, keyed["key"] == keys["hot_key"], "left_anti").unionByName(met.select(keyed.columns))


def _stars(keyed: DataFrame, limit: int, percent: int) -> DataFrame:
    """Edges (a, b) that connect, key by key, the rows within the signature and size limits."""

    def near(p, n, i, others):
        return _near(p, n, i, others, limit, percent)

    def parts(p, n, ids, lo, hi, edges):
        """Connected parts of rows lo .. hi, each as a star around its smallest id."""
        left = np.arange(lo, hi)
        while len(left) > 1:
            part, front, left = [left[0]], [left[0]], left[1:]
            while front and len(left):
                hit = near(p, n, front.pop(), left)
                new = left[hit]
                left = left[~hit]
                part += new.tolist()
                front += new.tolist()
            if len(part) > 1:
                members = ids[part]
                root = members.min()
                edges.append(np.stack([members[members != root], np.full((members != root).sum(), root)]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in runs(batches, "key"):
            ids, n = (table.column(c).to_numpy() for c in ("id", "n"))
            p = [table.column(c).to_numpy().view(_U) for c in ("p0", "p1", "p2")]  # unsigned: bits of a negative number are counted in its absolute value
            sizes, edges = np.diff(starts), []
            two = starts[:-1][sizes == 2]  # most groups that are any
            if len(two):
                ok = near(p, n, two, two + 1)
                edges.append(np.stack([np.maximum(ids[two], ids[two + 1])[ok], np.minimum(ids[two], ids[two + 1])[ok]]))
            for g in np.flatnonzero(sizes > 2):
                parts(p, n, ids, starts[g], starts[g + 1], edges)
            if edges:
                a, b = np.unique(np.concatenate(edges, axis=1), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(work, "a long, b long").distinct()


def _candidates(docs: DataFrame, parts: DataFrame) -> DataFrame:
    """(root, node, n, p0, p1, p2, set) of the documents in candidates' components, their shingle hashes sorted."""
    picked = F.broadcast(parts) if parts.count() <= MOST_BROADCAST else parts
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("string").alias("text")).join(picked, "node").select("root", "node", "text")
    names = ["root", "node", "n", "p0", "p1", "p2", "set"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                sets = [shingles(t.as_py()) for t in batch.column("text")]
                has = [i for i, s in enumerate(sets) if len(s)]
                if not has:
                    continue
                sets = [sets[i] for i in has]
                kept = batch.take(pa.array(has))
                n = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(np.concatenate(sets).astype(np.int64)))
                planes = _planes(signatures(sets))
                yield pa.RecordBatch.from_arrays([kept.column("root"), kept.column("node"), pa.array(n), *map(pa.array, planes), lists], names=names)
        _HASHES.clear()
        release()

    return texts.mapInArrow(work, "root long, node long, n long, p0 long, p1 long, p2 long, set array<long>")


def _direct(candidates: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """(node, root) of the members that link with the smallest member of their component: one comparison each, in the JVM."""
    spread = candidates.select("root", "node", "n", "set").join(sizes.select("root", "salts"), "root")
    first = spread.where("node = root").select("root", F.col("n").alias("m"), F.col("set").alias("first"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    others = spread.where("node <> root").withColumn("salt", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int"))
    same = F.size(F.array_intersect("set", "first"))
    close = F.when(100 * F.least("n", "m") >= percent * F.greatest("n", "m"), 100 * same >= percent * (F.col("n") + F.col("m") - same))
    return others.join(first, ["root", "salt"]).where(close).select("node", "root").distinct()


def _links(groups: DataFrame, limit: int, percent: int) -> DataFrame:
    """A spanning forest (a, b) of the exact links in each group of rows (grp, rest, node, settled, n, p0, p1, p2, set).

    Rows of `rest` are compared with the group's other rows; `settled` ones are connected already.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in runs(batches, "grp"):
            out: tuple[list, list] = ([], [])
            rest, settled = (np.array(table.column(c).to_pylist(), dtype=bool) for c in ("rest", "settled"))
            node, n = table.column("node").to_numpy(), table.column("n").to_numpy()
            p = [table.column(c).to_numpy().view(_U) for c in ("p0", "p1", "p2")]
            lists = table.column("set").combine_chunks()
            ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy().view(_U)
            own = lambda i: flat[ends[i] : ends[i + 1]]
            for lo, hi in zip(starts, starts[1:]):
                rows = np.arange(lo, hi)
                ask, all_ = rows[rest[lo:hi]], rows[~rest[lo:hi]]
                root: dict = {}

                def find(x):
                    while root.get(x, x) != x:
                        root[x] = x = root.get(root[x], root[x])
                    return x

                name = lambda i: "settled" if settled[i] else int(node[i])  # noqa: E731  what is settled is one part
                for x in ask:
                    others = all_[settled[all_] | (node[all_] < node[x])]
                    for y in others[_near(p, n, x, others, limit, percent)]:
                        a, b = find(name(x)), find(name(y))
                        if a == b:
                            continue
                        u, v = own(x), own(y)
                        at = np.minimum(np.searchsorted(u, v), len(u) - 1)
                        same = int((u[at] == v).sum())
                        if 100 * same >= percent * (len(u) + len(v) - same):
                            root[a] = b
                            out[0].append(node[x])
                            out[1].append(node[y])
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["a", "b"])

    return groups.repartition("grp").sortWithinPartitions("grp").mapInArrow(work, "a long, b long")


def _groups(candidates: DataFrame, direct: DataFrame, sizes: DataFrame, block: int) -> DataFrame:
    """The rows of every (rest block, block) pair of the components that have a rest."""
    settled = direct.select("node", F.lit(True).alias("hit"))
    marked = candidates.join(settled, "node", "left").withColumn("settled", F.coalesce("hit", F.col("node") == F.col("root"))).drop("hit")
    in_blocks = lambda n: F.ceil(n / block).cast("int")
    rest = marked.where("NOT settled").groupBy("root").agg(in_blocks(F.count("*")).alias("rests"))
    # a table of its own, so that the join with it can split a large component's rows
    plan = materialize(rest.join(sizes.select("root", in_blocks(F.col("size")).alias("blocks")), "root"), "near-plan")
    spread = marked.join(plan, "root")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    ask = spread.where("NOT settled").withColumn("i", F.pmod(F.xxhash64("node"), F.col("rests"))).withColumn("j", each("blocks"))
    all_ = spread.withColumn("j", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks"))).withColumn("i", each("rests"))
    grp = F.xxhash64("root", F.col("i").cast("long"), F.col("j").cast("long")).alias("grp")
    columns = ["node", "settled", "n", "p0", "p1", "p2", "set"]
    return ask.select(grp, F.lit(True).alias("rest"), *columns).unionByName(all_.select(grp, F.lit(False).alias("rest"), *columns))


def duplicates(docs: DataFrame, percent: int = 85, block: int = 64, miss: float = 1e-6, hot: int = 16_384) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document; links are similarities of at least `percent` hundredths."""
    limit = distance_limit(percent / 100, miss)
    with scratch() as keep:
        sets = keep(materialize(_sets(docs), "near-sets"))
        reps = sets.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("f1", "f2").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("signature").alias("signature"))
        reps = materialize(reps, "near-reps")
        stars = materialize(_stars(_split(reps.select("id", "n", "signature"), limit, hot), limit, percent), "near-stars")
        parts = components(stars, "near-parts")
        candidates = materialize(_candidates(docs, parts), "near-candidates")
        sizes = candidates.groupBy("root").agg(F.count("*").alias("size"))
        sizes = materialize(sizes.withColumn("salts", F.ceil(F.col("size") / 4096).cast("int")), "near-sizes")
        direct = materialize(_direct(candidates, sizes, percent), "near-direct")
        links = materialize(_links(_groups(candidates, direct, sizes, block), limit, percent), "near-links")
        linked = components(links.unionByName(direct.select(F.col("node").alias("a"), F.col("root").alias("b"))), "near-linked")
        classes = reps.select("f1", "f2", "id").join(linked, F.col("id") == F.col("node"), "left").select("f1", "f2", F.coalesce("root", "id").alias("component_id"))
        classes = keep(materialize(classes, "near-classes"))
    out = sets.drop("signature").join(classes, ["f1", "f2"], "left").withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def without_duplicates(docs: DataFrame, percent: int = 80, **options) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id, with the columns of docs.

    Rows that repeat an id leave one row, the one whose text comes first; rows
    without an id stay. The rows to drop are joined by id, so with few of them
    no text moves.
    """
    found = duplicates(docs, percent, **options)
    dropped = materialize(found.where("NOT kept").select("doc_id").distinct(), "near-dropped")
    dropped = F.broadcast(dropped) if dropped.count() <= MOST_BROADCAST else dropped
    kept = docs.join(dropped, docs["doc_id"].cast("long") == dropped["doc_id"], "left_anti")
    repeated = materialize(found.where("kept AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "near-repeated")
    if not repeated.count():
        return kept
    again = kept.join(repeated, kept["doc_id"].cast("long") == repeated["doc_id"], "left_semi")
    first = again.groupBy("doc_id").agg(F.min(F.struct(*(F.col(c) for c in ("text", *(c for c in docs.columns if c not in ("text", "doc_id")))))).alias("row"))
    first = first.select(*(F.col(c) if c == "doc_id" else F.col("row")[c].alias(c) for c in docs.columns))
    return kept.join(repeated, kept["doc_id"].cast("long") == repeated["doc_id"], "left_anti").unionByName(first)
