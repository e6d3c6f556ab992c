"""Quality by perplexity under an interpolated modified Kneser-Ney model of UTF-8 bytes.

Any text is a sequence of 256 symbols, so every character of every script is
modelled as itself; a byte that trusted text never had in a place backs off down
to the uniform probability 1 / 257. N-grams of `order` bytes are counted over
every trusted document; their number grows with the corpus. Counts, continuation
counts, context sums, discounts and interpolation are grouped and joined tables
sharded by n-gram.

Scoring gathers the distinct n-grams of all documents and joins them with the
sharded model, order by order. The costs go back to the documents in two ways
with the same values: those of the most frequent n-grams, at most `head`, by
broadcast, all others by a join of (document, n-gram, count) rows, so that no
n-gram of that join is a hot key. Costs are whole numbers of 2^-20 bits, whose
sums do not depend on their order.

Limits come from trusted documents that the model has not seen: of every `apart`
trusted documents one, by hash of its id, is left out of the counts. Bits per
character scatter more in short texts, by about the root of the length, so the
quantile by language is that of bits - slack / sqrt(length), with three standard
errors on top where few documents give it, and a document is rejected if its own
value is beyond it. Texts of all lengths shape the limits.

Defined cases: a null or empty text has no perplexity and is rejected; a null
language, or one without trusted documents left out, takes the quantile over all
languages, and if none at all is left out, that of the documents counted; without
any trusted text nothing is rejected but empty texts; rows that repeat are
counted and scored each; labels that repeat an id make it trusted if any of them
does; a long text is scored whole, its distinct n-grams being one row; other
columns pass through, but verdicts() replaces `bits`, `bits_limit` and `kept`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialize, release, scratch

#: Symbols (what stands before a text, and the bytes) and length of n-grams.
SIZE, ORDER = 257, 5
#: Most n-grams whose costs are broadcast (16 bytes each); all others are joined by shuffle.
HEAD = 1 << 18
#: Units of cost in a bit.
UNIT = 1 << 20
#: Most trusted labels that are broadcast (ids alone, some 40 MB as a hash table); beyond it they are joined by shuffle.
MOST_LABELS = 1_000_000
#: Least scatter of trusted documents, in bits per character, that standard errors are reckoned with.
SCATTER = 0.1
#: Most languages whose limits are broadcast.
MOST_LANGUAGES = 100_000


def grams(text: str, order: int = ORDER) -> np.ndarray:
    """The n-gram code that ends at each byte; what stands before the text is symbol 0."""
    c = np.concatenate([np.zeros(order - 1, dtype=np.int64), np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8).astype(np.int64) + 1])
    n = len(c) - order + 1
    out = np.zeros(n, dtype=np.int64)
    for i in range(order):
        out *= SIZE
        out += c[i : i + n]
    return out


def trusted_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents with a label of quality 1."""
    ids = labels.where(F.col("quality").cast("int") == 1).select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    if ids.count() <= MOST_LABELS:
        ids = F.broadcast(ids)
    return docs.join(ids, docs["doc_id"] == ids["doc_id"], "left_semi")


def _counted(docs: DataFrame, order: int) -> DataFrame:
    """Occurrences (code, n) of the n-grams of all texts; each task sums up its own first, some millions at a time."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        codes, counts = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

        def add():
            new, k = np.unique(np.concatenate(held), return_counts=True)
            both, at = np.unique(np.concatenate([codes, new]), return_inverse=True)
            total = np.zeros(len(both), dtype=np.int64)
            total[at[: len(codes)]] += counts
            total[at[len(codes) :]] += k
            return both, total

        def out():
            for at in range(0, len(codes), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(codes[at : at + 100_000]), pa.array(counts[at : at + 100_000])], names=["code", "n"])

        for batch in batches:
            for text in batch.column(0):
                held.append(grams(text.as_py(), order))
                n += len(held[-1])
                if n > 1_000_000:
                    codes, counts = add()
                    held, n = [], 0
                    if len(codes) > 4_000_000:  # sums in parts: what a task holds stays bounded
                        yield from out()
                        codes, counts = codes[:0], counts[:0]
        if held:
            codes, counts = add()
        yield from out()
        held, codes, counts = [], np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        release()

    texts = docs.select(F.col("text").cast("string").alias("text")).where("text IS NOT NULL AND text <> ''")
    return texts.mapInArrow(work, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def kneser_ney(counts: DataFrame, size: int, order: int) -> list[tuple[DataFrame, DataFrame]]:
    """For orders 1 .. order: (code, p) of the seen n-grams and (context, gamma) of their contexts.

    counts: (code, n) of the highest order. p is interpolated with the lower
    order; an unseen n-gram has gamma of its context times the lower order's p.
    """
    tables = {order: counts.select("code", F.col("n").alias("c"))}
    for k in range(order - 1, 0, -1):  # continuation counts: in how many n-grams of the next order it is the end
        tables[k] = materialize(tables[k + 1].groupBy((F.col("code") % size**k).alias("code")).agg(F.count("*").alias("c")), f"lm-counts-{k}")
    out: list[tuple[DataFrame, DataFrame]] = []
    lower = None
    for k in range(1, order + 1):
        t = tables[k]
        n1, n2, n3, n4 = t.agg(*(F.coalesce(F.sum((F.col("c") == i).cast("long")), F.lit(0)).alias(f"n{i}") for i in range(1, 5))).first()
        y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        d = [max(0.0, min(0.99 * i, i - (i + 1) * y * b / a)) if a and b else 0.5 for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
        discount = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
        t = t.withColumn("context", F.floor(F.col("code") / size)).withColumn("d", F.least(discount, F.col("c") * 0.99))
        contexts = t.groupBy("context").agg(F.sum("c").alias("total"), F.sum("d").alias("held"))
        contexts = materialize(contexts.select("context", "total", (F.col("held") / F.col("total")).alias("gamma")), f"lm-contexts-{k}")
        t = t.join(contexts, "context").withColumn("suffix", F.col("code") % size ** (k - 1))
        if lower is None:
            below = F.lit(1.0 / size)
        else:
            t, below = t.join(lower.select(F.col("code").alias("suffix"), F.col("p").alias("below")), "suffix"), F.col("below")
        lower = materialize(t.select("code", ((F.col("c") - F.col("d")) / F.col("total") + F.col("gamma") * below).alias("p")), f"lm-{k}")
        out.append((lower, contexts.select("context", "gamma")))
    return out


def probabilities(wanted: DataFrame, tables: list[tuple[DataFrame, DataFrame]], size: int) -> DataFrame:
    """(code, p) of the distinct n-grams wanted (code), from the tables of kneser_ney(), order by order."""
    order = len(tables)
    need = {order: wanted.select("code")}
    for k in range(order - 1, 0, -1):
        need[k] = materialize(need[k + 1].select((F.col("code") % size**k).alias("code")).distinct(), f"lm-wanted-{k}")
    lower = None
    for k, (seen, gamma) in enumerate(tables, 1):
        t = need[k].withColumn("context", F.floor(F.col("code") / size)).withColumn("suffix", F.col("code") % size ** (k - 1))
        t = t.join(seen, "code", "left").join(gamma, "context", "left")
        if lower is None:
            below = F.lit(1.0 / size)
        else:
            t, below = t.join(lower.select(F.col("code").alias("suffix"), F.col("p").alias("below")), "suffix"), F.col("below")
        lower = materialize(t.select("code", F.coalesce("p", F.coalesce("gamma", F.lit(1.0)) * below).alias("p")), f"lm-p-{k}")
    return lower


def _costs(docs: DataFrame, trusted: DataFrame, order: int) -> DataFrame | None:
    """(code, cost, often) of every n-gram of docs, `often` by the logarithm of its count; None without any trusted text."""
    with scratch() as keep:
        counts = materialize(_counted(trusted, order), "lm-counts")
        if counts.isEmpty():
            return None
        wanted = materialize(_counted(docs, order), "lm-wanted")
        p = probabilities(wanted, kneser_ney(counts, SIZE, order), SIZE)
        cost = F.round(-F.log2(F.greatest("p", F.lit(1e-12))) * UNIT).cast("long")
        return keep(materialize(wanted.join(p, "code").select("code", cost.alias("cost"), F.floor(F.log2("n") * 8).cast("int").alias("often")), "lm-costs"))


def score(docs: DataFrame, trusted: DataFrame, order: int = ORDER, head: int = HEAD) -> DataFrame:
    """(lm_id_, lm_hash_, lm_lang_, lm_length_, bits) of every row of docs that has text; bits per character, null without a model."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("lm_id_"), F.xxhash64(F.col("text").cast("string")).alias("lm_hash_"), lang.alias("lm_lang_"), F.length("text").cast("long").alias("lm_length_"), F.col("text").cast("string").alias("text")).where("lm_length_ > 0")
    costs = _costs(docs, trusted, order)
    if costs is None:
        return rows.drop("text").withColumn("bits", F.lit(None).cast("double"))
    least, n = 1 << 20, 0
    for often, k in sorted(map(tuple, costs.groupBy("often").count().collect()), reverse=True):  # a few hundred rows at most
        n += k
        if n > head:
            break
        least = often
    found = costs.where(F.col("often") >= least).select("code", "cost").toArrow().sort_by("code")  # at most `head` rows
    held = docs.sparkSession.sparkContext.broadcast((found["code"].to_numpy(), found["cost"].to_numpy()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, cost = held.value
        if not len(codes):
            codes, cost = np.full(1, -1, dtype=np.int64), np.zeros(1, dtype=np.int64)
        # most n-grams are found in one step, by a hash; those that share their slot with another by bisection
        slot = lambda g: (g.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)
        slots = np.zeros(1 << 20, dtype=np.int32)
        slots[slot(codes)] = np.arange(len(codes), dtype=np.int32)
        for batch in batches:
            known, left, times, ends = [], [], [], [0]
            for text in batch.column("text"):
                g = grams(text.as_py(), order)
                at = slots[slot(g)]
                hit = codes[at] == g
                miss = np.flatnonzero(~hit)
                at[miss] = np.minimum(np.searchsorted(codes, g[miss]), len(codes) - 1)
                hit[miss] = codes[at[miss]] == g[miss]
                known.append(int(cost[at[hit]].sum()))
                rest, k = np.unique(g[~hit], return_counts=True)
                left.append(rest)
                times.append(k)
                ends.append(ends[-1] + len(rest))
            ends = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x), pa.int64())) for x in (left, times)] if left else [pa.array([], pa.list_(pa.int64()))] * 2
            at = batch.schema.get_field_index("text")
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(at)), pa.array(known, pa.int64()), *lists], names=[*batch.schema.names[:at], "known", "codes", "times"])
        release()

    rows = rows.mapInArrow(work, "lm_id_ long, lm_hash_ long, lm_lang_ string, lm_length_ long, known long, codes array<long>, times array<long>")
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "lm-rows")  # written: a row keeps its number
    rest = rows.select("row", F.explode(F.arrays_zip("codes", "times")).alias("x")).select("row", "x.codes", "x.times")
    rest = rest.join(costs.where(F.col("often") < least).select(F.col("code").alias("codes"), "cost"), "codes")
    rest = rest.groupBy("row").agg(F.sum(F.col("cost") * F.col("times")).alias("rest"))
    total = F.col("known") + F.coalesce("rest", F.lit(0))
    return rows.join(rest, "row", "left").select("lm_id_", "lm_hash_", "lm_lang_", "lm_length_", (total / UNIT / F.col("lm_length_")).alias("bits"))


def _apart(apart: int):
    """Whether a document is left out of the counts, by its id."""
    return F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.lit("apart")), F.lit(apart)) == 0


def verdicts(docs: DataFrame, labels: DataFrame, quantile: float = 0.995, slack: float = 6.0, apart: int = 10, **options) -> DataFrame:
    """docs with `bits`, `bits_limit` and `kept`; further options as in score()."""
    docs = docs.drop("bits", "bits_limit", "kept")
    scored = materialize(score(docs, trusted_documents(docs, labels).where(~_apart(apart)), **options), "lm-scored")
    trusted = trusted_documents(scored.withColumnRenamed("lm_id_", "doc_id"), labels).where("bits IS NOT NULL").withColumn("excess", F.col("bits") - slack / F.sqrt("lm_length_"))
    trusted = materialize(trusted.select("lm_lang_", "excess", _apart(apart).alias("left_out")), "lm-trusted")
    if not trusted.where("left_out").isEmpty():
        trusted = trusted.where("left_out")
    scatter = max(SCATTER, trusted.agg(F.coalesce(F.stddev_pop("excess"), F.lit(0.0))).first()[0])
    # a quantile of few documents is uncertain, by about the scatter over the root of their number
    at = F.percentile_approx("excess", quantile, 10_000) + 3 * scatter / F.sqrt(F.count("excess"))
    limits = materialize(trusted.groupBy("lm_lang_").agg(at.alias("lm_limit_")), "lm-limits")
    # one row a language: broadcast, so that no text moves to meet its limit, unless there are too many
    limits = F.broadcast(limits) if limits.count() <= MOST_LANGUAGES else limits
    overall = trusted.where("excess IS NOT NULL").groupBy().agg(F.when(F.count("excess") > 0, at).alias("limit")).first()["limit"]
    # rows that agree in id and text agree in bits
    scored = scored.groupBy("lm_id_", "lm_hash_").agg(F.max("bits").alias("bits"))
    own = docs.withColumn("lm_own_", F.xxhash64(F.col("text").cast("string")))
    out = own.join(scored.hint("merge"), F.col("doc_id").cast("long").eqNullSafe(F.col("lm_id_")) & (F.col("lm_own_") == F.col("lm_hash_")), "left").drop("lm_id_", "lm_hash_", "lm_own_")
    out = out.withColumn("lm_lang_", F.coalesce(F.col("lang").cast("string"), F.lit(""))).join(limits, "lm_lang_", "left").drop("lm_lang_")
    length = F.length("text")
    limit = F.coalesce("lm_limit_", F.lit(overall).cast("double")) + slack / F.sqrt(F.greatest(length, F.lit(1)))
    has_text = F.coalesce(length > 0, F.lit(False))
    return out.withColumn("bits_limit", limit).drop("lm_limit_").withColumn("kept", has_text & F.coalesce(F.col("bits") <= F.col("bits_limit"), F.lit(True)))


def filtered(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that the model accepts, with the columns of docs, whatever their names."""
    needed = ("doc_id", "text", "lang")
    names = {c: c if c in needed else f"own_{i}_" for i, c in enumerate(docs.columns)}
    kept = verdicts(docs.select(*(F.col(c).alias(n) for c, n in names.items())), labels, **options).where("kept")
    return kept.select(*(F.col(n).alias(c) for c, n in names.items()))
