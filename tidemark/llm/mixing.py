"""Mixing sources to target weights by entropy balancing, in DataFrame operations alone.

Document rates r minimise the entropy sum_i size_i (r_i log r_i - r_i + 1) under
0 <= r <= `most`, with two token constraints a source: the words taken are its
target, and their mean length band (floor of log2 of the document's size) moves
from the source's own mean towards the whole table's, by `pull` of the way but at
most one band; that second one is soft, with weight 1 / `ridge`, so the two can
always be met. The convex dual has two multipliers a source and its solution
tilts documents exponentially: r_i = min(most, exp(l + m z_i)), z_i being the
document's band less its source's mean. Gradient and Hessian of the dual are sums
over a source's bands, which are counted in one distributed aggregate; the Newton
steps then run for all sources in parallel, a source's few dozen bands being one
row. At the end l alone is settled by halving, so that the words add up to the
target whatever the bound on r does.

Rates become copies: every document gets floor(r) copies and some one more. Who
does follows one rule for all sizes: in order of size, a class of equal documents
takes as many extra copies as the rounded cumulative sum of fractions grows by,
so the words left over are at most one largest text. What is left is then paid by
single copies of a few classes of each band, from large to small, so that less
than a smallest text remains. Within a class extra copies go by hash rank,
counted in buckets of bounded size, so neither a hot source nor thousands of
equal documents meet in one task.

Defined cases: a null text has size 0 and takes 0; a null source is a source of
its own, last in order; sources of size 0 have target 0; repeated rows count
each; long texts count whole; reruns agree, since ranks come from hashes of the
id; an empty table gives no rows; other columns are kept out of mix()'s result,
and mixed() keeps them whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import ASCII_SPACE, materialize, scratch

#: Weights of the sources in order, repeating. Fixed values.
WEIGHTS = (5.0, 2.0, 1.0)


def word_count(text: Column) -> Column:
    """Number of words between ASCII white space; 0 for null."""
    bare = F.trim(F.coalesce(text, F.lit("")), F.lit(ASCII_SPACE))
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, r"[\x09-\x0D\x20]+"))).cast("long")


def band(size: Column) -> Column:
    """Length band: floor of log2 of the size, 0 for the empty ones too."""
    return F.floor(F.log2(F.greatest(size, F.lit(1)).cast("double"))).cast("long")


def targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """(skey, source, source_size, target): weighted shares, none above `most` times its source's size.

    Sources are ranked in ranges of their order, so no task holds all of them.
    The level up to which sources of one weight fill is raised until none of
    those below their caps is above it, one aggregate a step.
    """
    sources = sizes.groupBy("skey", "source").agg(F.sum("size").alias("source_size"))
    order = F.col("source").asc_nulls_last()
    ranged = materialize(sources.repartitionByRange(order).withColumn("part", F.spark_partition_id()), "mix-sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))  # one row a partition
    rank = F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    ranked = ranged.join(F.broadcast(parts), "part").withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int")))
    ranked = materialize(ranked.select("skey", "source", "source_size", "weight", (most * F.col("source_size")).alias("cap")), "mix-ranked")
    level = -1.0
    while True:
        full = F.col("cap") <= level * F.col("weight")
        capped, open_, total = ranked.agg(F.sum(F.when(full, F.col("cap")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight"))), F.sum("source_size")).first()
        raised = (share * total - capped) / open_ if open_ else level
        if not raised > level:
            break
        level = raised
    return ranked.select("skey", "source", "source_size", F.least(F.col("cap"), F.lit(level) * F.col("weight")).alias("target"))


def _bound(value: Column, use) -> Column:
    """use(value), the value being computed once: what stands inside a lambda is evaluated anew at each place."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def rates(classes: DataFrame, sources: DataFrame, most: float = 2.0, pull: float = 0.25, ridge: float = 1.0, iterations: int = 30) -> DataFrame:
    """(skey, source_size, target, band, rate) from classes (skey, size, n) and their sources' targets.

    Newton steps on the dual of the source's two constraints, two unknowns each.
    """
    words = (F.col("size") * F.col("n")).cast("double")
    cells = classes.groupBy("skey", band(F.col("size")).alias("band")).agg(F.sum(words).alias("words"))
    overall = cells.agg(F.sum(F.col("band") * F.col("words")) / F.nullif(F.sum("words"), F.lit(0.0))).first()[0] or 0.0
    profile = cells.groupBy("skey").agg(F.collect_list(F.struct("band", "words")).alias("cells"), F.coalesce(F.sum(F.col("band") * F.col("words")) / F.nullif(F.sum("words"), F.lit(0.0)), F.lit(0.0)).alias("mean"))
    both = profile.join(sources, "skey")
    both = both.withColumn("shift", F.greatest(F.least(pull * (F.lit(overall) - F.col("mean")), F.lit(1.0)), F.lit(-1.0)))
    both = both.withColumn("cells", F.transform("cells", lambda c: F.struct(c["band"].alias("band"), (c["band"] - F.col("mean")).alias("z"), c["words"].alias("words"))))
    target, shift = F.col("target"), F.col("shift")
    rate = lambda l, m, z: F.least(F.lit(most), F.exp(l + m * z))  # noqa: E731, E741

    def sums(l: Column, m: Column) -> Column:  # noqa: E741
        """Words taken and their moment, and the derivatives: bands at the bound do not move."""
        zero = F.struct(*(F.lit(0.0).alias(x) for x in ("s0", "s1", "d0", "d1", "d2")))

        def add(a: Column, c: Column) -> Column:
            def with_rate(r: Column) -> Column:
                w, z = c["words"] * r, c["z"]
                free = F.when(r < most, w).otherwise(0.0)
                return F.struct((a["s0"] + w).alias("s0"), (a["s1"] + w * z).alias("s1"), (a["d0"] + free).alias("d0"), (a["d1"] + free * z).alias("d1"), (a["d2"] + free * z * z).alias("d2"))

            return _bound(rate(l, m, c["z"]), with_rate)

        return F.aggregate("cells", zero, add)

    def step(state: Column, _: Column) -> Column:
        def with_sums(x: Column) -> Column:
            g1, g2 = target - x["s0"], target * shift - x["s1"] - ridge * target * state["m"]
            h11, h12, h22 = x["d0"], x["d1"], x["d2"] + ridge * target
            det = h11 * h22 - h12 * h12
            clip = lambda v: F.greatest(F.least(v, F.lit(0.5)), F.lit(-0.5))
            # with all bands at the bound there is no slope: back off if that is too much
            dl = F.when(det > 0, (g1 * h22 - g2 * h12) / det).when(g1 < 0, F.lit(-0.5)).otherwise(0.0)
            dm = F.when(det > 0, (h11 * g2 - h12 * g1) / det).when(h22 > 0, g2 / h22).otherwise(0.0)
            return F.struct((state["l"] + clip(dl)).alias("l"), (state["m"] + clip(dm)).alias("m"))

        return _bound(sums(state["l"], state["m"]), with_sums)

    def halve(state: Column, _: Column) -> Column:
        def with_middle(l: Column) -> Column:  # noqa: E741
            under = sums(l, F.col("dual")["m"])["s0"] < target
            return F.struct(F.when(under, l).otherwise(state["lo"]).alias("lo"), F.when(under, state["hi"]).otherwise(l).alias("hi"))

        return _bound((state["lo"] + state["hi"]) / 2, with_middle)

    start = F.struct(F.log(target / F.nullif(F.col("source_size"), F.lit(0))).alias("l"), F.lit(0.0).alias("m"))
    both = both.withColumn("dual", F.when((target > 0) & (F.col("source_size") > 0), F.aggregate(F.sequence(F.lit(1), F.lit(iterations)), start, step)))
    at = F.aggregate(F.sequence(F.lit(1), F.lit(64)), F.struct((F.col("dual")["l"] - 40).alias("lo"), (F.col("dual")["l"] + 40).alias("hi")), halve)["hi"]
    both = both.withColumn("l", F.when(F.col("dual").isNotNull(), at))
    out = both.select("skey", "source_size", "target", F.col("dual.m").alias("m"), "l", F.explode("cells").alias("c"))
    # a target at its cap leaves no choice
    at = F.when(target <= 0, 0.0).when(target >= most * F.col("source_size"), F.lit(most)).otherwise(rate(F.col("l"), F.col("m"), F.col("c.z")))
    return out.select("skey", "source_size", "target", F.col("c.band").alias("band"), at.alias("rate"), "m", "c.z")


def _plan(base: DataFrame, share: float, most: float, weights: tuple[float, ...], **options) -> DataFrame:
    """(skey, size, n, source_size, target, whole, extra) of every class of equal source and size: `whole` copies for each document and `extra` more among them."""
    classes = materialize(base.groupBy("skey", "source", "size").agg(F.count("*").alias("n")), "mix-classes")
    sources = targets(classes.select("skey", "source", (F.col("size") * F.col("n")).alias("size")), share, most, weights)
    found = materialize(rates(classes.select("skey", "size", "n"), sources.drop("source"), most, **options).drop("m", "z"), "mix-rates")
    c = classes.select("skey", "size", "n", band(F.col("size")).alias("band")).join(found, ["skey", "band"])
    c = c.withColumn("whole", F.floor("rate").cast("long")).withColumn("fraction", F.col("rate") - F.floor("rate"))
    # running sums of fractions by size: over bands and spans of sizes first, then within each
    c = c.withColumn("span", F.floor(F.col("size") / 1024)).withColumn("part", F.col("fraction") * F.col("n"))
    spans = c.groupBy("skey", "span").agg(F.sum("part").alias("span_part"))
    before = Window.partitionBy("skey").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("skey", "span", F.coalesce(F.sum("span_part").over(before), F.lit(0.0)).alias("part_before"))
    within = Window.partitionBy("skey", "span").orderBy("size")
    c = c.join(spans, ["skey", "span"]).withColumn("upto", F.col("part_before") + F.sum("part").over(within))
    grown = F.floor(F.col("upto") + 0.5) - F.floor(F.col("upto") - F.col("part") + 0.5)
    # a text without words has nothing to owe
    c = c.withColumn("extra", F.when(F.col("size") == 0, 0).otherwise(F.greatest(F.least(grown, F.col("n")), F.lit(0))).cast("long"))
    c = materialize(c.select("skey", "band", "size", "n", "source_size", "target", "whole", "part", "extra"), "mix-rounded")
    owed = c.groupBy("skey").agg(F.sum((F.col("part") - F.col("extra")) * F.col("size")).alias("owed"))
    # copies that may be added or taken back, in the four classes of each band that have most of them
    up = F.when(F.col("whole") + 1 <= most, F.col("n") - F.col("extra")).otherwise(0)
    down = F.when(F.col("extra") > 0, F.col("extra")).when(F.col("whole") >= 1, F.col("n")).otherwise(0)
    few = c.where("size > 0").withColumn("up", up).withColumn("down", down)
    few = few.withColumn("place", F.row_number().over(Window.partitionBy("skey", "band").orderBy(F.greatest("up", "down").desc(), "size"))).where("place <= 4")
    smaller = Window.partitionBy("skey").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    words = lambda copies: F.coalesce(F.sum(F.col(copies) * F.col("size")).over(smaller), F.lit(0)).cast("double")
    few = few.select("skey", "size", "up", "down", words("up").alias("up_words"), words("down").alias("down_words"))
    few = few.groupBy("skey").agg(F.sort_array(F.collect_list(F.struct("size", "up", "down", "up_words", "down_words")), asc=False).alias("few")).join(owed, "skey")

    def pay(state: Column, x: Column) -> Column:
        size, adds = x["size"].cast("double"), state["owed"] >= 0

        def with_whole(p: Column) -> Column:
            rest = F.abs(state["owed"]) - p * size
            # one more if smaller texts cannot pay the rest, but can take back what is then too much
            pays, takes = F.when(adds, x["up_words"]).otherwise(x["down_words"]), F.when(adds, x["down_words"]).otherwise(x["up_words"])
            more = (rest > pays + 1e-6) & ((size - rest <= takes) | (size - rest < rest - pays))
            return F.least(p + more.cast("double"), F.when(adds, x["up"]).otherwise(x["down"]).cast("double")) * F.when(adds, 1.0).otherwise(-1.0)

        with_paid = lambda p: F.struct((state["owed"] - p * size).alias("owed"), F.concat(state["paid"], F.array(F.struct(x["size"].alias("size"), p.cast("long").alias("more")))).alias("paid"))
        return _bound(_bound(F.floor(F.abs(state["owed"]) / size + 1e-6).cast("double"), with_whole), with_paid)

    start = F.struct(F.col("owed").cast("double").alias("owed"), F.array().cast("array<struct<size:bigint,more:bigint>>").alias("paid"))
    paid = few.select("skey", F.explode(F.aggregate("few", start, pay)["paid"]).alias("x")).select("skey", "x.size", "x.more")
    out = c.join(paid, ["skey", "size"], "left").withColumn("extra", F.col("extra") + F.coalesce("more", F.lit(0)))
    less = (F.col("extra") < 0).cast("long")  # some have a whole copy less
    return out.select("skey", "source_size", "target", (F.col("whole") - less).alias("whole"), "size", "n", (F.col("extra") + less * F.col("n")).alias("extra"))


def _key() -> Column:
    """A key by source that null sources have too."""
    return F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))


def _copies(docs: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[float, ...] = WEIGHTS, bucket: int = 250, **options) -> DataFrame:
    """(doc_id, skey, size, source_size, target, copies) of every document; further options as in rates()."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), _key().alias("skey"), word_count(F.col("text").cast("string")).alias("size"), F.xxhash64(F.col("doc_id").cast("long")).alias("hash"))
    with scratch() as keep:
        base = materialize(base, "mix-sizes")
        plan = materialize(_plan(base, share, most, weights, **options), "mix-plan")
        rows = base.drop("source").join(plan, ["skey", "size"])
        buckets = F.greatest(F.ceil(F.col("n") / bucket), F.lit(1))
        rows = keep(materialize(rows.withColumn("bucket", F.pmod("hash", buckets)), "mix-rows"))
    # of a class in several buckets, each bucket gives the extra copies between its first and last place
    counted = rows.where((F.col("n") > bucket) & (F.col("extra") > 0) & (F.col("extra") < F.col("n"))).groupBy("skey", "size", "bucket", "n", "extra").agg(F.count("*").alias("here"))
    upto = F.sum("here").over(Window.partitionBy("skey", "size").orderBy("bucket"))
    share_at = lambda at: F.floor(F.col("extra") * at / F.col("n"))
    counted = counted.select("skey", "size", "bucket", (share_at(upto) - share_at(upto - F.col("here"))).alias("given"))
    ranked = rows.join(counted, ["skey", "size", "bucket"], "left")
    rank = F.row_number().over(Window.partitionBy("skey", "size", "bucket").orderBy("hash", "doc_id"))
    copies = F.col("whole") + (rank <= F.coalesce("given", "extra")).cast("long")
    return ranked.select("doc_id", "skey", "size", "source_size", "target", copies.alias("copies"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies) of every document; options as in _copies()."""
    return _copies(docs, **options).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """docs with every row as often as the mix takes it, all columns kept.

    Copies are decided on ids and sizes alone; texts move once, to meet their
    copies. Rows that agree in id, source and size share what these were given.
    """
    given = materialize(_copies(docs, **options).groupBy("doc_id", "skey", "size").agg(F.sum("copies").alias("copies"), F.count("*").alias("rows")), "mix-copies")
    own = {c: f"own_{i}_" for i, c in enumerate(docs.columns)}
    key = [F.col("doc_id").cast("long").alias("left_id"), _key().alias("left_key"), word_count(F.col("text").cast("string")).alias("left_size")]
    left = docs.select(*(F.col(c).alias(n) for c, n in own.items()), *key)
    # always by sort-merge: both sides grow with the documents, so no size of them is one to broadcast
    both = left.join(given.hint("merge"), F.col("left_id").eqNullSafe(F.col("doc_id")) & (F.col("left_key") == F.col("skey")) & (F.col("left_size") == F.col("size")))
    times = F.col("copies")
    if not given.where("rows > 1").isEmpty():
        place = F.row_number().over(Window.partitionBy("left_id", "left_key", "left_size").orderBy("left_size"))
        times = F.floor(F.col("copies") / F.col("rows")) + (place <= F.col("copies") % F.col("rows")).cast("long")
    both = both.withColumn("times", times).where("times > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    return both.select(*(F.col(n).alias(c) for c, n in own.items()))
