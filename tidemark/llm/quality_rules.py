"""Quality rules in SQL functions alone: counts, repetition, distribution divergence.

A document's histogram of character classes and its histogram of common words
are compared with references of its language by Jensen-Shannon distance (base 2,
0 to 1). The references are the languages' own distributions over the whole
table: a first pass writes each document's counts, small rows, and their sums by
language are the references. Documents under `min_words` words are too short for
a distribution and only the base rules hold for them.

Defined cases: a null or empty text has no words, so the base rules fail it; a
null or unknown language is a language of its own, with the words of all
lists; repeated rows count each for itself; long texts are counted whole, in
arrays of some 60 bytes a word; other columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import ASCII_SPACE, materialize

#: Common words by language. Fixed values.
COMMON = {
    "en": "the of and to in is that it for on with as was by be are this from at an".split(),
    "de": "der die und das von zu den mit sich des auf für ist im dem nicht ein eine als auch".split(),
    "fr": "le la les de des et en un une du que qui dans pour par sur est au ce pas".split(),
    "es": "el la los las de que y en un una del se por con para es al lo su como".split(),
}
#: Symbols that the base rule counts. Fixed values.
SYMBOLS = "#*$%&|<>"
#: Character classes: (name, characters) counted by removal; letters by case follow from what changes. Fixed values.
CLASSES = (("digit", "0123456789"), ("symbol", SYMBOLS), ("shout", "!?"), ("stop", ".,;:"), ("space", ASCII_SPACE), ("bracket", "()[]{}\"'/\\-_+=@~^`"), ("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZÄÖÜÀÂÇÉÈÊËÎÏÔÙÛÁÍÓÚÑ"))
WINDOW = 5
#: Runs of lower-case letters, none of which is in CLASSES. Fixed value.
LOWER = "[a-zß-öø-ÿ]+"


def words_of(text: Column) -> Column:
    """Words between ASCII white space; an empty array without any."""
    bare = F.trim(text, F.lit(ASCII_SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x09-\x0D\x20]+"))


def _without(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _with_repeats(df: DataFrame) -> DataFrame:
    """Add `twice`: positions, in order, of the windows that occur twice or more.

    Only where the distinct hashes are fewer than the windows are positions
    sorted by hash and neighbours compared. Each step is a column of its own:
    an expression inside a lambda is evaluated anew for every element.
    """
    # hashes of words, of pairs, of pairs of pairs, then of five words: three cheap steps an element
    zipped = lambda a, b, k: F.zip_with(a, F.slice(b, k, F.greatest(F.size(b) - (k - 1), F.lit(0))), lambda x, y: F.xxhash64(x, y))
    df = df.withColumn("h1", F.transform("words", lambda w: F.xxhash64(w))).withColumn("h2", zipped("h1", "h1", 2))
    df = df.withColumn("h4", zipped("h2", "h2", 3))
    # zip_with pads the shorter side: what lies beyond the last whole window goes
    df = df.withColumn("hashes", F.slice(zipped("h4", "h1", WINDOW), F.lit(1), F.greatest(F.size("h1") - (WINDOW - 1), F.lit(0))))
    df = df.withColumn("placed", F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    h = lambda i: F.get("placed", i)["h"]
    df = df.withColumn("marked", F.transform("placed", lambda x, i: F.when((x["h"] == h(i - 1)) | (x["h"] == h(i + 1)), x["i"])))
    return df.withColumn("twice", F.sort_array(F.filter("marked", lambda p: p.isNotNull())))


def counts(docs: DataFrame, symbols: str = SYMBOLS) -> DataFrame:
    """Base counts and histograms of every document: one scan, no shuffle."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), text.alias("text"))
    base = base.withColumn("words", words_of(F.col("text")))
    base = _with_repeats(base)
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.trim(x, F.lit(ASCII_SPACE)) != "")
    base = base.withColumn("lines", lines)
    listed = F.lit(None).cast("array<string>")
    everything = sorted({w for ws in COMMON.values() for w in ws})
    for lang, ws in COMMON.items():
        listed = F.when(F.col("lang") == lang, F.array(*map(F.lit, ws))).otherwise(listed)
    base = base.withColumn("common", F.filter("words", lambda w: w.isin(everything)))
    # lower-case letters are most of a text: classes are counted in what remains without them
    base = base.withColumn("rest", F.regexp_replace("text", LOWER, ""))
    base = base.withColumn("listed", F.coalesce(listed, F.array(*map(F.lit, everything))))
    return base.select(
        "doc_id",
        "lang",
        F.size("words").cast("long").alias("n_words"),
        (F.length("text") - _without(F.col("rest"), ASCII_SPACE)).cast("long").alias("word_chars"),
        _without(F.col("rest"), symbols).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.aggregate(
            F.transform("twice", lambda p, i: F.least(F.coalesce(F.get("twice", i + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)).cast("long")),
            F.lit(0).cast("long"),
            lambda a, x: a + x,
        ).alias("n_repeat_words"),
        F.array(*(_without(F.col("rest"), chars).cast("double") for _, chars in CLASSES), F.length("text").cast("double")).alias("classes"),
        F.transform("listed", lambda w: (F.size("common") - F.size(F.array_remove("common", w))).cast("double")).alias("common"),
    )


def _distribution(counted: Column, total: Column) -> Column:
    """Shares of the counted parts and of the rest."""
    rest = F.greatest(total - F.aggregate(counted, F.lit(0.0), lambda a, x: a + x), F.lit(0.0))
    return F.transform(F.concat(counted, F.array(rest)), lambda x: x / F.greatest(total, F.lit(1.0)))


def jensen_shannon(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance, base 2, of two distributions given as arrays of equal length."""
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    divergence = F.aggregate(F.zip_with(p, q, lambda x, y: (part(x, (x + y) / 2) + part(y, (x + y) / 2)) / 2), F.lit(0.0), lambda a, x: a + x)
    return F.sqrt(F.greatest(divergence, F.lit(0.0)))


def judge(docs: DataFrame, class_limit: tuple[float, float] = (0.14, 0.9), word_limit: tuple[float, float] = (0.12, 1.7), min_words: int = 40) -> DataFrame:
    """Counts, distances and verdict of every document.

    A limit (a, b) stands for a distance of a + b / sqrt(n_words): short texts
    scatter more around their language's distribution.
    """
    counted = materialize(counts(docs), "quality-counts")
    counted = counted.withColumn("lang_key", F.coalesce("lang", F.lit("\0")))
    n_classes, n_common = len(CLASSES), max(map(len, [*COMMON.values(), {w for ws in COMMON.values() for w in ws}]))
    n = F.col("n_words")
    failed = (n < 10) | (100 * F.col("n_repeat_words") > 20 * n)
    # junk must not shape the references: only texts that pass the base rules and hold few symbols do
    plain = counted.where(~failed & (50 * F.col("n_symbols") <= F.col("word_chars")))
    sums = plain.groupBy("lang_key").agg(
        F.array(*(F.sum(F.col("classes")[i]) for i in range(n_classes + 1))).alias("ref_classes"),
        F.array(*(F.coalesce(F.sum(F.get("common", F.lit(i))), F.lit(0.0)) for i in range(n_common))).alias("ref_common"),
        F.sum("n_words").cast("double").alias("ref_words"),
    )
    both = counted.join(sums, "lang_key", "left")
    classes = lambda c: _distribution(F.slice(F.col(c), 1, n_classes), F.col(c)[n_classes])
    common = lambda c, n: _distribution(F.slice(F.col(c), F.lit(1), F.size("common")), F.col(n).cast("double"))
    beyond = lambda c, limit: F.col(c) > limit[0] + limit[1] / F.sqrt(n)
    distant = (n >= min_words) & (beyond("class_distance", class_limit) | beyond("word_distance", word_limit))
    near = lambda d: F.coalesce(d, F.lit(0.0))  # noqa: E731  a language without a reference has nothing to be distant from
    both = both.withColumn("class_distance", near(jensen_shannon(classes("classes"), classes("ref_classes")))).withColumn("word_distance", near(jensen_shannon(common("common", "n_words"), common("ref_common", "ref_words"))))
    return both.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & ~distant).alias("kept"), "class_distance", "word_distance")
