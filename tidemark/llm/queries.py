"""The queries of this subpackage: each applies one operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import mixing, near_duplicates, near_vectors, packing, personal_data, quality_model, quality_rules, token_counts, token_output, toxicity


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.digest(personal_data.find_spans(_documents(spark, sf_dir)))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.duplicates(_documents(spark, sf_dir))


def op4_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_model.verdicts(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged.select("doc_id", "lang", "bits", F.pow(F.lit(2.0), "bits").alias("perplexity"), "bits_limit", "kept")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_documents(spark, sf_dir))


def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text", "_metadata.file_path", "_metadata.row_index")
    return token_output.write_shards(docs, _vocabulary("byte_bpe_50k.json"), order=("file_path", "row_index"))[0]


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = _documents(spark, sf_dir), F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    machine = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), held_out=held_out)
    return toxicity.score(docs, machine).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_documents(spark, sf_dir), _vocabulary("word_bpe_49k.json"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_documents(spark, sf_dir)).drop("class_distance", "word_distance")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_documents(spark, sf_dir), _vocabulary("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_vectors": op1_near_vectors,
    "op2_personal_data": op2_personal_data,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_quality_model": op4_quality_model,
    "op5_mixing": op5_mixing,
    "op6_token_output": op6_token_output,
    "op7_toxicity": op7_toxicity,
    "op8_token_counts": op8_token_counts,
    "op9_quality_rules": op9_quality_rules,
    "op10_packing": op10_packing,
}


def _rules_sql() -> str:
    """The rules in SQL: base counts by windows of words, distances by lists."""
    quoted = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]"
    everything = sorted({w for ws in quality_rules.COMMON.values() for w in ws})
    listed = "CASE lang " + " ".join(f"WHEN '{k}' THEN {quoted(ws)}" for k, ws in quality_rules.COMMON.items()) + f" ELSE {quoted(everything)} END"
    gone = lambda chars: "length(rest) - length(translate(rest, '" + chars.replace("'", "''") + "', ''))"
    classes = ", ".join(gone(chars) for _, chars in quality_rules.CLASSES)
    shares = lambda counted, total: f"list_transform(list_append({counted}, greatest({total} - list_sum({counted}), 0)), lambda x: x / greatest({total}, 1)::DOUBLE)"
    term = "CASE WHEN z[{i}] > 0 THEN z[{i}] * log2(z[{i}] / ((z[1] + z[2]) / 2)) ELSE 0 END"
    distance = lambda p, q: f"sqrt(greatest(list_sum(list_transform(list_zip({p}, {q}), lambda z: ({term.format(i=1)} + {term.format(i=2)}) / 2)), 0))"
    sums = lambda c, n: "[" + ", ".join(f"sum(coalesce({c}[{i}], 0))::DOUBLE" for i in range(1, n + 1)) + "]"
    return rf"""
WITH d AS (SELECT doc_id, coalesce(lang, chr(0)) AS lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, regexp_replace(coalesce(text, ''), '{quality_rules.LOWER}', '', 'g') AS rest FROM documents),
p AS (SELECT doc_id, unnest(w) AS v, generate_subscripts(w, 1) AS i FROM d),
g AS (SELECT doc_id, i, v || ' ' || lead(v, 1) OVER z || ' ' || lead(v, 2) OVER z || ' ' || lead(v, 3) OVER z || ' ' || lead(v, 4) OVER z AS g FROM p WINDOW z AS (PARTITION BY doc_id ORDER BY i)),
m AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g WHERE g IS NOT NULL) WHERE n > 1),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM m, range(5) o(k) GROUP BY doc_id),
c AS (SELECT d.doc_id, lang, CAST(len(w) AS BIGINT) AS n_words, CAST(length(rest) * 0 + list_sum(list_append(list_transform(w, lambda x: length(x)), 0)) AS BIGINT) AS word_chars,
  CAST({gone(quality_rules.SYMBOLS)} AS BIGINT) AS n_symbols, coalesce(r.n, 0) AS n_repeat_words,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines, length(t) AS size, [{classes}] AS classes,
  list_transform({listed}, lambda x: len(list_filter(w, lambda y: y = x))) AS common
  FROM d LEFT JOIN r ON r.doc_id = d.doc_id),
j AS (SELECT *, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c),
s AS (SELECT lang, {sums("classes", len(quality_rules.CLASSES))} AS rc, sum(size)::DOUBLE AS rs, {sums("common", len(everything))} AS rw, sum(n_words)::DOUBLE AS rn FROM j WHERE NOT base_failed AND 50 * n_symbols <= word_chars GROUP BY lang),
x AS (SELECT j.*, {distance(shares("classes", "size"), shares("rc", "rs"))} AS cd, {distance(shares("common", "n_words"), shares("rw[1:len(common)]", "rn"))} AS wd FROM j LEFT JOIN s ON s.lang = j.lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (n_words >= 40 AND (coalesce(cd, 0) > 0.14 + 0.9 / sqrt(greatest(n_words, 1)) OR coalesce(wd, 0) > 0.12 + 1.7 / sqrt(greatest(n_words, 1)))) AS kept
FROM x
"""


_REACHED = """
SELECT {id}, {n}, min(c) AS component_id, {id} = min(c) AS kept FROM r JOIN n USING ({id}) GROUP BY {id}, {n}
"""

ORACLE: dict[str, str] = {
    "op1_near_vectors": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
n AS (SELECT e.vec_id, count(y) AS n_links FROM embeddings e LEFT JOIN l ON x = e.vec_id GROUP BY e.vec_id),
r AS (SELECT vec_id, vec_id AS c FROM embeddings UNION SELECT r.vec_id, l.y FROM r JOIN l ON l.x = r.c)
"""
    + _REACHED.format(id="vec_id", n="n_links"),
    "op3_near_duplicates": """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, unnest(w) AS t, generate_subscripts(w, 1) AS i FROM w),
g AS (SELECT doc_id, t || ' ' || lead(t, 1) OVER z || ' ' || lead(t, 2) OVER z || ' ' || lead(t, 3) OVER z || ' ' || lead(t, 4) OVER z AS g FROM p WINDOW z AS (PARTITION BY doc_id ORDER BY i)),
u AS (SELECT doc_id, g FROM g WHERE g IS NOT NULL UNION SELECT doc_id, array_to_string(w, ' ') FROM w WHERE len(w) BETWEEN 1 AND 4),
n AS (SELECT w.doc_id, count(g) AS n_shingles FROM w LEFT JOIN u ON u.doc_id = w.doc_id GROUP BY w.doc_id),
i AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM u a JOIN u b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM i JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 85 * (a.n_shingles + b.n_shingles - k)),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT r.doc_id, l.y FROM r JOIN l ON l.x = r.c)
"""
    + _REACHED.format(id="doc_id", n="n_shingles"),
    "op9_quality_rules": _rules_sql(),
}
